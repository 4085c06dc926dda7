"""A common table expression that is read twice, computed once.

Spark reuses an exchange only while both readers' plans stay equal; with AQE
the second reader is planned anew from the first one's sizes and often isn't.
``compute_once`` materialises a summary (a row for each key, small beside its
input) in the reliable checkpoint folder, which all executors share: it
survives lost executors, and both readers start from it.  The files go when
no plan refers to them any more, if the session was built with
``spark.cleaner.referenceTracking.cleanCheckpoints`` (``build_session`` is).
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or what the context has; only a local
    session without either gets a folder of its own."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if named is None and not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="tallyforge-"))
    return (named or sc.getCheckpointDir()).rstrip("/")


def compute_once(df: DataFrame) -> DataFrame:
    """``df``, computed now; what is built on it reads the result."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()

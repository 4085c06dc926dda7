"""Shared helpers of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.once import checkpoint_folder

SPACE = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"           # the characters of SPACE
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, base_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet").select(*columns)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which all executors
    share; a private one only for local sessions (tests), an error on a
    cluster without the setting."""
    return checkpoint_folder(spark)


def counted(df: DataFrame, rows: int = 100_000, most: int | None = None) -> tuple[DataFrame, int]:
    """``df`` materialised in the shared folder, its lineage cut, and its
    rows; a lost executor loses nothing.  A small result is read in fewer
    partitions, of about ``rows`` rows, so that the steps after it stay small,
    too.  With ``most``, a bound on its rows, it is also written by as few
    tasks: each leaves two files, and for a file Hadoop's local file system
    starts a process, which for a moment shares all of its executor's memory."""
    shared_folder(df.sparkSession)
    if most is not None:
        df = df.coalesce(most // rows + 1)
    seen = Observation()
    done = df.observe(seen, F.count(F.lit(1)).alias("n")).checkpoint()
    n = seen.get["n"]
    return done.coalesce(n // rows + 1), n


def cut(df: DataFrame, rows: int = 100_000, most: int | None = None) -> DataFrame:
    return counted(df, rows, most)[0]


BROADCAST_KEYS = 1_500_000      # long keys: about 40 MB as a hash table


def few(df: DataFrame) -> DataFrame:
    """``df`` (materialised rows of a few longs), marked for broadcast if it
    has at most ``BROADCAST_KEYS`` rows; beyond, joins with it shuffle."""
    return F.broadcast(df) if df.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS else df


def semi(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows of ``df`` whose long ``on`` is among ``keys`` (materialised)."""
    return df.join(few(keys), on, "left_semi")


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop input columns whose names an operator is about to produce."""
    return df.drop(*[c for c in df.columns if c in names])


def fresh(df: DataFrame, *names: str) -> tuple[str, ...]:
    """``names``, each with as many underscores behind it as it takes to be
    none of the columns of ``df`` (Spark tells no upper from lower case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return tuple(out)


def word_list(text: Column) -> Column:
    """Whitespace-separated words of the whole text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def lower_az(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

"""tallyforge: relational and nested-report analytics as Spark DataFrame jobs.

Sub-packages
------------
sources    reading tables (column-pruned parquet scans), re-aiming the
           driver's TPC-H-like tables at the report schemas, JSON sinks
functions  Column-level helpers: conditional/signed/weighted sums, guarded
           rates, date arithmetic, correlation from moments
operators  DataFrame-level operators: anti/semi joins, summary stars,
           edge tables, substring/token joins, id lists and nested
           documents, weighted scores, factorised fan-out rewrites
plans      the report specifications (one function per report) and the
           operator catalogue run by ``__spark_entry__``
"""

__all__ = ["session"]

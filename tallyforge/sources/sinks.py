"""Sinks for report results.

``FOR JSON PATH`` in the scripts returns one JSON text for a whole result.
Here a result is written as JSON lines -- one document per row, written by
the executors in parallel -- or as parquet with the nested columns kept
as structs/arrays.  Nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.nested import to_document


def write_json_lines(df: DataFrame, path: str, keep_nulls: bool = True, mode: str = "overwrite") -> None:
    """One JSON object per row (``INCLUDE_NULL_VALUES`` when ``keep_nulls``)."""
    to_document(df, keep_nulls=keep_nulls).write.mode(mode).text(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Tabular result (nested columns stay typed) as parquet."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)

"""Parquet scans.

Every read goes through ``scan`` so that the caller names the columns it
needs: the projection reaches the parquet reader (``ReadSchema``) and any
later ``where`` is pushed into it (``PushedFilters``) by Catalyst.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(base_dir: str, name: str) -> str:
    return f"{base_dir.rstrip('/')}/{name}.parquet"


def scan(spark: SparkSession, base_dir: str, name: str,
         columns: Iterable[str] | None = None) -> DataFrame:
    """Read one table; restrict to ``columns`` when given."""
    df = spark.read.parquet(table_path(base_dir, name))
    if columns is not None:
        df = df.select(*columns)
    return df


class LazyTables(Mapping):
    """Name -> DataFrame, each built on first access.

    ``spark.read.parquet`` lists files and reads footers when it is called,
    so a query should open only the tables it touches.
    """

    def __init__(self, names: Iterable[str], make: Callable[[str], DataFrame]):
        self._names = list(names)
        self._make = make
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._cache:
            self._cache[name] = self._make(name)
        return self._cache[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def load(spark: SparkSession, base_dir: str,
         names: Iterable[str] = DRIVER_TABLES[:8]) -> LazyTables:
    """Open tables on demand; nothing is read until an action runs."""
    return LazyTables(names, lambda n: scan(spark, base_dir, n))

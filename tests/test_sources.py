"""Table scans: schema cache and lazy opening."""

import os
import tempfile
import time

from tallyforge.sources import tables


def test_schema_cache_follows_file_changes(spark):
    base = tempfile.mkdtemp(prefix="tf-src-")
    spark.createDataFrame([(1, "a")], "k bigint, v string").write.parquet(os.path.join(base, "t.parquet"))
    first = tables.scan(spark, base, "t")
    again = tables.scan(spark, base, "t", ["k"])
    assert again.columns == ["k"] and first.schema == tables.scan(spark, base, "t").schema
    time.sleep(0.01)
    spark.createDataFrame([(2, 3.5)], "k bigint, w double").write.mode("overwrite").parquet(
        os.path.join(base, "t.parquet"))
    changed = tables.scan(spark, base, "t")
    assert changed.columns == ["k", "w"] and changed.collect()[0].w == 3.5


def test_load_opens_tables_lazily(spark):
    t = tables.load(spark, "/root/testdata/sf0.001", ["region", "no_such_table"])
    assert list(t) == ["region", "no_such_table"]
    assert t["region"].count() == 5          # only the touched table is opened

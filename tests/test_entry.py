"""The driver contract in __spark_entry__."""

import __spark_entry__ as entry


def test_entry_runs_on_smoke_data(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "related_entities" in df.columns


def test_every_oracle_has_a_query_and_names_match():
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 80

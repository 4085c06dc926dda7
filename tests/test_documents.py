"""Stacked report sections and the JSON-lines sink."""

import json
import os
import tempfile
from decimal import Decimal

from tallyforge.operators.nested import section_facts
from tallyforge.sources.sinks import write_json_lines


def test_section_facts_one_row_a_field(spark):
    wide = Decimal("99999999999999999999.25")
    df = spark.createDataFrame([(1, None, 2.5, "x", None, wide), (None, "b", None, None, None, None), (7, "", 1.0, None, None, None)],
                               "k bigint, l string, n double, s string, t timestamp, d decimal(38,2)")
    rows = section_facts("sec", df, ["k", "l"], ["n", "s", "t", "d"], order=["-k"]).collect()
    got = {(r.section, tuple(r.row_key), r.position, r.field, r.number, r.exact, r.text) for r in rows}
    assert got == {("sec", ("1", None), 2, "n", 2.5, None, None), ("sec", ("1", None), 2, "s", None, None, "x"),
                   ("sec", ("1", None), 2, "d", float(wide), "99999999999999999999.25", None),
                   ("sec", ("7", ""), 1, "n", 1.0, None, None)}
    assert {r.position for r in section_facts("sec", df, [], ["n"]).collect()} == {None}
    assert section_facts("sec", df.limit(0), ["k"], ["n"]).count() == 0


def test_json_lines_sink(spark):
    df = spark.createDataFrame([(1, None, [1, 2])], "a bigint, b string, c array<bigint>")
    out = os.path.join(tempfile.mkdtemp(prefix="tf-sink-"), "docs")
    write_json_lines(df, out, keep_nulls=True)
    lines = [ln for f in sorted(os.listdir(out)) if f.endswith(".txt")
             for ln in open(os.path.join(out, f)).read().splitlines()]
    assert [json.loads(ln) for ln in lines] == [{"a": 1, "b": None, "c": [1, 2]}]

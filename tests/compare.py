"""Run ``queries()[k]`` in Spark and ``oracle_sql()[k]`` in DuckDB and
compare row count, column names/types and an order-insensitive multiset of
values.  Used by the tests and by hand:

    python -m tests.compare [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
    "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT",
}


def _duck_type(t: str) -> str:
    if t.startswith("array<") and t.endswith(">"):
        return _duck_type(t[6:-1]) + "[]"
    return SPARK_TO_DUCK.get(t, t.upper())


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict(recursive=True))
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def duck_connect(sf_dir: str):
    import duckdb
    from tallyforge.sources.tables import DRIVER_TABLES
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, key, query, sql, sf_dir):
    t0 = time.time()
    sdf = query(spark, sf_dir)
    rows = sdf.collect()
    t1 = time.time()
    s_cols = sdf.columns
    s_types = [f.dataType.simpleString() for f in sdf.schema.fields]
    res = {"key": key, "spark_rows": len(rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    rel = con.sql(sql)
    d_cols, d_types = rel.columns, [str(t) for t in rel.types]
    drows = rel.fetchall()
    res["oracle_rows"] = len(drows)
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={s_cols} oracle={d_cols}")
    else:
        dmap = dict(zip(d_cols, d_types))
        for c, t in zip(s_cols, s_types):
            want = _duck_type(t)
            if want != dmap[c]:
                problems.append(f"type {c}: spark={t} oracle={dmap[c]}")
        order = sorted(s_cols)
        si = [s_cols.index(c) for c in order]
        di = [d_cols.index(c) for c in order]
        sset = sorted((tuple(_norm(r[i]) for i in si) for r in rows), key=repr)
        dset = sorted((tuple(_norm(r[i]) for i in di) for r in drows), key=repr)
        if len(rows) != len(drows):
            problems.append(f"rows spark={len(rows)} oracle={len(drows)}")
        if sset != dset:
            sd = set(map(repr, sset)) - set(map(repr, dset))
            ds = set(map(repr, dset)) - set(map(repr, sset))
            problems.append(f"values differ: spark-only {sorted(sd)[:3]} oracle-only {sorted(ds)[:3]}")
    res["status"] = "ok" if not problems else "MISMATCH"
    if problems:
        res["problems"] = problems
    return res


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from tallyforge.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    spark = build_session("local[8]", shuffle_partitions=8, driver_memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck_connect(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for k in keys or list(qs):
        try:
            r = compare(spark, con, k, qs[k], sqls.get(k), sf_dir)
        except Exception as e:  # report and go on
            r = {"key": k, "status": "ERROR", "error": str(e).splitlines()[0][:400]}
        bad += r["status"] in ("MISMATCH", "ERROR")
        print(r, flush=True)
    print(f"{len(keys or qs) - bad} fine, {bad} bad")


if __name__ == "__main__":
    main(sys.argv)

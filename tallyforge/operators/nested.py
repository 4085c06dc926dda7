"""Nested documents: child-id arrays, arrays of objects, report sections.

Documents stay ``struct``/``array`` columns until the sink; JSON text is
produced only by ``to_document``.  Each child table is grouped on its own
key *before* it meets the parent, so joining several children never
multiplies them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegralType, NumericType, TimestampType

from ..functions.aggs import id_list
from .ordered import with_position

class Child(NamedTuple):
    """One child table feeding an id array: ``df.fk`` refers to the parent."""

    df: DataFrame
    fk: str
    id_col: str
    where: Column | None = None


def id_lists(df: DataFrame, keys: str | list[str], id_col: str | Column, out: str, text: bool = False) -> DataFrame:
    """``keys..., out``: the sorted id list of each key (STRING_AGG), NULL
    ids skipped; ``text=True`` gives comma text instead of an array.  One row
    per key, so for keys whose lists are of bounded size (an order's lines, a
    person's items); ``ids_long`` is the form for lists that grow with the
    data."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    d = df.select(*keys, (F.col(id_col) if isinstance(id_col, str) else id_col).alias("_id")).where(F.col("_id").isNotNull())
    arr = id_list("_id")
    if text:
        arr = F.array_join(F.transform(arr, lambda x: x.cast("string")), ",")
    return d.groupBy(*keys).agg(arr.alias(out))


def _children(child: Child, key: str) -> DataFrame:
    df = child.df if child.where is None else child.df.where(child.where)
    return df.select(F.col(child.fk).alias(key), F.col(child.id_col).alias("id")).where(F.col(key).isNotNull())


def ids_long(key: str, children: Mapping[str, Child]) -> DataFrame:
    """``key, field, id, occurrences``: every parent's child ids in long
    form, one row per distinct id, whatever the lists' sizes.  Counts combine
    before the shuffle, and a parent's ids are spread over all tasks."""
    out = None
    for field, ch in children.items():
        rows = (_children(ch, key).where(F.col("id").isNotNull()).groupBy(key, "id").agg(F.count(F.lit(1)).alias("occurrences"))
                .select(key, F.lit(field).alias("field"), F.col("id").cast("string").alias("id"), "occurrences"))
        out = rows if out is None else out.unionByName(rows)
    return out


def related_ids(parent: DataFrame, key: str, children: Mapping[str, Child],
                out: str = "related_entities", empty_as: str = "empty") -> DataFrame:
    """Attach ``out`` = struct of child-id arrays to every parent row.

    Each child table is grouped alone on the key and left-joined, so the
    children never multiply and every parent stays one row.  ``empty_as='empty'``
    gives ``[]`` for a parent without children (the ``ISNULL(..., '[]')`` and
    ``COALESCE(csv, '')`` forms); ``'null'`` keeps NULL.  Parents keep
    their own NULL columns.
    """
    cols = list(parent.columns)
    df = parent
    fields = []
    for field, ch in children.items():
        df = df.join(id_lists(_children(ch, key), key, "id", field), key, "left")
        c = F.col(field)
        if empty_as == "empty":
            dtype = ch.df.schema[ch.id_col].dataType.simpleString()
            c = F.coalesce(c, F.array().cast(f"array<{dtype}>"))
        fields.append(c.alias(field))
    return df.select(*[F.col(c) for c in cols], F.struct(*fields).alias(out))


def nested_objects(parent: DataFrame, key: str, child: DataFrame, fk: str,
                   cols: Sequence[str | Column], out: str,
                   order: Sequence[str] | None = None) -> DataFrame:
    """Attach ``out`` = array of child objects per parent (NULL when none).

    The correlated ``(SELECT ... WHERE child.fk = parent.key FOR JSON PATH)``
    of the text: the child is grouped on ``fk`` and left-joined, and a
    parent without children gets NULL, which ``to_json`` omits like
    ``FOR JSON`` does.  ``order`` sorts the array by those struct fields.
    Every parent stays one row and every child object comes once.
    """
    sel = [F.col(c) if isinstance(c, str) else c for c in cols]
    obj = F.struct(*sel)
    rows = child.select(F.col(fk).alias(key), obj.alias("_obj")).where(F.col(key).isNotNull())
    grouped = rows.groupBy(key).agg(F.collect_list("_obj").alias(out))
    if order:
        grouped = grouped.withColumn(out, _sort_structs(F.col(out), order))
    return parent.join(grouped, key, "left")


def _sort_structs(arr: Column, order: Sequence[str]) -> Column:
    """Sort an array of structs by the named fields (``-name`` = descending,
    NULLs first ascending and last descending, as SQL Server orders)."""
    def cmp(a, b):
        res = F.lit(0)
        for spec in reversed(order):
            desc = spec.startswith("-")
            name = spec.lstrip("-")
            x, y = a[name], b[name]
            c = (F.when(x.isNull() & y.isNull(), 0)
                  .when(x.isNull(), 1 if desc else -1)
                  .when(y.isNull(), -1 if desc else 1)
                  .when(x < y, 1 if desc else -1)
                  .when(x > y, -1 if desc else 1)
                  .otherwise(0))
            res = F.when(c != 0, c).otherwise(res)
        return res
    return F.array_sort(arr, cmp)


def section(df: DataFrame, cols: Sequence[str | Column], out: str,
            order: Sequence[str] | None = None) -> DataFrame:
    """One-row frame holding ``df`` as an array of objects (``FOR JSON PATH``
    over a whole, already aggregated section).  NULL when ``df`` is empty,
    as the text yields.  Only for sections of bounded size: the whole
    section ends up in one row, so keep large sections as tables."""
    sel = [F.col(c) if isinstance(c, str) else c for c in cols]
    arr = F.collect_list(F.struct(*sel))
    if order:
        arr = _sort_structs(arr, order)
    return df.agg(F.when(F.count(F.lit(1)) > 0, arr).alias(out))


def to_document(df: DataFrame, keep_nulls: bool = True, out: str = "document") -> DataFrame:
    """One JSON object per row.

    ``keep_nulls=True`` is ``FOR JSON PATH, INCLUDE_NULL_VALUES``; False
    omits NULL keys as plain ``FOR JSON PATH`` does.  Writing the result
    with ``write.text`` gives JSON lines (one document per row), never one
    giant string.
    """
    opts = {"ignoreNullFields": "false" if keep_nulls else "true"}
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns]), opts).alias(out))


def section_facts(name: str, df: DataFrame, keys: Sequence[str], fields: Sequence[str],
                  order: Sequence[str] | None = None) -> DataFrame:
    """A report section as rows (section, row_key, position, field, number,
    exact, text), one for each non-NULL field, so that a whole report is a
    union of sections and no row grows with the data.  ``row_key`` is the
    array of the keys' texts (NULLs kept), ``position`` the row's place in
    the section's ``order`` (``-name`` descending; NULL without one).
    Numbers come as double and, if they are decimals or integers, as exact
    text; timestamps as text."""
    def fact(c: str) -> Column:
        kind = df.schema[c].dataType
        number, exact, text = F.lit(None).cast("double"), F.lit(None).cast("string"), F.lit(None).cast("string")
        if isinstance(kind, NumericType):
            number = F.col(c).cast("double")
            exact = F.col(c).cast("string") if isinstance(kind, (DecimalType, IntegralType)) else exact
        else:
            text = F.date_format(c, "yyyy-MM-dd HH:mm:ss") if isinstance(kind, (DateType, TimestampType)) else F.col(c)
        return F.struct(F.lit(c).alias("field"), number.alias("number"), exact.alias("exact"), text.alias("text"))

    key = F.array(*[F.col(c).cast("string") for c in keys]).cast("array<string>")
    rows = with_position(df, order) if order else df.withColumn("position", F.lit(None).cast("long"))
    facts = rows.select(F.lit(name).alias("section"), key.alias("row_key"), "position", F.inline(F.array(*[fact(c) for c in fields])))
    return facts.where("number is not null or text is not null")

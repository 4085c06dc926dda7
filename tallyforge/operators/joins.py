"""Join operators.

Strategy is left to Catalyst/AQE: a side is broadcast only when its
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` (AQE
re-checks at runtime), otherwise both sides shuffle on the key and skewed
partitions are split by AQE's skew-join handling.  The helpers here only
fix the *logical* shape.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def anti(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """``LEFT JOIN right ... WHERE right.key IS NULL`` as a left-anti join.

    Same rows as the outer-join form, including NULL and dangling keys on
    the left, but Catalyst does not make that rewrite itself: the outer
    form keeps a LeftOuter join plus a Filter and carries every matched
    pair through the join.
    """
    return left.join(right, on, "left_anti")


def semi(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Rows of ``left`` with at least one partner (each left row once)."""
    return left.join(right, on, "left_semi")


def summary_star(base: DataFrame, key: str | Sequence[str],
                 summaries: Sequence[DataFrame]) -> DataFrame:
    """Left-join a chain of per-key summaries onto ``base``.

    Every summary must be unique on ``key`` (grouped by it), so the chain
    never fans out.  Because all joins use the same key, Spark keeps the
    hash partitioning of the first shuffle for the following joins (or
    broadcasts small summaries), instead of re-shuffling ``base`` each time.
    """
    out = base
    for s in summaries:
        out = out.join(s, key, "left")
    return out


def edge_both_ways(nodes: DataFrame, edges: DataFrame, node_key: str,
                   node_name: str, src: str, dst: str, kind: str,
                   out_names: tuple[str, str, str] = ("name", "relationship", "related_name"),
                   ) -> DataFrame:
    """Each edge ``src -> dst`` listed from both ends (the text's UNION ALL
    of two self-joins).

    The edge table is joined to the node names once for both ends, and
    every joined row emits its two directions through ``explode`` -- one
    pass over the edges instead of two unioned join pipelines.
    """
    a = nodes.select(F.col(node_key).alias("_a_key"), F.col(node_name).alias("_a_name"))
    b = nodes.select(F.col(node_key).alias("_b_key"), F.col(node_name).alias("_b_name"))
    named = (edges.select(F.col(src).alias("_src"), F.col(dst).alias("_dst"), F.col(kind).alias("_kind"))
             .join(a, F.col("_src") == F.col("_a_key"))
             .join(b, F.col("_dst") == F.col("_b_key")))
    n, k, r = out_names
    both = F.array(F.struct(F.col("_a_name").alias(n), F.col("_kind").alias(k), F.col("_b_name").alias(r)),
                   F.struct(F.col("_b_name").alias(n), F.col("_kind").alias(k), F.col("_a_name").alias(r)))
    return named.select(F.explode(both).alias("_e")).select(f"_e.{n}", f"_e.{k}", f"_e.{r}")


GRAM = 3      # characters of the pieces that long keys are found by


def substring_keys(text: Column, max_len: int = 10, pattern: str | None = None,
                   key_chars: str | None = None, min_len: int = 1) -> Column:
    """All distinct substrings of ``text`` with length ``min_len``..``max_len``.

    ``key_chars`` (a regex character class such as ``'[-0-9]'``) says which
    characters a key's text can contain: substrings are then enumerated
    only inside the maximal runs of those characters -- a substring that
    crosses any other character cannot equal a key.  ``pattern`` (a regex)
    then keeps only substrings shaped like a key, e.g. ``'^-?[0-9]+$'``.
    Empty or NULL text yields an empty array.
    """
    def all_subs(s: Column) -> Column:
        n = F.length(s)
        subs = F.flatten(F.transform(
            F.sequence(F.lit(1), F.greatest(n - min_len + 1, F.lit(1))),
            lambda i: F.transform(
                F.sequence(F.lit(min_len), F.greatest(F.least(F.lit(max_len), n - i + 1), F.lit(min_len))),
                lambda k: F.substring(s, i, k))))
        return F.when(n >= min_len, subs).otherwise(F.array().cast("array<string>"))

    if key_chars is not None:
        runs = F.regexp_extract_all(text, F.lit(f"{key_chars}+"), 0)
        subs = F.flatten(F.transform(runs, all_subs))
    else:
        subs = all_subs(text)
    if pattern is not None:
        subs = F.filter(subs, lambda x: x.rlike(pattern))
    return F.coalesce(F.array_distinct(subs), F.array().cast("array<string>"))


def substring_join(keys: DataFrame, key_col: str, lists: DataFrame, list_col: str,
                   how: str = "left", pattern: str | None = None, key_chars: str | None = None) -> DataFrame:
    """``keys JOIN lists ON CHARINDEX(CAST(key AS VARCHAR), list) > 0``.

    The naive plan is a nested-loop join (every key against every list).
    Here a key of ``GRAM`` characters or more is anchored by its rarest
    piece of that length (the one fewest keys have); each list is exploded
    once into its distinct pieces, as many as it has characters whatever the
    longest key, and a key meets the lists that hold its anchor, which
    ``instr`` verifies.  Shorter keys are equi-joined to the lists' short
    substrings; theirs are the frequent ones, and the inner join's hot keys
    are split by AQE.  Pairs are the same as the CHARINDEX form: '1' matches
    inside '12' (use ``token_join`` for exact list members).  For integer
    keys pass ``key_chars='[-0-9]'`` and ``pattern='^-?[0-9]+$'``; keys not
    of that shape match nothing, nor do NULL and empty ones.

    Result: all columns of ``keys`` and of ``lists`` (``how`` is ``inner``
    or ``left`` from the ``keys`` side).
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    text = F.col(key_col).cast("string")
    long = F.length(text) >= GRAM
    if pattern is not None:
        long = long & text.rlike(pattern)
    far = keys.where(long).withColumn("_key_text", text)
    near = keys.where(~F.coalesce(long, F.lit(False)))
    pieces = far.select("_key_text").distinct().select("_key_text", F.explode(
        substring_keys(F.col("_key_text"), GRAM, min_len=GRAM)).alias("_piece"))
    shared = pieces.groupBy("_piece").agg(F.count(F.lit(1)).alias("_n"))
    anchors = (pieces.join(shared, "_piece").groupBy("_key_text")
               .agg(F.min(F.struct("_n", "_piece")).alias("_a")).select("_key_text", F.col("_a._piece").alias("_anchor")))
    exploded = lists.withColumn("_piece", F.explode(substring_keys(F.col(list_col), GRAM, key_chars=key_chars, min_len=GRAM)))
    held = (F.col("_anchor") == F.col("_piece")) & (F.instr(F.col(list_col), F.col("_key_text")) > 0)
    found = far.join(anchors, "_key_text").join(exploded, held, how).drop("_key_text", "_anchor", "_piece")
    short = lists.withColumn("_sub", F.explode(substring_keys(F.col(list_col), GRAM - 1, pattern, key_chars)))
    return found.unionByName(_left_via_inner(near, key_col, short, "_sub", how))


def token_join(keys: DataFrame, key_col: str, lists: DataFrame, list_col: str,
               how: str = "left", sep: str = ",") -> DataFrame:
    """Exact-member variant: split the list on ``sep``, trim, equi-join."""
    toks = F.array_distinct(F.transform(F.split(F.col(list_col), sep), lambda t: F.trim(t)))
    exploded = lists.withColumn("_sub", F.explode(toks))
    return _left_via_inner(keys, key_col, exploded, "_sub", how)


def _left_via_inner(keys: DataFrame, key_col: str, exploded: DataFrame, cand: str, how: str) -> DataFrame:
    """``keys LEFT JOIN exploded ON text(key) = cand`` built as an inner join
    plus the unmatched keys.

    The exploded side is the big one and its candidates are skewed (a short
    id occurs in many lists).  AQE splits skewed partitions of either side
    of an *inner* join, but not of the non-preserved side of an outer join;
    so the pairs come from an inner join and keys without any match are
    added back by a left-anti join with NULL list columns.
    """
    k = keys.withColumn("_key_text", F.col(key_col).cast("string"))
    pairs = k.join(exploded, F.col("_key_text") == F.col(cand), "inner").drop(cand)
    if how == "inner":
        return pairs.drop("_key_text")
    if how != "left":
        raise ValueError("how must be 'inner' or 'left'")
    hit = exploded.select(F.col(cand).alias("_key_text")).distinct()
    missing = k.join(hit, "_key_text", "left_anti")
    for f in exploded.schema.fields:
        if f.name != cand:
            missing = missing.withColumn(f.name, F.lit(None).cast(f.dataType))
    return pairs.unionByName(missing).drop("_key_text")

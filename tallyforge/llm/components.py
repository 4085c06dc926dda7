"""Distributed union-find and the search for links behind shared keys.

Both work on tables of (key, node) and (a, b) with long ids; every round is
cut into the shared checkpoint folder, nothing is gathered anywhere.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import counted, cut, semi


PIVOTS = (1, 4)       # for each key, round by round; a round without a new link is the last
FIRSTS = 16           # smallest keys of a node, to tell a pair's first common key by
WIDE_ROWS, SET_ROWS = 10_000, 2_000      # pairs to a task, at least, whose wide sketches or sets are compared
CROWD = 32            # further pivots stand for as many nodes at least; fewer are soon compared pair by pair


def _stars(edges: DataFrame, large: bool, parts: int) -> DataFrame:
    """Each node sends its smallest neighbour to its larger (large star) or
    its smaller (small star) neighbours and, there, to itself."""
    back = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    both = edges.unionByName(back)
    if not large:
        both = both.where("b < a")
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    out = both.join(least, "a").where("b > a" if large else "b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        out = out.unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a != b").coalesce(parts).distinct().coalesce(parts)


def components(edges: DataFrame, most: int | None = None) -> DataFrame:
    """``edges`` (a, b), at most ``most`` if known -> (node, comp): comp is the
    smallest node reachable; only nodes with an edge appear.  Large-star and small-star rounds until
    every component is a star; a node's neighbours are only ever reduced to
    a minimum, so a hub is pre-aggregated before the shuffle."""
    edges = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), most=most)
    seen = None
    while True:
        now = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if not now.n or seen == (now.n, now.x):
            break
        seen = (now.n, now.x)
        parts = now.n // 100_000 + 1
        edges = cut(_stars(_stars(edges, True, parts), False, parts))
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(
        roots.select("node", F.col("node").alias("comp")))


def shared_only(keys: DataFrame, unique: bool, most: int | None = None) -> tuple[DataFrame, int]:
    """Rows (key, node) of the keys that more than one node has, and how many;
    ``unique`` says that no (key, node) comes twice, so that a count tells,
    ``most`` bounds the rows of ``keys``, if known."""
    if unique:
        dup = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    else:
        dup = keys.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
    shared = semi(keys, cut(dup.select("key"), most=most), "key")
    return counted(shared if unique else shared.distinct(), most=most)


def with_sketch(sets: DataFrame) -> DataFrame:
    """``sets`` (node, hashes; each node once, its hashes distinct, rows dealt
    by node) -> node, n, the set's size, and a parity sketch: every element
    flips one bit, so the Hamming distance of two sketches is at most the
    symmetric difference of the sets.  It has 512 bits, and for sets of more
    than 256 the power of two from twice their size on."""
    long = lambda c: c.cast("long")
    zero, eight = long(F.lit(0)), [f"w{i}" for i in range(8)]
    blocks = F.greatest(F.lit(1), F.pow(F.lit(2), F.ceil(F.log2(F.col("n") / 256))).cast("int"))      # of 8 words
    sized = sets.select("node", "hashes", F.size("hashes").alias("n")).select("node", "n", "hashes", blocks.alias("blocks"))
    # outer: the other's own filter is put before the shuffle and makes every set twice
    bits = sized.select("node", "n", "blocks", F.explode_outer("hashes").alias("h")).where("h is not null")
    bit = F.call_function("shiftleft", long(F.lit(1)), F.shiftrightunsigned("h", 58).cast("int"))
    bits = bits.select("node", "n", F.shiftright("h", 3).bitwiseAND(long(F.col("blocks") - 1)).cast("int").alias("block"),
                       F.col("h").bitwiseAND(F.lit(7)).cast("int").alias("w"), bit.alias("bit"))
    done = bits.groupBy("node", "n", "block").agg(*[F.bit_xor(F.when(F.col("w") == i, F.col("bit")).otherwise(zero)).alias(w)
                                                    for i, w in enumerate(eight)])
    done = done.groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("block", F.array(*eight).alias("words")))).alias("some"))
    found = F.map_from_entries("some")
    filled = F.transform(F.sequence(F.lit(0), blocks - 1), lambda b: F.coalesce(F.try_element_at(found, b), F.array(*[zero] * 8)))
    return done.select("node", "n", F.flatten(F.when(F.size("some") == blocks, F.col("some.words")).otherwise(filled)).alias("sketch"))


def _apart(x: Column, y: Column) -> Column:
    """Hamming distance of two sketches.  The longer of two is folded (its
    halves xor-ed), which keeps the bound; sets that may link differ by at
    most one doubling."""
    half = lambda c: F.floor(F.size(c) / 2).cast("int")
    fold = lambda c: F.zip_with(F.slice(c, 1, half(c)), F.slice(c, half(c) + 1, half(c)), lambda p, q: p.bitwiseXOR(q))
    a = F.when(F.size(x) > F.size(y), fold(x)).otherwise(x)
    b = F.when(F.size(y) > F.size(x), fold(y)).otherwise(y)
    return F.aggregate(F.zip_with(a, b, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda p, q: p + q)


def _coarse(c: Column) -> list[Column]:
    """A sketch's first 32 words folded to 8."""
    word = lambda i: F.coalesce(F.get(c, F.lit(i)), F.lit(0).cast("long"))
    return [reduce(Column.bitwiseXOR, [word(i + j) for j in (0, 8, 16, 24)]) for i in range(8)]


def _bits_apart(a: list[Column], b: list[Column]) -> Column:
    return reduce(add, [F.bit_count(p.bitwiseXOR(q)) for p, q in zip(a, b, strict=True)])


def _coarsely_apart(x: Column, y: Column, bits: Column | None = None) -> Column:
    """Hamming distance of two sketches folded to 512 bits, at most that of
    ``_apart``; 0 if one has more than 32 words.  It is compiled code without
    lambdas, to rule out most pairs before those run.  ``bits`` is the folded
    sketches' distance, if they are at hand."""
    bits = _bits_apart(_coarse(x), _coarse(y)) if bits is None else bits
    return F.when((F.size(x) <= 32) & (F.size(y) <= 32), bits).otherwise(0)


def _wide_enough(pairs: DataFrame, profiles: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (a, b, sizes) less those that the sketches of large sets rule out.
    512 bits say nothing about sets of thousands; ``wide`` has a bit for each
    element, its length a power of two, and is empty for sets that ``sketch``
    serves."""
    x, y = F.col("wide"), F.col("wide2")
    fits = (100 + percent) * _apart(x, y) <= (100 - percent) * (F.col("n") + F.col("n2"))
    both = pairs.join(profiles.select(F.col("node").alias("a"), "n", "wide"), "a").join(
        profiles.select(F.col("node").alias("b"), F.col("n").alias("n2"), F.col("wide").alias("wide2")), "b")
    return both.where((F.size(x) == 0) | (F.size(y) == 0) | fits).select("a", "b", "sizes")


def _likely(percent: int, bits: Column | None = None) -> Column:
    """What a link's sizes and parity sketches must satisfy; of sketches of 8
    words the coarse distance is the whole one."""
    x, y = F.col("sketch"), F.col("sketch2")
    fits = lambda apart: (100 + percent) * apart <= (100 - percent) * (F.col("n") + F.col("n2"))
    return ((100 * F.least("n", "n2") >= percent * F.greatest("n", "n2")) & fits(_coarsely_apart(x, y, bits))
            & ((F.size(x) + F.size(y) <= 16) | fits(_apart(x, y))))


def linked_components(keys: DataFrame, profiles: DataFrame, fetch: Callable[[DataFrame], DataFrame],
                      percent: int, own_set: Callable[[Column], Column] = lambda c: c, n_keys: int | None = None) -> DataFrame:
    """Components of the links (Jaccard similarity of at least ``percent``)
    among nodes with a common key.  ``keys`` (key, node) holds shared keys
    only, ``profiles`` (node, n, sketch, perhaps wide) their nodes; both are materialised.
    ``n_keys`` is the number of rows of ``keys``, if known.  ``fetch`` takes materialised nodes and gives rows (node, own), ``own_set``
    makes the set's hashes, which may repeat, of an ``own``: what travels to a pair may
    be smaller than its set.

    Each round compares every key's nodes with a few of them, its pivots
    (``PIVOTS``), and merges what links, so a group of g copies takes g
    comparisons instead of g * g.  A pivot has then met all nodes of its key and
    leaves it; keys whose other nodes have become one component are dropped.  Once a round finds
    no new link, or after the last, what is left in a key, nodes of different components,
    is compared pair by pair.  Pairs whose sizes or parity sketches rule a
    link out are not compared: no link is lost, and pairs inside a component,
    which can't change the result, are never made."""
    wide, every = "wide" in profiles.columns, profiles
    profiles = every.select("node", "n", "sketch")
    second = [F.col(c).alias(f"{c}2") for c in ("node", "n", "sketch")]
    tested = edges = labels = spent = None
    links, rounds = 0, 0
    left = keys.count() if n_keys is None else n_keys
    while True:
        last = rounds >= len(PIVOTS)
        here = _with_components(keys, labels)
        if spent is not None:
            here, left = counted(here.join(spent, ["key", "node"], "left_anti"), most=left)
            mixed = here.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
            here, left = counted(semi(here, cut(mixed, most=left), "key"), most=left)
            keys = here.select("key", "node")
        if last:
            firsts = here.groupBy("node").agg(F.slice(F.sort_array(F.collect_list("key")), 1, FIRSTS).alias("firsts"))
            words = [f"w{i}" for i in range(8)]       # folded once a row, as its pairs may be many
            folded = [c.alias(w) for c, w in zip(_coarse(F.col("sketch")), words, strict=True)]
            here = here.join(profiles.select("*", *folded), "node").join(firsts, "node")
            there = here.select(F.col("key").alias("key2"), F.col("comp").alias("comp2"), F.col("firsts").alias("firsts2"),
                                *[F.col(w).alias(f"{w}2") for w in words], *second)
            bits = _bits_apart([F.col(w) for w in words], [F.col(f"{w}2") for w in words])
            before = F.array_min(F.array_intersect("firsts", "firsts2"))      # a pair comes once, with its first common key
            pairs = here.join(there, (F.col("key") == F.col("key2")) & (F.col("comp") < F.col("comp2")) & _likely(percent, bits)
                              & (before.isNull() | (F.col("key") <= before)))
        else:
            part = F.pmod("node", F.lit(PIVOTS[rounds]))
            least = F.min("node").alias("pn"), F.min_by("comp", "node").alias("pc")
            if labels is None:
                least = F.min("node").alias("pn"), F.min("node").alias("pc")
            pivot = here.groupBy("key", part.alias("part")).agg(*least, F.count("*").alias("g"))
            pivot = pivot.where(f"part = 0 or g >= {CROWD}").select("key", "pn", "pc")
            spent = pivot.select("key", F.col("pn").alias("node"))
            pairs = here.join(pivot, "key").where("comp != pc").select(F.least("node", "pn").alias("node"), F.greatest("node", "pn").alias("node2"))
            pairs = pairs.distinct().join(profiles, "node").join(profiles.select(*second), "node2").where(_likely(percent))
        pairs = pairs.select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b"), (F.col("n") + F.col("n2")).alias("sizes")).distinct()
        if tested is not None:
            pairs = pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti")
        pairs, n = counted(pairs, most=None if last else left * PIVOTS[rounds])
        found = 0
        if n:
            tested = pairs if tested is None else tested.unionByName(pairs)
            if wide:
                pairs = cut(_wide_enough(pairs, every, percent).coalesce(n // WIDE_ROWS + 1))
            nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
            good = _similar(pairs, fetch(cut(nodes.distinct(), most=2 * n)), percent, own_set).coalesce(n // SET_ROWS + 1)
            edges, all_links = counted(good if edges is None else edges.unionByName(good))
            found, links = all_links - links, all_links
            if found:
                labels = cut(components(edges, links), most=2 * links)
        if last:
            break
        rounds = rounds + 1 if found else len(PIVOTS)
    if labels is None:
        return profiles.select("node", F.col("node").alias("comp")).limit(0)
    return labels


def _similar(pairs: DataFrame, sets: DataFrame, percent: int, own_set: Callable[[Column], Column]) -> DataFrame:
    """The pairs (a, b, sizes) whose sets are similar enough, compared exactly:
    what their sizes, added, are more than their union is what they share."""
    left = sets.select(F.col("node").alias("a"), F.col("own").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("own").alias("y"))
    union = F.size(F.array_union(own_set(F.col("x")), own_set(F.col("y"))))
    return pairs.join(left, "a").join(right, "b").where(100 * F.col("sizes") >= (100 + percent) * union).select("a", "b")


def _with_components(keys: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return keys.withColumn("comp", F.col("node"))
    return keys.join(labels, "node", "left").select("key", "node", F.coalesce("comp", "node").alias("comp"))

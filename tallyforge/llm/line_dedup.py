"""Fuzzy line deduplication by MinHash, DataFrame functions only.

A line's set is its character shingles: the 12 characters from every place
(the whole line if it is shorter), cut from its UTF-32 bytes, where every
character takes four.  12 MinHashes come from a shingle's 64-bit hash and 2 seeded
ones of it, whose four parts of 16 bits each order a set independently
of each other; they are minima, so they are reduced per distinct line before
the shuffle, and equal lines fall together there.  Six bands of two (recall 0.998 at similarity 0.8,
tested on sets of 5 to 20) give the candidates, which are verified by exact
Jaccard similarity of the shingle sets; union-find joins verified links, and
the first line of each component (by doc_id, text hash, line number) stays.

Defined results: lines of fewer than ``least`` characters (spaces at the
ends not counted) are too short to compare by shingles and are repeats only
if equal; lines without a character beyond white space always stay; null
text stays null; a document all of whose lines go keeps an empty text
(``dedup_lines``) or goes (``keep_documents``); rows equal in doc_id and text
are one document and share their fate; a null doc_id sorts first; an empty
table gives an empty result.  Input columns named like an output column are
replaced, other extra columns are kept whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import linked_components, shared_only, with_sketch
from .util import SPACES, WORD, counted, cut, few, fresh, semi, without

BANDS, ROWS = 6, 2
LEAST = 24
PERCENT = 80
SHINGLE = 12
STEP = 2              # shingles to a row while their MinHashes are reduced
# a hash's order by each of its four parts of 16 bits; what follows a part tells ties
PARTS = (lambda x: x, lambda x: F.shiftleft(x, 16), lambda x: F.shiftleft(x, 32),
         lambda x: F.shiftleft(x, 48).bitwiseOR(F.shiftrightunsigned(x, 16)))
OUT = ("n_lines", "n_removed")


def last_start(code: Column) -> Column:
    return F.greatest(F.length(code) - F.lit(4 * SHINGLE - 1), F.lit(1))


def starts(code: Column) -> Column:
    """Where the shingles of a line in UTF-32 begin, counted in bytes from 1."""
    return F.sequence(F.lit(1), last_start(code), F.lit(4))


def piece(code: Column, at: Column) -> Column:
    return F.xxhash64(F.substring(code, at, F.lit(4 * SHINGLE)))


def line_hashes(line: Column) -> Column:
    """The hashes of a line's shingles, from every place (the line's bytes are bound once)."""
    return F.get(F.transform(F.array(F.encode(line, "UTF-32")), lambda c: F.transform(starts(c), lambda i: piece(c, i))), 0)


def line_set(line: Column) -> Column:
    """The distinct ones (outside the lambda, where it is compiled)."""
    return F.array_distinct(line_hashes(line))


def line_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, line_no, node, line) of the lines that aren't blank
    (an outer explode: the other's own filter would split every text again;
    trimmed on one side, as trimming the right looks at all of a line)."""
    d = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("text_hash"),
                                              F.posexplode_outer(F.split("text", "\n")).alias("line_no", "line"))
    d = d.withColumn("line", F.trim(F.col("line"))).where(F.ltrim(F.col("line"), F.lit(SPACES)) != "")
    return d.withColumn("node", F.xxhash64("line"))


def set_keys(shingles: DataFrame) -> DataFrame:
    """(node, keys) of the sets given as rows of node and one or more of its
    shingles' hashes: a key for each band."""
    some = [c for c in shingles.columns if c != "node"]
    hashes = BANDS * ROWS // len(PARTS)
    more = [F.xxhash64(F.lit(i), c).alias(f"x{i}_{c}") for i in range(1, hashes) for c in some]
    h = shingles.select("node", *[F.col(c).alias(f"x0_{c}") for c in some], *more)
    orders = [f(F.col(f"x{i}_{c}")) for i in range(hashes) for f in PARTS for c in some]
    least = [F.least(*orders[i:i + len(some)]) if len(some) > 1 else orders[i] for i in range(0, len(orders), len(some))]
    row = h.select("node", *[x.alias(f"x{i}") for i, x in enumerate(least)])
    sig = row.groupBy("node").agg(*[F.shiftright(F.min(f"x{i}"), 32).alias(f"m{i}") for i in range(BANDS * ROWS)])
    keys = F.array(*[F.xxhash64(F.lit(b), *[F.col(f"m{b * ROWS + r}") for r in range(ROWS)]) for b in range(BANDS)])
    return sig.select("node", keys.alias("keys"))


def band_keys(lines: DataFrame) -> tuple[DataFrame, int]:
    """(key, node): a row for each band of each distinct line; and how many."""
    code = lines.select("node", F.encode("line", "UTF-32").alias("code"))
    code = code.select("node", "code", last_start(F.col("code")).alias("last"))
    at = code.select("node", "code", "last", F.explode(F.sequence(F.lit(1), "last", F.lit(4 * STEP))).alias("at"))
    some = [piece(F.col("code"), F.least(F.col("at") + 4 * i, "last")).alias(f"h{i}") for i in range(STEP)]
    keys, n = counted(set_keys(at.select("node", *some)), 50_000)
    return keys.select(F.explode("keys").alias("key"), "node"), n * BANDS


def removed_lines(docs: DataFrame, least: int = LEAST, percent: int = PERCENT) -> DataFrame:
    """(doc_id, text_hash, removed): the line numbers that go."""
    lines = line_rows(docs.select("doc_id", "text"))
    wide = lines.where(F.length("line") >= least).select("node", "line")
    every, n = band_keys(wide)
    keys, n_keys = shared_only(every, unique=True, most=n)
    nodes, n = counted(keys.select("node").distinct(), most=n_keys)
    texts = cut(semi(wide, nodes, "node").groupBy("node").agg(F.first("line").alias("line")), 10_000, most=n)
    profiles = with_sketch(texts.repartition("node").select("node", line_set(F.col("line")).alias("hashes")))
    profiles = cut(profiles.coalesce(n // 5_000 + 1))
    labels = linked_components(keys, profiles, lambda wanted: semi(texts, wanted, "node").select("node", F.col("line").alias("own")),
                               percent, own_set=line_hashes, n_keys=n_keys)
    at = F.struct("doc_id", "text_hash", "line_no")
    lines, n = counted(lines.select("doc_id", "text_hash", "line_no", "node"))
    seen = lines.groupBy("node").agg(F.min(at).alias("f"), F.max(at).alias("l")).join(labels, "node", "left")
    seen = seen.where("f < l or comp is not null").select("node", F.coalesce("comp", "node").alias("comp"), "f")
    seen, n_seen = counted(seen, most=n)
    first = seen.groupBy("comp").agg(F.min("f").alias("first"))
    seen = cut(seen.join(first, "comp").select("node", "first"), most=n_seen)
    gone = lines.join(few(seen), "node").where(at != F.col("first"))
    return gone.groupBy("doc_id", "text_hash").agg(F.collect_set("line_no").alias("removed")).coalesce(n // 50_000 + 1)


def few_lists(gone: DataFrame, removed: str) -> DataFrame:
    """``gone`` (materialised), marked for broadcast if its rows and line
    numbers come to at most 32 MB; beyond, its join shuffles."""
    size = gone.agg(F.sum(F.lit(64) + 4 * F.size(removed)).alias("b")).first().b or 0
    return F.broadcast(gone) if size <= 32 << 20 else gone


def _shortened(docs: DataFrame, least: int, percent: int, counts: tuple[str, str]) -> DataFrame:
    """``docs`` with the text less its repeated lines, and two counts."""
    own, text_hash, removed, lines = fresh(docs, "own", "text_hash", "removed", "lines")
    gone = cut(removed_lines(docs, least, percent).toDF(own, text_hash, removed))
    d = docs.join(few_lists(gone, removed), (F.xxhash64("text") == F.col(text_hash)) & F.col("doc_id").eqNullSafe(F.col(own)), "left")
    d = d.withColumn(lines, F.split("text", "\n"))
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(removed))
    text = F.when(F.col(removed).isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(F.col(lines), i)), "\n"))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long")
    n_removed = F.when(F.col(removed).isNull(), 0).otherwise(F.size(removed)).cast("long")
    return d.select(*[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns],
                    n_lines.alias(counts[0]), n_removed.alias(counts[1]))


def dedup_lines(docs: DataFrame, least: int = LEAST, percent: int = PERCENT) -> DataFrame:
    """``docs`` with the text less its repeated lines, n_lines, n_removed."""
    return _shortened(without(docs, *OUT), least, percent, OUT)


def keep_documents(docs: DataFrame, least: int = LEAST, percent: int = PERCENT) -> DataFrame:
    """The columns of ``docs``; documents all of whose lines went are gone."""
    counts = fresh(docs, *OUT)
    d = _shortened(docs, least, percent, counts)
    return d.where((F.col(counts[1]) == 0) | F.col("text").rlike(WORD)).select(*[F.col(f"`{c}`") for c in docs.columns])

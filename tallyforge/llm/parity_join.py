"""N-gram Jaccard join by parity sketches.

A document's set is its distinct 3-word shingles (A-Z lower-cased; with
fewer words the whole sequence).  Equal sets form one class.  Sets of
Jaccard similarity >= p % differ in at most d = (a + b)(100 - p) // (100 + p)
shingles.  Per size band the sketch has half again as many words as d + 1,
of 2 ** 32 bits (a sparse one: only its set bits are held), d taken at the band's upper end; every shingle flips one bit,
so the sketches' Hamming distance, and with it the number of differing
words, is at most the symmetric difference: of m words two linked sets agree
in at least m - d.  Ordered by set bits (most first) and hash, an order that
is the same for all sets, one of these words is among the first d + 1 of
both: words without a bit, which always agree, are seldom needed.  Unequal
words of so many bits agree once in 2 ** 32 pairs at most, so unrelated sets
share no key by chance.
Classes are joined on (band, word number, word); sets near the top of a band
are also sketched for the next one.  Of the candidates, those whose sizes and
sketches (512 bits, a bit an element for larger sets) allow a link are verified by exact set similarity
(``linked_components``).

Defined results: null or empty text and text without words have an empty
set, n_shingles 0 and only themselves as component; copies and repeated rows
share a component; a null doc_id never becomes a component_id unless its
component has no other id; an empty table gives an empty result.  Extra
input columns are ignored.  Shingles and sets are told apart by 64- and
128-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import linked_components, shared_only
from .util import counted, cut, few, fresh, semi
from .vector import SPACE_WORDS, U, chunks, mix, shingles, split_words

CHUNK = 2 << 20
WORD_BITS = 1 << 32


def band_bounds(most: int, ratio: float = 1.4) -> list[int]:
    """Lower ends of the size bands, two bands past the one of ``most``."""
    out = [1, 2, 3]
    while out[-3] <= most:
        out.append(max(out[-1] + 1, int(out[-1] * ratio)))
    return out


def block_keys(s: np.ndarray, percent: int, bounds: list[int]) -> np.ndarray:
    """Join keys of one set (sorted distinct hashes)."""
    n = len(s)
    i = int(np.searchsorted(bounds, n, "right")) - 1
    bands = [i] + [i + 1] * (n * 100 >= percent * bounds[i + 1])
    out = []
    for b in bands:
        d = 2 * (bounds[b + 1] - 1) * (100 - percent) // (100 + percent)
        if d == 0:                       # only equal sets link, which are one class
            continue
        m = d + 1 + (d + 1) // 2
        word = ((s >> U(32)) * U(m)) >> U(32)
        at, times = np.unique(word * U(WORD_BITS) + (s & U(WORD_BITS - 1)), return_counts=True)
        at = at[times & 1 == 1]          # the sketch's set bits
        word = (at // U(WORD_BITS)).astype(np.int64)
        ones = np.bincount(word, minlength=m)
        value = np.zeros(m, U)
        np.bitwise_xor.at(value, word, mix(at))
        place = (np.arange(m, dtype=U) << U(16)) + U(b)
        keys = mix(mix(value) + place * U(0x9E3779B97F4A7C15))
        out.append(keys[np.lexsort((keys, -ones))[:d + 1]])
    return np.concatenate(out) if out else np.zeros(0, U)


def sketch(s: np.ndarray) -> np.ndarray:
    """512 parity bits of a whole set, to compare any two sets by."""
    at = ((s & U(7)) * U(64) + ((s >> U(3)) & U(63))).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=512) & 1).astype(np.uint8), bitorder="little").view("<u8")


def wide_sketch(s: np.ndarray) -> np.ndarray:
    """A parity bit for each element of a set of more than 512, rounded up to
    a power of two; folded to 512 bits it is ``sketch``."""
    if len(s) <= 512:
        return np.zeros(0, U)
    j = (len(s) - 1).bit_length() - 9
    word = (s & U(7)) + (((s >> U(9)) & U((1 << j) - 1)) << U(3))
    at = (word * U(64) + ((s >> U(3)) & U(63))).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=512 << j) & 1).astype(np.uint8), bitorder="little").view("<u8")


def set_hashes(s: np.ndarray) -> tuple[int, int]:
    """128 bits that tell a set from others: sums of two mixings."""
    h1, h2 = mix(s ^ U(0x243F6A8885A308D3)).sum(dtype=U), mix(s + U(0x13198A2E03707344)).sum(dtype=U)
    pair = mix(np.array([h1, h2 ^ U(len(s))], U)).view(np.int64)
    return int(pair[0]), int(pair[1])


def _lists(parts: list[np.ndarray], kind=np.int64) -> pa.Array:
    off = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    flat = np.concatenate(parts).view(kind) if parts else np.zeros(0, kind)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(flat))


def _summaries(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = band_bounds(1 << 12)
        for batch in chunks(batches, "text", CHUNK):
            w = split_words(batch.column("text"), SPACE_WORDS)
            sizes, one, two, sketches, wide, keys = [], [], [], [], [], []
            for doc in range(batch.num_rows):
                s = shingles(w, doc, k)
                if len(s) >= bounds[-3]:
                    bounds = band_bounds(len(s))
                sizes.append(len(s))
                h = set_hashes(s) if len(s) else (0, 0)
                one.append(h[0])
                two.append(h[1])
                sketches.append(sketch(s))
                wide.append(wide_sketch(s))
                keys.append(block_keys(s, percent, bounds) if len(s) else np.zeros(0, U))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(one, pa.int64()),
                 pa.array(two, pa.int64()), _lists(sketches), _lists(wide), _lists(keys)],
                ["doc_id", "text_hash", "n_shingles", "h1", "h2", "sketch", "wide", "keys"])

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", CHUNK):
            w = split_words(batch.column("text"), SPACE_WORDS)
            found = [shingles(w, d, k) for d in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_hashes(s)[0] if len(s) else 0 for s in found], pa.int64()), _lists(found)], ["node", "own"])

    return run


def near_duplicates(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, text_hash, n_shingles,
    component_id, comp.  ``comp`` is the component's own hash, null without
    shingles; ids may be null or shared by different components."""
    d = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    id_type = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {id_type}, text_hash long, n_shingles long, h1 long, h2 long, sketch array<long>, wide array<long>, keys array<long>"
    rows, n_rows = counted(d.mapInArrow(_summaries(k, percent), schema), 5_000)
    full = rows.where("n_shingles > 0")
    keys = full.select(F.explode("keys").alias("key"), F.col("h1").alias("node"))
    keys, n_keys = shared_only(keys, unique=False)
    nodes, n = counted(keys.select(F.col("node").alias("h1")).distinct(), most=n_keys)
    profiles = semi(full, nodes, "h1").select(F.col("h1").alias("node"), F.col("n_shingles").alias("n"), "sketch", "wide")
    profiles = cut(profiles.dropDuplicates(["node"]).coalesce(n // 10_000 + 1))

    def fetch(wanted: DataFrame) -> DataFrame:
        n = wanted.count()
        one = semi(full, wanted.withColumnRenamed("node", "h1"), "h1").groupBy("h1").agg(F.min(F.struct("doc_id", "text_hash")).alias("r"))
        one = cut(one.select(F.col("r.text_hash").alias("text_hash"), F.col("r.doc_id").alias("_id")), most=n)
        texts = d.join(few(one), "text_hash").where(F.col("doc_id").eqNullSafe(F.col("_id"))).select("text")
        return cut(texts.mapInArrow(_sets(k), "node long, own array<long>").dropDuplicates(["node"]), 2_000, most=n)

    labels = linked_components(keys, profiles, fetch, percent, n_keys=n_keys)
    classes = full.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"))
    classes = (classes.join(labels.withColumnRenamed("node", "h1"), "h1", "left")
               .select("h1", "h2", "least", F.coalesce("comp", "h1").alias("comp")))
    classes = cut(classes, most=n_rows)
    comps = classes.groupBy("comp").agg(F.min("least").alias("component_id"))
    ids = classes.join(comps, "comp").select("h1", "h2", "component_id", "comp")
    out = ["doc_id", "text_hash", "n_shingles", "component_id", "comp"]
    alone = rows.where("n_shingles = 0").select("*", F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("comp"))
    return full.join(ids, ["h1", "h2"]).select(*out).unionByName(alone.select(*out))


def keep_first(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """One document of each component stays: the one with the least doc_id
    (null first, then the least text hash).  Texts without words are their
    own components.  Of rows equal in doc_id and text one stays."""
    found = near_duplicates(docs, k, percent)
    first = found.where("n_shingles > 0").groupBy("comp").agg(F.min(F.struct("doc_id", "text_hash")).alias("r"))
    alone = found.where("n_shingles = 0").select(F.struct("doc_id", "text_hash").alias("r"))
    own, text_hash, times = fresh(docs, "own", "text_hash", "times")
    keep = first.select("r").unionByName(alone).select(F.col("r.doc_id").alias(own), F.col("r.text_hash").alias(text_hash)).distinct()
    number = found.groupBy(F.col("doc_id").alias("i"), F.col("text_hash").alias("t")).agg(F.count("*").alias(times))
    keep = cut(keep.join(number, (F.col(text_hash) == F.col("t")) & F.col(own).eqNullSafe(F.col("i"))).select(own, text_hash, times))
    same = (F.xxhash64("text") == F.col(text_hash)) & F.col("doc_id").eqNullSafe(F.col(own))
    once = docs.join(few(keep.where(F.col(times) == 1)), same, "left_semi")
    again = docs.join(few(keep.where(F.col(times) > 1)), same, "left_semi")          # only repeated rows are shuffled
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    order = F.row_number().over(Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(*others or [F.col("doc_id")]))
    return once.unionByName(again.withColumn(times, order).where(F.col(times) == 1).drop(times))

"""Benchmark decontamination with an FM-index per shard of training text.

Texts are lower-cased (A-Z) and cut into words; words outside the
benchmark's vocabulary can't be part of an occurrence and separate segments,
as do ends of documents; segments shorter than the shortest window hold
none.  Each task indexes its texts shard by shard and searches all windows
of all items (13 words; a shorter item is one window) backward, locates the
occurrences and merges the words they cover into removal spans.

The benchmark reaches the tasks as broadcast blocks of at most
``BLOCK_WORDS`` words; a larger benchmark is more blocks, each searched in
every shard's index, so no broadcast grows past that.

Defined results: null or empty text has no words, no hits and is not
contaminated; items without words are ignored, as are items without an id;
equal ids count as one item; repeated documents are judged alike; an empty
table gives an empty result, an empty benchmark no hits.  Input columns
named like an output column are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fm_index import FMIndex
from .util import without
from .vector import ALNUM_WORDS, Words, chunks, gathered, split_words

WINDOW = 13
SHARD = 4 << 20            # bytes of text in one index
BLOCK_WORDS = 500_000
OUT = {"n_words": "long", "n_hit": "long", "n_items": "long", "items_sha256": "string", "contaminated": "boolean",
       "spans": "array<struct<start:long,end:long>>"}


@dataclass
class Phrases:
    """Distinct windows of one block of items."""
    vocabulary: np.ndarray   # sorted word hashes; ids are places + 1
    ids: np.ndarray          # one row of word ids each, padded with 0
    sizes: np.ndarray
    items: list[list[str]]   # the items of each window

    @staticmethod
    def of(rows, window: int) -> Phrases:
        w = split_words(pa.array([r.text for r in rows], pa.string()), ALNUM_WORDS)
        vocabulary = np.unique(w.hashes)
        word = np.searchsorted(vocabulary, w.hashes) + 1
        found: dict[tuple, set[str]] = {}
        for i, r in enumerate(rows):
            own = word[w.first[i]:w.first[i + 1]].tolist()
            for at in range(max(1, len(own) - window + 1) if own else 0):
                found.setdefault(tuple(own[at:at + window]), set()).add(str(r.item_id))
        ids = np.zeros((len(found), window), np.int64)
        for i, p in enumerate(found):
            ids[i, :len(p)] = p
        return Phrases(vocabulary, ids, np.array([len(p) for p in found], np.int64), [sorted(x) for x in found.values()])


def _index(w: Words, p: Phrases) -> tuple[FMIndex, np.ndarray] | None:
    """The shard's index and the word of each of its symbols (-1: none)."""
    place = np.searchsorted(p.vocabulary, w.hashes)
    place[place == len(p.vocabulary)] = 0
    known = np.flatnonzero(p.vocabulary[place] == w.hashes)
    if not len(known):
        return None
    doc_start = np.zeros(len(w.hashes) + 1, bool)
    doc_start[w.first] = True
    breaks = np.concatenate(([False], (np.diff(known) != 1) | doc_start[known[1:]]))
    segment = np.cumsum(breaks)
    long_enough = np.bincount(segment)[segment] >= p.sizes.min()
    known, breaks = known[long_enough], breaks[long_enough]
    if not len(known):
        return None
    at = np.arange(len(known)) + np.cumsum(np.concatenate(([False], (np.diff(known) != 1) | doc_start[known[1:]])))
    text = np.zeros(at[-1] + 2, np.int64)
    word_of = np.full(len(text), -1)
    text[at], word_of[at] = place[known] + 1, known
    return FMIndex(text, len(p.vocabulary)), word_of


def _search(w: Words, p: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, first word) of all occurrences of a block in a shard."""
    built = _index(w, p) if len(p.sizes) else None
    if built is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    index, word_of = built
    who, lo, hi = index.search(p.ids, p.sizes)
    many = hi - lo
    rows = np.repeat(lo, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    return np.repeat(who, many), word_of[index.locate(rows)]


def _judged(batch: pa.RecordBatch, blocks: list[Phrases]) -> list[pa.Array]:
    w = split_words(batch.column("text"), ALNUM_WORDS)
    total = np.diff(w.first)
    change = np.zeros(len(w.hashes) + 1, np.int64)
    items: dict[int, set[str]] = {}
    for p in blocks:
        who, at = _search(w, p)
        np.add.at(change, at, 1)
        np.add.at(change, at + p.sizes[who], -1)
        doc = np.searchsorted(w.first, at, "right") - 1
        for d, i in np.unique(np.stack((doc, who), 1), axis=0).tolist():
            items.setdefault(d, set()).update(p.items[i])
    hit = np.cumsum(change[:-1]) > 0
    n_hit = np.diff(np.concatenate(([0], np.cumsum(hit)))[w.first])
    spans: list[list[dict]] = [[] for _ in range(batch.num_rows)]
    for d in np.flatnonzero(n_hit).tolist():
        a, b = w.first[d], w.first[d + 1]
        edge = np.diff(np.concatenate(([0], hit[a:b].astype(np.int8), [0])))
        first, last = np.flatnonzero(edge == 1) + a, np.flatnonzero(edge == -1) + a - 1
        spans[d] = [{"start": int(s), "end": int(e)} for s, e in
                    zip(w.code_points(d, w.starts[first]), w.code_points(d, w.ends[last]), strict=True)]
    names = [",".join(sorted(items.get(d, ()))) for d in range(batch.num_rows)]
    return [pa.array(total, pa.int64()), pa.array(n_hit, pa.int64()),
            pa.array([len(items.get(d, ())) for d in range(batch.num_rows)], pa.int64()),
            pa.array([hashlib.sha256(x.encode()).hexdigest() for x in names]),
            pa.array((n_hit > 0) & (20 * n_hit >= total)),
            pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` (text, ...) with n_words, n_hit, n_items, items_sha256,
    contaminated (5 % or more of the words hit) and removal spans (code
    points); ``benchmark`` has item_id and text."""
    docs = without(docs, *OUT)
    items = benchmark.where("item_id is not null and text is not null").select("item_id", "text").distinct()
    words = items.agg(F.sum(F.length("text") / 2 + 1).alias("n")).first().n or 0      # at least the words
    parts = max(1, int(words // BLOCK_WORDS) + 1)
    send = docs.sparkSession.sparkContext.broadcast
    blocks = [send(Phrases.of(items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == i).collect(), window))
              for i in range(parts)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(gathered(batches, "text", SHARD), "text", SHARD):
            new = _judged(batch, [b.value for b in blocks])
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *OUT])

    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"{k} {v}" for k, v in OUT.items()])
    return docs.mapInArrow(run, fields)


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, unchanged."""
    return decontaminate(docs.select("*"), benchmark).where(~F.col("contaminated")).select(*docs.columns)

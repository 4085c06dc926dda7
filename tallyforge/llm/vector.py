"""Vectorised word handling over Arrow string buffers (used inside tasks).

A batch of texts is one byte buffer; words, their spans and 64-bit hashes
come from numpy operations over it, without a Python loop over words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64


def _table(allowed) -> np.ndarray:
    t = np.zeros(256, bool)
    t[[b for b in range(256) if allowed(b)]] = True
    return t


# [^\x20\x09-\x0D] and, after lower-casing, [^\x00-\x2F\x3A-\x60\x7B-\x7F]
SPACE_WORDS = _table(lambda b: b != 0x20 and not 9 <= b <= 13)
ALNUM_WORDS = _table(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Words:
    buf: np.ndarray       # lower-cased bytes of all texts
    offsets: np.ndarray   # byte offsets of the texts
    starts: np.ndarray    # byte start of each word
    ends: np.ndarray      # byte end of each word
    first: np.ndarray     # index of each text's first word, and the total
    hashes: np.ndarray    # 64-bit hash of each word

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def code_points(self, doc: int, at: np.ndarray) -> np.ndarray:
        """Byte positions of one text as code-point positions in it."""
        b = self.buf[self.offsets[doc]:self.offsets[doc + 1]]
        heads = np.concatenate(([0], np.cumsum((b & 0xC0) != 0x80)))
        return heads[np.asarray(at) - self.offsets[doc]]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift), vectorised."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U(27))
    h = h * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.string())
    if texts.null_count:
        texts = texts.fill_null("")
    bufs = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(bufs[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8)[off[0]:off[-1]] if bufs[2] is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def split_words(texts: pa.Array, table: np.ndarray) -> Words:
    raw, off = text_buffer(texts)
    buf = _LOWER[raw]
    if not len(buf):
        z = np.zeros(0, np.int64)
        return Words(buf, off, z, z, np.zeros(len(off), np.int64), np.zeros(0, U))
    inside = table[buf]
    edge = np.zeros(len(buf) + 1, bool)           # a text begins or ends here
    edge[off] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(stop) + 1
    return Words(buf, off, starts, ends, np.searchsorted(starts, off), hash_spans(buf, starts, ends))


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span, eight bytes at a time."""
    pad = np.concatenate((buf, np.zeros(8, np.uint8)))
    eight = np.ndarray((len(pad) - 7,), "<u8", pad.data, 0, (1,))
    size = ends - starts
    h = mix(size.astype(U) + U(0x9E3779B97F4A7C15))
    todo, k = np.arange(len(starts)), 0
    while len(todo):
        left = size[todo] - k
        v = eight[starts[todo] + k]
        short = left < 8
        keep = (U(1) << (U(8) * np.minimum(left, 7).astype(U))) - U(1)
        h[todo] = mix(h[todo] ^ np.where(short, v & keep, v)) * U(0x9E3779B97F4A7C15)
        k += 8
        todo = todo[left > 8]
    return h


def shingles(words: Words, doc: int, k: int) -> np.ndarray:
    """Sorted distinct hashes of a text's k-word shingles; with fewer than
    k words, the whole sequence as one; none without words."""
    h = words.hashes[words.first[doc]:words.first[doc + 1]]
    if not len(h):
        return h
    n = max(1, len(h) - k + 1)
    out = np.full(n, min(k, len(h)), U)
    for i in range(min(k, len(h))):
        out = mix(out ^ h[i:i + n]) * U(0x9E3779B97F4A7C15)
    return np.unique(out)


def chunks(batches: Iterator[pa.RecordBatch], column: str, most: int, rows: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Re-slice batches so that a slice holds at most ``most`` bytes of text
    and ``rows`` rows (a longer single text is a slice of its own)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = text_buffer(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, min(at + rows, int(np.searchsorted(off, off[at] + most, "right")) - 1))
            yield batch.slice(at, to - at)
            at = to


def gathered(batches: Iterator[pa.RecordBatch], column: str, least: int) -> Iterator[pa.RecordBatch]:
    """Join small batches until they hold ``least`` bytes of text."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += int(text_buffer(b.column(b.schema.get_field_index(column)))[1][-1])
        if size >= least:
            yield _joined(held)
            held, size = [], 0
    if held:
        yield _joined(held)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(batches) == 1:
        return batches[0]
    t = pa.Table.from_batches(batches).combine_chunks()
    return t.to_batches()[0] if t.num_rows else batches[0]

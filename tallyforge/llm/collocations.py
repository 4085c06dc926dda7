"""Phrase collocations counted with double-array tries.

Apriori, level by level.  The words of each language are counted first; a
phrase can only be frequent if its words are, and a phrase of three only if
both its pairs are, too.  What passes is asked from bit maps of fixed size
over hashes of the words, pairs and triples whose hashes come up often
enough: equal hashes only add to such a sum, so a wrong pass adds a candidate
and no frequent phrase is lost (Apriori-safe).

The occurrences of what passes are dealt by the hashes of their first two
words to 2 ** ``DEAL_BITS`` parts, those of a stretch of text that are alike as
one with its count, so the texts are read once for all phrases, however many
there are.  A task takes part after part; of the phrases that come there, those
whose hashes again come often enough are made into double-array tries (base and
check arrays; a word is two symbols, so that a state has a bounded number of
children) of ``BLOCK`` phrases.  numpy advances the states of all occurrences
of a part together, word by word, and sums the counts of the accepting ones.
Words and phrases travel as 64-bit hashes of language and spelling.

Scores are exact (decimals; products may pass 64 bits).

Defined results: null and empty texts have no words; a null language is
``und``; repeated rows count each time; an empty table gives an empty
result.  Extra input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .util import cut
from .vector import U, chunks, gathered, hash_spans, mix, split_words, text_buffer

LEAST = 10            # occurrences of a candidate
SHARE = 50            # percent: of a phrase's occurrences inside one longer candidate that drop it
TOP = 2_000
MAP_BITS = 26         # a bit map of hashes: 8 MB
BLOCK = 400_000       # phrases in a trie, and occurrences counted at once unless a part has more
PASS_BYTES = 64 << 20     # of a part's occurrences; beyond, those alike are added up
BATCH = 2 << 20
SPLITS = 2            # of the input, read by one task
SUM_BITS = 40         # of a hash, where its occurrences are summed
HELD = 1_000_000      # occurrences that a task gathers before they move
SUMMED = 4_000_000    # of hashes alone
DEAL_BITS = 12        # of a hash: the part that it is dealt to
SUM = {"low": np.uint32, "n": np.uint32}              # the rest of a hash, and its count
ROW = {"k1": U, "k2": U, "k3": U, "n": np.uint32}     # an occurrence; without a third word k3 is 0
FIRST = 64            # shares of a language's phrases, ranked apart at first
RADIX = 1024          # a word is the symbols id // RADIX and id % RADIX

PARTS = [ord(c) for c in ".,;:!?\n\v\f\r"]
_WORD = np.ones(256, bool)
_WORD[[0x20, 0x09, *PARTS]] = False
_PART = np.zeros(256, bool)
_PART[PARTS] = True


@dataclass
class Positions:
    """The words of a batch of texts."""
    keys: np.ndarray      # hash of language and word
    next: np.ndarray      # whether the next word follows in the same piece
    w: object
    lang: pa.Array

    @cached_property
    def _unique(self) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(self.keys, return_inverse=True)

    @property
    def distinct(self) -> np.ndarray:
        return self._unique[0]

    @property
    def which(self) -> np.ndarray:
        return self._unique[1]

    @staticmethod
    def of(batch: pa.RecordBatch) -> Positions:
        w = split_words(batch.column("text"), _WORD)
        raw, off = text_buffer(batch.column("lang"))
        lang = mix(hash_spans(raw, off[:-1], off[1:]))
        doc = w.doc_of()
        piece = np.concatenate(([0], np.cumsum(_PART[w.buf])))[w.starts]
        follows = np.zeros(len(doc), bool)
        follows[:-1] = (doc[1:] == doc[:-1]) & (piece[1:] == piece[:-1])
        return Positions(mix(w.hashes ^ lang[doc]), follows, w, batch.column("lang"))


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * U(0x9E3779B97F4A7C15) + b)


class BitMap:
    """One bit for each of 2 ** MAP_BITS ranges of 64-bit hashes."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def of(keys: DataFrame, bits_of_key: int = 64) -> BitMap:
        """``keys`` has the hashes as ``key``, or their first bits; the map is
        made by tasks, in pieces of 4 KB, and has the same size for any
        number of them."""
        at = keys.select(F.shiftrightunsigned("key", bits_of_key - MAP_BITS).alias("at"))
        parts = at.groupBy(F.shiftright("at", 15).alias("p")).agg(F.bitmap_construct_agg(F.col("at").bitwiseAND(F.lit(32767))).alias("b"))
        bits = np.zeros(1 << (MAP_BITS - 3), np.uint8)
        for r in parts.toLocalIterator():
            bits[r.p << 12:(r.p + 1) << 12] = np.frombuffer(r.b, np.uint8)
        return BitMap(bits)

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = (keys >> U(64 - MAP_BITS)).astype(np.int64)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & np.uint8(1) == 1


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[Positions]:
    for batch in chunks(gathered(batches, "text", BATCH), "text", BATCH):
        p = Positions.of(batch)
        if len(p.keys):
            yield p


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch's words with their counts."""
    for p in _batches(batches):
        keys, at, n = np.unique(p.keys, return_index=True, return_counts=True)
        data, w = p.w.buf.tobytes(), p.w
        words = [data[a:b] for a, b in zip(w.starts[at].tolist(), w.ends[at].tolist())]
        lang = p.lang.take(pa.array(np.searchsorted(w.first, at, "right") - 1))
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), lang, pa.array(words, pa.binary()).cast(pa.string()),
                                          pa.array(n, pa.int64())], ["key", "lang", "word", "f"])


def _packed(part: np.ndarray, columns: list[np.ndarray], kinds: dict) -> pa.RecordBatch:
    """A row for each part (sorted) with its columns as bytes."""
    edges = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True])))
    columns = [np.ascontiguousarray(c, k) for c, k in zip(columns, kinds.values())]
    packed = [pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer((edges * c.itemsize).astype(np.int32)), pa.py_buffer(c)]) for c in columns]
    return pa.RecordBatch.from_arrays([pa.array(part[edges[:-1]].astype(np.int32)), *packed], ["part", *kinds])


def _unpacked(batch: pa.RecordBatch, kinds: dict) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Parts and their columns, in the batch's order."""
    part = batch.column("part").to_numpy()
    edges = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True])))
    columns = []
    for name, kind in kinds.items():
        c = batch.column(name).cast(pa.binary())
        offsets = np.frombuffer(c.buffers()[1], np.int32)[c.offset:c.offset + len(c) + 1]
        values = np.frombuffer(c.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].view(kind)
        columns.append((values, (offsets - offsets[0]) // values.itemsize))
    for i, j in zip(edges[:-1].tolist(), edges[1:].tolist()):
        yield int(part[i]), [v[at[i]:at[j]] for v, at in columns]


def _whole(batches: Iterator[pa.RecordBatch], kinds: dict, least: int, most_bytes: int, add_up) -> Iterator[list[list[np.ndarray]]]:
    """Rows of whole parts, which come in their order: of as many as it takes
    for ``least`` rows.  A part of more than ``most_bytes`` is added up."""
    held, size, last, room = [], 0, None, 0
    for batch in batches:
        for part, rows in _unpacked(batch, kinds):
            if part != last:
                if size >= least:
                    yield held
                    held, size = [], 0
                last, room = part, size + most_bytes // sum(np.dtype(k).itemsize for k in kinds.values())
            held.append([np.full(len(rows[0]), part, U), *rows])
            size += len(rows[0])
            if size > room:
                held = [add_up(held)]
                size = len(held[0][0])
                room = max(room, 2 * size)
    if size:
        yield held


def _in_order(rows: DataFrame) -> DataFrame:
    """Each part in one task, a task's parts one after the other."""
    return rows.repartition("part").sortWithinPartitions("part")


def _often(hashes: np.ndarray, n: np.ndarray, least: int) -> np.ndarray:
    """Which hashes come ``least`` times, with those that end alike."""
    bits = len(hashes).bit_length() + 2
    at = (hashes & U((1 << bits) - 1)).astype(np.int64)
    return np.bincount(at, n, 1 << bits)[at] >= least


def _joined(held: list[list[np.ndarray]]) -> list[np.ndarray]:
    return [np.concatenate(c) for c in zip(*held)]


def _sums(keys: list[np.ndarray]) -> pa.RecordBatch:
    keys, n = np.unique(np.concatenate(keys), return_counts=True)
    return _packed((keys >> U(SUM_BITS - DEAL_BITS)).astype(np.int32), [keys & U((1 << SUM_BITS - DEAL_BITS) - 1), n], SUM)


def _summed(held: list[list[np.ndarray]], least: int = 1) -> list[np.ndarray]:
    """Parts, rests and counts of the hashes that come ``least`` times."""
    part, low, n = _joined(held)
    keys = part << U(SUM_BITS - DEAL_BITS) | low
    ok = _often(keys, n, least)
    keys, which = np.unique(keys[ok], return_inverse=True)
    n = np.bincount(which, n[ok], len(keys)).astype(np.int64)
    keys, n = keys[n >= least], n[n >= least]
    return [keys >> U(SUM_BITS - DEAL_BITS), keys & U((1 << SUM_BITS - DEAL_BITS) - 1), n]


def _frequent_hashes(least: int):
    """The first SUM_BITS bits of the hashes that come ``least`` times."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _whole(batches, SUM, HELD, PASS_BYTES, _summed):
            part, low, _ = _summed(held, least)
            yield pa.RecordBatch.from_arrays([pa.array((part << U(SUM_BITS - DEAL_BITS) | low).view(np.int64))], ["key"])

    return run


def _passing(p: Positions, words: BitMap, pairs: BitMap | None) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the pairs of words that the maps let pass."""
    known = words.has(p.keys)
    at = np.flatnonzero(p.next[:-1] & known[:-1] & known[1:])
    two = pair_hash(p.keys[at], p.keys[at + 1])
    if pairs is None:
        return at, two
    ok = pairs.has(two)
    return at[ok], two[ok]


def _triples(p: Positions, at: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs go on to a triple whose last two words pass, and its hash."""
    on = np.flatnonzero(np.diff(at) == 1)
    return on, pair_hash(two[on], p.keys[at[on] + 2])


def _hash_sums(words, pairs=None):
    """Counts of the hashes of pairs or, given their map, of triples."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for p in _batches(batches):
            found = _passing(p, words.value, pairs and pairs.value)
            held.append((_triples(p, *found) if pairs else found)[1] >> U(64 - SUM_BITS))
            size += len(held[-1])
            if size > SUMMED:
                yield _sums(held)
                held, size = [], 0
        if size:
            yield _sums(held)

    return run


def _dealt(words, pairs, triples):
    """Occurrences of the pairs that the maps let pass, with the third word
    of a triple that passes, too; packed by part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for p in _batches(batches):
            at, two = _passing(p, words.value, pairs.value)
            on, three = _triples(p, at, two)
            ok = triples.value.has(three)
            on, whole, third = on[ok], two.copy(), np.zeros(len(at), U)
            whole[on], third[on] = three[ok], p.keys[at[on] + 2]
            held.append((whole, two, p.keys[at], p.keys[at + 1], third))
            size += len(at)
            if size > HELD:
                yield _occurrences(held)
                held, size = [], 0
        if size:
            yield _occurrences(held)

    return run


def _occurrences(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    whole, two, *keys = _joined(held)
    _, first, n = np.unique(whole, return_index=True, return_counts=True)
    part = (two[first] >> U(64 - DEAL_BITS)).astype(np.uint16)
    order = np.argsort(part, kind="stable")
    first = first[order]
    return _packed(part[order], [*(k[first] for k in keys), n[order]], ROW)


# ---- the trie

class Trie:
    """Double-array trie of phrases of words; slot 1 is the root."""

    NAMES = ("words", "base", "check", "phrase")

    def __init__(self, words, base, check, phrase):
        self.words, self.base, self.check, self.phrase = words, base, check, phrase

    @staticmethod
    def of(keys: np.ndarray, sizes: np.ndarray) -> Trie:
        """``keys`` has a row of word hashes for each phrase, ``sizes`` how
        many of them are its words."""
        used = np.arange(keys.shape[1]) < sizes[:, None]
        words = np.unique(keys[used])
        ids = np.where(used, np.searchsorted(words, keys), -1)
        symbols = np.stack((np.where(used, ids // RADIX, -1), np.where(used, ids % RADIX, -1)), 2).reshape(len(ids), -1)
        order = np.lexsort(symbols.T[::-1])
        symbols, rows = symbols[order], order
        build = _Builder(2 * symbols.size // 3 + 4 * RADIX)
        state = np.full(len(rows), 1)                       # of each phrase so far
        new = np.zeros(len(rows), bool)
        new[:1] = True
        phrase_of = np.full(len(rows), -1)
        for t in range(symbols.shape[1]):
            live = symbols[:, t] >= 0
            new[1:] |= symbols[1:, t] != symbols[:-1, t]
            new[1:] |= live[1:] & ~live[:-1]
            heads = np.flatnonzero(new & live)              # one row for each child
            slots = build.place(state[heads], symbols[heads, t])
            place = np.cumsum(new & live) - 1
            state = np.where(live, slots[place] if len(slots) else 0, state)
        phrase_of[rows] = state
        base, check = build.arrays()
        phrase = np.full(len(base), -1, np.int32)
        phrase[phrase_of] = np.arange(len(rows))
        return Trie(words, base, check, phrase)

    def step(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """0 where the trie has no such child."""
        to = np.clip(self.base[state] + symbol, 0, len(self.base) - 1)
        return np.where(self.check[to] == state, to, 0)

    def count(self, p: Positions, longest: int, out: np.ndarray) -> None:
        """Adds the occurrences of each phrase among the positions."""
        own = np.minimum(np.searchsorted(self.words, p.distinct), len(self.words) - 1)
        ids = np.where(self.words[own] == p.distinct, own, -1)[p.which]
        at = np.flatnonzero(ids >= 0)
        known = np.zeros(len(p.keys) + 1, bool)
        known[at] = True
        state = np.ones(len(at), np.int64)
        for level in range(longest):
            word = ids[at + level]
            state = self.step(self.step(state, word // RADIX), word % RADIX)
            hit = self.phrase[state]
            out += np.bincount(hit[(hit >= 0) & (state > 0)], minlength=len(out))
            on = (state > 0) & p.next[at + level]
            on &= known[at + level + 1]
            at, state = at[on], state[on]

    def tally(self, keys: np.ndarray, n: np.ndarray, out: np.ndarray) -> None:
        """Adds ``n`` to each phrase that a row of word hashes begins with."""
        own = np.minimum(np.searchsorted(self.words, keys), len(self.words) - 1)
        ids = np.where(self.words[own] == keys, own, -1)
        at = np.flatnonzero(ids[:, 0] >= 0)
        state = np.ones(len(at), np.int64)
        for level in range(keys.shape[1]):
            word = ids[at, level]
            state = self.step(self.step(state, word // RADIX), word % RADIX)
            hit = self.phrase[state]
            ok = (hit >= 0) & (state > 0)
            out += np.bincount(hit[ok], n[at[ok]], len(out)).astype(np.int64)
            if level + 1 < keys.shape[1]:
                on = (state > 0) & (ids[at, level + 1] >= 0)
                at, state = at[on], state[on]

    def dump(self) -> bytes:
        sink = pa.BufferOutputStream()
        arrays = [pa.array([getattr(self, n).tobytes()], pa.large_binary()) for n in self.NAMES]
        batch = pa.RecordBatch.from_arrays(arrays, list(self.NAMES))
        with pa.ipc.new_stream(sink, batch.schema) as w:
            w.write_batch(batch)
        return sink.getvalue().to_pybytes()

    @staticmethod
    def load(data: bytes) -> Trie:
        batch = pa.ipc.open_stream(data).read_next_batch()
        kinds = (U, np.int32, np.int32, np.int32)
        return Trie(*[np.frombuffer(batch.column(n)[0].as_buffer(), k) for n, k in zip(Trie.NAMES, kinds)])


class _Builder:
    """Places the children of trie states in the arrays."""

    def __init__(self, slots: int):
        self.base, self.check = np.zeros(slots, np.int32), np.zeros(slots, np.int32)
        self.used = np.zeros(slots, bool)
        self.used[:2] = True
        self.end = 2

    def _grow(self, slots: int) -> None:
        if slots > len(self.used):
            more = max(slots, 2 * len(self.used)) - len(self.used)
            self.base, self.check = np.pad(self.base, (0, more)), np.pad(self.check, (0, more))
            self.used = np.pad(self.used, (0, more))

    def place(self, parents: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Slots of the children (parent's slot, symbol), given in order of
        the parents: several children where a free place fits all, single
        ones in the gaps."""
        if not len(parents):
            return parents
        start = np.flatnonzero(np.concatenate(([True], parents[1:] != parents[:-1])))
        many = np.diff(np.append(start, len(parents)))
        slots = np.zeros(len(parents), np.int64)
        for g in np.flatnonzero(many > 1)[np.argsort(-many[many > 1], kind="stable")].tolist():
            own = slice(start[g], start[g] + many[g])
            slots[own] = self._fit(symbols[own])
        one = start[many == 1]
        self._grow(self.end + len(one))
        free = np.flatnonzero(~self.used)[:len(one)]
        slots[one] = free
        self.used[free] = True
        self.end = max(self.end, int(slots.max()) + 1)
        self.check[slots] = parents
        self.base[parents] = slots - symbols
        return slots

    def _fit(self, symbols: np.ndarray) -> np.ndarray:
        span = symbols - symbols[0]
        self._grow(self.end + int(span[-1]) + 1)
        if len(span) <= 64:
            low = max(2, self.end - 4096)
            starts = low + np.flatnonzero(~self.used[low:self.end])[:256]
            fits = np.flatnonzero(~self.used[starts[:, None] + span].any(1))
            first = int(starts[fits[0]]) if len(fits) else self.end
        else:
            first = self.end
        slots = first + span
        self.used[slots] = True
        self.end = max(self.end, int(slots[-1]) + 1)
        return slots

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        return self.base[:self.end + 1], self.check[:self.end + 1]


def _added_up(held: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Occurrences that are alike as one with the sum of their counts."""
    part, *keys, n = _joined(held)
    _, first, which = np.unique(_hashes(*keys)[1], return_index=True, return_inverse=True)
    return [*(k[first] for k in (part, *keys)), np.bincount(which, n).astype(np.int64)]


def _hashes(k1: np.ndarray, k2: np.ndarray, k3: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the first two words, and of all."""
    two = pair_hash(k1, k2)
    return two, np.where(k3 > 0, pair_hash(two, k3), two)


def _frequent(held: list[list[np.ndarray]], least: int, block: int) -> Iterator[pa.RecordBatch]:
    """Phrases that come ``least`` times in whole parts, counted by tries."""
    _, k1, k2, k3, n = _joined(held)
    two, whole = _hashes(k1, k2, k3)
    pair = _often(two, n, least)                       # a triple's pairs come as often as it does
    k1, k2, k3, n, two, whole = (c[pair] for c in (k1, k2, k3, n, two, whole))
    third = np.flatnonzero(k3 > 0)
    third = third[_often(whole[third], n[third], least)]
    pairs, triples = np.unique(two, return_index=True)[1], third[np.unique(whole[third], return_index=True)[1]]
    occurring = np.stack((k1, k2, k3), 1)
    keys = occurring[np.concatenate((pairs, triples))]
    keys[:len(pairs), 2] = 0
    sizes = np.repeat([2, 3], [len(pairs), len(triples)])
    for i in range(0, len(keys), block):
        own, size = keys[i:i + block], sizes[i:i + block]
        a = np.zeros(len(own), np.int64)
        Trie.of(own, size).tally(occurring, n, a)
        ok = a >= least
        yield pa.RecordBatch.from_arrays([*(pa.array(k[ok].view(np.int64)) for k in np.ascontiguousarray(own.T)), pa.array(size[ok]), pa.array(a[ok])],
                                         ["k1", "k2", "k3", "size", "a"])


def _counts(least: int, block: int, pass_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _whole(batches, ROW, block, pass_bytes, _added_up):
            yield from _frequent(held, least, block)

    return run


def word_counts(docs: DataFrame) -> DataFrame:
    """(key, lang, word, f) of ``docs`` (text, lang), the language given."""
    rows = docs.mapInArrow(_words, "key long, lang string, word string, f long")
    return rows.groupBy("key", "lang", "word").agg(F.sum("f").alias("f"))


def candidates(docs: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """Occurrences of phrases of two and three words that may come ``least``
    times, packed by part (part, k1, k2, k3, n)."""
    send = docs.sparkSession.sparkContext.broadcast

    def sums(run) -> BitMap:
        found = _in_order(docs.mapInArrow(run, "part int, low binary, n binary")).mapInArrow(_frequent_hashes(least), "key long")
        return send(BitMap.of(found, SUM_BITS))

    word_map = send(BitMap.of(words.where(F.col("f") >= least)))
    pair_map = sums(_hash_sums(word_map))
    triple_map = sums(_hash_sums(word_map, pair_map))
    return docs.mapInArrow(_dealt(word_map, pair_map, triple_map), "part int, k1 binary, k2 binary, k3 binary, n binary")


def phrase_counts(occurring: DataFrame, least: int, block: int = BLOCK, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """Phrases (k1, k2, k3, size) of ``occurring`` (as ``candidates`` gives
    it) that come ``least`` times, with a, their occurrences."""
    return _in_order(occurring).mapInArrow(_counts(least, block, pass_bytes), "k1 long, k2 long, k3 long, size long, a long")


def score(a: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(1000000 a a / (l r)), exact."""
    wide = lambda c: c.cast("decimal(19,0)")
    up, down = F.lit(1_000_000).cast("decimal(7,0)") * wide(a) * wide(a), wide(l) * wide(r)
    return F.call_function("div", up, down).cast("long")


def scored(found: DataFrame, words: DataFrame) -> DataFrame:
    """Candidates (k1, k2, k3, size, a) with lang, l, r and score of their
    lowest-scoring cut, less those mostly inside one longer candidate."""
    word = lambda k, f, *more: words.select(F.col("key").alias(k), F.col("f").alias(f), *more)
    two, three = found.where("size = 2"), found.where("size = 3")
    inside = three.select("k1", "k2", "a").unionByName(three.select(F.col("k2").alias("k1"), F.col("k3").alias("k2"), "a"))
    inside = inside.groupBy("k1", "k2").agg(F.max("a").alias("most"))
    pairs = two.join(inside, ["k1", "k2"], "left").where(F.col("most").isNull() | (100 * F.col("most") < SHARE * F.col("a")))
    pairs = pairs.join(word("k1", "l", "lang"), "k1").join(word("k2", "r"), "k2").withColumn("score", score(F.col("a"), F.col("l"), F.col("r")))
    t = three.join(word("k1", "l1", "lang"), "k1").join(word("k3", "r2"), "k3")
    t = t.join(two.select(F.col("k1").alias("k2"), F.col("k2").alias("k3"), F.col("a").alias("r1")), ["k2", "k3"])
    t = t.join(two.select("k1", "k2", F.col("a").alias("l2")), ["k1", "k2"])
    cuts = F.least(*[F.struct(score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"),
                              F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in (1, 2)])
    t = t.withColumn("c", cuts).select("lang", "k1", "k2", "k3", "a", "c.l", "c.r", "c.score")
    return pairs.select("lang", "k1", "k2", F.lit(None).cast("long").alias("k3"), "a", "l", "r", "score").unionByName(t)


def mine(docs: DataFrame, least: int = LEAST, top: int = TOP, block: int = BLOCK, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """``docs`` (text, lang) -> the first ``top`` phrases of each language:
    lang, rank, phrase, a, l, r, n, score."""
    docs = docs.where("text is not null").select("text", F.coalesce("lang", F.lit("und")).alias("lang"))
    splits = docs.rdd.getNumPartitions()          # more text in a task: more is summed before it moves
    docs = docs.coalesce(max(1, splits // SPLITS, min(splits, docs.sparkSession.sparkContext.defaultParallelism)))
    words = cut(word_counts(docs))
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = words.where(F.col("f") >= least)
    found = phrase_counts(candidates(docs, words, least), least, block, pass_bytes)
    rows = scored(cut(found), frequent).withColumn("share", F.pmod(F.xxhash64("k1", "k2", "k3"), F.lit(FIRST)))
    for own in (["lang", "share"], ["lang"]):         # a phrase's place in a share is no later than in its language
        few = F.rank().over(Window.partitionBy(*own).orderBy(F.desc("score"), F.desc("a")))      # ties are settled by the spelling
        rows = rows.withColumn("place", few).where(F.col("place") <= top).drop("place")
    rows = cut(rows.drop("share"))
    for i in (1, 2, 3):
        side = frequent.select(F.col("key").alias(f"k{i}"), F.col("word").alias(f"w{i}"))
        rows = rows.join(side, f"k{i}", "left" if i == 3 else "inner")
    rows = rows.withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return first.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

"""Token ids in files of shuffled bit planes.

Documents are dealt by ranges of doc_id (then text hash) and sorted, so file
after file holds the ids in ascending doc_id order.  A file is written by one
task, block by block (``BLOCK`` ids): the block's 32-bit ids are transposed
into bit planes (or byte planes), each plane is compressed with zstandard,
and a plane of zeros takes no space.  Behind the blocks come the documents
(id, number of ids) and the chunk index, so that any range of ids is read by
decoding only its blocks (``TokenFile.ids``).

    TFPLANE1 | planes of block 0, 1, ... | documents (Arrow) | chunk index | footer

A task names its file by itself and returns a row about it; ``manifest`` (a
Parquet table beside the files) holds the rows of the tasks that ended well,
with the number of ids in the files before.  What a lost or repeated task
wrote is in no row and never read.  No file, block or prefix sum is held
whole by the driver or by one task: a task holds a batch of texts, a block
and its documents' lengths.

Tokenizers that drop white space and never look across it are asked for new
words only (cut at some marks, too, and with A-Z folded, if that is the same
to them), many at a time with a special token between them; others get whole
texts.  ``drops_spaces``, ``parts_marks``, ``folds_case`` and ``separator``
probe for that.  Words are told apart by 64-bit hashes, and a worker process
keeps those it met from task to task (``encoder``).

Defined results: null and empty text have no ids but the end id; null
doc_ids come first, ties by text hash; repeated rows are all written; an
empty table gives no file and an empty result.  Extra input columns are
ignored.
"""

from __future__ import annotations

import json
import os
import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .vector import SPACE_WORDS, chunks, gathered, hash_spans, text_buffer

MAGIC = b"TFPLANE1"
FOOTER = struct.Struct("<6Q2I8s")     # documents at, size; index at, size; ids; documents; block; planes; magic
BLOCK = 1 << 17
BATCH = 2 << 20           # bytes of text encoded at once
RUN = 2_000               # words or texts in one call of the tokenizer
KNOWN = 300_000           # words a worker process remembers
GROUP = 1024              # files whose ids are summed in one step of the prefix sum
MARKS = ",.;:!?\"()"
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
KIND = np.zeros(256, np.int8)        # 1: a letter, 2: one of MARKS
KIND[65:91] = KIND[97:123] = 1
KIND[list(MARKS.encode())] = 2
PROBES = ("a", "Straße", "don't", "x1,y2", "(é́)", "日本", "\U0001f600!", "--", "Å", "ΣΟΣ")


def to_planes(ids: np.ndarray, planes: int) -> list[np.ndarray]:
    """32 bit planes or 4 byte planes of 32-bit ids; zero planes are empty."""
    cells = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    top = int(ids.max(initial=0))
    out = [np.zeros(0, np.uint8)] * planes
    for byte in range((top.bit_length() + 7) // 8):
        plane = np.ascontiguousarray(cells[:, byte])
        if planes == 4:
            out[byte] = plane
            continue
        for bit in range(8):
            out[8 * byte + bit] = np.packbits(plane & np.uint8(1 << bit), bitorder="little")
    return [p if p.any() else p[:0] for p in out]


def from_planes(parts: list[bytes], n: int) -> np.ndarray:
    """The ids of a block from its planes (empty ones are zero)."""
    cells = np.zeros((n, 4), np.uint8)
    for i, p in enumerate(parts):
        if p and len(parts) == 4:
            cells[:, i] = np.frombuffer(p, np.uint8)
        elif p:
            cells[:, i // 8] |= np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") << np.uint8(i % 8)
    return cells.reshape(-1).view("<u4")


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if ":" in path.split("/", 1)[0] else (pafs.LocalFileSystem(), path)


class Writer:
    """One file; ``add`` takes ids and the lengths of whole documents."""

    def __init__(self, path: str, block: int, planes: int, level: int = 3):
        fs, name = _open(path)
        fs.create_dir(posixpath.dirname(name), recursive=True)
        self.out, self.block, self.planes = fs.open_output_stream(name), block, planes
        self.press = zstandard.ZstdCompressor(level=level)
        self.out.write(MAGIC)
        self.at, self.n_ids = len(MAGIC), 0
        self.index: list[list[int]] = []
        self.doc_ids: list[pa.Array] = []
        self.lengths: list[np.ndarray] = []
        self.held: list[np.ndarray] = []
        self.n_held = 0

    def _put(self, data: bytes) -> int:
        self.out.write(data)
        self.at += len(data)
        return len(data)

    def _flush(self, ids: np.ndarray) -> None:
        start = self.at
        sizes = [self._put(self.press.compress(p.tobytes())) if len(p) else 0 for p in to_planes(ids, self.planes)]
        self.index.append([start, len(ids), *sizes])

    def add(self, doc_ids: pa.Array, lengths: np.ndarray, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_ids)
        self.lengths.append(lengths)
        self.n_ids += len(ids)
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= self.block:
            ids = np.concatenate(self.held)
            full = len(ids) - len(ids) % self.block
            for i in range(0, full, self.block):
                self._flush(ids[i:i + self.block])
            self.held, self.n_held = [ids[full:]], len(ids) - full

    def close(self) -> int:
        """Writes what is left and returns the number of documents."""
        if self.n_held:
            self._flush(np.concatenate(self.held))
        lengths = np.concatenate(self.lengths)
        sink = pa.BufferOutputStream()
        batch = pa.RecordBatch.from_arrays([pa.concat_arrays(self.doc_ids), pa.array(lengths, pa.int64())], ["doc_id", "n_tokens"])
        with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
            w.write_batch(batch)
        docs_at = self.at
        docs_size = self._put(sink.getvalue().to_pybytes())
        index_at = self.at
        index_size = self._put(self.press.compress(np.array(self.index, "<i8").tobytes()))
        self._put(FOOTER.pack(docs_at, docs_size, index_at, index_size, self.n_ids, len(lengths), self.block, self.planes, MAGIC))
        self.out.close()
        return len(lengths)


class TokenFile:
    """A file opened for reading; blocks are decoded only when asked for."""

    def __init__(self, path: str):
        fs, name = _open(path)
        self.file = fs.open_input_file(name)
        size = self.file.size()
        (docs_at, docs_size, index_at, index_size, self.n_ids, self.n_docs, self.block, self.planes,
         magic) = FOOTER.unpack(self._bytes(size - FOOTER.size, FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is not a token file")
        self.press = zstandard.ZstdDecompressor()
        self.docs_place = docs_at, docs_size
        self.index = np.frombuffer(self.press.decompress(self._bytes(index_at, index_size)), "<i8").reshape(-1, 2 + self.planes)
        self.blocks_read = 0

    def _bytes(self, at: int, size: int) -> bytes:
        return self.file.read_at(size, at)

    def documents(self) -> pa.RecordBatch:
        with pa.ipc.open_stream(self._bytes(*self.docs_place)) as r:
            return r.read_next_batch()

    def read_block(self, i: int) -> np.ndarray:
        at, n, *sizes = self.index[i].tolist()
        raw, ends = self._bytes(at, sum(sizes)), np.cumsum([0, *sizes])
        width = n if self.planes == 4 else (n + 7) // 8
        self.blocks_read += 1
        return from_planes([self.press.decompress(raw[a:b], max_output_size=width) if b > a else b"" for a, b in zip(ends, ends[1:])], n)

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids first to last (exclusive) of the file."""
        first, last = max(first, 0), min(last, self.n_ids)
        if first >= last:
            return np.zeros(0, "<u4")
        a, b = first // self.block, (last - 1) // self.block
        return np.concatenate([self.read_block(i) for i in range(a, b + 1)])[first - a * self.block:last - a * self.block]

    def close(self) -> None:
        self.file.close()


def _added(tokenizer) -> list[dict]:
    return json.loads(tokenizer.to_str()).get("added_tokens", [])


def drops_spaces(tokenizer) -> bool:
    """Whether texts can be encoded word by word: white space leaves no
    ids and nothing looks across it."""
    if any(t["lstrip"] or t["rstrip"] or set(t["content"]) & set(" \t\n\v\f\r") for t in _added(tokenizer)):
        return False
    words = [*PROBES, *(t["content"] for t in _added(tokenizer)[:4])]
    one = {w: tokenizer.encode(w, add_special_tokens=False).ids for w in words}
    return all(tokenizer.encode(f"{s}{a}{s}{b}{s}", add_special_tokens=False).ids == one[a] + one[b]
               for a in words for b in words for s in (" ", "\n\t", "\r\v\f"))


def parts_marks(tokenizer) -> bool:
    """Whether a word can also be cut between a letter A-Z and one of
    ``MARKS``, as runs of letters and of marks are encoded apart."""
    ids = lambda x: tokenizer.encode(x, add_special_tokens=False).ids
    added = "".join(t["content"] for t in _added(tokenizer))
    return not set(added) & set(MARKS) and all(
        ids(f"{a}{m}{b}") == ids(a) + ids(m) + ids(b) for m in [*MARKS, "...", ".'", "\"--", "),'1", ".\u0301", "(#\u00e9\u0301."]
        for a in ("Straw", "n't", "I", "\u00e9xX", "1a") for b in ("Berry", "s", "ll've", "x\u0301", "a1"))


def folds_case(tokenizer) -> bool:
    """Whether A-Z and a-z are the same to it (but in added tokens)."""
    ids = lambda x: tokenizer.encode(x, add_special_tokens=False).ids
    return all(ids(w.upper()) == ids(w) for w in ("straw", "o's", "x1y", "berry'll've", "abcdefghijklm", "nopqrstuvwxyz", "a\u0301"))


def separator(tokenizer) -> tuple[str, int] | None:
    """A special token, of one id, that parts a text as ends of texts do."""
    for t in _added(tokenizer):
        one = {w: tokenizer.encode(w, add_special_tokens=False).ids for w in PROBES}
        if t["special"] and all(tokenizer.encode(f"{a}{t['content']}{b}", add_special_tokens=False).ids == [*one[a], t["id"], *one[b]]
                                for a in PROBES for b in PROBES):
            return t["content"], t["id"]
    return None


@dataclass
class Encoder:
    """Batches of texts to one array of ids, the end id behind each text.
    Words met before are looked up; ``KNOWN`` of them are held at most."""
    path: str
    end_id: int

    def __post_init__(self):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(self.path)
        self.by_word = drops_spaces(self.tokenizer)
        self.part = separator(self.tokenizer) if self.by_word else None
        self.marks, self.fold = parts_marks(self.tokenizer), folds_case(self.tokenizer)
        self.added = [t["content"].encode().lower() for t in _added(self.tokenizer)]
        self._forget()

    def _forget(self) -> None:
        self.known, self.size, self.begin, self.flat = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4")

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each text, all ids)."""
        sizes, flats = [], []
        for i in range(0, len(texts), RUN):
            some = texts[i:i + RUN]
            if self.part and (joined := self.part[0].join(some)).count(self.part[0]) == len(some) - 1:
                ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
                ends = np.flatnonzero(ids == self.part[1])
                if len(ends) == len(some) - 1:
                    sizes.append(np.diff(np.concatenate(([-1], ends, [len(ids)]))) - 1)
                    flats.append(np.delete(ids, ends))
                    continue
            found = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
            flats.append(np.fromiter((i for f in found for i in f), "<u4", int(sizes[-1].sum())))
        return np.concatenate([np.zeros(0, np.int64), *sizes]), np.concatenate([np.zeros(0, "<u4"), *flats])

    def _words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(place of each word among the known ones, first word of each text)."""
        buf, off = text_buffer(texts)
        lower = LOWER[buf]
        plain = lower.tobytes()
        if self.fold and not any(t in plain for t in self.added):
            buf = lower
        edge = np.zeros(len(buf) + 1, bool)
        edge[off] = True
        inside = SPACE_WORDS[buf]
        edge[1:-1] |= inside[1:] != inside[:-1]
        if self.marks:
            kind = KIND[buf]
            edge[1:-1] |= kind[1:] * kind[:-1] == 2
        starts = np.flatnonzero(edge[:-1] & inside)
        ends = np.flatnonzero(edge[1:] & inside) + 1
        hashes, at, which = np.unique(hash_spans(buf, starts, ends), return_index=True, return_inverse=True)
        if len(self.known) > KNOWN:
            self._forget()
        new = np.ones(len(hashes), bool)
        if len(self.known):
            new = self.known[np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)] != hashes
        data = buf.tobytes()
        size, flat = self._encode([data[i:j].decode() for i, j in zip(starts[at[new]].tolist(), ends[at[new]].tolist())])
        known = np.concatenate((self.known, hashes[new]))
        order = np.argsort(known)
        self.begin = np.concatenate((self.begin, np.cumsum(size) - size + len(self.flat)))[order]
        self.size, self.known = np.concatenate((self.size, size))[order], known[order]
        self.flat = np.concatenate((self.flat, flat))
        return np.searchsorted(self.known, hashes)[which], np.searchsorted(starts, off)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each text with its end id, all ids)."""
        if self.by_word:
            which, first = self._words(texts)
            size, begin, flat = self.size, self.begin, self.flat
        else:
            first = which = np.arange(len(texts) + 1)
            size, flat = self._encode([t or "" for t in texts.to_pylist()])
            begin, which = np.cumsum(size) - size, which[:-1]
        many = size[which]
        ends = np.concatenate(([0], np.cumsum(many)))
        n = np.diff(ends[first])
        out = np.full(int(ends[-1]) + len(n), self.end_id, "<u4")
        at = np.arange(ends[-1])
        out[at + np.repeat(np.arange(len(n)), n)] = flat[np.repeat(begin[which] - ends[:-1], many) + at]
        return n + 1, out


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, end_id: int) -> Encoder:
    """This process's encoder: a worker that serves task after task loads the
    tokenizer once and keeps the words it met.  A changed file is a new one."""
    file = os.stat(path)
    key = (path, end_id, file.st_ino, file.st_size, file.st_mtime_ns)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(path, end_id)
    return _ENCODERS[key]


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int, block: int = BLOCK, planes: int = 4) -> None:
    """Write the ids of ``docs`` (doc_id, text) into new files of ``folder``
    (which all executors share) and their manifest.  ``planes``: 32 bit or 4
    byte planes; ``tokenizer`` is the path of a tokenizers file."""
    if planes not in (4, 32) or block < 8:
        raise ValueError("planes is 4 or 32, block at least 8")
    folder = folder.rstrip("/")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        writer, encode = None, None
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.planes"
        for batch in chunks(gathered(batches, "text", BATCH), "text", BATCH):
            if writer is None:
                writer, encode = Writer(f"{folder}/{name}", block, planes), encoder(tokenizer, end_id)
            writer.add(batch.column("doc_id"), *encode(batch.column("text")))
        if writer is not None:
            n_docs = writer.close()
            yield pa.RecordBatch.from_pylist([{"part": TaskContext.get().partitionId(), "name": name, "n_docs": n_docs,
                                               "n_ids": writer.n_ids, "n_bytes": writer.at}], MANIFEST)

    rows = dealt.mapInArrow(run, "part long, name string, n_docs long, n_ids long, n_bytes long")
    rows.write.parquet(f"{folder}/files")
    files = docs.sparkSession.read.parquet(f"{folder}/files").withColumn("g", F.floor(F.col("part") / GROUP))
    within, before = Window.partitionBy("g").orderBy("part"), Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    groups = files.groupBy("g").agg(F.sum("n_ids").alias("s")).select("g", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("base"))
    start = F.col("base") + F.sum("n_ids").over(within) - F.col("n_ids")
    files.join(groups, "g").select("part", "name", "n_docs", "n_ids", "n_bytes", start.alias("start")).write.parquet(f"{folder}/manifest")


MANIFEST = pa.schema([("part", pa.int64()), ("name", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_bytes", pa.int64())])


def _documents(path: str, base: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    """A file's documents, some blocks at a time; one that runs over many
    blocks is summed as they come (and held whole only for ``with_ids``)."""
    file = TokenFile(path)
    docs = file.documents()
    size = docs.column("n_tokens").to_numpy()
    ends = np.cumsum(size)
    at, crc, parts, found, sums, done = 0, 0, [], [], [], 0
    for i in range(len(file.index)):
        ids = file.read_block(i)
        raw, first = memoryview(ids.tobytes()), i * file.block
        while at < len(size):
            a, b = max(int(ends[at] - size[at]) - first, 0), int(ends[at]) - first
            crc = zlib.crc32(raw[4 * a:4 * min(b, len(ids))], crc)
            if with_ids:
                parts.append(ids[a:b])
            if b > len(ids):
                break
            sums.append(crc)
            if with_ids:
                found.append(np.concatenate(parts))
            at, crc, parts = at + 1, 0, []
            if b == len(ids):
                break
        if at > done:
            cols = [docs.column("doc_id").slice(done, at - done), pa.array(base + ends[done:at] - size[done:at], pa.int64()),
                    pa.array(size[done:at], pa.int64()), pa.array(sums, pa.int64())]
            names = ["doc_id", "start", "n_tokens", "ids_crc32"]
            if with_ids:
                off = np.concatenate(([0], np.cumsum(size[done:at]))).astype(np.int32)
                cols.append(pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate(found).astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)
            done, sums, found = at, [], []
    file.close()


def read_tokens(spark: SparkSession, folder: str, id_type: str = "long", with_ids: bool = True) -> DataFrame:
    """Documents of ``folder``: doc_id, start (ids of all documents before
    it), n_tokens, ids_crc32 (of its ids as little-endian unsigned 32-bit
    integers) and, if asked for, ids.  A task reads some files."""
    folder = folder.rstrip("/")
    files = spark.read.parquet(f"{folder}/manifest").select("name", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                yield from _documents(f"{folder}/{r['name']}", r["start"], with_ids)

    fields = f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    spread = files.repartition(max(1, min(files.count(), 10_000)))
    return spread.mapInArrow(run, fields)

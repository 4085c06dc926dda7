"""Language ID by error-correcting output codes.

Every language has a codeword of bits; one logistic classifier per bit, on
hashed character n-gram (1 to 3 bytes of the lower-cased text) weights,
predicts it.  A text's language is the codeword of the least weighted
logistic loss, each bit weighted by its training accuracy; a small gap to
the second flags ambiguity.  The classifiers are fitted on a bounded sample
of ``PER_LANGUAGE`` documents of each language (whole texts), taken by hash
among those not held out.

Defined results: null text and text without a letter give ``und`` with
score 0; without training rows everything is ``und``; a null doc_id is not
held out; rows with null lang are predicted but never learnt from; an empty
table gives an empty result.  Input columns named like an output column are
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import without
from .vector import _LOWER, chunks, text_buffer

PER_LANGUAGE = 250
DIM = 1 << 12
CHUNK, ROWS = 1 << 20, 256      # bytes of text and texts handled at once
GAP = 0.2
OUT = {"lang_pred": "string", "score": "double", "ambiguous": "boolean"}


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1


def features(texts: pa.Array) -> np.ndarray:
    """One unit vector of n-gram weights per text."""
    raw, off = text_buffer(texts)
    b = _LOWER[raw].astype(np.uint32)
    size = np.diff(off)
    doc = np.repeat(np.arange(len(size)), size)
    x = np.zeros(len(size) * DIM)
    gram = np.zeros(len(b), np.uint32)
    for n in (1, 2, 3):
        live = len(b) - n + 1
        if live <= 0:
            break
        gram = gram[:live] * np.uint32(257) + b[n - 1:n - 1 + live]
        whole = doc[:live] == doc[n - 1:n - 1 + live]
        slot = ((gram + np.uint32(n * 7919)) * np.uint32(2654435761)) >> np.uint32(20)
        x += np.bincount((doc[:live] * DIM + slot)[whole], minlength=len(x))
    x = np.sqrt(x.reshape(len(size), DIM))
    return (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def codewords(n: int) -> np.ndarray:
    """n rows of +-1 bits: the exhaustive code up to six languages, else the
    random code with the greatest least distance of 200."""
    if n <= 6:
        bits = range(1, 1 << (n - 1)) if n > 1 else [0]
        return np.array([[1 if (b >> max(0, i - 1)) & 1 and i else -1 for b in bits] for i in range(n)], float)
    r, best = np.random.default_rng(11), None
    for _ in range(200):
        m = r.choice([-1.0, 1.0], (n, max(15, int(10 * np.log2(n)))))
        gap = (len(m[0]) - m @ m.T)[~np.eye(n, dtype=bool)].min()
        if best is None or gap > best[0]:
            best = (gap, m)
    return best[1]


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray
    weights: np.ndarray     # features + 1 by bits
    trust: np.ndarray       # weight of each bit

    @staticmethod
    def fit(x: np.ndarray, langs: list[str], steps: int = 300) -> Model:
        names = sorted(set(langs))
        y = np.array([names.index(v) for v in langs])
        code = codewords(len(names))
        t = (code[y] + 1) / 2
        x1 = np.hstack((x, np.ones((len(x), 1), np.float32)))
        balance = (1 / np.bincount(y))[y][:, None] / len(names)
        w, speed = np.zeros((x1.shape[1], code.shape[1])), 0.0
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
            speed = 0.9 * speed - 4.0 * (x1.T @ ((p - t) * balance) + 1e-4 * w)
            w = w + speed
        right = ((x1 @ w > 0) == (t > 0.5)).mean(0)
        return Model(names, code, w.astype(np.float32), np.maximum(right - 0.5, 0.01) / np.maximum(right - 0.5, 0.01).sum())

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language number, probability, gap to the second)."""
        f = x @ self.weights[:-1] + self.weights[-1]
        loss = (np.logaddexp(0, -self.code[None] * f[:, None, :]) * self.trust).sum(2) * self.code.shape[1]
        p = np.exp(-(loss - loss.min(1, keepdims=True)))
        p /= p.sum(1, keepdims=True)
        top = np.sort(p, 1)[:, ::-1]
        return loss.argmin(1), top[:, 0], top[:, 0] - (top[:, 1] if p.shape[1] > 1 else 0)


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """Fitted on at most about ``per_language`` documents of each language."""
    seen = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r.lang: r.n for r in seen.groupBy("lang").agg(F.count("*").alias("n")).collect()}   # one row per language
    if not counts:
        return None
    share = F.create_map(*[F.lit(v) for k, n in sorted(counts.items()) for v in (k, min(1.0, per_language / n))])
    chance = F.pmod(F.xxhash64(F.lit(17), F.col("doc_id"), F.col("text")), F.lit(1 << 30)) / float(1 << 30)
    picked = seen.where(chance < F.element_at(share, F.col("lang"))).select("text", "lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", CHUNK, ROWS):
            x = features(batch.column("text"))
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes() for v in x], pa.binary()), batch.column("lang")], ["x", "lang"])

    rows = picked.mapInArrow(run, "x binary, lang string").collect()      # a bounded sample
    rows.sort(key=lambda r: (r.lang, bytes(r.x)))
    if not rows:
        return None
    return Model.fit(np.stack([np.frombuffer(r.x, np.float32) for r in rows]), [r.lang for r in rows])


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` (text, ...) with lang_pred, score and ambiguous."""
    docs = without(docs, *OUT, "_letter")
    seen = docs.withColumn("_letter", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    if model is None:
        return docs.select("*", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("ambiguous"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in chunks(batches, "text", CHUNK, ROWS):
            letter = batch.column("_letter").to_numpy(zero_copy_only=False)
            lang, score, gap = m.decode(features(batch.column("text")))
            new = [pa.array([m.langs[i] if ok else "und" for i, ok in zip(lang, letter, strict=True)]),
                   pa.array(np.where(letter, np.clip(score, 0, 1), 0.0)), pa.array((gap < GAP) | ~letter)]
            keep = [i for i, n in enumerate(batch.schema.names) if n != "_letter"]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in keep], *new], [*[batch.schema.names[i] for i in keep], *OUT])

    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"{k} {v}" for k, v in OUT.items()])
    return seen.mapInArrow(run, fields)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous of every document."""
    held = docs.select("doc_id", "text", held_out().alias("held_out"))
    return predict(held, train(docs)).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")

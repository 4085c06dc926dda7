"""Secret scans: rules plus a character convolutional network in numpy.

Three rules find assignments, access keys and long hexadecimal runs.  The
network scores every other candidate, a run of 16 or more key characters
with a digit and a letter, together with its surroundings; of a longer one
every window of ``INSIDE`` characters, the best of which counts.  What rules
leave of a run is a candidate, too.  The network is trained on
labelled findings: the windows of rule matches, with and without the
name that gives them away (positive; bare digit runs, which are mostly card numbers,
negative), and of candidates that are plainly words and numbers (``plain``;
negative), all distinct ones of all documents, whole texts.
Other candidates have no label: a bare key among them must not be taught to
be clean.  Windows are dealt into shards of about ``SHARD`` of each label (the
rarer label's go to several); in each of ``EPOCHS`` rounds every shard trains
on from the common weights, which then are the shards' mean.  The scores are
calibrated on held-out windows, a quarter of all; the threshold is the highest at which
``MIN_RECALL`` of the held-out positives pass (to 2 ** -40 of a raw score).

Defined results: null text is empty; without windows of both labels the network
adds nothing; repeated rows are scanned alike; an empty table gives an
empty result.  Spans are code points, end exclusive.  Input columns named
like an output column are replaced.
"""

from __future__ import annotations

import copy
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import cut, without

KINDS = ("assign", "access", "hex", "cnn")
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
SIGNS, PLAIN = re.compile(r"[+/_=-]+"), re.compile(r"[A-Z]?[a-z]{0,15}|[A-Z]{1,15}|[0-9]{1,8}")
SHARD = 3_000               # windows of each label
EPOCHS = 12
SUM = "decimal(30,18)"      # weights are summed as decimals: the same in any order
MIN_RECALL = 0.98
BEFORE, INSIDE, AFTER = 16, 32, 8
WIDTH = BEFORE + INSIDE + AFTER
OUT = {"n_assign": "long", "n_access": "long", "n_hex": "long", "base_sha256": "string", "spans": "string",
       "findings": "array<struct<kind:string,start:long,end:long,score:double>>"}


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the rules' findings, in order."""
    out = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def value_span(text: str, start: int, kind: int, end: int) -> tuple[int, int]:
    """The secret itself within a finding."""
    return ASSIGN.match(text, start).span(1) if kind == 0 else (start, end)


def is_candidate(s: str) -> bool:
    return len(s) >= 16 and any("0" <= c <= "9" for c in s) and any(c.isalpha() for c in s)


def other_candidates(text: str, rules: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Candidates, less what rules found of them."""
    out = []
    for m in CANDIDATE.finditer(text):
        if is_candidate(m[0]):
            at = m.start()
            for a, _, b in [r for r in rules if r[0] < m.end() and m.start() < r[2]] + [(m.end(), 0, m.end())]:
                if is_candidate(text[at:max(at, a)]):
                    out.append((at, a))
                at = max(at, b)
    return out


def plain(s: str) -> bool:
    """Whether a candidate is words and numbers joined by signs: each part
    letters of one case (or one capital first), or up to eight digits."""
    return all(PLAIN.fullmatch(x) for x in SIGNS.split(s))


def window(text: str, start: int, end: int) -> bytes:
    """Character classes of a candidate and its surroundings: printable ASCII
    as itself, other letters 1, other characters 2, padding 0."""
    parts = (text[max(0, start - BEFORE):start].rjust(BEFORE, "\0"), text[start:end][:INSIDE].ljust(INSIDE, "\0"),
             text[end:end + AFTER].ljust(AFTER, "\0"))
    return window_codes("".join(parts))


def window_codes(s: str) -> bytes:
    return bytes(o if (o := ord(c)) == 0 or 32 <= o < 127 else 1 if c.isalpha() else 2 for c in s)


def windows(text: str, start: int, end: int) -> list[bytes]:
    """The windows of a candidate, one for each place where ``INSIDE`` of its
    characters begin."""
    if end - start <= INSIDE:
        return [window(text, start, end)]
    a = max(0, start - BEFORE)
    codes = window_codes(text[a:start].rjust(BEFORE, "\0") + text[start:end + AFTER].ljust(end - start + AFTER, "\0"))
    return [codes[i:i + WIDTH] for i in range(end - start - INSIDE + 1)]


class CharNet:
    """Embedding, one convolution, rectifier, maximum over places, logistic
    output; trained by Adam, then a calibrated slope and offset."""

    def __init__(self, seed: int = 5, depth: int = 8, filters: int = 24, span: int = 5):
        r = np.random.default_rng(seed)
        self.span = span
        self.p = {"emb": r.normal(0, 0.3, (127, depth)), "conv": r.normal(0, 0.3, (span * depth, filters)),
                  "bias": np.zeros(filters), "out": r.normal(0, 0.3, filters), "off": np.zeros(1)}
        self.m = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.t = 0
        self.slope, self.shift, self.threshold = 1.0, 0.0, 1.0

    def _forward(self, x: np.ndarray):
        places = np.lib.stride_tricks.sliding_window_view(x, self.span, axis=1)         # n, places, span
        e = self.p["emb"][places].reshape(len(x), places.shape[1], -1)
        z = e @ self.p["conv"] + self.p["bias"]
        top = z.argmax(1)
        best = np.take_along_axis(z, top[:, None, :], 1)[:, 0]
        h = np.maximum(best, 0)
        return places, e, top, best, h, h @ self.p["out"] + self.p["off"][0]

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros(0), *[self._forward(x[i:i + 512])[-1] for i in range(0, len(x), 512)]])

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probabilities."""
        return self.probability(self.raw(x))

    def probability(self, raw):
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.shift, -30, 30)))

    def state(self) -> np.ndarray:
        """All weights with both of Adam's means, in one row."""
        return np.concatenate([d[k].ravel() for d in (self.p, self.m, self.v) for k in self.p])

    def set_state(self, flat: np.ndarray) -> None:
        at = 0
        for d in (self.p, self.m, self.v):
            for k, old in self.p.items():
                d[k] = flat[at:at + old.size].reshape(old.shape)
                at += old.size

    def epoch(self, x: np.ndarray, y: np.ndarray, r: np.random.Generator, rate: float = 0.01) -> CharNet:
        """One pass of Adam over some windows."""
        weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
        for rows in np.array_split(r.permutation(len(y)), max(1, len(y) // 64)):
            places, e, top, best, h, raw = self._forward(x[rows])
            d = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y[rows]) * weight[rows] / len(rows)
            dh = np.outer(d, self.p["out"]) * (best > 0)
            picked = np.take_along_axis(e, top[:, :, None], 1)                         # n, filters, span * depth
            g = {"out": h.T @ d, "off": d.sum(keepdims=True), "bias": dh.sum(0),
                 "conv": np.einsum("nf,nfk->kf", dh, picked), "emb": np.zeros_like(self.p["emb"])}
            back = (dh[:, :, None] * self.p["conv"].T[None]).reshape(len(rows), dh.shape[1], self.span, -1)
            np.add.at(g["emb"], np.take_along_axis(places, top[:, :, None], 1), back)
            self.t += 1
            for k in self.p:
                self.m[k] = 0.9 * self.m[k] + 0.1 * g[k]
                self.v[k] = 0.999 * self.v[k] + 0.001 * g[k] ** 2
                self.p[k] = self.p[k] - rate * (self.m[k] / (1 - 0.9 ** self.t)) / (np.sqrt(self.v[k] / (1 - 0.999 ** self.t)) + 1e-8)
        return self

    def calibrate(self, raw: np.ndarray, y: np.ndarray, n: np.ndarray) -> CharNet:
        """Slope and offset by gradient steps on n windows of each raw score
        and label."""
        a, b, share = 1.0, 0.0, n / n.sum()
        for _ in range(300):
            d = (1 / (1 + np.exp(-np.clip(a * raw + b, -30, 30))) - y) * share
            a, b = a - 0.05 * float((d * raw).sum()), b - 0.05 * float(d.sum())
        self.slope, self.shift = a, b
        return self


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in set(batch.column("text").to_pylist()):
            text = text or ""
            rules = rule_spans(text)
            for a, k, b in rules:
                v, w = value_span(text, a, k, b)
                found = int(k < 2 or not text[a:b].isdigit())
                rows.append((window(text, v, w), found))
                if v > a:                        # the value without the name that gives it away
                    near = text[max(0, a - BEFORE):a]
                    rows.append((window(near + text[v:w + AFTER], len(near), len(near) + w - v), found))
            rows += [(w, 0) for a, b in other_candidates(text, rules) if plain(text[a:b]) for w in windows(text, a, b)]
        rows = sorted(set(rows))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int32())],
                                         ["window", "label"])


def _codes(windows: bytes) -> np.ndarray:
    return np.frombuffer(windows, np.uint8).reshape(-1, WIDTH).astype(np.int64)


def _shards(rows: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """``rows`` (window, label, h) -> a row for each shard: its windows, one
    behind the other, and their labels.  Every shard has windows of both
    labels in like number: of the rarer label a window goes to several."""
    most = max(sizes.values())
    shards = (most - 1) // SHARD + 1
    copies = F.when(F.col("label") == 1, min(shards, most // sizes[1])).otherwise(min(shards, most // sizes[0]))
    dealt = rows.withColumn("j", F.explode(F.sequence(F.lit(0), copies - 1)))
    dealt = dealt.withColumn("shard", F.pmod(F.shiftright("h", 2) + F.col("j"), F.lit(shards)))
    packed = dealt.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("h", "window", "label"))).alias("r"))
    return packed.select("shard", F.col("r.window").alias("window"), F.col("r.label").alias("label")).repartition(shards).checkpoint()


def _train_round(net: CharNet, number: int, shards: int):
    """A pass over each shard from the common weights; its share of the new."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                own = copy.deepcopy(net)
                x, y = _codes(b"".join(r["window"])), np.array(r["label"])
                flat = own.epoch(x, y, np.random.default_rng([6, number, r["shard"]])).state() / shards
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat), pa.array(np.full(len(flat), own.t))],
                                                 ["i", "w", "t"])

    return run


def _raw_scores(net: CharNet):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = net.raw(_codes(b"".join(batch.column("window").to_pylist())))
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(raw)], ["label", "raw"])

    return run


def _order_statistic(values: DataFrame, place: int) -> float:
    """The value ``v`` with ``place`` smaller ones, or up to 2 ** -40 less:
    found by counts in cells, then in the cells of that cell, so at most some
    ten thousand counts are gathered at once."""
    low, wide = None, 2.0 ** -8
    for width in (wide, 2.0 ** -24, 2.0 ** -40):
        cell = F.floor(F.col("v") / F.lit(width))
        some = values if low is None else values.where((F.col("v") >= low) & (F.col("v") < low + wide))
        for r in sorted(some.groupBy(cell.alias("c")).count().collect()):
            if place < r[1]:
                low, wide = r.c * width, width
                break
            place -= r[1]
    return low


def train(docs: DataFrame) -> CharNet | None:
    """A network fitted on the labelled windows of all documents; None
    without both labels."""
    found = docs.select("text").mapInArrow(_labelled, "window binary, label int").distinct()
    rows = cut(found.withColumn("h", F.xxhash64("window", F.lit(3))))
    held = F.pmod("h", F.lit(4)) == 0
    n = {(r.label, r.held): r["count"] for r in rows.groupBy("label", held.alias("held")).count().collect()}
    if len({label for label, _ in n}) < 2:
        return None
    split = n.get((1, True), 0) >= 5            # else all positives are trained and calibrated on
    fit = rows.where(~held | (F.lit(not split) & (F.col("label") == 1)))
    sizes = {0: n.get((0, False), 0), 1: n.get((1, False), 0) + (0 if split else n.get((1, True), 0))}
    if min(sizes.values()) == 0:                # a handful of windows
        fit, sizes = rows, {k: n.get((k, True), 0) + n.get((k, False), 0) for k in (0, 1)}
    shards = _shards(fit, sizes)
    many, net = shards.count(), CharNet()
    for i in range(EPOCHS):
        new = shards.mapInArrow(_train_round(net, i, many), "i long, w double, t long")
        new = new.groupBy("i").agg(F.sum(F.col("w").cast(SUM)).cast("double").alias("w"), F.max("t").alias("t")).collect()
        flat = np.zeros(len(new))
        flat[[r.i for r in new]] = [r.w for r in new]
        net.set_state(flat)
        net.t = max(r.t for r in new)
    scores = cut((rows.where(held) if split else rows).select("window", "label").mapInArrow(_raw_scores(net), "label int, raw double"))
    cell = F.round(F.greatest(F.least("raw", F.lit(100.0)), F.lit(-100.0)) * 256) / 256
    counts = np.array([tuple(r) for r in sorted(scores.groupBy(cell.alias("c"), "label").count().collect())], float)
    net.calibrate(counts[:, 0], counts[:, 1], counts[:, 2])
    place = int((1 - MIN_RECALL) * counts[counts[:, 1] == 1, 2].sum())
    z = F.greatest(F.least(F.col("raw") * net.slope + net.shift, F.lit(30.0)), F.lit(-30.0))
    low = _order_statistic(scores.where("label = 1").select(z.alias("v")), place)
    net.threshold = float(1 / (1 + np.exp(-low)))
    return net


def best_scores(model: CharNet, lists: list[list[bytes]]) -> np.ndarray:
    """The best score of each list of windows; equal windows count once."""
    places: dict[bytes, int] = {}
    at = np.array([places.setdefault(w, len(places)) for x in lists for w in x])
    x = np.frombuffer(b"".join(places), np.uint8).reshape(-1, WIDTH)
    p = np.concatenate([model.score(x[i:i + 4096].astype(np.int64)) for i in range(0, len(x), 4096)])
    return np.maximum.reduceat(p[at], np.cumsum([0] + [len(x) for x in lists[:-1]]))


def scan(docs: DataFrame, net: CharNet | None) -> DataFrame:
    """``docs`` (text, ...) with counts, base_sha256, spans and findings."""
    docs = without(docs, *OUT)
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            base = [rule_spans(t) for t in texts]
            more = [(i, a, b) for i, t in enumerate(texts) for a, b in other_candidates(t, base[i])] if model else []
            lists = [windows(texts[i], a, b) for i, a, b in more] + [
                [window(texts[i], *value_span(texts[i], a, k, b))] for i, r in enumerate(base) for a, k, b in r]
            p = best_scores(model, lists) if model and lists else np.zeros(0)
            found = [[] for _ in texts]
            for (i, a, b), s in zip(more, p, strict=False):
                if s >= model.threshold:
                    found[i].append((a, 3, b, float(s)))
            own = iter(p[len(more):])
            for i, r in enumerate(base):
                found[i] = sorted(found[i] + [(a, k, b, float(next(own, 1.0))) for a, k, b in r])
            text_of = lambda spans: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b, *_ in spans)
            new = [pa.array([sum(k == n for _, k, _ in r) for r in base], pa.int64()) for n in range(3)]
            new += [pa.array([hashlib.sha256(text_of(r).encode()).hexdigest() for r in base]), pa.array([text_of(f) for f in found]),
                    pa.array([[{"kind": KINDS[k], "start": a, "end": b, "score": s} for a, k, b, s in f] for f in found],
                             pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *OUT])

    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"{k} {v}" for k, v in OUT.items()])
    return docs.mapInArrow(run, fields)


def scan_secrets(docs: DataFrame) -> DataFrame:
    return scan(docs, train(docs))

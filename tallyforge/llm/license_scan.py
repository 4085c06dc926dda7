"""License scans: winnowed template fingerprints, then banded alignment.

Every template's 3-word shingles are hashed and winnowed (the least hash of
each run of three); the kept ones form an inverted index from hash to
(template, place).  All 3-word shingles of a text are looked up in it; hits
of one template on diagonals no further apart than a passing match can stray
are a candidate region, which is aligned with the template by dynamic
programming in a band around the hits' diagonals; the match's words are
masked and the rest aligned again, and a region that doesn't pass is divided.  A match is reported when at least ``least`` of the template's
words, and of the words in its span, are aligned, with coverage and span.  Words outside the templates'
vocabulary can't be part of a shingle and are passed over by array
operations; the index has the size of the templates.

Defined results: null and empty text have no matches; repeated rows are
scanned alike; overlapping matches of different templates are all reported,
of the same template only the better (then the earlier); an empty table
gives an empty result.  Spans are code points, end exclusive.  Input columns
named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .util import without
from .vector import ALNUM_WORDS, U, Words, chunks, mix, split_words

K, RUN = 3, 3
LEAST = 0.8
CHUNK = 4 << 20
OUT = {"n_matches": "long", "licenses": "string", "matches":
       "array<struct<license:string,coverage:double,matched:long,start:long,end:long>>"}

# Public license notices.
TEMPLATES = {
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details."),
    "MIT-line": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."),
}


def shingle_hashes(ids: np.ndarray) -> np.ndarray:
    """Hash of the K-word shingle at each place."""
    out = np.full(max(0, len(ids) - K + 1), U(K))
    for i in range(K if len(out) else 0):
        out = mix(out ^ ids[i:i + len(out)].astype(U)) * U(0x9E3779B97F4A7C15)
    return out


def winnow(h: np.ndarray) -> np.ndarray:
    """Places of the rightmost least hash in every run of RUN."""
    if len(h) <= RUN:
        return np.array([len(h) - 1 - int(h[::-1].argmin())]) if len(h) else np.zeros(0, np.int64)
    v = np.lib.stride_tricks.sliding_window_view(h, RUN)
    return np.unique(np.arange(len(v)) + RUN - 1 - v[:, ::-1].argmin(1))


class Index:
    """Template words by hash and the inverted index of fingerprints."""

    def __init__(self, templates: dict[str, str]):
        self.names = sorted(templates)
        w = split_words(pa.array([templates[n] for n in self.names], pa.string()), ALNUM_WORDS)
        self.vocabulary = np.unique(w.hashes)
        ids = np.searchsorted(self.vocabulary, w.hashes) + 1
        self.words = [ids[w.first[i]:w.first[i + 1]] for i in range(len(self.names))]
        rows = [(h, t, p) for t, own in enumerate(self.words) for h, p in
                ((hs[p], p) for hs in [shingle_hashes(own)] for p in winnow(hs).tolist())]
        rows.sort()
        self.hashes = np.array([r[0] for r in rows], U)
        self.template, self.place = (np.array([r[i] for r in rows], np.int64) for i in (1, 2))

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, template, place in it) of the known shingles."""
        known = ids > 0
        at = np.flatnonzero(known[:-2] & known[1:-1] & known[2:]) if len(ids) >= K else np.zeros(0, np.int64)
        if not len(at) or not len(self.hashes):
            return at[:0], at[:0], at[:0]
        h = np.full(len(at), U(K))
        for i in range(K):
            h = mix(h ^ ids[at + i].astype(U)) * U(0x9E3779B97F4A7C15)
        lo, hi = np.searchsorted(self.hashes, h), np.searchsorted(self.hashes, h, "right")
        n = hi - lo
        row = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(at, n), self.template[row], self.place[row]


def align(template: np.ndarray, text: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """Most template words matched in order to words of ``text`` on diagonals
    low..high (text place less template place): (matched, first, last text
    place).  Ties prefer the shorter span, then the earlier."""
    width = high - low + 1
    best = np.zeros(width, np.int64)                  # matches ending on each diagonal
    first, last = np.full(width, -1), np.full(width, -1)
    for i, word in enumerate(template):
        j = i + low + np.arange(width)
        ok = (j >= 0) & (j < len(text))
        same = np.zeros(width, bool)
        same[ok] = text[j[ok]] == word
        # skipping a template word moves one diagonal down at the same text place
        down, down_f, down_l = (np.concatenate((v[1:], [z])) for v, z in ((best, 0), (first, -1), (last, -1)))
        take = same
        new = np.where(take, best + 1, 0)
        new_f, new_l = np.where(take & (first < 0), j, first), np.where(take, j, last)
        skip = down > new
        new, new_f, new_l = np.where(skip, down, new), np.where(skip, down_f, new_f), np.where(skip, down_l, new_l)
        # skipping text words moves up along the row
        best = np.maximum.accumulate(new)
        source = np.maximum.accumulate(np.where(new == best, np.arange(width), 0))
        first, last = new_f[source], new_l[source]
    k = int(np.lexsort((first, last - first, -best))[0])
    return int(best[k]), int(first[k]), int(last[k])


def _stretches(group: np.ndarray, diagonal: np.ndarray, most: int, overlap: int) -> list[np.ndarray]:
    """A group over many diagonals in overlapping stretches of at most
    ``most``: hits of one match are at most ``overlap`` diagonals apart, so a
    stretch holds them all."""
    d = diagonal[group]
    if d[-1] - d[0] <= most:
        return [group]
    starts = np.arange(d[0], d[-1] + 1, most - overlap)
    parts = [group[np.searchsorted(d, a):np.searchsorted(d, a + most, "right")] for a in starts.tolist()]
    return [x for x in parts if len(x)]


def document_matches(ids: np.ndarray, hits, index: Index, least: float) -> list[tuple[int, int, int, int]]:
    """(first word, last word, template, matched) of one text's matches;
    ``hits`` are its (word, template, place)."""
    out = []
    at, tem, place = hits
    for t in np.unique(tem).tolist():
        own = tem == t
        p, diagonal = at[own], at[own] - place[own]
        by = np.lexsort((p, diagonal))
        p, diagonal = p[by], diagonal[by]
        # a passing match strays by at most ``drift`` from the diagonal of any of its hits
        size = len(index.words[t])
        drift = int(size * (1 / least - 1) + 1e-9)
        new = (np.diff(diagonal) > drift) | (np.abs(np.diff(p)) > size + drift)
        found = []
        groups = np.split(np.arange(len(p)), np.flatnonzero(new) + 1)
        todo = [(part, ids) for g in groups for part in _stretches(g, diagonal, 8 * (size + drift), 2 * drift)]
        while todo:
            group, text = todo.pop()
            d0, d1 = int(diagonal[group[0]]) - drift, int(diagonal[group[-1]]) + drift
            lo, hi = max(0, d0), min(len(ids), d1 + size)
            if np.isin(index.words[t], text[lo:hi]).sum() < least * size:
                continue                                          # nor can any part of it
            n, a, b = align(index.words[t], text[lo:hi], d0 - lo, d1 - lo)
            if n >= least * size and n >= least * (b - a + 1):
                found.append((-n, a + lo, b + lo))
                rest = group[(p[group] + K <= a + lo) | (p[group] > b + lo)]
                if len(rest):
                    text = text.copy()
                    text[a + lo:b + lo + 1] = 0                   # aligned words are used up
                gaps = np.flatnonzero(np.diff(diagonal[rest]) > drift) + 1
                todo += [(g, text) for g in np.split(rest, gaps) if len(g)]
            elif diagonal[group[0]] < diagonal[group[-1]]:        # words of several places: apart at the widest gap
                cut = int(np.diff(diagonal[group]).argmax()) + 1
                todo += [(group[:cut], text), (group[cut:], text)]
        kept: list[tuple[int, int, int]] = []
        for n, a, b in sorted(found):
            if all(b < x or y < a for _, x, y in kept):
                kept.append((n, a, b))
        out += [(a, b, t, -n) for n, a, b in kept]
    return sorted(out)


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST) -> DataFrame:
    """``docs`` (text, ...) with n_matches, licenses (names by place,
    comma-joined) and matches."""
    docs = without(docs, *OUT)
    sent = docs.sparkSession.sparkContext.broadcast(Index(TEMPLATES if templates is None else templates))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = sent.value
        for batch in chunks(batches, "text", CHUNK):
            w = split_words(batch.column("text"), ALNUM_WORDS)
            found = _matches(w, index, least)
            rows = [[{"license": index.names[t], "coverage": n / len(index.words[t]), "matched": n, "start": s, "end": e}
                     for s, e, t, n in f] for f in found]
            new = [pa.array([len(r) for r in rows], pa.int64()), pa.array([",".join(m["license"] for m in r) for r in rows], pa.string()),
                   pa.array(rows, pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("matched", pa.int64()),
                                                      ("start", pa.int64()), ("end", pa.int64())])))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *OUT])

    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"{k} {v}" for k, v in OUT.items()])
    return docs.mapInArrow(run, fields)


def _matches(w: Words, index: Index, least: float) -> list[list[tuple[int, int, int, int]]]:
    out: list[list] = [[] for _ in range(len(w.first) - 1)]
    if not len(w.hashes) or not len(index.vocabulary):
        return out
    place = np.searchsorted(index.vocabulary, w.hashes)
    place[place == len(index.vocabulary)] = 0
    ids = np.where(index.vocabulary[place] == w.hashes, place + 1, 0)
    at, tem, pos = index.hits(ids)
    doc = np.searchsorted(w.first, at, "right") - 1
    inside = at + K <= w.first[doc + 1]                 # no shingle across texts
    at, tem, pos, doc = at[inside], tem[inside], pos[inside], doc[inside]
    for d in np.unique(doc).tolist():
        own, a = doc == d, int(w.first[d])
        found = document_matches(ids[a:w.first[d + 1]], (at[own] - a, tem[own], pos[own]), index, least)
        if found:
            s = w.code_points(d, w.starts[[a + f[0] for f in found]])
            e = w.code_points(d, w.ends[[a + f[1] for f in found]])
            out[d] = [(int(x), int(y), f[2], f[3]) for x, y, f in zip(s, e, found, strict=True)]
    return out

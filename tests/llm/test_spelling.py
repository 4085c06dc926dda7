"""Spelling variants against all pairs of the vocabulary."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyforge.llm import spelling

from .helpers import SCHEMA, lower_az


def brute_words(rows):
    c = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower_az(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            c[run] += 1
    return {w: n for w, n in c.items() if len(w) >= 7 and n >= 2}


def one_edit(x, y):
    x, y = sorted((x, y), key=len)
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    return len(y) == len(x) + 1 and any(y[:i] + y[i + 1:] == x for i in range(len(y)))


def brute_variants(words):
    form, near = {}, {}
    for w in words:
        near[w] = [v for v in words if abs(len(v) - len(w)) <= 1 and one_edit(v, w)]
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), form[w] and words[form[w]]))
    return sorted(out)


def variants(rng, n, letters, least=7):
    """Words and words at one or two edits of them."""
    words = {}
    while len(words) < n:
        w = "".join(rng.choice(letters) for _ in range(rng.randrange(least, least + 6)))
        for _ in range(rng.randrange(4)):
            words[w] = rng.choice([2, 3, 25, 400, 5000])
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i + 1:], w[:i] + rng.choice(letters) + w[i:]])
            if len(w) < least:
                break
    return words


@pytest.mark.parametrize("seed,letters,most", [(1, "abc", 4000), (2, "abéÿ", 5), (3, "aab", 2), (4, "abcdefghij", 50)])
def test_variants_against_all_pairs(spark, seed, letters, most):
    words = variants(random.Random(seed), 500, letters)
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(4)
    got = spelling.group_variants(df, most=most).collect()
    assert sorted(map(tuple, got)) == brute_variants(words)


def test_hot_lists_are_dealt_on_and_pairs_come_once(spark):
    """Thousands of words with the same first half, then the same both ends."""
    rng = random.Random(9)
    words = {"sameprefix" + "".join(rng.choice("abcd") for _ in range(rng.randrange(8, 11))): rng.randrange(2, 100) for _ in range(1500)}
    words |= {"left" + "".join(rng.choice("xyz") for _ in range(rng.randrange(3, 6))) + "right": 5 for _ in range(300)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    rows = spelling.dealt(df, 7, 40).groupBy("key").count()
    assert rows.agg({"count": "max"}).first()[0] <= 40
    pairs = [tuple(r)[:2] for r in spelling.near_words(df, most=40).collect()]
    assert len(pairs) == len(set(pairs))
    by = {}
    for w in words:                                       # words equal but for one place share a pattern
        for i in range(len(w) + 1):
            by.setdefault(w[:i] + "*" + w[i:], set()).add(w)
            by.setdefault(w[:i] + "*" + w[i + 1:], set()).add(w)
    want = {(a, b) for s in by.values() for a in s for b in s if a != b and one_edit(a, b)}
    assert set(pairs) == want and len(want) > 100


def test_scan_skips_far_ranges():
    words = sorted({"".join(random.Random(i).choices("abcdefghijklmnop", k=8)) for i in range(3000)})
    s = spelling.SortedLists(words, np.zeros(len(words), np.int64))
    looked, inner = [], s.children
    s.children = lambda lo, hi, d: looked.append(len(lo)) or inner(lo, hi, d)
    s.near(np.arange(50), 0)
    assert sum(looked) < 50 * len(words) / 10


def test_corpus_words_and_edge_cases(spark):
    rng = random.Random(6)
    base = ["language", "languages", "Strasse", "Élèvesÿ×", "reading", "readings", "mississippi", "abcdefgh"]
    rows = [(i, " ".join(rng.choice(base) + rng.choice(["", ",", "7", "Ā"]) for _ in range(300))) for i in range(60)]
    rows += [(70, None), (71, ""), (72, "short words only"), (None, "language " * 40), (1, rows[1][1]),
             (80, "q" * 3000 + " " + "q" * 3000 + " " + "q" * 2999 + " " + "q" * 2999)]
    docs = spark.createDataFrame([(i, t, "x", 3) for i, t in rows], "doc_id long, text string, word string, n long")
    words = brute_words(rows)
    got = spelling.group_variants(spelling.vocabulary(docs)).collect()
    assert sorted(map(tuple, got)) == brute_variants(words)
    assert any(r.form for r in got) and any(len(r.word) > 2000 and r.n_near for r in got)
    assert spelling.group_variants(spelling.vocabulary(spark.createDataFrame([], SCHEMA))).count() == 0

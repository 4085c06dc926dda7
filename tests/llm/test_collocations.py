"""Collocations against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import collocations as co

from .helpers import SCHEMA, lower_az


def brute(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\v\f\r]", lower_az(text or "")):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        best = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in cand.items() if len(q) > len(p)):
                continue
            s, k = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            best.append((-s, -a, " ".join(p).encode(), a, c[p[:k]], c[p[k:]]))
        best.sort()
        out += [(lang, i + 1, b[2].decode(), b[3], b[4], b[5], n[lang], -b[0]) for i, b in enumerate(best[:top])]
    return sorted(out)


def texts(seed, n=120):
    rng = random.Random(seed)
    words = ["new", "York", "the", "of", "in", "a", "bank", "river", "élan", "ĀĀ", "\x1cx", "x-ray", "Zürich", "日本"]
    rows = []
    for _ in range(n):
        w = []
        for _ in range(rng.randrange(0, 60)):
            w += rng.choice([["New", "york", "City"], ["in", "the", "end"], [rng.choice(words)], [f"w{rng.randrange(200)}"], ["a", "a", "a", "a"]])
        text = "".join(x + rng.choice([" "] * 8 + ["  ", "\t", ", ", ".", "\n", "! ", " ; "]) for x in w)
        rows.append((text, rng.choice(["en", "en", "de", None, "und", ""])))
    return [*rows, (None, "en"), ("", "de"), ("...", "xx"), (". a", None), ("one", "yy"), rows[0], rows[0],
            ("of the sea " * 2000, "en"), ("rare " * 9, "zz")]


def check(spark, rows, least, top, **more):
    docs = spark.createDataFrame([(t, g, 1, "x") for t, g in rows], "text string, lang string, key long, word string").repartition(4)
    got = co.mine(docs, least, top, **more)
    assert sorted(map(tuple, got.collect())) == brute(rows, least, top)
    return got


def test_phrases_against_plain_counting(spark):
    got = check(spark, texts(1), 10, 2000)
    assert got.where("size(split(phrase, ' ')) = 3").count() > 5
    check(spark, texts(2), 3, 40)


def test_more_tries_than_one_pass_holds(spark):
    """Blocks of 50 phrases, one to a pass, give the same counts."""
    rows = texts(3, 40)
    check(spark, rows, 4, 30, block=200, pass_bytes=1)


def test_texts_are_read_as_often_for_many_phrases_as_for_few(spark):
    """Four times: for the words, the pairs, the triples and the counts."""
    rows = [(t, g) for t, g in texts(5, 60) if t is not None]
    for block, pass_bytes in ((co.BLOCK, co.PASS_BYTES), (20, 1)):
        seen = spark.sparkContext.accumulator(0)

        def passed(batches, seen=seen):
            for b in batches:
                seen.add(b.num_rows)
                yield b

        docs = spark.createDataFrame(rows, "text string, lang string").repartition(2).mapInArrow(passed, "text string, lang string")
        assert sorted(map(tuple, co.mine(docs, 3, 50, block, pass_bytes).collect())) == brute(rows, 3, 50)
        assert seen.value == 4 * len(rows)


def test_wrong_passes_only_add_candidates(spark, monkeypatch):
    """With maps that let everything pass the result is the same."""
    monkeypatch.setattr(co.BitMap, "of", staticmethod(lambda keys, bits=64: co.BitMap(np.full(1 << (co.MAP_BITS - 3), 255, np.uint8))))
    check(spark, texts(4, 30), 3, 50)


def test_bit_map_has_every_key(spark):
    keys = [-(2**63), -1, 0, 1, 2**63 - 1, 123456789 << 30, -(987654321 << 20)]
    m = co.BitMap.of(spark.createDataFrame([(k,) for k in keys], "key long"))
    assert m.has(np.array(keys, np.int64).view(np.uint64)).all()
    assert m.has(np.random.default_rng(1).integers(0, 2**63, 100000, np.uint64)).sum() < 5


@pytest.mark.parametrize("seed,n,vocabulary", [(1, 1, 3), (2, 500, 30), (3, 5000, 3000), (4, 20000, 200)])
def test_trie_finds_its_phrases_and_no_others(seed, n, vocabulary):
    rng = np.random.default_rng(seed)
    words = rng.integers(1, 2**63, vocabulary, np.uint64)
    rows = np.unique(np.stack([rng.integers(0, vocabulary, n), rng.integers(0, vocabulary, n), rng.integers(-1, vocabulary, n)], 1), axis=0)
    sizes = np.where(rows[:, 2] < 0, 2, 3)
    keys = np.where(rows < 0, np.uint64(0), words[rows])
    trie = co.Trie.load(co.Trie.of(keys, sizes).dump())
    assert len(trie.base) < 8 * keys.size + 5 * co.RADIX
    out = np.zeros(len(rows), np.int64)
    text = rng.integers(0, vocabulary, 30000)
    follows = rng.random(30000) < 0.9
    follows[-1] = False
    trie.count(co.Positions(words[text], follows, None, None), 3, out)
    pairs, triples = Counter(), Counter()
    for i in range(29999):
        if follows[i]:
            pairs[text[i], text[i + 1]] += 1
            if follows[i + 1]:
                triples[text[i], text[i + 1], text[i + 2]] += 1
    want = [pairs[a, b] if c < 0 else triples[a, b, c] for a, b, c in rows.tolist()]
    assert out.tolist() == want


def test_score_is_exact_beyond_64_bits(spark):
    rows = [(9 * 10**14, 10**15 - 1, 10**15 - 7), (10, 10, 10), (10**9 + 7, 10**9 + 9, 10**9 + 7), (10, 10**15, 10**15)]
    df = spark.createDataFrame(rows, "a long, l long, r long").withColumn("s", co.score(F.col("a"), F.col("l"), F.col("r")))
    for r in df.collect():
        assert r.s == 1000000 * r.a * r.a // (r.l * r.r)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert co.mine(none).count() == 0
    assert co.mine(spark.createDataFrame([("too few words", "en")], "text string, lang string")).count() == 0

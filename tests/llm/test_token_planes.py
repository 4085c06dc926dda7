"""Token files: exact round trip, ids as the tokenizer gives them."""

import os
import random
import struct
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyforge.llm import token_planes as tp

from .helpers import SCHEMA, corpus, prose

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", None, "  ", "a", "İstanbul ΣΑΣ Σ́ x", "<|endoftext|> <|ENDOFTEXT|> a<|startoftext|>b", "é ́ ́x", "don't I'LL  we've",
       "a b c\u0085d\x1cf", "\U0001f600‍\U0001f600 日本語 12 345", "\x00 \x01", "tab\tnew\r\nline\x0bv\x0cf", "ﬁ Å Å", "x" * 5000,
       "a,b. (c)d!e?f;g:h\"i 'S. x.'s o'll,'ve ...'t.'re \u0301.a e\u0301,\u0301o don't.Don'T,'D 1.a.2 A\u030a.a\u030a", "Foo FOO foo, fOO."]


def expected(rows, end=2):
    """doc_id order (null first), the tokenizer's own ids of whole texts."""
    t = Tokenizer.from_file(PATH)
    return [(i, [*t.encode(x or "", add_special_tokens=False).ids, end]) for i, x in rows]


@pytest.mark.parametrize("planes", [4, 32])
@pytest.mark.parametrize("top", [0, 1, 255, 256, 49407, 65535, 65536, 2**32 - 1])
def test_planes_round_trip(planes, top):
    rng = np.random.default_rng(top % 1000)
    for n in (1, 7, 8, 9, 1000):
        ids = rng.integers(0, top, n, np.uint64, endpoint=True).astype("<u4")
        ids[-1] = top
        parts = tp.to_planes(ids, planes)
        assert all(len(p) == 0 for p in parts[(top.bit_length() if planes == 32 else (top.bit_length() + 7) // 8):])
        assert (tp.from_planes([p.tobytes() for p in parts], n) == ids).all()


def test_words_encode_as_whole_texts():
    enc = tp.Encoder(PATH, 2)
    assert enc.by_word and enc.marks and enc.fold and enc.part
    n, ids = enc(pa.array(ODD))
    want = expected(enumerate(ODD))
    assert [p.tolist() for p in np.split(ids, np.cumsum(n))[:-1]] == [w for _, w in want]
    plain = tp.Encoder(PATH, 2)
    rng = random.Random(5)
    mixed = ["".join(rng.choice("aB's.,()!\"\u00e9\u0301 \n1<|\u03a3 ll ve re") for _ in range(60)) for _ in range(300)]
    n, ids = plain(pa.array(mixed))
    assert [p.tolist() for p in np.split(ids, np.cumsum(n))[:-1]] == [w for _, w in expected(enumerate(mixed))]
    assert not tp.drops_spaces(Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))
    whole = tp.Encoder(public_tokenizers.path("byte_bpe_50k.json"), 50256)
    n, ids = whole(pa.array(["a b", None, "x  y\n"]))
    t = whole.tokenizer
    assert ids.tolist() == [*t.encode("a b").ids, 50256, 50256, *t.encode("x  y\n").ids, 50256]


@pytest.mark.parametrize("planes,block", [(32, 64), (4, 1000), (32, tp.BLOCK)])
def test_files_give_back_every_document(spark, tmp_path, planes, block):
    rng = random.Random(8)
    rows = [(r[0], r[1]) for r in corpus(3)] + [(2000 + i, t) for i, t in enumerate(ODD)] + [(3000, prose(rng, 30000)), (-5, "first"), (2000, "tie")]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, start string").repartition(5)
    folder = f"file://{tmp_path}/out"
    tp.write_tokens(docs, folder, PATH, 2, block=block, planes=planes)
    got = sorted(tp.read_tokens(spark, folder).collect(), key=lambda r: r.start)
    assert len(got) == len(rows)
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    at = 0
    for r in got:
        assert (r.start, r.n_tokens) == (at, len(r.ids))
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(r.ids)}I", *r.ids))
        at += r.n_tokens
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    assert sorted(((r.doc_id, r.ids) for r in got), key=key) == sorted(expected(rows), key=key)
    short = tp.read_tokens(spark, folder, with_ids=False)
    assert sorted(map(tuple, short.collect()), key=lambda r: r[1]) == [tuple(r)[:4] for r in got]
    name = spark.read.parquet(f"{folder}/manifest").orderBy(F.desc("n_ids")).first().name
    f = tp.TokenFile(f"{folder}/{name}")
    every = f.ids(0, f.n_ids)
    f.blocks_read = 0
    assert (f.ids(70, 75) == every[70:75]).all() and f.blocks_read == 1
    assert len(f.ids(5, 5)) == 0 and (f.ids(f.n_ids - 3, f.n_ids + 9) == every[-3:]).all()


def test_empty_table_and_lost_files(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    tp.write_tokens(none, f"{tmp_path}/none", PATH, 2)
    assert tp.read_tokens(spark, f"{tmp_path}/none").count() == 0
    docs = spark.createDataFrame([("b", "two words"), ("a", "one")], "doc_id string, text string")
    tp.write_tokens(docs, f"{tmp_path}/some", PATH, 2)
    (tmp_path / "some" / "part-000000-of-a-lost-task.planes").write_bytes(b"half a file")      # in no row of the manifest
    assert [(r.doc_id, r.start) for r in tp.read_tokens(spark, f"{tmp_path}/some", "string").orderBy("start").collect()] == [("a", 0), ("b", 2)]
    with pytest.raises(ValueError):
        tp.write_tokens(docs, f"{tmp_path}/bad", PATH, 2, planes=5)


def test_a_worker_loads_a_tokenizer_once(tmp_path):
    path = tmp_path / "t.json"
    path.write_bytes(Path(PATH).read_bytes())
    one = tp.encoder(str(path), 2)
    texts = pa.array(["some words, and some more", None, "Words again"])
    first, known = one(texts), len(one.known)
    again = tp.encoder(str(path), 2)
    assert again is one and tp.encoder(str(path), 3) is not one
    assert known and len(again.known) == known
    for got in (again(texts), tp.Encoder(str(path), 2)(texts)):
        assert all((x == y).all() for x, y in zip(first, got, strict=True))
    assert len(again.known) == known
    again = tp.encoder(str(path), 2)
    os.utime(path, ns=(1, 1))
    assert tp.encoder(str(path), 2) is not again

"""Long and hostile texts end soon, and brute-force forms of their finders."""

import random
import time

import numpy as np
import pytest

from tallyforge.llm import license_scan, pii

KEY = b"test"


def within(seconds, f, *args):
    start = time.process_time()
    out = f(*args)
    assert time.process_time() - start < seconds
    return out


@pytest.mark.parametrize("n", [1, 32, 60, 64, 65, 128, 250, 300, 5000])
def test_mail_names_of_any_length(n):
    p = pii.Permuter(KEY)
    rng = random.Random(n)
    names = {"".join(rng.choice("abcXYZ019._%+-") for _ in range(n - 1)) + "q" for _ in range(20)}
    names = {("a" + x)[:max(n, 1)] for x in names}
    out = {x: within(5, pii.pseudonymise_text, f"to {x}@mail.example.org.", p)[0] for x in names}
    assert len(set(out.values())) == len(names)                       # different names stay different
    for x, text in out.items():
        assert text.endswith("@mail.example.org.") and len(text) == len(f"to {x}@mail.example.org.")
        new = text[3:3 + len(x)]
        assert all((a.isdigit(), a.islower(), a.isupper()) == (b.isdigit(), b.islower(), b.isupper()) for a, b in zip(x, new))
        assert [a for a in x if not a.isalnum()] == [b for b in new if not b.isalnum()]
        assert pii.pseudonymise_text(f"to {x}@mail.example.org.", pii.Permuter(KEY))[0] == text


@pytest.mark.parametrize("kind,form,n", [("email", "aa", 676), ("email", "a0", 260), ("email", "A", 26)])
def test_names_are_permuted(kind, form, n):
    p = pii.Permuter(KEY)
    letters = {"a": "abcdefghijklmnopqrstuvwxyz", "A": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0": "0123456789"}
    every = [""]
    for c in form:
        every = [x + y for x in every for y in letters[c]]
    assert sorted(p._name(x, "") for x in every) == sorted(every) and len(every) == n


def test_long_runs_without_an_at_sign():
    p = pii.Permuter(KEY)
    for text in ("a" * 1_000_000, "a." * 500_000, "a1-" * 50_000, "1-" * 50_000, "@" * 300_000, "a@" * 200_000, "a@b" * 200_000,
                 "+1" * 50_000, "x" * 500_000 + "@y", "a@" + "b" * 500_000):
        new, spans = within(10, pii.pseudonymise_text, text, p)
        assert len(new) == len(text)
    new, spans = within(10, pii.pseudonymise_text, "a" * 500_000 + " bob@example.org", p)
    assert spans == [("email", 500_001, 500_016)]


def test_mail_addresses_against_a_naive_finder():
    """All starts and ends, the leftmost and then longest address."""
    import re
    whole = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")

    def naive(text):
        out, at = [], 0
        while at < len(text):
            ends = [b for b in range(len(text), at, -1) if whole.fullmatch(text, at, b)]
            if ends:
                out.append(("email", at, ends[0]))
            at = ends[0] if ends else at + 1
        return out

    rng = random.Random(3)
    p = pii.Permuter(KEY)
    found = 0
    for _ in range(2000):
        text = "".join(rng.choice("ab.c@-bd_x ") for _ in range(30))
        _, spans = pii.pseudonymise_text(text, p)
        assert spans == naive(text), text
        found += len(spans)
    assert found > 100


def test_dense_repeats_of_notice_phrases():
    index = license_scan.Index(license_scan.TEMPLATES)
    from tallyforge.llm.vector import ALNUM_WORDS, split_words
    import pyarrow as pa
    for phrase in ("gnu general public license ", "the software without restriction ", "permission is hereby granted "):
        w = split_words(pa.array([phrase * (100_000 // len(phrase.split()))]), ALNUM_WORDS)
        assert within(10, license_scan._matches, w, index, license_scan.LEAST) is not None
    name, text = min(license_scan.TEMPLATES.items(), key=lambda x: len(x[1]))
    w = split_words(pa.array([(text + " other words ") * 3000]), ALNUM_WORDS)
    found = within(60, license_scan._matches, w, index, license_scan.LEAST)[0]
    assert sum(index.names[f[2]] == name for f in found) == 3000


def test_banded_alignment_against_the_full_matrix():
    rng = np.random.default_rng(5)
    for _ in range(200):
        template, text = rng.integers(1, 4, rng.integers(1, 8)), rng.integers(1, 4, rng.integers(1, 12))
        best = np.zeros((len(template) + 1, len(text) + 1), int)
        for i in range(len(template)):
            for j in range(len(text)):
                best[i + 1, j + 1] = max(best[i, j + 1], best[i + 1, j], best[i, j] + (template[i] == text[j]))
        n, a, b = license_scan.align(template, text, -len(template), len(text))
        assert n == best[-1, -1]
        assert n == 0 or (template[:, None] == text[a:b + 1]).any(0)[[0, -1]].all()

import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tallyforge.llm import line_dedup, mixing, quality, url_cascade
from tallyforge.llm.catalogue import URL_RULES

from .helpers import SCHEMA, WS, corpus, groups, prose


def plan_of(df):
    return df._jdf.queryExecution().toString()


# ---- URL filters

# the rules as agreed, on their own: not those of the catalogue
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"),
         ("block", "com", "/de/")]


def brute_url(url):
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def test_urls_against_brute_force(spark):
    rng = random.Random(4)
    hosts = ["example.org", "a.EXAMPLE.org", "b.com", "com", "org", "xexample.org", "x.y.z.net", "example.org:80", "", "."]
    urls = [f"{rng.choice(['http', 'https'])}://{rng.choice(hosts)}{rng.choice(['', '/', '/es/', '/es', '/en/1', '/en/12', '/fr/x', '/de/9?q=/es/', '/x#/de/'])}"
            for _ in range(400)] + [None, "", "no scheme/es/", "http://", "a://b://example.org/es/", "x" * 20000 + "://example.org/es/"]
    pages = spark.createDataFrame([(i, u, "kept") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    out = url_cascade.judge_urls(pages, rules)
    for r in out.collect():
        assert (r.host, r.path, r.rule, r.verdict) == brute_url(urls[r.page_id]), urls[r.page_id]
    assert {(h, p, v) for v, h, p in RULES} == set(URL_RULES)
    assert brute_url("http://a.EXAMPLE.org/en/12")[3] == "block"
    assert "Join" not in plan_of(out)
    assert url_cascade.judge_urls(pages.limit(0), rules).count() == 0
    none = url_cascade.judge_urls(pages, rules.limit(0))
    assert none.where("rule is not null or verdict <> 'allow'").count() == 0


def test_cascade_is_exact_on_many_keys(spark):
    universe = spark.range(20000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where(F.xxhash64("key") % 40 == 0)
    c = url_cascade.Cascade(listed, universe, 20000)
    assert len(c.levels) >= 2                       # there are wrong passes to undo
    got = c.bind(universe, "_b").where(c.listed(F.col("key"), "_b")).select("key")
    assert sorted(got.collect()) == sorted(listed.collect())


# ---- mixing

def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, free, out = float(sum(sizes.values())), set(names), {}
    while free:
        level = left / sum(w[s] for s in free)
        over = {s for s in free if level * w[s] > cap * sizes[s]}
        if not over:
            return out | {s: level * w[s] for s in free}
        for s in over:
            out[s] = float(cap * sizes[s])
            left -= out[s]
        free -= over
    return out


def test_mixing(spark):
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.randrange(0, 40)), rng.choice(["a"] * 6 + ["b", "ç", None, "zz"])) for i in range(900)]
    rows += [(5000, None, "a"), (5001, "", "nothing"), (None, "x y", "b"), rows[7], rows[7]]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    out = mixing.mix(df)
    got = out.collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(WS.findall(t or ""))
    want, taken = brute_targets(sizes), Counter()
    assert len(got) == len(rows)
    for r in got:
        n = len(WS.findall(r.text or ""))
        assert r.size == n and r.source_size == sizes[r.source] and r.taken == r.copies * n <= 3 * n
        assert math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-9)
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 3 * 40
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(df.repartition(5)).collect()))
    assert mixing.emit(out).count() == sum(r.copies for r in got)
    assert mixing.mix(df.limit(0)).count() == 0


# ---- quality rules

def brute_counts(text):
    text = text or ""
    words = WS.findall(text)
    lines = [x for x in text.split("\n") if WS.search(x)]
    seen, at = {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i:i + 8]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            for p in places:
                at.update(range(p, p + 8))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(at))


def test_quality_counts_and_verdicts(spark):
    rng = random.Random(3)
    rows = corpus(4, 150)
    good = len(rows)
    for i in range(12):
        rows.append((2000 + i, "".join(f"{w}### " for w in prose(rng, 60).split()), "en", "a", 0))
        rows.append((3000 + i, prose(rng, 20) + (" " + prose(random.Random(1), 9)) * 9, "en", "a", 0))
        rows.append((4000 + i, "\n".join([prose(rng, 9)] * 30 + [prose(rng, 7) for _ in range(90)]), "en", "b", 0))
    rows += [(5000, "a b c d e f g h " * 40, "en", "a", 0), (5001, "é😀\n" * 9 + "\r\x0b\x0c", "en", "a", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    text = {(r[0], r[1]) for r in rows}
    counts = {}
    for i, t in text:
        counts.setdefault(i, set()).add(brute_counts(t))
    out = quality.judge(df)
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) in counts[r.doc_id], r
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
        if r.doc_id is not None and r.doc_id < good and not r.base_failed:
            assert r.kept
        if r.doc_id is not None and 2000 <= r.doc_id < 4000:
            assert not r.kept
    kept = quality.keep_good(df)
    assert kept.columns == df.columns and kept.count() == sum(r.kept for r in got)
    assert "Python" not in plan_of(kept) and "Arrow" not in plan_of(kept)
    assert quality.judge(df.limit(0)).count() == 0


# ---- line dedup

def brute_sets(line):
    return frozenset(line[i:i + 12] for i in range(max(1, len(line) - 11))) if len(line) >= line_dedup.LEAST else frozenset()


def test_line_dedup_against_brute_force(spark):
    rng = random.Random(12)
    base = [prose(rng, 30) for _ in range(12)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randrange(1, 5)):
            words = rng.choice(base).split() if rng.random() < 0.5 else prose(rng, rng.randrange(3, 40)).split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                words[rng.randrange(len(words))] = "changed"
            lines.append(" ".join(words))
        rows.append((i, "\n".join(lines + ["short"] * (i % 3)), "x"))
    rows += [(100, None, "x"), (101, "", "x"), (102, rows[0][1], "x"), rows[5], (None, rows[9][1], "x"), (103, "日本語" * 3000 + "\n" + "日本語" * 3000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_lines string")
    out = line_dedup.dedup_lines(df.repartition(4))
    assert "Python" not in plan_of(out) and "Arrow" not in plan_of(out)
    got = out.collect()
    assert len(got) == len(rows)
    at = []
    for i, t in {(r[0], r[1]) for r in rows if r[1] is not None}:
        at += [(i, n, line.strip(" ")) for n, line in enumerate(t.split("\n")) if WS.search(line)]
    at.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    sets = [brute_sets(x[2]) for x in at]
    links = [(a, b) for a in range(len(at)) for b in range(a) if at[a][2] == at[b][2] or sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = groups(len(at), links)
    first, gone = {}, {}
    for j, r in enumerate(root):
        if r in first:
            gone.setdefault(at[j][0], set()).add(at[j][1])
        else:
            first[r] = j
    for r in got:
        text = {x[0]: x[1] for x in rows}[r.doc_id]
        if text is None:
            assert r.text is None
            continue
        want = [x for n, x in enumerate(text.split("\n")) if n not in gone.get(r.doc_id, ())]
        assert r.text.split("\n") == (want or [""]), r.doc_id
    kept = line_dedup.keep_documents(df)
    assert kept.columns == df.columns and 102 not in {r.doc_id for r in kept.collect()}
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_minhash_recall_on_small_sets(spark):
    rows, pairs = [], 3000
    for n, size in enumerate((5, 10, 15, 20)):          # pairs that share size * 4 / 5 of size shingles
        for i in range(pairs):
            for side in (0, 1):
                node = (n * pairs + i) * 2 + side
                rows += [(node, f"{node // 2}/{j}") for j in range(size if side else size * 4 // 5)]
    shingles = spark.createDataFrame(rows, "node long, p string").select("node", F.xxhash64("p").alias("h"))
    keys = line_dedup.set_keys(shingles).collect()
    keys = {r.node: r["keys"] for r in keys}
    for n in range(4):
        missed = sum(not set(keys[2 * i]) & set(keys[2 * i + 1]) for i in range(n * pairs, (n + 1) * pairs))
        assert missed <= 0.01 * pairs, (n, missed)      # 0.3 % for independent hashes


def test_minhashes_take_two_hashes_of_a_shingle_and_blanks_one_trim(spark):
    one = spark.createDataFrame([(1, 5), (1, -7), (2, 5)], "node long, h long")
    keys = line_dedup.set_keys(one)
    hashes = plan_of(keys).split("== Physical Plan ==")[1].split("Project")[-1]
    assert hashes.count("xxhash64(") == 2, hashes           # the shingle's own is the third
    assert len(keys.collect()) == 2
    bits = spark.range(1).select(F.lit(0x0123_4567_89AB_CDEF).alias("x")).select(*[f(F.col("x")) for f in line_dedup.PARTS]).first()
    assert [b >> 32 & 0xFFFF_FFFF for b in bits] == [0x0123_4567, 0x4567_89AB, 0x89AB_CDEF, 0xCDEF_0123]
    lines = line_dedup.line_rows(spark.createDataFrame([(0, "a\n\t \n b\t")], "doc_id long, text string"))
    assert "BOTH" not in plan_of(lines) and "btrim" not in plan_of(lines).lower()
    assert {r.line for r in lines.collect()} == {"a", "b\t"}


def test_texts_are_split_once_and_blank_lines_go(spark):
    texts = ["a\n\n \t \x0b\x0c\r\n  b \r", "", " ", "\u00a0\n\u3000", None]
    lines = line_dedup.line_rows(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert plan_of(lines).split("== Physical Plan ==")[1].count("split(text") == 1
    got = {(r.doc_id, r.line_no, r.line) for r in lines.collect()}
    assert got == {(0, 0, "a"), (0, 3, "b \r"), (3, 0, "\u00a0"), (3, 1, "\u3000")}


def test_keys_are_the_same_with_several_shingles_to_a_row(spark):
    rng = random.Random(3)
    rows = [(i, [rng.randrange(-2**63, 2**63) for _ in range(2 * rng.randrange(1, 12))]) for i in range(50)]
    one = spark.createDataFrame([(i, h) for i, s in rows for h in s], "node long, h long")
    two = spark.createDataFrame([(i, s[j], s[j + 1]) for i, s in rows for j in range(0, len(s), 2)], "node long, h0 long, h1 long")
    assert sorted(line_dedup.set_keys(one).collect()) == sorted(line_dedup.set_keys(two).collect())


def test_lines_without_spaces_link_when_shifted(spark):
    rng = random.Random(8)
    han = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(80))
    url = "https://example.org/" + "".join(rng.choice("abcdefghij0123456789/") for _ in range(75))
    rows = [(0, han), (1, "x" + han), (2, url), (3, ">" + url), (4, han[::-1]), (5, "x" + url[::-1])]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.n_removed for r in out.collect()} == {0: 0, 1: 1, 2: 0, 3: 1, 4: 0, 5: 0}


def test_line_dedup_keeps_columns_named_like_its_own(spark):
    rng = random.Random(31)
    line = prose(rng, 30)
    names = ["own", "text_hash", "removed", "lines", "node", "line", "comp", "first", "at", "n_removed"]
    rows = [(0, f"{line}\nFirst one\nshort\n \n", *range(10)), (1, f"new\n{line}\nshort\n \n", *range(10, 20)), (2, line, *range(20, 30))]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} long" for c in names))
    out = line_dedup.dedup_lines(df)
    assert out.columns == ["doc_id", "text", *names[:-1], "n_lines", "n_removed"]
    got = {r.doc_id: r for r in out.collect()}
    assert [got[i].text for i in range(3)] == [rows[0][1], "new\n \n", ""]
    assert [got[i].n_removed for i in range(3)] == [0, 2, 1] and [got[i].node for i in range(3)] == [4, 14, 24]
    kept = line_dedup.keep_documents(df)
    assert kept.columns == df.columns and sorted(r.n_removed for r in kept.collect()) == [9, 19]

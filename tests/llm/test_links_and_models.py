import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from tallyforge.llm import lang_id, license_scan, parity_join, pii
from tallyforge.llm.components import components

from .helpers import SCHEMA, corpus, groups, prose, shingle_set


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(1, 80)] + [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)]
    rng.shuffle(edges)
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = sorted({x for e in edges for x in e if e[0] != e[1]})
    root = groups(len(nodes), [(nodes.index(a), nodes.index(b)) for a, b in edges if a != b])
    least = {}
    for n, r in zip(nodes, root, strict=True):
        least.setdefault(r, n)
    assert got == {n: least[r] for n, r in zip(nodes, root, strict=True)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_jaccard_join_against_brute_force(spark, k, percent):
    rng = random.Random(17)
    rows = corpus(6, 80)
    hub = prose(rng, 120).split()
    for i in range(40):                       # a large group of near copies, some of which link only through others
        words = list(hub)
        for _ in range(rng.randrange(0, 4)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(50)}"
        rows.append((2000 + i, " ".join(words).upper() if i % 7 == 0 else "  ".join(words), "en", "a", 0))
    df = spark.createDataFrame(rows, SCHEMA)
    got = parity_join.near_duplicates(df.repartition(5), k, percent).collect()
    assert len(got) == len(rows)
    sets = [shingle_set(r[1], k) for r in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    links += [(a, b) for a in range(len(rows)) for b in range(a) if rows[a][0] is not None and rows[a][0] == rows[b][0]]
    root = groups(len(rows), links)
    least = {}
    for r, row in zip(root, rows, strict=True):
        if row[0] is not None:
            least[r] = min(least.get(r, row[0]), row[0])
    want = sorted(((row[0] if row[0] is not None else -1), len(s), least.get(r, -1)) for row, s, r in zip(rows, sets, root, strict=True))
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_shingles, r.component_id if r.component_id is not None else -1) for r in got) == want
    kept = [r.doc_id for r in parity_join.keep_first(df, k, percent).collect() if r.text and r.text.strip()]
    assert len(kept) >= len({r for r, s in zip(root, sets, strict=True) if s}) and len(kept) <= len({r for r, s in zip(root, sets, strict=True) if s}) + 1
    assert parity_join.near_duplicates(df.limit(0), k, percent).count() == 0


def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    out = lang_id.identify(docs).join(docs, "doc_id").where("held_out")
    n, right = out.count(), out.where("lang = lang_pred").count()
    assert right >= 0.95 * n
    held = docs.where(F.crc32(F.col("doc_id").cast("string")) % 3 == 1).count()
    assert n == held


def test_language_id_edges(spark):
    rows = [(i, t, v) for i, (t, v) in enumerate([(None, "en"), ("", "en"), ("123 ...", "de"), ("the cat and the dog", "en"), ("der hund und die katze", "de"),
                                                  ("the long house", None), ("日本語", "ja")] + [("the and of that house " * 5, "en"), ("der die und das haus " * 5, "de")] * 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in lang_id.identify(df).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got.values())
    assert [got[i].lang_pred for i in (0, 1, 2)] == ["und"] * 3 and got[0].score == 0
    assert got[3].lang_pred == "en" and got[4].lang_pred == "de"
    assert {r.lang_pred for r in lang_id.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert lang_id.identify(df.limit(0)).count() == 0


def test_codewords_are_distinct_rows_and_columns():
    for n in (2, 3, 4, 6, 9, 20):
        c = lang_id.codewords(n)
        assert len({tuple(r) for r in c.tolist()}) == n


def test_license_scan(spark):
    rng = random.Random(2)
    t = license_scan.TEMPLATES
    broken = t["MIT"].split()
    del broken[10]
    broken[30:30] = ["inserted", "words"]
    broken[50] = "changed"
    rows = [(0, None), (1, ""), (2, prose(rng, 300)), (3, prose(rng, 50) + "\n" + t["MIT-line"] + "\n" + prose(rng, 50)),
            (4, "é 😀 " + " ".join(broken) + " " + prose(rng, 3000)), (5, t["GPL-3.0-notice"].upper() + " " + t["Apache-2.0-line"]),
            (6, (t["CC-BY-NC-4.0-line"] + " " + prose(rng, 30) + "\n") * 3), (7, " ".join(t["ISC"].split()[:12])), (7, " ".join(t["ISC"].split()[:12]))]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, licenses string")
    got = {r.doc_id: r for r in license_scan.scan_licenses(df).collect()}
    assert [got[i].licenses for i in (0, 1, 2, 3, 7)] == ["", "", "", "MIT-line", ""]
    assert "MIT" in got[4].licenses.split(",") and 0.8 <= next(m for m in got[4].matches if m.license == "MIT").coverage < 1
    m = next(m for m in got[4].matches if m.license == "MIT")
    assert rows[4][1][m.start:m.end].startswith("Permission is hereby") and rows[4][1][m.start:m.end].endswith("of the Software")
    assert got[5].licenses.split(",") == ["GPL-3.0-notice", "Apache-2.0-line"] and got[5].matches[0].coverage == 1
    assert got[6].licenses == ",".join(["CC-BY-NC-4.0-line"] * 3)
    for i, text in rows[3:7]:
        for m in got[i].matches:
            assert 0 <= m.start < m.end <= len(text)
    assert license_scan.scan_licenses(df.limit(0)).count() == 0
    assert license_scan.scan_licenses(df, {}).where("n_matches > 0").count() == 0


def test_permutations_are_one_to_one():
    p = pii.Permuter(b"k")
    assert sorted(p.permute("t", 500, i) for i in range(500)) == list(range(500))
    odd = [i for i in range(300) if i % 2]
    assert sorted(p.permute("u", 300, i, lambda x: x % 2) for i in odd) == odd
    assert [pii.Permuter(b"other").permute("t", 500, i) for i in range(9)] != [p.permute("t", 500, i) for i in range(9)]


def test_pseudonyms(spark):
    rng = random.Random(3)
    card = "4".ljust(15, "7")
    card += pii.luhn(card)
    spaced = " ".join(card[i:i + 4] for i in range(0, 16, 4))
    text = f"é {card} and {spaced}, +1 (017) 555-7713; 10.200.30.4. a.Bc7@mail.example.com 2024-02-29 29.02.2023 28.02.2023 123-45-6789 {card[:-1]}{(int(card[-1]) + 1) % 10}"
    rows = [(0, text), (1, None), (2, ""), (3, prose(rng, 5000)), (4, f"again {card}"), (4, f"again {card}"), (5, "999.1.1.1 000-12-3456 2024-13-01")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_pii int")
    out = pii.pseudonymise(df, b"key").collect()
    got = {r.doc_id: r for r in out}
    assert len(out) == len(rows) and got[1].text is None and got[2].text == "" and got[3].text == rows[3][1] and got[5].text == rows[6][1]
    new = got[0].text
    assert len(new) == len(text) and [s.kind for s in got[0].pii] == ["card", "card", "phone", "ip", "email", "date", "date", "ssn"]
    for s in got[0].pii:
        assert text[s.start:s.end] != new[s.start:s.end]
        assert re.sub("[0-9]", "0", re.sub("[a-z]", "a", text[s.start:s.end])) .replace("A", "B") == re.sub("[0-9]", "0", re.sub("[a-z]", "a", new[s.start:s.end])).replace("A", "B") or s.kind == "email"
    fresh = new[2:18]
    assert new[23:42].replace(" ", "") == fresh and pii.luhn(fresh[:-1]) == fresh[-1] and got[4].text == f"again {fresh}"
    assert "+1 (" in new and "@mail.example.com" in new and "29.02.2023" in new
    dt.date.fromisoformat(new[got[0].pii[5].start:got[0].pii[5].end])
    assert pii.pseudonymise(df.limit(0), b"key").count() == 0


def test_pipeline_against_brute_rules(spark, tmp_path):
    import corpus_pipeline

    rows = corpus(9, 60)
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, rows[20][1])], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    got = out.collect()
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "copy"]
    ids = {r.doc_id for r in got}
    assert 20 not in ids and not ids & {900, 901, 902, 903} and len(got) > 20
    sets = {r.doc_id: shingle_set(r.text, 5) for r in got}
    for a in sets:
        for b in sets:
            assert a == b or 100 * len(sets[a] & sets[b]) < 80 * len(sets[a] | sets[b])


def test_wide_sketches_bound_the_difference_when_folded():
    import numpy as np

    from tallyforge.llm.parity_join import sketch, wide_sketch
    rng = np.random.default_rng(5)
    for n, changed in ((520, 3), (1020, 9), (1030, 200), (4000, 700)):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate((a[changed:], rng.integers(0, 1 << 63, changed + 10, dtype=np.uint64))))
        x, y = wide_sketch(a), wide_sketch(b)
        while len(x) != len(y):
            x, y = (x[:len(x) // 2] ^ x[len(x) // 2:], y) if len(x) > len(y) else (x, y[:len(y) // 2] ^ y[len(y) // 2:])
        assert sum(int(v).bit_count() for v in x ^ y) <= len(np.setxor1d(a, b))
        while len(x) > 8:
            x = x[:len(x) // 2] ^ x[len(x) // 2:]
        assert (x == sketch(a)).all()


def test_long_documents_link_across_sketch_lengths(spark):
    import random

    from tallyforge.llm.parity_join import near_duplicates
    rng = random.Random(11)
    texts = []
    for base in (500, 1010, 2040):
        words = [f"w{rng.randrange(10**6)}" for _ in range(base)]
        for cut_at in (0, 8, 30, 150):
            texts.append(" ".join(words[cut_at:] + [f"z{rng.randrange(10**6)}" for _ in range(cut_at * 2)]))
    sets = []
    for t in texts:
        w = t.split(" ")
        sets.append({tuple(w[i:i + 3]) for i in range(len(w) - 2)})
    comp = list(range(len(texts)))
    for _ in texts:
        for i, x in enumerate(sets):
            for j, y in enumerate(sets):
                if 100 * len(x & y) >= 90 * len(x | y):
                    comp[i] = comp[j] = min(comp[i], comp[j])
    assert len(set(comp)) < len(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in near_duplicates(docs).collect()}
    assert got == dict(enumerate(comp))


def test_block_keys_of_linked_sets_meet_and_others_seldom_do():
    import numpy as np

    from tallyforge.llm.parity_join import band_bounds, block_keys

    rng = np.random.default_rng(11)
    bounds = band_bounds(8000)
    for percent in (80, 90):
        for n in [4, 7, 20, 55, 200, 1000, 4000] * 6:
            union = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
            n = len(union)
            loose = n * (100 - percent) // 100          # the most that may be outside the intersection
            cut_a = int(rng.integers(0, loose + 1))
            order = rng.permutation(n)
            a, b = np.sort(union[order[cut_a:]]), np.sort(union[order[:n - loose + cut_a]])
            same = len(np.intersect1d(a, b))
            assert 100 * same >= percent * len(np.union1d(a, b))
            ka, kb = block_keys(a, percent, bounds), block_keys(b, percent, bounds)
            assert np.array_equal(a, b) or len(np.intersect1d(ka, kb)), (percent, n, loose)
        apart = [block_keys(np.unique(rng.integers(0, 1 << 63, int(rng.integers(3000, 4200)), dtype=np.uint64) * np.uint64(2)),
                            percent, bounds) for _ in range(40)]
        met = sum(len(np.intersect1d(x, y)) > 0 for i, x in enumerate(apart) for y in apart[:i])
        assert met < 0.1 * 780, met


def test_cards_beside_other_numbers_and_month_first_dates():
    rng = random.Random(4)
    p = pii.Permuter(b"k")
    for _ in range(60):                     # some neighbours make a right check digit by chance
        card = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        card += pii.luhn(card)
        spaced = " ".join(card[i:i + 4] for i in range(0, 16, 4))
        plain = pii.pseudonymise_text(card, p)[0]
        wide = " ".join(plain[i:i + 4] for i in range(0, 16, 4))
        assert plain != card
        n = rng.randrange(10, 99)
        for before, own, new, after in (("", spaced, wide, f" {n}/27"), ("", card, plain, f" 1{n}"), (f"{n % 9 + 1} ", spaced, wide, ""),
                                        (f"{n} ", card, plain, ""), (f"{n} {n} ", spaced, wide, f" 1{n} {n}"), ("2024-13-01 ", spaced, wide, "")):
            text, spans = pii.pseudonymise_text(before + own + after, p)
            assert text == before + new + after, (before, own, after)
            assert spans == [("card", len(before), len(before) + len(own))]
        both = pii.pseudonymise_text(f"{spaced} {spaced}-{card}", p)[0]
        assert both == f"{wide} {wide}-{plain}"
    days = [dt.date(2023, 1, 1) + dt.timedelta(i) for i in range(365)]
    for own in ([f"{d:%m/%d/%Y}" for d in days], [f"{d:%d/%m/%Y}" for d in days]):
        assert all(pii.pseudonymise_text(x, p)[1] == [("date", 0, 10)] for x in own)
    every = {f"{d:%m/%d/%Y}" for d in days} | {f"{d:%d/%m/%Y}" for d in days}
    new = {pii.pseudonymise_text(x, p)[0] for x in every}
    assert len(new) == len(every)
    assert all(pii.parsed(x[6:], x[3:5], x[:2]) or pii.parsed(x[6:], x[:2], x[3:5]) for x in new)
    assert pii.pseudonymise_text("13/31/2024 and 00/12/2024", p)[1] == []


def test_keep_first_goes_by_component_not_by_id(spark):
    rng = random.Random(13)
    a, b, c, d, e = (prose(rng, 40) for _ in range(5))
    rows = [(None, a, "en"), (None, b, "en"), (None, b, "en"), (None, None, "de"), (7, c, "en"), (7, d, "en"),
            (8, e, "b"), (8, e, "a"), (9, e, "a"), (10, None, "en"), (10, None, "en"), (11, "", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = parity_join.keep_first(df.repartition(3), 5, 80)
    assert got.columns == df.columns
    want = [(None, a, "en"), (None, b, "en"), (None, None, "de"), (7, c, "en"), (7, d, "en"), (8, e, "a"), (10, None, "en"), (11, "", "en")]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_license_repeats_close_together_and_long_insertions(spark):
    rng = random.Random(21)
    t = license_scan.TEMPLATES
    notice = t["MIT"].split()
    middle = len(notice) // 2
    odd = [t["MIT-line"], "Released under the MIT Licence.", t["MIT-line"] + " Released", t["MIT-line"]]
    rows = [(t["MIT-line"] + "\n") * 7, "".join(f"src/a{i}.c: {t['CC-BY-NC-4.0-line']}\n" for i in range(9)), (t["ISC"] + "\n") * 3]
    rows += [" ".join(notice[:middle] + prose(rng, n).split() + notice[middle:]) for n in (13, 16)]
    rows += ["\n".join(odd)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.scan_licenses(df).collect()}
    assert got[0].licenses == ",".join(["MIT-line"] * 7) and got[1].licenses == ",".join(["CC-BY-NC-4.0-line"] * 9)
    assert got[2].licenses == ",".join(["ISC"] * 3)
    assert all(m.coverage == 1 for i in (0, 1, 2) for m in got[i].matches)
    for i in (3, 4):
        m = [x for x in got[i].matches if x.license == "MIT"]
        assert len(m) == 1 and m[0].coverage == 1 and m[0].end - m[0].start >= len(rows[i]) - 1
    assert got[5].licenses == ",".join(["MIT-line"] * 4)
    for r in got.values():
        spans = sorted((m.start, m.end) for m in r.matches if m.license == r.matches[0].license)
        assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:], strict=False))


def test_native_sketches_bound_the_difference(spark):
    """Sets of 1 to 5,000 hashes: the size is kept, the sketch has two bits an
    element at least, and the distance of two sketches, folded to the shorter,
    is at most their sets' difference and not far below it."""
    from tallyforge.llm.components import _apart, with_sketch
    rng = random.Random(11)
    sets = {}
    for i, n in enumerate([1, 5, 40, 250, 260, 900, 1030, 5000]):
        s = [rng.randrange(-2**63, 2**63) for _ in range(n)]
        sets[2 * i] = s
        sets[2 * i + 1] = s[n // 10:] + [rng.randrange(-2**63, 2**63) for _ in range(n // 20)]
    rows = spark.createDataFrame(list(sets.items()), "node long, hashes array<long>")
    done = with_sketch(rows.repartition("node")).cache()
    for r in done.collect():
        assert r.n == len(sets[r.node]) and len(r.sketch) * 64 >= max(512, 2 * r.n)
        assert len(r.sketch) & (len(r.sketch) - 1) == 0
    pairs = done.where("node % 2 = 0").select("node", F.col("sketch").alias("x")).join(
        done.where("node % 2 = 1").select((F.col("node") - 1).alias("node"), F.col("sketch").alias("y")), "node")
    apart = {r.node: r.d for r in pairs.select("node", _apart(F.col("x"), F.col("y")).alias("d")).collect()}
    assert len(apart) == 8
    for node, d in apart.items():
        real = len(set(sets[node]) ^ set(sets[node + 1]))
        assert 0.8 * real <= d <= real, (node, d, real)


def test_coarse_distance_is_at_most_the_full_one(spark):
    from tallyforge.llm.components import _apart, _coarsely_apart
    rng = random.Random(4)
    sketch = lambda n: [rng.randrange(-2**63, 2**63) for _ in range(n)]
    rows = [(sketch(n), sketch(m)) for n, m in ((8, 8), (8, 16), (16, 8), (16, 16), (16, 32), (32, 32), (64, 32), (64, 64))]
    x, y = F.col("x"), F.col("y")
    got = spark.createDataFrame(rows, "x array<long>, y array<long>").select(F.size("x").alias("n"), F.size("y").alias("m"),
                                                                             _coarsely_apart(x, y).alias("c"), _apart(x, y).alias("d")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.c <= r.d and (r.c > 150) == (max(r.n, r.m) <= 32) and (r.c == r.d or (r.n, r.m) != (8, 8))


def test_sketched_sets_are_made_once(spark):
    from tallyforge.llm.components import with_sketch
    from tallyforge.llm.line_dedup import line_set
    texts = spark.createDataFrame([(1, "a line of some length that is long enough")], "node long, line string")
    sets = with_sketch(texts.repartition("node").select("node", line_set(F.col("line")).alias("hashes")))
    assert sets._jdf.queryExecution().optimizedPlan().toString().count("array_distinct") == 1


def test_groups_left_to_pairs_lose_no_link(spark):
    """One key holds a chain: each set links only with its neighbours, so no
    pivot reaches far; keys are repeated so that pairs share several."""
    from tallyforge.llm.components import linked_components, with_sketch
    chains, steps, n = 3, 40, 100
    sets = {}
    for c in range(chains):
        for i in range(steps):
            sets[c * 1000 + i] = [c * 10**6 + v * 7919 * 10**9 for v in range(i * 8, i * 8 + n)]
    rows = spark.createDataFrame(list(sets.items()), "node long, hashes array<long>").cache()
    keys = spark.createDataFrame([(k, node) for node in sets for k in range(25)], "key long, node long").cache()
    labels = linked_components(keys, with_sketch(rows.repartition("node")).cache(),
                               lambda wanted: rows.join(wanted, "node", "left_semi").selectExpr("node", "hashes as own"), 80)
    got = {r.node: r.comp for r in labels.collect()}
    assert got == {node: node // 1000 * 1000 for node in sets}


def test_many_unrelated_sets_share_no_block_key():
    """With words of 1,024 bits, chance keys grew with the square of the sets."""
    from collections import Counter

    import numpy as np

    from tallyforge.llm.parity_join import band_bounds, block_keys

    rng = np.random.default_rng(8)
    bounds = band_bounds(1 << 12)
    holders = Counter()
    for _ in range(3000):
        own = np.unique(rng.integers(0, 1 << 64, int(rng.integers(150, 200)), dtype=np.uint64))
        holders.update(set(block_keys(own, 80, bounds).tolist()))
    assert sum(n for n in holders.values() if n > 1) <= 4


def test_small_results_are_written_by_few_tasks(spark, tmp_path):
    from pathlib import Path

    from tallyforge.llm.components import shared_only
    from tallyforge.llm.util import counted, shared_folder

    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        root = Path(shared_folder(spark).split(":")[-1])
        files = lambda: set(root.rglob("part-*"))
        before = files()
        rows = spark.range(1000).groupBy((F.col("id") % 100).alias("key")).agg(F.min("id").alias("node"))
        done, n = counted(rows, 60, most=100)
        assert n == 100 and done.count() == 100 and len(files() - before) == 2
        before = files()
        empty, n = counted(rows.where("node < 0"), most=100)
        assert n == 0 and empty.count() == 0 and len(files() - before) <= 1
        before = files()
        keys = spark.range(1000).select((F.col("id") % 400).alias("key"), F.col("id").alias("node"))
        shared, n = shared_only(keys.where("id >= 300"), unique=True, most=1000)
        assert n == 600 and shared.count() == 600 and len(files() - before) < 20
        before = files()
        labels = components(spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long").repartition(40), most=60)
        assert {r.comp for r in labels.collect()} == {0} and len(files() - before) < 20      # 40 to a round else
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_sketches_are_grouped_by_blocks_of_eight_words(spark):
    from tallyforge.llm.components import with_sketch
    sets = spark.createDataFrame([(1, [5, 9, -3]), (2, list(range(700)))], "node long, hashes array<long>")
    done = with_sketch(sets.repartition("node"))
    assert done._jdf.queryExecution().optimizedPlan().toString().count("bit_xor(CASE WHEN") == 8
    assert {r.node: len(r.sketch) for r in done.collect()} == {1: 8, 2: 32}


def test_pairs_are_compared_by_their_union(spark):
    """Hashes may repeat; no set is made distinct or written out for it."""
    from tallyforge.llm.components import _similar
    sets = {1: [1, 2, 3, 4, 4, 4], 2: [4, 3, 2, 1, 5, 5], 3: [1, 2, 3, 6, 7], 4: [-1, -1]}
    rows = spark.createDataFrame(list(sets.items()), "node long, own array<long>")
    pairs = spark.createDataFrame([(a, b, len(set(sets[a])) + len(set(sets[b]))) for a in sets for b in sets if a < b], "a long, b long, sizes int")
    good = _similar(pairs, rows, 80, lambda c: c)
    assert {(r.a, r.b) for r in good.collect()} == {(1, 2)}
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_union") == 1 and "Generate" not in plan and "array_distinct" not in plan

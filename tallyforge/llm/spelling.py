"""Spelling variant grouping by dynamic programming over sorted word lists.

The vocabulary holds the corpus's letter runs; two words are near if exactly
one code point is inserted, deleted or replaced.  Of two near words the
shorter, of length l, and the longer share the first l // 2 code points or
the last l - l // 2: words are dealt by these halves (for l their length and
one less), and pairs that share both are taken from the first.  A hot half,
of more than ``MOST`` words, is dealt on by longer ends, the code points
between them halved each time, until it is small or at most one or two code
points are free, which bounds it by the alphabet.  No pair is lost and none
comes twice.

A task scans its sorted lists (those dealt by their last code points are
sorted backward): the rows of the edit matrix, three cells wide, belong to
prefixes, so adjacent words reuse all rows up to their common prefix (LCP),
and a range of words whose shared prefix is more than one edit away from the
query's is skipped whole.  numpy advances all queries of a batch together,
a code point at a time.

Defined results: null and empty texts have no words; a null doc_id counts
as an empty string in the run's hash; repeated rows count each time; words
without a near word have n_near 0 and are their own root; an empty table
gives an empty result.  Extra input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import cut, lower_az

LEAST = 7             # code points of a word
TWICE = 2             # occurrences
FACTOR = 10           # a form is so many times as frequent
DROP = 31             # one run in so many loses a code point
MOST = 4_000          # words compared within one list
QUERIES = 8_192       # queries advanced together
ROWS = 30_000         # least rows of a batch of lists


def vocabulary(docs: DataFrame, least: int = LEAST, twice: int = TWICE) -> DataFrame:
    """(word, n) of ``docs`` (doc_id, text): runs of letters, A-Z in lower
    case, some less a code point."""
    run = F.explode(F.regexp_extract_all(lower_az(F.col("text")), F.lit(f"[A-Za-z\\u00C0-\\u00FF]{{{least},}}"), F.lit(0)))
    runs = docs.where("text is not null").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), run.alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run"))
    at = F.pmod(h, F.length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.pmod(h, F.lit(DROP)) == 0, less).otherwise(F.col("run"))
    words = runs.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return words.where((F.col("n") >= twice) & (F.length("word") >= least))


# ---- dealing

PLACE = ("a", "c", "l", "stop")       # shared ends, the shorter word's length, and the prefix that is taken elsewhere


def _place(a: Column, c: Column, l: Column, stop: Column) -> Column:  # noqa: E741
    return F.struct(a.cast("int").alias("a"), c.cast("int").alias("c"), l.cast("int").alias("l"), stop.cast("int").alias("stop"))


def _rows(words: DataFrame, places: Column) -> DataFrame:
    d = words.select("word", "n", F.explode(places).alias("p")).select("word", "n", "p.*")
    key = F.xxhash64(*PLACE, F.substring("word", F.lit(1), F.col("a")), F.expr("right(word, c)"))
    return d.withColumn("key", key)


def _halves(a: Column, c: Column, l: Column, stop: Column) -> Column:  # noqa: E741
    """The two places that the code points between a and c are halved to;
    the first only if its pairs aren't taken elsewhere."""
    half = a + F.floor((l - a - c) / 2)
    return F.array_compact(F.array(F.when(half < stop, _place(half, c, l, stop)), _place(a, l - half, l, F.least(stop, half))))


def dealt(words: DataFrame, least: int, most: int) -> DataFrame:
    """``words`` (word, n) with the places and keys of their lists."""
    size, none, far = F.length("word"), F.lit(0), F.lit(1 << 30)
    first = F.concat(_halves(none, none, size, far), F.when(size > least, _halves(none, none, size - 1, far)).otherwise(F.array()))
    rows, done = _rows(words, first), None
    while True:
        groups = rows.groupBy("key").agg(F.count("*").alias("m"), *[F.min(c).alias(c) for c in PLACE])
        hot = cut(groups.where((F.col("m") > most) & (F.col("l") - F.col("a") - F.col("c") > 1)).select("key"))
        if hot.isEmpty():
            return rows if done is None else done.unionByName(rows)
        cold = rows.join(hot, "key", "left_anti")
        done = cold if done is None else done.unionByName(cold)
        again = rows.join(hot, "key", "left_semi").withColumn("p", _halves(*[F.col(c) for c in PLACE]))
        rows = cut(_rows(again.drop(*PLACE, "key"), F.col("p")))


# ---- scanning

class SortedLists:
    """Sorted lists of distinct words, one after the other."""

    def __init__(self, words: list[str], lists: np.ndarray):
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        self.begin = np.cumsum(self.size + 1) - self.size - 1
        self.points = np.frombuffer("".join(w + "\0" for w in words).encode("utf-32-le"), np.uint32)
        start = np.flatnonzero(np.concatenate(([True], lists[1:] != lists[:-1])))
        which = np.cumsum(np.isin(np.arange(len(words)), start)) - 1
        self.last = np.append(start[1:], len(words))[which]          # end of each word's list
        self.first = start[which]
        lcp = np.zeros(len(words), np.int64)
        lcp[start] = -1
        todo = np.flatnonzero(lcp == 0)
        while len(todo):                                              # both words go on alike
            d = lcp[todo]
            x = self.point(todo, d)
            todo = todo[(x == self.point(todo - 1, d)) & (x != 0)]
            lcp[todo] += 1
        self.order = np.argsort(lcp, kind="stable")                   # places of each LCP, ascending
        self.lcp = lcp[self.order]

    def point(self, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Code points; 0 behind a word's end."""
        return self.points[self.begin[word] + np.minimum(at, self.size[word])]

    def children(self, lo: np.ndarray, hi: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ranges that share d + 1 code points, of ranges that share d:
        (parent, lo, hi)."""
        cuts = self.order[np.searchsorted(self.lcp, d):np.searchsorted(self.lcp, d, "right")]
        a, b = np.searchsorted(cuts, lo, "right"), np.searchsorted(cuts, hi)
        many = b - a + 1
        parent = np.repeat(np.arange(len(lo)), many)
        place = np.arange(len(parent)) - np.repeat(np.cumsum(many) - many, many)
        begin = lo[parent]
        inner = place > 0
        begin[inner] = cuts[(a[parent] + place - 1)[inner]]
        end = np.append(begin[1:], 0)
        final = place == many[parent] - 1
        end[final] = hi[parent][final]
        return parent, begin, end

    def near(self, queries: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) at one edit; a query's list shares ``depth`` code
        points."""
        q, lo, hi, d = queries, self.first[queries], self.last[queries], depth
        size, two = self.size[q], np.int8(2)
        row = [np.full(len(q), 1 if d else 2, np.int8), np.zeros(len(q), np.int8), np.where(d < size, np.int8(1), two)]
        found = []
        while len(q):
            ends = self.size[lo] == d                                 # a word that is the prefix itself
            if ends.any():
                m = self.size[q] - d
                edits = np.where(m == -1, row[0], np.where(m == 0, row[1], np.where(m == 1, row[2], two)))
                hit = ends & (edits == 1)
                found.append((q[hit], lo[hit]))
                lo = lo + ends
                go = lo < hi
                q, lo, hi, row = q[go], lo[go], hi[go], [r[go] for r in row]
            parent, lo, hi = self.children(lo, hi, d)
            q, old = q[parent], [r[parent] for r in row]
            c, size = self.point(lo, np.full(len(lo), d)), self.size[q]
            x = [self.point(q, np.full(len(q), j)) for j in (max(d - 1, 0), d, d + 1)]
            new0 = np.minimum(old[0] + (x[0] != c), old[1] + 1) if d else old[1] + np.int8(1)
            new1 = np.minimum(np.minimum(old[1] + (x[1] != c), old[2] + 1), new0 + 1)
            new2 = np.minimum(old[2] + (x[2] != c), new1 + 1)
            row = [np.where(size >= d, new0, two), np.where(size >= d + 1, new1, two), np.where(size >= d + 2, new2, two)]
            go = np.minimum(np.minimum(row[0], row[1]), row[2]) < 2    # else the range is skipped
            q, lo, hi, row = q[go], lo[go], hi[go], [np.minimum(r[go], two).astype(np.int8) for r in row]
            d += 1
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _shares(s: SortedLists, x: np.ndarray, y: np.ndarray, k: np.ndarray, back: np.ndarray) -> np.ndarray:
    """Whether words x and y share their first k code points (as spelt: the
    words of lists dealt by their last code points are held backward)."""
    same = (s.size[x] >= k) & (s.size[y] >= k)
    todo, j = np.flatnonzero(same), 0
    while len(todo):
        a, b = x[todo], y[todo]
        at = lambda w: s.point(w, np.where(back[todo], s.size[w] - 1 - j, j))
        alike = at(a) == at(b)
        same[todo[~alike]] = False
        j += 1
        todo = todo[alike & (k[todo] > j)]
    return same


NEAR = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])


def _pairs(t: pa.Table) -> pa.RecordBatch:
    col = {n: t.column(n).to_numpy() for n in ("key", "a", "c", "l", "stop", "n")}
    spelt = t.column("spelt").to_pylist()
    s = SortedLists(spelt, col["key"])
    back = col["c"] > col["a"]
    depth = np.maximum(col["a"], col["c"])
    one = (s.size == col["l"]) & (s.last - s.first > 1)
    xs, ys = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for d in np.unique(depth[one]).tolist():
        queries = np.flatnonzero(one & (depth == d))
        for i in range(0, len(queries), QUERIES):
            x, y = s.near(queries[i:i + QUERIES], d)
            xs.append(x)
            ys.append(y)
    x, y = np.concatenate(xs), np.concatenate(ys)
    own = ~_shares(s, x, y, col["stop"][x], back[x])
    x, y = x[own], y[own]
    longer = s.size[y] > s.size[x]                    # words of equal length find each other
    a, b = np.concatenate((x, y[longer])), np.concatenate((y, x[longer]))
    words = t.column("word").combine_chunks()
    return pa.RecordBatch.from_arrays([words.take(pa.array(a)), words.take(pa.array(b)), pa.array(col["n"][b])], schema=NEAR)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole lists, some of them at a time."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < ROWS:
            continue
        t = pa.Table.from_batches(held)
        key = t.column("key").to_numpy()
        change = np.flatnonzero(key[1:] != key[:-1])
        if len(change):
            end = int(change[-1]) + 1
            yield _pairs(t.slice(0, end))
            held, rows = t.slice(end).to_batches(), t.num_rows - end
    if rows:
        yield _pairs(pa.Table.from_batches(held))


def near_words(words: DataFrame, least: int = LEAST, most: int = MOST) -> DataFrame:
    """(word, near, near_n), both ways, of all near words of ``words``
    (word, n; distinct words of at least ``least`` code points, at least 2)."""
    spelt = F.when(F.col("c") > F.col("a"), F.reverse("word")).otherwise(F.col("word"))
    rows = dealt(words, least, most).select("key", *PLACE, "word", "n", spelt.alias("spelt"))
    rows = rows.repartition("key").sortWithinPartitions("key", "spelt")
    return rows.mapInArrow(_scan, "word string, near string, near_n long")


def group_variants(words: DataFrame, least: int = LEAST, factor: int = FACTOR, most: int = MOST) -> DataFrame:
    """``words`` (word, n) -> word, form, root, n, n_near, form_n.  A word's
    form is its most frequent near word (ties: the least), if that is
    ``factor`` (at least 2) times as frequent; forms are followed to the root
    by pointer doubling, in as many rounds as the logarithm of the steps."""
    words = cut(words.select("word", "n"))
    best = F.min(F.struct((-F.col("near_n")).alias("m"), "near"))
    near = near_words(words, least, most).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    form = F.when(-F.col("best.m") >= factor * F.col("n"), F.col("best.near"))
    out = cut(words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                                                      form.alias("form"), F.when(form.isNotNull(), -F.col("best.m")).alias("form_n")))
    roots = out.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = cut(roots.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if not roots.where("moved").limit(1).count():
            break
        roots = roots.select("word", "root")
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

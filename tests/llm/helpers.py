"""Small fixtures and brute-force forms for the training-data operators."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WS = re.compile(r"[^\x20\x09-\x0D]+")


def lower_az(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def prose(rng, n, vocabulary=400):
    return " ".join(f"{rng.choice('bcdfgklmnprst')}{rng.choice('aeiou')}{rng.randrange(vocabulary)}x" for _ in range(n))


def corpus(seed=1, n=60):
    """Prose with exact and near copies, null, empty, blank, short and long
    texts, a repeated row and null columns."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = "\n".join(prose(rng, rng.randrange(8, 60)) for _ in range(rng.randrange(1, 6)))
        if i % 5 == 1 and i > 5:
            text = rows[i - 5][1]
        if i % 5 == 2 and i > 5:
            words = (rows[i - 4][1] or "x").split(" ")
            for _ in range(max(1, len(words) // 60)):
                words[rng.randrange(len(words))] = "edited"
            text = " ".join(words)
        rows.append((i, text, rng.choice(["en", "de", None]), rng.choice(["a", "a", "b", None])))
    rows += [(900, None, "en", "a"), (901, "", "en", "a"), (902, " \t\n ", None, None), (903, "One", "en", "b"),
             (904, prose(rng, 6000), "de", "a"), (905, "Ünï ćødé 😀 wörds", "de", "b"), rows[3], (None, "null id here", "en", "a"),
             (None, prose(rng, 40), "en", "a")]
    return [(*r, len(r[1]) if r[1] else 0) for r in rows]


def shingle_set(text, k):
    w = WS.findall(lower_az(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def groups(n, links):
    """Root of each of n nodes under the given links."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    return [find(i) for i in range(n)]

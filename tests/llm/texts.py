"""Small document tables with the hard cases, and brute-force helpers."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "score double, id long, size string, row string, `a.b` int, part int, k long")
VOCAB = ["the", "of", "and", "to", "in", "is", "that", "for", "was", "with", "river", "stone", "garden", "window",
         "market", "winter", "letter", "music", "doctor", "engine", "paper", "kitchen", "forest", "bridge"]
GERMAN = ["der", "die", "und", "nicht", "über", "schön", "straße", "zeitung", "möglich", "größe", "werden", "auch"]


def prose(rng, n, words=VOCAB):
    out = []
    while n > 0:
        k = min(n, rng.randint(5, 12))
        s = " ".join(rng.choice(words) for _ in range(k))
        out.append(s[0].upper() + s[1:] + ".")
        n -= k
    return "\n".join(" ".join(out[i:i + 3]) for i in range(0, len(out), 3))


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), 0.5, 7, "x", "y", 1, 2, None)


def documents(spark, texts=()):
    """Prose, copies, near copies, a shared passage, and nulls, empties, long texts and repeated rows."""
    rng = random.Random(3)
    rows = [row(i, prose(rng, rng.randint(20, 120)), "en", "abc"[i % 3]) for i in range(30)]
    rows += [row(100 + i, prose(rng, 60, GERMAN), "de", None) for i in range(10)]
    base = rows[0][1].split(" ")
    passage = prose(rng, 55)
    for i in range(8):                                      # near copies of document 0
        words = list(base)
        words[rng.randrange(len(words))] = "changed"
        rows.append(row(200 + i, " ".join(words)))
    rows += [row(300 + i, rows[1][1]) for i in range(5)]    # exact copies of document 1
    rows += [row(400 + i, passage + "\n" + prose(rng, 90)) for i in range(6)]
    rows += [row(500, None), row(501, None, None, None), row(502, ""), row(503, " \n\t "), row(504, "one"),
             row(505, "one two three"), row(506, "ONE two three"), row(507, "12 34 ... !!"),
             row(508, prose(rng, 4000)), row(None, rows[2][1]), row(None, None), rows[3], rows[3],
             row(509, "x" * 5000), row(510, "naïve café ß 中文 🙂 " * 30, "fr", "d")]
    rows += [row(600 + i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return WORD.findall(text or "")


def shingles(text, width=5):
    w = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(w) < width:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1))


def components(rows, percent=75):
    """{id: (set size, smallest linked id)} by comparing all pairs; rows are (id, text) with ids."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            both = len(a & b)
            if both and 100 * both >= percent * len(a | b):
                lo, hi = sorted((find(i), find(j)))
                parent[hi] = lo
    return {i: (len(s), find(i)) for i, s in sets}

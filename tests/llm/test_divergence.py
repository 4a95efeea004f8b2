"""Source divergence against a plain computation with Python's whole numbers."""

import random
import re
from collections import Counter, defaultdict

import pytest
import texts as T

from vigil.llm import divergence as D

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def brute(rows, min_docs=10, top=10):
    """{(lang, source, part, item): (value, rank)} from (text, lang, source) rows."""
    counts, files, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = TERM.findall((text or "").translate(FOLD))
        groups[lang].add(source)
        counts[lang, source].update(found)
        files[lang].update(set(found))
    out = {}
    for lang, sources in groups.items():
        kept = sorted(t for t, n in files[lang].items() if n >= min_docs)

        def shares(count, kept=kept):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10 ** 9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}
        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))

        def f(a, b):
            return (a - b) ** 2 // (a + b)
        for s in sources:
            pair = [(x, sum(f(p[s][t], p[x][t]) for t in kept)) for x in sources if x != s]
            term = [(t, f(p[s][t], q[t])) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pair), ("term", term)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                for k, (item, value) in enumerate(items if part == "pair" else items[:top]):
                    out[lang, s, part, item] = (value, k + 1)
    return out


def run(docs, **kw):
    audit = D.Audit(docs, **kw)
    rows = D.ranked(audit.pairs(), "pair").unionByName(D.ranked(audit.terms(), "term", D.TOP)).collect()
    got = {tuple(r)[:4]: tuple(r)[4:] for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(8)
    texts = []
    for i in range(160):
        words = [rng.choice(T.VOCAB[:rng.randint(3, 24)]) for _ in range(rng.randint(0, 80))]
        texts.append(T.row(2000 + i, " ".join(words) + " ÄÖ l'été 3x_y", rng.choice(["en", "de", "", None]),
                           rng.choice(["a", "b", "c", "ä", "z", None, ""])))
    texts += [T.row(3000, None, "en", "silent"), T.row(3001, "12 34", "xx", "a"), T.row(3002, "rare", "xx", "b")]
    return T.documents(spark).unionByName(spark.createDataFrame(texts, T.SCHEMA)).cache()


@pytest.mark.parametrize("min_docs,block,tile", [(10, 256, 64), (2, 7, 64), (1, 16, 2)])
def test_divergence_against_brute_force(corpus, monkeypatch, min_docs, block, tile):
    monkeypatch.setattr(D, "BLOCK", block)
    monkeypatch.setattr(D, "TILE", tile)
    want = brute([(r.text, r.lang, r.source) for r in corpus.collect()], min_docs)
    assert run(corpus.repartition(5), min_docs=min_docs) == want
    assert ("xx", "a", "pair", "b") in want and ("en", "silent", "pair", "a") in want


def test_divergence_of_nothing(spark):
    assert run(T.empty(spark)) == {}
    alone = spark.createDataFrame([T.row(i, "one word", "en", "a") for i in range(10)], T.SCHEMA)
    assert run(alone) == {}         # a single source has no pair, and its shares are the lang's


def test_runs_are_longest_and_complete(corpus, monkeypatch):
    monkeypatch.setattr(D, "BLOCK", 16)
    audit = D.Audit(corpus, min_docs=1)
    columns = defaultdict(list)
    for r in audit.runs().collect():
        columns[r.lang, r.source, r.block].append((r.start, r.length, r.p))
    for runs in columns.values():
        (size, _, rest), = [x for x in runs if x[1] == 0]
        filled = sorted(x for x in runs if x[1])
        assert all(p > rest for _, _, p in filled)
        for (s1, n1, p1), (s2, _, p2) in zip(filled, filled[1:], strict=False):
            assert s1 + n1 < s2 or s1 + n1 == s2 and p1 != p2
        assert not filled or filled[-1][0] + filled[-1][1] <= size
    n = audit.kept.count()
    assert sum(x[1] for runs in columns.values() for x in runs) == n > sum(1 for runs in columns.values() for x in runs if x[1])


def test_long_texts_are_cut_between_terms(monkeypatch):
    rng = random.Random(6)
    text = "".join(rng.choice("abZé-1 ß") for _ in range(5000))
    monkeypatch.setattr(D, "PIECE", 50)
    got = [t.decode() for part in D.text_terms(text.encode()) for t in part if t]
    assert got == TERM.findall(text.translate(FOLD))
    assert list(D.text_terms(b"")) == []


def test_counts_are_handed_on_in_parts(corpus, monkeypatch):
    whole = run(corpus)
    monkeypatch.setattr(D, "HELD", 5)
    assert run(corpus) == whole

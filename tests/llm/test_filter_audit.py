"""Filter interaction audit against brute force over all orders."""

import itertools
import random
from collections import defaultdict

import numpy as np
import texts as T

from vigil.llm import filter_audit as A

LABELS = "doc_id long, quality int, toxic int, source string, n long"


def brute(rows, labels):
    """{(part, order, step): counts} from (id, text, part) rows."""
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    marks = defaultdict(lambda: [False, False])
    for i, good, toxic in labels:
        marks[i][0] |= good == 1
        marks[i][1] |= toxic == 1
    seen = []
    for i, t, part in rows:
        t = t or ""
        w = T.words(t)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w),
                 "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t), "D": any(c in "#$%&*|" for c in t),
                 "E": i is not None and i > first[t]}
        seen.append((part or "", {x for x in fails if fails[x]}, *(marks[i] if i is not None else (False, False))))
    out = {}
    for part in {s[0] for s in seen}:
        mine, fair = [s for s in seen if s[0] == part], defaultdict(int)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for k, x in enumerate(order):
                gone = [s for s in left if x in s[1]]
                left = [s for s in left if x not in s[1]]
                fair[x] += len(gone)
                out[part, order, k + 1] = [
                    len(left), len(gone), sum(x in s[1] for s in mine) - len(gone), sum(s[1] == {x} for s in mine),
                    sum(s[2] for s in gone), sum(s[3] for s in gone)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(fair[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def run(docs, labels):
    out = A.audit(A.survivors(A.failures(docs), labels)).collect()
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in out}
    assert len(got) == len(out)
    return got


def test_audit_against_all_orders(spark):
    rng = random.Random(2)
    texts = [T.prose(rng, 130), "SHOUT " * 150, "a b # c " * 40, T.prose(rng, 20) + " 100%", "ÀÉ " * 60,
             " ".join(f"w{i}" for i in range(120)), " ".join(f"W{i}" for i in range(120)) + " $"]
    docs = T.documents(spark, texts + texts[:4])
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    labels = [(i, i % 2, int(i % 3 == 0)) for i, _, _ in rows if i is not None and i % 5]
    labels += [(3, 1, 0), (3, 0, 1), (4, None, None), (None, 1, 1), (99999, 1, 1)]
    table = spark.createDataFrame([(*x, "a", 1) for x in labels], LABELS)
    want = brute(rows, labels)
    assert run(docs, table) == want
    assert run(docs.repartition(7), table.repartition(3)) == want
    assert {k[0] for k in want} == {"", "de", "en", "fr"} and len(want) == 4 * 600


def test_audit_of_nothing(spark):
    labels = spark.createDataFrame([], LABELS)
    assert run(T.empty(spark), labels) == {}
    one = spark.createDataFrame([T.row(1, "x", None)], T.SCHEMA)
    got = run(one, labels)
    assert got == brute([(1, "x", None)], []) and len(got) == 600


def test_positional_counts_add_up():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 5, 64, 1001):
        words = rng.integers(0, 1 << 32, n, dtype=np.uint32)
        times = rng.integers(1, 9, n)
        bits = (words[:, None] >> np.arange(32, dtype=np.uint32)) & 1
        assert A.positional_counts(words) == bits.sum(axis=0).tolist()
        assert A.positional_counts(words, times) == (bits * times[:, None]).sum(axis=0).tolist()
    counter = A.PositionalCounter()
    whole = rng.integers(0, 1 << 32, 4000, dtype=np.uint32)
    for part in np.array_split(whole, 13):
        counter.add(part)
        assert all(len(p) <= 2 for p in counter.planes.values())
    assert counter.counts() == A.positional_counts(whole)


def test_long_texts_are_split_at_white_space(monkeypatch):
    rng = random.Random(4)
    text = (" ".join("w" * rng.randint(1, 30) for _ in range(3000)) + "\n\t ").encode()
    whole = A.own_failures(text)
    monkeypatch.setattr(A, "PIECE", 64)
    assert [w for p in A._pieces(text) for w in p.split()] == text.split()
    assert A.own_failures(text) == whole
    assert list(A._pieces(b"x" * 500)) == [b"x" * 500] and list(A._pieces(b"")) == []

"""What the driver and the disk hold stays small beside the input."""

import tracemalloc

import numpy as np

from vigil.llm import weaklabel


def _rows(n):
    rng = np.random.default_rng(3)
    stat = weaklabel.BUCKETS + np.arange(len(weaklabel.STATS)) * weaklabel.STAT_BINS
    return [(i % 5, weaklabel._sparse(rng.integers(0, weaklabel.BUCKETS, int(rng.integers(200, 1500))), stat))
            for i in range(n)]


def test_fit_of_the_scorer_holds_few_bytes_a_feature():
    rows = _rows(3000)
    features = sum(len(f) // 8 for _, f in rows)
    tracemalloc.start()
    try:
        patterns, blocks = weaklabel.feature_blocks(iter(rows))
        got = weaklabel.fit_linear(blocks, patterns / 4, rounds=3)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # six bytes a feature, and the sums of one block; whole-sample sums took more than 40
    assert sum(len(c) for _, c, _ in blocks) == features and peak < 14 * features
    assert patterns.tolist() == [p for p, _ in rows]

    # the same descent over the whole sample at once, to the bit
    index = [np.frombuffer(f[:len(f) // 2], np.int32) for _, f in rows]
    row = np.repeat(np.arange(len(rows)), [len(i) for i in index])
    col, val = np.concatenate(index), np.concatenate([np.frombuffer(f[len(f) // 2:], np.float32) for _, f in rows])
    target, n = patterns / 4, weaklabel.N_FEATURES
    w, seen = np.zeros(n + 1), np.full(n + 1, 1e-8)
    balance = np.where(target >= 0.5, 0.5 / (target >= 0.5).mean(), 0.5 / (target < 0.5).mean())
    for _ in range(3):
        e = (1 / (1 + np.exp(-np.clip(np.bincount(row, val * w[col]) + w[-1], -60, 60))) - target) * balance
        g = np.append(np.bincount(col, val * e[row], n), e.sum()) / len(rows) + 1e-5 * w
        seen += g * g
        w -= 0.5 * g / np.sqrt(seen)
    assert got.tobytes() == w.tobytes()


def test_encoding_shuffles_no_texts_and_takes_any_table(spark, tmp_path, monkeypatch):
    """Tables read from files, shuffled and made in memory give the same ids; ids join no texts."""
    from vigil.llm import lattice

    monkeypatch.setattr(lattice, "GROUP_ROWS", 7)       # many groups, some without a rare unit
    rng = np.random.default_rng(5)
    common = ["the", "of", "Anblewh", "and,", "été", "a--b", "x\ny"]
    texts = [" ".join([*rng.choice(common, 30), *(f"w{i}q{rng.integers(9)}z",) * (i % 3), "🙂"]) for i in range(60)]
    texts += [None, "", " ", "  two", "end ", "▁", texts[0], texts[0], "-" * 300]
    rows = list(enumerate(texts)) + [(0, texts[1]), (None, texts[2])]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    path = str(tmp_path / "t")
    made.repartition(3).write.parquet(path)
    read = spark.read.parquet(path)
    pieces = lattice.load_pieces(lattice.model_path())
    want = sorted((i is None, i or 0, t or "", [int(x) for u in lattice.units_of(t) for x in lattice.best_ids(u, pieces)])
                  for i, t in rows)
    for docs in (read, read.select("doc_id", "text"), read.repartition(4), made, read.union(read.limit(0))):
        for frequent in (0, 5, 1 << 17):
            out = lattice.encode(docs, pieces, frequent=frequent)
            assert sorted((r.id is None, r.id or 0, r.text, r.ids) for r in out.collect()) == want
            if docs is read:    # the result is a scan and one map: no shuffle takes texts to their ids
                assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
            if frequent and docs is not read:
                break

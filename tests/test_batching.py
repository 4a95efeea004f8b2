import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from vigil.operators import batching
from vigil.operators.ordinal import with_ordinal


def test_byte_batches_reference_case(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate([40, 40, 40, 90, 20])], "seq bigint, len bigint")
    df = df.withColumn("feed", F.lit("f"))
    out = batching.byte_batches(df, "len", ["seq"], by=["feed"], batch_size=5000, max_bytes=100, carry=["seq"])
    assert [r.byte_batch for r in out.orderBy("seq").collect()] == [0, 0, 1, 2, 3]


def test_byte_batches_limit_property(spark):
    rnd = random.Random(7)
    rows = [(i, f"f{i % 3}", rnd.choice([1, 5, 30, 99, 100, 101, 250])) for i in range(600)]
    df = spark.createDataFrame(rows, "seq bigint, feed string, len bigint")
    out = batching.byte_batches(df, "len", ["seq"], by=["feed"], batch_size=50, max_bytes=100, carry=["seq"])
    got = out.collect()
    assert len(got) == len(rows)
    groups = {}
    for r in got:
        groups.setdefault((r.feed, r.batch_no, r.byte_batch), []).append(r.len)
    for lens in groups.values():
        assert sum(lens) <= 100 or len(lens) == 1        # over the limit only when alone
    # greedy reference computed in plain Python per feed / count batch
    for feed in ("f0", "f1", "f2"):
        seq = sorted((s, n) for s, f, n in rows if f == feed)
        want = []
        for start in range(0, len(seq), 50):
            cur, bb = 0, 0
            for i, (_, n) in enumerate(seq[start:start + 50]):
                if i > 0 and cur + n > 100:
                    bb, cur = bb + 1, 0
                cur += n
                want.append(bb)
        have = [r.byte_batch for r in sorted((r for r in got if r.feed == feed), key=lambda r: r.seq)]
        assert have == want


def test_count_batches(spark):
    df = spark.createDataFrame([(i, "a" if i % 4 else "b") for i in range(23)], "seq bigint, feed string")
    out = {r.seq: (r.pos, r.batch_no) for r in batching.count_batches(df, ["seq"], ["feed"], 5).collect()}
    a = [s for s in range(23) if s % 4]
    assert out[a[0]] == (1, 0) and out[a[4]] == (5, 0) and out[a[5]] == (6, 1)


def test_ordinal_matches_row_number_under_skew(spark):
    rnd = random.Random(3)
    rows = [("hot" if rnd.random() < 0.6 else f"g{rnd.randint(0, 5)}", i, rnd.randint(0, 50)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, id bigint, v int")
    got = with_ordinal(df, ["v", "id"], by=["g"], name="rn", partitions=7)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")))
    assert got.select("g", "id", "rn").exceptAll(want.select("g", "id", "rn")).count() == 0
    assert got.count() == 3000


def test_ordinal_global_and_null_group(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), ("x", 2)], "g string, v int")
    got = sorted((r.g, r.v, r.rn) for r in with_ordinal(df, ["v"], by=["g"]).collect() if r.g is None)
    assert [x[2] for x in got] == [1, 2]
    allr = sorted(r.rn for r in with_ordinal(df, ["v"]).collect())
    assert allr == [1, 2, 3]


def test_ordinal_and_batches_on_empty_input(spark):
    empty = spark.createDataFrame([], "seq bigint, feed string, len bigint")
    assert with_ordinal(empty, ["seq"], by=["feed"]).count() == 0
    assert batching.byte_batches(empty, "len", ["seq"], by=["feed"], batch_size=5, max_bytes=10).count() == 0

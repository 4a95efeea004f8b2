"""Hot keys: one key holding a third of the rows must not end up in one task."""

from pyspark.sql import functions as F

from vigil.operators import dedup


def test_anti_join_splits_a_hot_key(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 60000
        ev = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot-key")).otherwise(F.col("id").cast("string")).alias("item_id"),
            F.col("id"), F.repeat(F.lit("x"), 20).alias("pad"))
        seen = spark.range(0, n, 7).select(F.col("id").cast("string").alias("item_id"))
        out = dedup.new_only(ev, seen)
        got = out.count()
        want = n - len({i for i in range(0, n, 7) if i % 3 != 0})
        assert got == want                                   # whole result, hot key included
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "LeftAnti" in plan
        assert "isSkewJoin=true" in plan or "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_first_occurrence_of_hot_key_is_combined_map_side(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
        F.col("id").cast("string")).alias("k"), F.col("id").alias("t"))
    out = dedup.first_per_key(df, "k", ["t"])
    assert out.filter(F.col("k") == "hot").first().t == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan

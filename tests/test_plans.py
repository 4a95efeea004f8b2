"""Plan assertions: the physical operators the design relies on."""

import os

from pyspark.sql import functions as F

from vigil.operators import dedup, envelope, state as S
from vigil.plans import registry as R


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_anti_join_and_pushdown(spark, tmp_root):
    path = os.path.join(tmp_root, "v.parquet")
    spark.range(1000).select(F.col("id").cast("string").alias("item_id"),
                             F.when(F.col("id") % 3 == 0, "high").otherwise("low").alias("severity"),
                             (F.col("id") * 10).alias("last_found_epoch")).write.parquet(path)
    ev = spark.read.parquet(path).filter((F.col("severity") == "high") & (F.col("last_found_epoch") > 50))
    seen = spark.createDataFrame([("3",)], "item_id string")
    p = plan(dedup.new_only(ev, seen))
    assert "LeftAnti" in p
    assert "PushedFilters: [IsNotNull(severity), IsNotNull(last_found_epoch), EqualTo(severity,high)" in p
    assert "ReadSchema: struct<item_id:string,severity:string,last_found_epoch:bigint>" in p


def test_registry_join_is_broadcast(spark):
    ev = spark.range(100).select(F.lit("asset").alias("feed"), F.col("id"))
    p = envelope.classify(ev, R.registry_frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_cap_ranks_without_a_window_per_feed(spark):
    st = spark.range(100).select((F.col("id") % 2).cast("string").alias("feed"), F.col("id").cast("string").alias("item_id"),
                                 F.timestamp_seconds(F.col("id")).alias("seen_at"))
    trimmed = S.trim_newest(st, 10)
    assert "row_number" not in plan(trimmed)
    assert trimmed.count() == 20


def test_submitted_shuffle_partitions_survive(spark):
    from vigil.session import build_session

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "77")
    try:
        assert build_session().conf.get("spark.sql.shuffle.partitions") == "77"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_first_per_key_is_partial_aggregate(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    p = plan(dedup.first_per_key(df, "k", ["t"]))
    assert "partial_min" in p and "Window" not in p


def test_incremental_mark_prunes_ingest_partitions(spark, tmp_root):
    import json

    from vigil.plans import feeds
    from vigil.sources import readers

    for day, ts in (("2026-01-01", "2026-01-01T10:00:00Z"), ("2026-01-05", "2026-01-05T10:00:00Z")):
        d = os.path.join(tmp_root, "assets", f"ingest_date={day}")
        os.makedirs(d)
        with open(os.path.join(d, "part-0.json"), "w") as f:
            f.write(json.dumps({"id": day, "updated_at": ts, "is_deleted": False}) + "\n")
    a = readers.assets(spark, os.path.join(tmp_root, "assets"))
    mark = 1767571200                                   # 2026-01-05 00:00:00
    df = feeds.extract(R.REGISTRY["asset"], a, mark=mark)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in p and "ingest_date#" in p
    assert [r.item_id for r in df.collect()] == ["2026-01-05"]


def test_bucketed_state_is_not_moved(spark, tmp_root):
    """Neither the anti-join nor the merge of a commit exchanges the state; the merged rows go back bucket by bucket."""
    base = os.path.join(tmp_root, "s")
    state = spark.range(500).select(F.lit("a").alias("feed"), F.col("id").cast("string").alias("item_id"),
                                    F.timestamp_seconds(F.col("id") + 1000).alias("seen_at"))
    S.commit(state, base, 1, buckets=4)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        events = spark.range(400, 600).select(F.col("id").cast("string").alias("k"))
        new = dedup.new_only(events, S.active_keys(S.load(spark, base, "a"), 1100, 1), "k")
        p = plan(new)
        assert "SortMergeJoin" in p and p.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in p
        assert sorted(int(r.k) for r in new.collect()) == list(range(500, 600))
        fresh = events.select(F.lit("a").alias("feed"), F.col("k").alias("item_id"), F.timestamp_seconds(F.lit(5000)).alias("seen_at"))
        stays = S.unrenewed(S.load(spark, base, "a"), fresh)
        p = plan(stays.repartition(4, "item_id"))
        assert p.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in p and "REPARTITION" not in p
        S.commit(stays, base, 2, feeds=["a"], buckets=4, added=fresh)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert sorted(map(tuple, S.load(spark, base).collect())) == sorted(map(tuple, S.upsert(state, fresh).collect()))
    files = [f for f in os.listdir(os.path.join(base, "keys", "v=2", "feed=a")) if f.endswith(".parquet")]
    assert len(files) == 8          # a file per bucket and part
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("vigil_state")]

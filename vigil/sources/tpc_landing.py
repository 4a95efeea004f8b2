"""Landing-zone adapters over the driver's TPC-style tables.

The feeds normally read landed export documents (see ``readers.py``); for
tests and benchmarks the same shapes are derived from the driver tables with
plain projections so Catalyst prunes columns and pushes predicates down to
the parquet scan. Every function returns a lazy DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X

# ---- fixed values shared with the oracle SQL -------------------------------------
NOW_TPC = 1007164800          # 2001-12-01 00:00:00 UTC
NOW_EVENTS = 1706745600       # 2024-02-01 00:00:00 UTC
STATE_RETENTION_DAYS = 365
STATE_FEED = "vulnerability"
STATE_FEED_2 = "fixed_vulnerability"
# -----------------------------------------------------------------------------------


REBALANCE = "spark.vigil.rebalanceLanding"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A landed table, read as it is.

    With the session setting ``spark.vigil.rebalanceLanding`` (the benchmark sets it: its
    tables are one row group each, so one task would do all work before the first
    shuffle) rows are first hash-partitioned by the key column.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if spark.conf.get(REBALANCE, "false") == "true":
        return df.repartition(spark.sparkContext.defaultParallelism, df.columns[0])
    return df


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    prio, status, cust = F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_custkey")
    return o.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderdate").alias("updated_at"),
        prio.isin("1-URGENT", "2-HIGH").alias("has_agent"),
        F.when(prio == "1-URGENT", F.lit("NESSUS_AGENT,NESSUS_SCAN"))
        .when(prio == "3-MEDIUM", F.lit("NESSUS_AGENT"))
        .otherwise(F.lit("NESSUS_SCAN")).alias("sources_csv"),
        (status == "F").alias("is_deleted"),
        (status == "P").alias("is_terminated"),
        F.when((status == "P") & (cust % 2 == 0), F.col("o_orderdate")).alias("terminated_at"),
        (cust % 5 != 0).alias("has_plugin_results"),
    )


def assets_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``assets`` with the export's list column and epoch times."""
    a = assets(spark, sf_dir)
    return a.select(
        "id", "has_agent", "is_deleted", "is_terminated", "has_plugin_results",
        F.split("sources_csv", ",").alias("sources"),
        X.epoch_seconds("updated_at").alias("updated_epoch"),
        X.epoch_seconds("terminated_at").alias("terminated_epoch"),
    )


def vulns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vulns_from_lineitem(table(spark, sf_dir, "lineitem"))


def vulns_from_lineitem(li: DataFrame) -> DataFrame:
    """Lineitem-shaped landing rows (batch or one micro-batch) -> flat vulnerability rows."""
    q = F.col("l_quantity")
    return li.select(
        F.col("l_orderkey").cast("string").alias("asset_uuid"),
        (F.col("l_orderkey") % 2 == 0).alias("asset_has_agent"),
        F.col("l_partkey").alias("plugin_id"),
        F.when(F.col("l_linenumber") < 7, F.col("l_linenumber")).alias("port"),
        F.when(F.col("l_returnflag") == "A", F.lit(None).cast("string"))
        .when(F.col("l_linestatus") == "O", F.lit("tcp")).otherwise(F.lit("udp")).alias("protocol"),
        F.when(q < 10, F.lit("info")).when(q < 20, F.lit("low")).when(q < 30, F.lit("medium"))
        .when(q < 40, F.lit("high")).otherwise(F.lit("critical")).alias("severity"),
        F.when(F.col("l_returnflag") == "R", F.lit("FIXED")).otherwise(F.lit("OPEN")).alias("state"),
        (F.col("l_suppkey") % 10 != 0).alias("is_licensed"),
        F.col("l_shipdate").alias("last_found"),
        F.col("l_suppkey").alias("snapshot_id"),
        # total order of the export stream (unique per row)
        F.col("l_orderkey").alias("ord_a"),
        F.col("l_linenumber").cast("bigint").alias("ord_b"),
        F.col("l_partkey").alias("ord_c"),
        F.col("l_suppkey").alias("ord_d"),
    )


ORDER_COLS = ("ord_a", "ord_b", "ord_c", "ord_d")


def nest_vulns(df: DataFrame) -> DataFrame:
    """Re-nest flat vulnerability rows into the export's record shape."""
    return df.select(
        F.struct(F.col("asset_uuid").alias("uuid"), F.col("asset_has_agent").alias("has_agent"))
        .alias("asset"),
        F.struct(F.col("plugin_id").alias("id")).alias("plugin"),
        F.struct(F.col("port").alias("port"), F.col("protocol").alias("protocol")).alias("port"),
        "severity", "state", "is_licensed", "last_found", "snapshot_id", *ORDER_COLS,
    )


def vulns_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = vulns(spark, sf_dir)
    return v.select(X.vuln_key("asset_uuid", "plugin_id", "port", "protocol").alias("vuln_key"), "*")


def state(spark: SparkSession, sf_dir: str, second_feed: bool = True) -> DataFrame:
    """Keys delivered earlier: ``feed, item_id, seen_at`` (one row per key).

    Both feeds come out of one scan: each row is tagged with the feeds whose
    snapshot it belongs to, then one aggregate keeps the newest sighting.
    """
    k = vulns_keyed(spark, sf_dir)
    sid = F.col("snapshot_id")
    tags = [F.when(sid % 4 == 0, F.lit(STATE_FEED))]
    if second_feed:
        tags.append(F.when(sid % 5 == 0, F.lit(STATE_FEED_2)))
    pre = (sid % 4 == 0) | (sid % 5 == 0) if second_feed else (sid % 4 == 0)
    tagged = k.filter(pre).select(F.explode(F.array(*tags)).alias("feed"), "vuln_key", "last_found").filter(
        F.col("feed").isNotNull())
    return (tagged.groupBy("feed", "vuln_key").agg(F.max("last_found").alias("seen_at"))
            .select("feed", F.col("vuln_key").alias("item_id"), F.col("seen_at").cast("timestamp").alias("seen_at")))


def prev_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = vulns_keyed(spark, sf_dir)
    return k.filter((F.col("state") == "OPEN") & (F.col("snapshot_id") % 3 != 0)).select("vuln_key").distinct()


def curr_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = vulns_keyed(spark, sf_dir)
    return k.filter((F.col("state") == "OPEN") & (F.col("snapshot_id") % 2 == 0)).select("vuln_key").distinct()


def snapshot_keys(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """Open keys of snapshot ``n`` of three (``snapshot_id % 3 = n``)."""
    k = vulns_keyed(spark, sf_dir)
    return k.filter((F.col("state") == "OPEN") & (F.col("snapshot_id") % 3 == n)).select("vuln_key").distinct()


def families(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.substring("p_brand", 7, 1 << 20).cast("int").alias("family_id"),
                    F.col("p_brand").alias("family_name")).distinct()


def family_plugins(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.substring("p_brand", 7, 1 << 20).cast("int").alias("family_id"),
                    F.col("p_partkey").alias("plugin_id"))


FAMILY_PAGE = 1024


def family_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Family-detail documents: ``family_id, plugins ARRAY<STRUCT<id>>``.

    Landed as pages of at most ``FAMILY_PAGE`` plugins (the export is paged), so no
    single document grows with the catalogue.
    """
    fp = family_plugins(spark, sf_dir)
    return (fp.groupBy("family_id", F.floor(F.col("plugin_id") / FAMILY_PAGE).alias("page"))
            .agg(F.collect_list(F.struct(F.col("plugin_id").alias("id"))).alias("plugins")))


def plugin_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return (p.filter(F.col("p_partkey") % 13 != 0)
            .select(F.col("p_partkey").alias("plugin_id"), F.col("p_name").alias("plugin_name"),
                    F.col("p_type").alias("plugin_type"), F.col("p_size").alias("plugin_size")))


def scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("scan_id"),
        F.concat(F.lit("scan-"), F.col("o_orderkey").cast("string")).alias("scan_name"),
        F.when(F.col("o_orderstatus") == "F", F.lit("completed"))
        .when(F.col("o_orderstatus") == "P", F.lit("running")).otherwise(F.lit("aborted")).alias("status"),
        F.col("o_orderdate").alias("modified_at"),
    )


def scan_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return (li.join(s, li.l_suppkey == s.s_suppkey)
            .select(F.col("l_orderkey").alias("scan_id"), F.col("l_suppkey").alias("host_id"),
                    F.col("s_name").alias("hostname")).distinct())


def compliance(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("scan_id"), F.col("l_suppkey").alias("host_id"),
                     F.col("l_partkey").alias("plugin_id"), F.col("l_linenumber").alias("item_no"),
                     F.col("l_returnflag").alias("result"))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    et = F.col("event_type")
    return e.select(
        F.col("event_id").alias("run_id"), et.alias("feed"),
        F.when(et.isin("click", "view"), F.lit("assets"))
        .when(et.isin("purchase", "signup"), F.lit("vulnerabilities")).otherwise(F.lit("plugins"))
        .alias("feed_group"),
        F.floor("value").cast("bigint").alias("event_count"),
        F.col("user_id").alias("duration_s"),
        F.col("ts"),
    )


def error_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return (e.filter(F.col("event_type") == "error")
            .select(F.col("event_id").alias("error_id"), (F.col("user_id") % 10).alias("feed_no"), "ts"))


def delivery_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    m = F.col("event_id") % 10
    return e.select(
        F.col("event_id").alias("batch_id"),
        F.when(m == 0, F.lit(429)).when(m == 1, F.lit(503)).when(m == 2, F.lit(400))
        .when(m == 3, F.lit(None).cast("int")).otherwise(F.lit(200)).alias("status_code"),
        F.floor("value").cast("bigint").alias("event_count"),
        F.col("value").alias("delay_ms"),
        F.col("ts"),
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("seq"), F.col("source").alias("feed"),
                    F.col("text").alias("payload"), "n_chars")

"""Registered queries: each builds a feed operation on the landing views.

Every entry pairs a DataFrame plan (``queries()``) with DuckDB SQL over the same
driver tables (``oracle_sql()``); both alias their output columns identically.
Times leave as epoch seconds / microseconds so both engines hash them alike.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import batching, dedup, diff, envelope, flatten, lateness, metrics, watermark
from ..operators import filters as P
from ..operators import sink
from ..operators import state as S
from ..session import work_dir
from ..sources import tpc_landing as L
from . import feeds
from .oracle_views import rnd, with_views as V
from .registry import HOST, INDEX, REGISTRY, SOURCE, FeedSpec, registry_frame, select_feeds

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

NOW = L.NOW_TPC
NOW_EV = L.NOW_EVENTS
RET = L.STATE_RETENTION_DAYS
CUTOFF_SQL = "TIMESTAMP '2000-12-01 00:00:00'"          # NOW - 365 days
MARK_1998 = 883612800                                    # 1998-01-01
MARK_1999 = 915148800                                    # 1999-01-01
MARK_2000 = 946684800                                    # 2000-01-01
MARK_2002 = 1009843200                                   # 2002-01-01
ACTIVE_SQL = "('medium', 'high', 'critical')"
TIE = ("last_found_epoch", "snapshot_id", "severity", "state")


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---- shared building blocks ---------------------------------------------------------

def vuln_source(spark: SparkSession, d: str) -> DataFrame:
    """Vulnerability export records (nested) with epoch times."""
    return L.nest_vulns(L.vulns(spark, d)).withColumn("last_found_epoch", X.epoch_seconds("last_found"))


VULN_COLS_SQL = "vuln_key, asset_uuid, plugin_id, port, protocol, severity"


def seen_us(col: str = "seen_at"):
    return X.epoch_micros(col).alias("seen_us")


def state_out(df: DataFrame) -> DataFrame:
    return df.select("feed", "item_id", seen_us())


def new_active(spark: SparkSession, d: str, state: DataFrame | None = None) -> DataFrame:
    """Active-severity vulnerabilities not in live state (first run, no mark)."""
    st = L.state(spark, d) if state is None else state
    return feeds.run_incremental(REGISTRY["vulnerability"], vuln_source(spark, d), st, NOW, retention_days=RET)


NEW_ACTIVE_SQL = f"""new_active AS (
  SELECT k.* FROM v_vulns_keyed k
  WHERE severity IN {ACTIVE_SQL}
    AND NOT EXISTS (SELECT 1 FROM v_state s WHERE s.feed = 'vulnerability' AND s.seen_at > {CUTOFF_SQL}
                    AND s.item_id = k.vuln_key))"""


# ---- 2.1 scans / sources ---------------------------------------------------------------

@register("scan_assets", V("""
SELECT id, updated_epoch, terminated_epoch, has_agent, is_deleted, is_terminated, has_plugin_results,
       list_contains(string_split(sources_csv, ','), 'NESSUS_AGENT') AS agent_source,
       CAST(len(string_split(sources_csv, ',')) AS INTEGER) AS n_sources
FROM v_assets_n""", "v_assets_n"))
def scan_assets(spark, d):
    a = L.assets_native(spark, d)
    return a.select("id", "updated_epoch", "terminated_epoch", "has_agent", "is_deleted", "is_terminated",
                    "has_plugin_results", F.array_contains("sources", P.AGENT_SOURCE).alias("agent_source"),
                    F.size("sources").alias("n_sources"))


def scan_vulns_df(spark, d, severities=None, state=None, since=None, include_unlicensed=True) -> DataFrame:
    """The export scan with its source-side parameters as pushed predicates."""
    v = vuln_source(spark, d)
    preds = [P.severity_in(severities) if severities else None,
             (F.col("state") == state) if state else None,
             P.since("last_found_epoch", since), P.licensed(include_unlicensed)]
    return v.filter(P.all_of(*preds))


@register("scan_vulns", V(f"""
SELECT {VULN_COLS_SQL}, state, CAST(epoch_us(last_found) // 1000000 AS BIGINT) AS last_found_epoch
FROM v_vulns_keyed
WHERE severity IN {ACTIVE_SQL} AND state = 'OPEN' AND epoch_us(last_found) // 1000000 > {MARK_1999}
  AND COALESCE(is_licensed, false)""", "v_vulns_keyed"))
def scan_vulns(spark, d):
    v = scan_vulns_df(spark, d, P.ACTIVE_SEVERITIES, "OPEN", MARK_1999, include_unlicensed=False)
    v = v.withColumn("item_id", X.vuln_key("asset.uuid", "plugin.id", "port.port", "port.protocol"))
    return v.select(F.col("item_id").alias("vuln_key"), F.col("asset.uuid").alias("asset_uuid"),
                    F.col("plugin.id").alias("plugin_id"), F.col("port.port").alias("port"),
                    F.col("port.protocol").alias("protocol"), "severity", "state", "last_found_epoch")


@register("scan_plugin_catalog", V("""
SELECT f.family_id, f.family_name, CAST(COUNT(*) AS BIGINT) AS n_plugins,
       CAST(COUNT(d.plugin_id) AS BIGINT) AS n_detailed
FROM v_families f JOIN v_family_plugins fp ON f.family_id = fp.family_id
LEFT JOIN v_plugin_details d ON fp.plugin_id = d.plugin_id
GROUP BY f.family_id, f.family_name""", "v_families", "v_family_plugins", "v_plugin_details"))
def scan_plugin_catalog(spark, d):
    fp = flatten.explode_family_details(L.family_details(spark, d))
    det = L.plugin_details(spark, d).select("plugin_id", F.lit(1).alias("_has"))
    per_family = fp.join(det, "plugin_id", "left").groupBy("family_id").agg(
        F.count(F.lit(1)).alias("n_plugins"), F.count("_has").alias("n_detailed"))
    return L.families(spark, d).join(per_family, "family_id").select(
        "family_id", "family_name", "n_plugins", "n_detailed")


@register("scan_compliance_tree", V("""
SELECT s.scan_id, s.scan_name, s.status, CAST(COALESCE(h.n_hosts, 0) AS BIGINT) AS n_hosts,
       CAST(COALESCE(c.n_items, 0) AS BIGINT) AS n_items
FROM v_scans s
LEFT JOIN (SELECT scan_id, COUNT(*) AS n_hosts FROM v_scan_hosts GROUP BY scan_id) h ON s.scan_id = h.scan_id
LEFT JOIN (SELECT scan_id, COUNT(*) AS n_items FROM v_compliance GROUP BY scan_id) c ON s.scan_id = c.scan_id""",
                                     "v_scans", "v_scan_hosts", "v_compliance"))
def scan_compliance_tree(spark, d):
    hosts = L.scan_hosts(spark, d).groupBy("scan_id").agg(F.count(F.lit(1)).alias("n_hosts"))
    items = L.compliance(spark, d).groupBy("scan_id").agg(F.count(F.lit(1)).alias("n_items"))
    s = L.scans(spark, d).join(hosts, "scan_id", "left").join(items, "scan_id", "left")
    return s.select("scan_id", "scan_name", "status", F.coalesce("n_hosts", F.lit(0)).alias("n_hosts"),
                    F.coalesce("n_items", F.lit(0)).alias("n_items"))


STATE_OUT_SQL = V("SELECT feed, item_id, epoch_us(seen_at) AS seen_us FROM v_state", "v_state")


@register("state_load", STATE_OUT_SQL)
def state_load(spark, d):
    """Commit the landed state as a snapshot, then load it through the reader."""
    base = work_dir(spark, "state-load")
    S.commit(L.state(spark, d), base, version=1)
    return state_out(S.load(spark, base))


LEGACY_PAGE = 1000


@register("state_migrate_legacy", V(
    "SELECT feed, item_id, CAST(1007164800000000 AS BIGINT) AS seen_us FROM v_state", "v_state"))
def state_migrate_legacy(spark, d):
    st = L.state(spark, d)
    # legacy documents: one id list per feed, landed in pages of ~LEGACY_PAGE ids
    n_pages = max(1, -(-st.count() // LEGACY_PAGE))                 # one scalar
    legacy = st.groupBy("feed", F.pmod(F.xxhash64("item_id"), F.lit(n_pages)).alias("page")).agg(
        F.collect_list("item_id").alias("processed_ids"))
    return state_out(S.migrate_legacy(legacy, NOW))


@register("state_active_keys", V(f"SELECT feed, item_id FROM v_state WHERE seen_at > {CUTOFF_SQL}", "v_state"))
def state_active_keys(spark, d):
    return S.active_keys(L.state(spark, d), NOW, RET)


# ---- 2.2 sinks --------------------------------------------------------------------------

ENV_CONST_SQL = ("'vm:vulnerability' AS sourcetype, 'vm-collector' AS source, 'security' AS event_index, "
                 "'collector' AS host, '1007164800' AS time, 'vulnerability' AS feed_type, "
                 "'Active Vulnerabilities' AS feed_name")
EVENT_SCHEMA = "vuln_key string, asset_uuid string, plugin_id bigint, port int, protocol string, severity string"


def active_wrapped(spark, d, dedup_state: bool = False) -> DataFrame:
    spec = REGISTRY["vulnerability"]
    src = vuln_source(spark, d)
    if dedup_state:
        ev = feeds.run_incremental(spec, src, L.state(spark, d), NOW, retention_days=RET)
    else:
        ev = feeds.extract(spec, src)
    return feeds.wrap(feeds.flat_vuln_event(ev), spec, NOW, feeds.VULN_EVENT_COLS)


def envelope_scalars(env: DataFrame) -> DataFrame:
    """Scalars parsed back from delivered JSON lines."""
    parsed = F.col("event") if env.schema["event"].dataType.typeName() == "struct" else F.from_json("event", EVENT_SCHEMA)
    ev = env.withColumn("ev", parsed)
    return ev.select("ev.vuln_key", "ev.plugin_id", "ev.port", "ev.protocol", "ev.severity",
                     "sourcetype", "source", F.col("index").alias("event_index"), "host", "time",
                     F.col("fields.feed_type").alias("feed_type"), F.col("fields.feed_name").alias("feed_name"))


@register("sink_outbox", V(f"""
SELECT vuln_key, plugin_id, port, protocol, severity, {ENV_CONST_SQL}
FROM v_vulns_keyed WHERE severity IN {ACTIVE_SQL}""", "v_vulns_keyed"))
def sink_outbox(spark, d):
    path = work_dir(spark, "outbox")
    sink.write_outbox(active_wrapped(spark, d), path)
    return envelope_scalars(sink.read_outbox(spark, path, EVENT_SCHEMA))


@register("sink_delivery", V(f"""
SELECT vuln_key, plugin_id, port, protocol, severity, {ENV_CONST_SQL}
FROM v_vulns_keyed WHERE severity IN {ACTIVE_SQL}""", "v_vulns_keyed"))
def sink_delivery(spark, d):
    """Envelopes posted through the delivery data source (file transport), read back
    from the delivered gzip batches; every delivery record must be a 200."""
    from ..sources import event_sink

    root = work_dir(spark, "delivery")
    event_sink.deliver(active_wrapped(spark, d), f"file:{root}/posted", f"{root}/log", run_id="q")
    failed = event_sink.read_delivery_log(spark, f"{root}/log").filter(F.col("status_code") != 200).count()
    if failed:
        raise RuntimeError(f"{failed} delivery batches failed")
    return envelope_scalars(sink.read_outbox(spark, f"{root}/posted/*.json.gz", EVENT_SCHEMA))


RECORDED_BATCHES = 1000


def recorded_delivery(spark: SparkSession, d: str):
    """Delivery as the event log recorded it: a batch (the plugins with one remainder) that has no 200 there is
    answered 503. Takes the arguments of ``event_sink.deliver`` and leaves the same tables, as Spark jobs."""
    answers = L.delivery_log(spark, d).filter("status_code = 200").select("batch_id").distinct().withColumn("ok", F.lit(True))

    def deliver(lines, transport, delivery_log, *, delivered_keys, failed_keys, retry_lines=None, **_):
        batch = F.coalesce(F.split("item_id", "_")[1].try_cast("bigint") % RECORDED_BATCHES, F.lit(0).cast("bigint"))
        told = lines.select(F.col("item_id").cast("string").alias("item_id"), "json", batch.alias("batch_id")).join(
            answers, "batch_id", "left").checkpoint()
        sent, lost = told.filter("ok"), told.filter("ok IS NULL")
        sink.write_outbox(sent, transport.removeprefix("file:"))
        sent.select("item_id").write.mode("overwrite").parquet(delivered_keys)
        lost.select("item_id").write.mode("overwrite").parquet(failed_keys)
        if retry_lines:
            lost.select(F.col("batch_id").cast("string").alias("batch_id"), "item_id", F.col("json").alias(
                "event")).write.mode("overwrite").parquet(retry_lines)
        told.groupBy("batch_id", "ok").agg(F.count(F.lit(1)).alias("event_count")).select(
            F.col("batch_id").cast("string").alias("batch_id"), F.lit(1).alias("attempt"),
            F.when(F.col("ok"), 200).otherwise(503).alias("status_code"), "event_count", F.lit(True).alias("final"),
            F.lit(float(NOW)).alias("ts")).write.mode("overwrite").json(delivery_log)
    return deliver


@register("failed_batch_resend", V(f"""
SELECT vuln_key, plugin_id, port, protocol, severity, {ENV_CONST_SQL}
FROM v_vulns_keyed WHERE severity IN {ACTIVE_SQL}""", "v_vulns_keyed"))
def failed_batch_resend(spark, d):
    """Two runs over the same landing, the first answered as the event log has it: together
    they send every event exactly once, events that share a key included."""
    from .run import run_feed

    spec, root = REGISTRY["vulnerability"], work_dir(spark, "resend")
    src = vuln_source(spark, d)
    for run_id, how in ((1, {"deliver": recorded_delivery(spark, d)}), (2, {})):
        run_feed(spark, spec, src, f"{root}/state", f"{root}/outbox", NOW, run_id, feeds.VULN_EVENT_COLS,
                 retention_days=RET, shape=feeds.flat_vuln_event, **how)
    return envelope_scalars(sink.read_outbox(spark, [f"{root}/outbox/run=1/feed={spec.feed}/*.gz",
                                                     f"{root}/outbox/run=2/feed={spec.feed}/*.gz"], EVENT_SCHEMA))


EXPORT_LINES = 100_000      # lines of an export file at most: a gzip file is read by one task


@register("landing_run", V(f"""
SELECT vuln_key, plugin_id, port, protocol, severity FROM v_vulns_keyed WHERE severity IN {ACTIVE_SQL}""",
                           "v_vulns_keyed"))
def landing_run(spark, d):
    """The JSON landing path end to end: export lines written, parsed once into the typed table, one
    feed run through sink and state, and the delivered documents read back."""
    from ..sources import readers
    from .run import run_feed

    spec, root = REGISTRY["vulnerability"], work_dir(spark, "landing")
    doc = vuln_source(spark, d).select(F.to_json(F.struct(
        "asset", "plugin", "port", "severity", "state", "is_licensed",
        F.col("last_found_epoch").cast("string").alias("last_found"))).alias("value"))
    sink.write_outbox(doc, f"{root}/vulns", "value", EXPORT_LINES)
    src = readers.land(spark, "vulns", f"{root}/vulns", f"{root}/typed", f"{root}/rejects")
    run_feed(spark, spec, src, f"{root}/state", f"{root}/outbox", NOW, 1, [], retention_days=RET, raw_col="raw")
    sent = readers.good(readers.parse_vulns(sink.read_outbox(spark, f"{root}/outbox/run=1/feed={spec.feed}/*.json.gz")
                                            .select(F.col("event").alias("value"))))
    return sent.select(spec.key().alias("vuln_key"), F.col("plugin.id").alias("plugin_id"),
                       F.col("port.port").alias("port"), F.col("port.protocol").alias("protocol"), "severity")


LANDED_RETENTION_DAYS = 3650


@register("landing_incremental", V(f"""
WITH first_run AS (
  SELECT *, 1 AS run_no FROM v_vulns_keyed
  WHERE severity IN {ACTIVE_SQL} AND epoch_us(last_found) // 1000000 <= {MARK_1998}),
second_run AS (
  SELECT *, 2 AS run_no FROM v_vulns_keyed v
  WHERE severity IN {ACTIVE_SQL} AND epoch_us(last_found) // 1000000 > {MARK_1998}
    AND NOT EXISTS (SELECT 1 FROM first_run f WHERE f.vuln_key = v.vuln_key))
SELECT vuln_key, severity, run_no FROM first_run UNION ALL SELECT vuln_key, severity, run_no FROM second_run""",
                                   "v_vulns_keyed"))
def landing_incremental(spark, d):
    """Two exports land a year apart, each followed by a feed run: the second run parses and sends what
    is new only."""
    from ..sources import landing
    from .run import run_feed

    spec, root = REGISTRY["vulnerability"], work_dir(spark, "landing-incremental")
    doc = vuln_source(spark, d).select("last_found_epoch", F.to_json(F.struct(
        "asset", "plugin", "port", "severity", "state", "is_licensed",
        F.col("last_found_epoch").cast("string").alias("last_found"))).alias("value"))
    early = F.coalesce(F.col("last_found_epoch") <= MARK_1998, F.lit(True))
    sent = []
    for run_no, now, day, part in ((1, MARK_1998, "1998-01-01", early), (2, NOW, "2001-12-01", ~early)):
        sink.write_outbox(doc.filter(part), f"{root}/vulns/ingest_date={day}", "value", EXPORT_LINES)
        src = landing.land_new(spark, "vulns", f"{root}/vulns", f"{root}/typed", f"{root}/rejects")
        run_feed(spark, spec, src, f"{root}/state", f"{root}/outbox", now, run_no, [], raw_col="raw",
                 retention_days=LANDED_RETENTION_DAYS)
        env = sink.read_outbox(spark, f"{root}/outbox/run={run_no}/feed={spec.feed}/*.gz")
        sent.append(env.select(F.col("event").alias("value"), F.lit(run_no).alias("run_no")))
    parsed = readers_good_vulns(sent[0].unionByName(sent[1]))
    return parsed.select(spec.key().alias("vuln_key"), "severity", "run_no")


def readers_good_vulns(lines: DataFrame) -> DataFrame:
    from ..sources import readers
    return readers.good(readers.parse_vulns(lines))


@register("sink_event_overrides", V("""
SELECT vuln_key,
       COALESCE(CASE WHEN state = 'FIXED' THEN 'vm:vulnerability:fixed' END, 'vm:vulnerability') AS sourcetype,
       'vm-collector' AS source,
       COALESCE(CASE WHEN severity = 'critical' THEN CAST(epoch_us(last_found) // 1000000 AS VARCHAR) END,
                '1007164800') AS time
FROM v_vulns_keyed""", "v_vulns_keyed"))
def sink_event_overrides(spark, d):
    spec = REGISTRY["vulnerability"]
    v = vuln_source(spark, d).withColumn("item_id", spec.key())
    st_override = F.when(F.col("state") == "FIXED", F.lit(REGISTRY["fixed_vulnerability"].sourcetype))
    t_override = F.when(F.col("severity") == "critical", F.col("last_found_epoch"))
    env = envelope.envelope(F.struct("item_id"), F.coalesce(st_override, F.lit(spec.sourcetype)), SOURCE, INDEX,
                            HOST, NOW, time=t_override)
    j = v.select(F.col("item_id").alias("vuln_key"), envelope.envelope_json(env).alias("json"))
    e = j.select("vuln_key", F.from_json("json", envelope.ENVELOPE_SCHEMA).alias("e"))
    return e.select("vuln_key", "e.sourcetype", "e.source", "e.time")


@register("delivery_outcome", V("""
SELECT batch_id, status_code,
       CASE WHEN status_code = 200 THEN 'delivered'
            WHEN status_code IS NULL OR status_code IN (429, 500, 502, 503, 504) THEN 'retryable'
            ELSE 'dropped' END AS outcome
FROM v_delivery_log""", "v_delivery_log"))
def delivery_outcome(spark, d):
    return sink.outcome(L.delivery_log(spark, d)).select("batch_id", "status_code", "outcome")


@register("state_commit", V(f"""
WITH {NEW_ACTIVE_SQL},
merged AS (
  SELECT feed, item_id, MAX(seen_at) AS seen_at FROM (
    SELECT feed, item_id, seen_at FROM v_state
    UNION ALL
    SELECT 'vulnerability', vuln_key, TIMESTAMP '2001-12-01 00:00:00' FROM new_active) u
  GROUP BY feed, item_id)
SELECT feed, item_id, epoch_us(seen_at) AS seen_us FROM merged WHERE seen_at > {CUTOFF_SQL}""",
                             "v_vulns_keyed", "v_state"))
def state_commit(spark, d):
    """Upsert delivered keys, apply retention, write the snapshot, read it back."""
    st = L.state(spark, d)
    new = new_active(spark, d, st).select(F.lit("vulnerability").alias("feed"), "item_id",
                                          F.timestamp_seconds(F.lit(NOW)).alias("seen_at"))
    base = work_dir(spark, "state-commit")
    S.commit(S.flush(S.upsert(st, new), NOW, RET), base, version=1, feeds=["vulnerability", "fixed_vulnerability"])
    return state_out(S.load(spark, base))


@register("state_clear", V(
    "SELECT feed, item_id, epoch_us(seen_at) AS seen_us FROM v_state WHERE feed <> 'vulnerability'", "v_state"))
def state_clear(spark, d):
    """Commit the state, clear a feed in the store, read the store back."""
    base = work_dir(spark, "state-clear")
    S.commit(L.state(spark, d), base, version=1)
    S.commit_clear(spark, base, "vulnerability")
    return state_out(S.load(spark, base))


@register("commit_delivered_only", V(f"""
WITH {NEW_ACTIVE_SQL}
SELECT DISTINCT 'vulnerability' AS feed, vuln_key AS item_id FROM new_active e
WHERE EXISTS (SELECT 1 FROM v_delivery_log dl WHERE dl.batch_id = e.ord_a % 10000 AND dl.status_code = 200)""",
                                     "v_vulns_keyed", "v_state", "v_delivery_log"))
def commit_delivered_only(spark, d):
    ev = new_active(spark, d).withColumn("batch_id", F.col("ord_a") % 10000)
    keys = sink.committed_keys(ev, L.delivery_log(spark, d), "item_id", "batch_id")
    return keys.select(F.lit("vulnerability").alias("feed"), "item_id")


# ---- 2.3 filters / projections ----------------------------------------------------------

@register("assets_live", V("SELECT id, updated_epoch FROM v_assets_n WHERE NOT COALESCE(is_deleted, false)",
                           "v_assets_n"))
def assets_live(spark, d):
    return L.assets_native(spark, d).filter(P.live_assets()).select("id", "updated_epoch")


@register("assets_agent", V("""
SELECT id, updated_epoch FROM v_assets_n
WHERE list_contains(string_split(sources_csv, ','), 'NESSUS_AGENT') AND COALESCE(has_agent, false)""",
                            "v_assets_n"))
def assets_agent(spark, d):
    return L.assets_native(spark, d).filter(P.agent_assets()).select("id", "updated_epoch")


@register("assets_terminated", V("""
SELECT id, terminated_epoch FROM v_assets_n WHERE COALESCE(is_terminated, false) AND terminated_epoch IS NOT NULL""",
                                 "v_assets_n"))
def assets_terminated(spark, d):
    return L.assets_native(spark, d).filter(P.terminated_assets("terminated_epoch")).select(
        "id", "terminated_epoch")


@register("assets_scanned", V("SELECT id FROM v_assets_n WHERE COALESCE(has_plugin_results, false)", "v_assets_n"))
def assets_scanned(spark, d):
    return L.assets_native(spark, d).filter(P.scanned_assets()).select("id")


@register("vulns_active", V(f"""
WITH {NEW_ACTIVE_SQL}
SELECT {VULN_COLS_SQL}, 'vm:vulnerability' AS sourcetype, 'vulnerability' AS feed_type,
       'Active Vulnerabilities' AS feed_name, '1007164800' AS time
FROM new_active""", "v_vulns_keyed", "v_state"))
def vulns_active(spark, d):
    """Flagship: scan -> severity -> since -> key -> anti-join live state -> envelope."""
    w = active_wrapped(spark, d, dedup_state=True)
    return w.select("vuln_key", "asset_uuid", "plugin_id", "port", "protocol", "severity",
                    F.col("env.sourcetype").alias("sourcetype"), F.col("env.fields.feed_type").alias("feed_type"),
                    F.col("env.fields.feed_name").alias("feed_name"), F.col("env.time").alias("time"))


def _feed_events(spark, d, feed: str, state=None, **kw) -> DataFrame:
    spec = REGISTRY[feed]
    st = state if state is not None else S.empty_state(spark)
    return feeds.run_incremental(spec, vuln_source(spark, d), st, NOW, retention_days=RET, **kw)


@register("vulns_info", V(f"""
SELECT vuln_key, plugin_id, severity FROM v_vulns_keyed k
WHERE severity = 'info' AND NOT EXISTS (
  SELECT 1 FROM v_state s WHERE s.feed = 'fixed_vulnerability' AND s.seen_at > {CUTOFF_SQL} AND s.item_id = k.vuln_key)""",
                          "v_vulns_keyed", "v_state"))
def vulns_info(spark, d):
    """Run with state of its own feed (the fixture's second key set under this feed's name)."""
    own = L.state(spark, d).filter(F.col("feed") == L.STATE_FEED_2).withColumn("feed", F.lit("vulnerability_no_info"))
    ev = _feed_events(spark, d, "vulnerability_no_info", own)
    return ev.select(F.col("item_id").alias("vuln_key"), F.col("plugin.id").alias("plugin_id"), "severity")


@register("vulns_agent_open", V("""
SELECT vuln_key, asset_uuid, state FROM v_vulns_keyed WHERE state = 'OPEN' AND COALESCE(asset_has_agent, false)""",
                                "v_vulns_keyed"))
def vulns_agent_open(spark, d):
    ev = _feed_events(spark, d, "vulnerability_self_scan")
    return ev.select(F.col("item_id").alias("vuln_key"), F.col("asset.uuid").alias("asset_uuid"), "state")


@register("vulns_license_option", V(f"""
SELECT vuln_key, severity, is_licensed FROM v_vulns_keyed
WHERE severity IN {ACTIVE_SQL} AND COALESCE(is_licensed, false)""", "v_vulns_keyed"))
def vulns_license_option(spark, d):
    ev = _feed_events(spark, d, "vulnerability", include_unlicensed=False)
    return ev.select(F.col("item_id").alias("vuln_key"), "severity", "is_licensed")


@register("incremental_since", V(f"""
SELECT id, updated_epoch FROM v_assets_n WHERE NOT COALESCE(is_deleted, false) AND updated_epoch > {MARK_1998}""",
                                 "v_assets_n"))
def incremental_since(spark, d):
    return feeds.extract(REGISTRY["asset"], L.assets_native(spark, d), mark=MARK_1998).select("id", "updated_epoch")


@register("scans_completed_since", V(f"""
SELECT scan_id, scan_name, modified_epoch FROM v_scans_n
WHERE status = 'completed' AND COALESCE(modified_epoch, 0) > {MARK_1999}""", "v_scans_n"))
def scans_completed_since(spark, d):
    s = scans_epoch(spark, d)
    return flatten.completed_since(s, MARK_1999).select("scan_id", "scan_name", "modified_epoch")


def scans_epoch(spark, d) -> DataFrame:
    return L.scans(spark, d).withColumn("modified_epoch", X.epoch_seconds("modified_at"))


# fixed: the feeds of the run log and their groups
RUN_LOG_FEEDS = ("click", "view", "purchase", "signup", "error")
FEED_SELECTION = ("click", "signup")


@register("feed_select", V("""
SELECT run_id, feed, feed_group, event_count FROM v_run_log WHERE feed IN ('click', 'signup')""", "v_run_log"))
def feed_select(spark, d):
    reg = {f: FeedSpec(f, "", f, f, f, i, source="events") for i, f in enumerate(RUN_LOG_FEEDS)}
    chosen = select_feeds(",".join(FEED_SELECTION), reg)
    return L.run_log(spark, d).filter(F.col("feed").isin(*chosen)).select("run_id", "feed", "feed_group",
                                                                          "event_count")


@register("event_envelope", V(f"""
SELECT vuln_key, plugin_id, port, protocol, severity, {ENV_CONST_SQL}
FROM v_vulns_keyed WHERE severity IN {ACTIVE_SQL}""", "v_vulns_keyed"))
def event_envelope(spark, d):
    w = active_wrapped(spark, d)
    parsed = w.select(F.from_json("json", envelope.ENVELOPE_SCHEMA).alias("e")).select("e.*")
    return envelope_scalars(parsed)


@register("compliance_events", V(f"""
SELECT s.scan_id, s.scan_name, h.host_id, h.hostname, c.plugin_id, c.item_no, c.result
FROM v_scans_n s JOIN v_scan_hosts h ON s.scan_id = h.scan_id
JOIN v_compliance c ON c.scan_id = h.scan_id AND c.host_id = h.host_id
WHERE s.status = 'completed' AND COALESCE(s.modified_epoch, 0) > {MARK_1999}""",
                                  "v_scans_n", "v_scan_hosts", "v_compliance"))
def compliance_events(spark, d):
    scans = flatten.completed_since(scans_epoch(spark, d), MARK_1999)
    t = flatten.compliance_tree(scans, L.scan_hosts(spark, d), L.compliance(spark, d))
    ev = t.select("scan_id", "scan_name", "host_id", "hostname",
                  F.struct("plugin_id", "item_no", "result").alias("compliance_data"))
    return ev.select("scan_id", "scan_name", "host_id", "hostname", "compliance_data.*")


@register("plugin_enriched", V("""
SELECT d.plugin_id, d.plugin_name, d.plugin_type, d.plugin_size, f.family_id, f.family_name
FROM v_family_plugins fp JOIN v_families f ON fp.family_id = f.family_id
JOIN v_plugin_details d ON d.plugin_id = fp.plugin_id""", "v_family_plugins", "v_families", "v_plugin_details"))
def plugin_enriched(spark, d):
    """The catalogue's detail documents as the plugin feed sends them, stale family fields written over."""
    doc = F.struct("plugin_id", "plugin_name", "plugin_type", "plugin_size", F.lit("stale").alias("family_name"),
                   F.lit(-1).alias("family_id"))
    details = L.plugin_details(spark, d).select("plugin_id", F.to_json(doc).alias("raw"))
    cat = flatten.plugin_catalog(L.families(spark, d), L.family_details(spark, d), details)
    sent = flatten.enriched_documents(cat).select(F.from_json("event_raw", (
        "plugin_id bigint, plugin_name string, plugin_type string, plugin_size int, family_id int, family_name string"
    )).alias("e"))
    return sent.select("e.*")


@register("event_classified", V("""
SELECT vuln_key, 'vulnerability' AS feed, 'vulnerabilities' AS feed_group, 'vulnerability' AS feed_type,
       'Active Vulnerabilities' AS feed_name, 'vm:vulnerability' AS sourcetype
FROM v_vulns_keyed WHERE severity IN ('medium', 'high', 'critical')
UNION ALL
SELECT vuln_key, 'vulnerability_no_info', 'vulnerabilities', 'vulnerability_info',
       'Informational Vulnerabilities', 'vm:vulnerability:info'
FROM v_vulns_keyed WHERE severity = 'info'
UNION ALL
SELECT vuln_key, 'vulnerability_self_scan', 'vulnerabilities', 'vulnerability_self_scan',
       'Agent-Based Vulnerabilities', 'vm:vulnerability:self_scan'
FROM v_vulns_keyed WHERE state = 'OPEN' AND COALESCE(asset_has_agent, false)""", "v_vulns_keyed"))
def event_classified(spark, d):
    specs = [REGISTRY[f] for f in ("vulnerability", "vulnerability_no_info", "vulnerability_self_scan")]
    u = feeds.extract_many(specs, vuln_source(spark, d)).select(F.col("item_id").alias("vuln_key"), "feed")
    tagged = envelope.classify(u, registry_frame(spark))
    return tagged.select("vuln_key", "feed", "feed_group", "feed_type", "feed_name", "sourcetype")


# ---- 2.4 joins ---------------------------------------------------------------------------

@register("dedup_new_only", V(f"""
SELECT vuln_key, snapshot_id, severity, state FROM v_vulns_keyed k
WHERE NOT EXISTS (SELECT 1 FROM v_state s WHERE s.feed = 'vulnerability' AND s.seen_at > {CUTOFF_SQL}
                  AND s.item_id = k.vuln_key)""", "v_vulns_keyed", "v_state"))
def dedup_new_only(spark, d):
    seen = S.active_keys(L.state(spark, d), NOW, RET, feed="vulnerability")
    return dedup.new_only(L.vulns_keyed(spark, d), seen, "vuln_key").select(
        "vuln_key", "snapshot_id", "severity", "state")


STATE_BUCKETS = 16


@register("dedup_bucketed", V(f"""
SELECT vuln_key, snapshot_id, severity, state FROM v_vulns_keyed k
WHERE NOT EXISTS (SELECT 1 FROM v_state s WHERE s.feed = 'vulnerability' AND s.seen_at > {CUTOFF_SQL}
                  AND s.item_id = k.vuln_key)""", "v_vulns_keyed", "v_state"))
def dedup_bucketed(spark, d):
    """The anti-join against a state that was committed in hash buckets: only the events are moved."""
    base = work_dir(spark, "state-bucketed")
    S.commit(L.state(spark, d), base, version=1, buckets=STATE_BUCKETS)
    seen = S.active_keys(S.load(spark, base, "vulnerability"), NOW, RET)
    return dedup.new_only(L.vulns_keyed(spark, d), seen, "vuln_key").select(
        "vuln_key", "snapshot_id", "severity", "state")


@register("assets_deleted", V("""
SELECT DISTINCT p.id AS asset_id, 'asset_deleted' AS event_type, CAST(1007164800 AS BIGINT) AS detected_at
FROM v_assets p
WHERE COALESCE(p.has_plugin_results, false) AND p.id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM v_assets c WHERE NOT COALESCE(c.is_deleted, false) AND c.id = p.id)""",
                              "v_assets"))
def assets_deleted(spark, d):
    spec = REGISTRY["deleted_asset"]
    a = L.assets_native(spark, d)
    before = a.filter(P.scanned_assets()).select(F.lit(spec.feed).alias("feed"), F.col("id").alias("item_id"),
                                                 F.timestamp_seconds(F.lit(NOW)).alias("seen_at"))
    return feeds.run_snapshot_diff(spec, a.filter(P.live_assets()), before, NOW, RET)


FIX_SQL_COLS = """vuln_key AS vulnerability_key,
       COALESCE(string_split(vuln_key, '_')[1], 'unknown') AS asset_uuid,
       COALESCE(string_split(vuln_key, '_')[2], 'unknown') AS plugin_id,
       COALESCE(string_split(vuln_key, '_')[3], '0') AS port,
       COALESCE(string_split(vuln_key, '_')[4], 'tcp') AS protocol"""


@register("vulns_fixed", V(f"""
SELECT {FIX_SQL_COLS}, 'vulnerability_fixed' AS event_type, CAST(1007164800 AS BIGINT) AS detected_at
FROM v_prev_keys p WHERE NOT EXISTS (SELECT 1 FROM v_curr_keys c WHERE c.vuln_key = p.vuln_key)""",
                           "v_prev_keys", "v_curr_keys"))
def vulns_fixed(spark, d):
    spec = REGISTRY["fixed_vulnerability"]
    before = L.prev_keys(spark, d).select(F.lit(spec.feed).alias("feed"), F.col("vuln_key").alias("item_id"),
                                          F.timestamp_seconds(F.lit(NOW)).alias("seen_at"))
    now = L.nest_vulns(L.vulns(spark, d).filter(F.col("snapshot_id") % 2 == 0))
    return feeds.run_snapshot_diff(spec, now, before, NOW, RET)


@register("plugin_catalog_flat", V("""
SELECT f.family_id, f.family_name, fp.plugin_id
FROM v_family_plugins fp JOIN v_families f ON fp.family_id = f.family_id
JOIN v_plugin_details d ON d.plugin_id = fp.plugin_id""", "v_family_plugins", "v_families", "v_plugin_details"))
def plugin_catalog_flat(spark, d):
    cat = flatten.plugin_catalog(L.families(spark, d), L.family_details(spark, d), L.plugin_details(spark, d))
    return cat.select("family_id", "family_name", "plugin_id")


@register("compliance_flat", V("""
SELECT c.scan_id, c.host_id, c.plugin_id, c.item_no
FROM v_scans s JOIN v_scan_hosts h ON s.scan_id = h.scan_id
JOIN v_compliance c ON c.scan_id = h.scan_id AND c.host_id = h.host_id
WHERE s.status = 'completed'""", "v_scans", "v_scan_hosts", "v_compliance"))
def compliance_flat(spark, d):
    scans = L.scans(spark, d).filter(F.col("status") == "completed")
    t = flatten.compliance_tree(scans, L.scan_hosts(spark, d), L.compliance(spark, d))
    return t.select("scan_id", "host_id", "plugin_id", "item_no")


# ---- 2.5 aggregations --------------------------------------------------------------------

@register("watermark_max", V(f"""
SELECT 'asset' AS feed, CAST({MARK_1998} AS BIGINT) AS old_mark,
       CAST(GREATEST({MARK_1998}, COALESCE(MAX(updated_epoch), 0)) AS BIGINT) AS new_mark
FROM v_assets_n WHERE NOT COALESCE(is_deleted, false) AND updated_epoch > {MARK_1998}""", "v_assets_n"))
def watermark_max(spark, d):
    spec = REGISTRY["asset"]
    emitted = feeds.extract(spec, L.assets_native(spark, d), mark=MARK_1998).withColumn("feed", F.lit(spec.feed))
    old = spark.createDataFrame([(spec.feed, MARK_1998)], "feed string, last_timestamp bigint")
    return watermark.data_mark(emitted, old, "updated_epoch")


# fixed: previous marks of the three vulnerability feeds (none / beyond the data / mid-range)
CLOCK_MARKS = (("vulnerability", 0), ("vulnerability_no_info", MARK_2002), ("vulnerability_self_scan", MARK_2000))


@register("watermark_clock", V(f"""
WITH ev AS (
  SELECT 'vulnerability' AS feed, COUNT(*) AS n FROM v_vulns_keyed WHERE severity IN {ACTIVE_SQL}
  UNION ALL
  SELECT 'vulnerability_no_info', COUNT(*) FROM v_vulns_keyed
  WHERE severity = 'info' AND epoch_us(last_found) // 1000000 > {MARK_2002}
  UNION ALL
  SELECT 'vulnerability_self_scan', COUNT(*) FROM v_vulns_keyed
  WHERE state = 'OPEN' AND COALESCE(asset_has_agent, false) AND epoch_us(last_found) // 1000000 > {MARK_2000}),
old AS (SELECT * FROM (VALUES ('vulnerability', 0), ('vulnerability_no_info', {MARK_2002}),
                              ('vulnerability_self_scan', {MARK_2000})) t(feed, last_timestamp))
SELECT o.feed, CAST(o.last_timestamp AS BIGINT) AS old_mark, CAST(COALESCE(e.n, 0) AS BIGINT) AS n_events,
       CAST(CASE WHEN COALESCE(e.n, 0) > 0 OR o.last_timestamp = 0 THEN 1007164800 ELSE o.last_timestamp END
            AS BIGINT) AS new_mark
FROM old o LEFT JOIN ev e ON o.feed = e.feed""", "v_vulns_keyed"))
def watermark_clock(spark, d):
    specs = [REGISTRY[f] for f, _ in CLOCK_MARKS]
    emitted = feeds.extract_many(specs, vuln_source(spark, d), marks=dict(CLOCK_MARKS)).select("feed")
    old = spark.createDataFrame(list(CLOCK_MARKS), "feed string, last_timestamp bigint")
    return watermark.clock_mark(emitted, old, NOW)


@register("watermark_scans", V(f"""
SELECT CAST(GREATEST({MARK_1999}, COALESCE(MAX(modified_epoch), 0)) AS BIGINT) AS new_mark
FROM v_scans_n WHERE status = 'completed' AND COALESCE(modified_epoch, 0) > {MARK_1999}""", "v_scans_n"))
def watermark_scans(spark, d):
    return watermark.scan_mark(flatten.completed_since(scans_epoch(spark, d), MARK_1999), MARK_1999)


@register("current_keys", V("SELECT vuln_key FROM v_curr_keys", "v_curr_keys"))
def current_keys(spark, d):
    return L.curr_keys(spark, d)


@register("events_per_feed", V("""
SELECT feed, CAST(COUNT(*) AS BIGINT) AS runs, CAST(SUM(event_count) AS BIGINT) AS events
FROM v_run_log GROUP BY feed""", "v_run_log"))
def events_per_feed(spark, d):
    return metrics.events_per_feed(L.run_log(spark, d))


@register("events_rollup", V("""
SELECT feed_group, feed, CAST(GROUPING(feed_group, feed) AS BIGINT) AS level, CAST(COUNT(*) AS BIGINT) AS runs,
       CAST(SUM(event_count) AS BIGINT) AS events
FROM v_run_log GROUP BY ROLLUP (feed_group, feed)""", "v_run_log"))
def events_rollup(spark, d):
    return metrics.events_rollup(L.run_log(spark, d))


@register("run_summary", V(f"""
SELECT CAST((SELECT COUNT(DISTINCT feed) FROM v_run_log) AS BIGINT) AS feeds,
       CAST((SELECT SUM(event_count) FROM v_run_log) AS BIGINT) AS total_events,
       CAST((SELECT COUNT(*) FROM v_error_log) AS BIGINT) AS total_errors,
       CAST((SELECT SUM(duration_s) FROM v_run_log) AS BIGINT) AS elapsed_s,
       {rnd("CAST((SELECT SUM(event_count) FROM v_run_log) AS DOUBLE) / GREATEST(CAST((SELECT SUM(duration_s) FROM v_run_log) AS DOUBLE), 0.001)", 2)} AS events_per_sec""",
                           "v_run_log", "v_error_log"))
def run_summary(spark, d):
    return metrics.run_summary(L.run_log(spark, d), L.error_log(spark, d))


@register("errors_per_feed", V("SELECT feed_no, CAST(COUNT(*) AS BIGINT) AS errors FROM v_error_log GROUP BY feed_no",
                               "v_error_log"))
def errors_per_feed(spark, d):
    return metrics.errors_per_feed(L.error_log(spark, d))


@register("delivery_metrics", V("""
SELECT CAST(COUNT(*) AS BIGINT) AS attempts,
       CAST(SUM(CASE WHEN status_code = 200 THEN event_count ELSE 0 END) AS BIGINT) AS events_sent,
       CAST(SUM(CASE WHEN status_code IS NULL OR status_code IN (429, 500, 502, 503, 504) THEN 1 ELSE 0 END)
            AS BIGINT) AS retries,
       CAST(SUM(CASE WHEN status_code IS NULL OR status_code <> 200 THEN 1 ELSE 0 END) AS BIGINT) AS errors,
       CAST(SUM(CASE WHEN status_code IS NULL OR status_code IN (429, 503) THEN 1 ELSE 0 END) AS BIGINT) AS throttles
FROM v_delivery_log""", "v_delivery_log"))
def delivery_metrics(spark, d):
    return metrics.delivery_metrics(L.delivery_log(spark, d))


@register("state_upsert", V("""
SELECT feed, item_id, epoch_us(MAX(seen_at)) AS seen_us FROM (
  SELECT feed, item_id, seen_at FROM v_state
  UNION ALL
  SELECT 'vulnerability', vuln_key, last_found FROM v_vulns_keyed WHERE severity IN ('medium', 'high', 'critical')
) u GROUP BY feed, item_id""", "v_vulns_keyed", "v_state"))
def state_upsert(spark, d):
    ev = L.vulns_keyed(spark, d).filter(P.severity_in(P.ACTIVE_SEVERITIES)).select(
        F.lit("vulnerability").alias("feed"), F.col("vuln_key").alias("item_id"), F.col("last_found").alias("seen_at"))
    return state_out(S.upsert(L.state(spark, d), ev))


# fixed: scalar marks of the two state feeds
STATE_MARKS = (("vulnerability", MARK_2000, NOW), ("fixed_vulnerability", None, NOW))


@register("state_stats", V(f"""
WITH marks AS (SELECT * FROM (VALUES ('vulnerability', {MARK_2000}, {NOW}),
                                     ('fixed_vulnerability', NULL, {NOW})) t(feed, last_timestamp, last_cleanup))
SELECT s.feed, s.total_tracked, s.active_ids, s.newest_us, CAST(m.last_timestamp AS BIGINT) AS last_timestamp,
       CAST(m.last_cleanup AS BIGINT) AS last_cleanup
FROM (SELECT feed, CAST(COUNT(*) AS BIGINT) AS total_tracked,
             CAST(SUM(CASE WHEN seen_at > {CUTOFF_SQL} THEN 1 ELSE 0 END) AS BIGINT) AS active_ids,
             epoch_us(MAX(seen_at)) AS newest_us
      FROM v_state GROUP BY feed) s LEFT JOIN marks m ON s.feed = m.feed""", "v_state"))
def state_stats(spark, d):
    marks = spark.createDataFrame(list(STATE_MARKS), "feed string, last_timestamp bigint, last_cleanup bigint")
    return S.stats(L.state(spark, d), marks, NOW, RET)


@register("state_feeds", V("SELECT DISTINCT feed FROM v_state", "v_state"))
def state_feeds(spark, d):
    return S.feeds(L.state(spark, d))


@register("feed_completion", V(f"""
SELECT r.feed, CAST(SUM(r.event_count) AS BIGINT) AS processed,
       CAST(SUM(CASE WHEN dl.status_code = 200 THEN r.event_count ELSE 0 END) AS BIGINT) AS sent,
       {rnd("CAST(SUM(r.duration_s) AS DOUBLE) / 60.0", 1)} AS minutes,
       {rnd("CASE WHEN SUM(r.duration_s) > 0 THEN CAST(SUM(r.event_count) AS DOUBLE) / SUM(r.duration_s) ELSE 0 END", 2)} AS rate
FROM v_run_log r LEFT JOIN v_delivery_log dl ON dl.batch_id = r.run_id
GROUP BY r.feed""", "v_run_log", "v_delivery_log"))
def feed_completion(spark, d):
    ok = L.delivery_log(spark, d).select(F.col("batch_id").alias("run_id"), "status_code")
    log = L.run_log(spark, d).join(ok, "run_id", "left").withColumn(
        "sent", F.when(F.col("status_code") == 200, F.col("event_count")).otherwise(0))
    return metrics.feed_completion(log, "duration_s", digits=2)


@register("state_sweep", V(f"""
SELECT feed, CAST(COUNT(*) AS BIGINT) AS active_ids
FROM v_state WHERE seen_at > {CUTOFF_SQL} GROUP BY feed""", "v_state"))
def state_sweep(spark, d):
    """Commit the state, sweep the store, count what the store then holds."""
    base = work_dir(spark, "state-sweep")
    S.commit(L.state(spark, d), base, version=1)
    return S.commit_sweep(spark, base, NOW, RET)


# ---- 2.6 windows / top-k / limits --------------------------------------------------------

TOPK = 1000


@register("state_trim_topk", V(f"""
SELECT feed, item_id, epoch_us(seen_at) AS seen_us FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY feed ORDER BY seen_at DESC, item_id) AS rk FROM v_state) t
WHERE rk <= {TOPK}""", "v_state"))
def state_trim_topk(spark, d):
    return state_out(S.trim_newest(L.state(spark, d), TOPK))


@register("state_expire", V(f"""
SELECT feed, CAST(SUM(CASE WHEN seen_at > {CUTOFF_SQL} THEN 1 ELSE 0 END) AS BIGINT) AS kept,
       CAST(SUM(CASE WHEN seen_at > {CUTOFF_SQL} THEN 0 ELSE 1 END) AS BIGINT) AS expired
FROM v_state GROUP BY feed""", "v_state"))
def state_expire(spark, d):
    st = L.state(spark, d)
    kept = S.expire(st, NOW, RET).groupBy("feed").agg(F.count(F.lit(1)).alias("kept"))
    total = st.groupBy("feed").agg(F.count(F.lit(1)).alias("_n"))
    return total.join(kept, "feed", "left").select(
        "feed", F.coalesce("kept", F.lit(0)).cast("bigint").alias("kept"),
        (F.col("_n") - F.coalesce("kept", F.lit(0))).cast("bigint").alias("expired"))


COUNT_BATCH = 10


@register("batch_by_count", V(f"""
SELECT seq, feed, CAST(rn AS BIGINT) AS pos, CAST((rn - 1) // {COUNT_BATCH} AS BIGINT) AS batch_no FROM (
  SELECT seq, feed, ROW_NUMBER() OVER (PARTITION BY feed ORDER BY seq) AS rn FROM v_payload) t""", "v_payload"))
def batch_by_count(spark, d):
    p = L.payloads(spark, d).select("seq", "feed")
    return batching.count_batches(p, ["seq"], by=["feed"], batch_size=COUNT_BATCH).select(
        "seq", "feed", "pos", "batch_no")


BYTE_COUNT_BATCH = 25
BYTE_LIMIT = 20000


@register("batch_by_bytes", V(f"""
WITH RECURSIVE numbered AS (
  SELECT seq, feed, CAST(length(payload) AS BIGINT) AS len,
         (ROW_NUMBER() OVER (PARTITION BY feed ORDER BY seq) - 1) // {BYTE_COUNT_BATCH} AS batch_no,
         ROW_NUMBER() OVER (PARTITION BY feed ORDER BY seq) AS pos
  FROM v_payload),
inb AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY feed, batch_no ORDER BY seq) AS i FROM numbered),
r AS (
  SELECT feed, batch_no, i, seq, pos, len AS cur, CAST(0 AS BIGINT) AS byte_batch FROM inb WHERE i = 1
  UNION ALL
  SELECT n.feed, n.batch_no, n.i, n.seq, n.pos,
         CASE WHEN r.cur + n.len > {BYTE_LIMIT} THEN n.len ELSE r.cur + n.len END,
         CASE WHEN r.cur + n.len > {BYTE_LIMIT} THEN r.byte_batch + 1 ELSE r.byte_batch END
  FROM r JOIN inb n ON n.feed = r.feed AND n.batch_no = r.batch_no AND n.i = r.i + 1)
SELECT seq, feed, CAST(batch_no AS BIGINT) AS batch_no, CAST(pos AS BIGINT) AS pos, byte_batch FROM r""",
                              "v_payload"))
def batch_by_bytes(spark, d):
    p = L.payloads(spark, d).select("seq", "feed", X.payload_chars("payload").alias("len"))
    b = batching.byte_batches(p, "len", ["seq"], by=["feed"], batch_size=BYTE_COUNT_BATCH, max_bytes=BYTE_LIMIT,
                              carry=["seq"])
    return b.select("seq", "feed", "batch_no", "pos", "byte_batch")


@register("state_stamp_order", V(f"""
WITH {NEW_ACTIVE_SQL}
SELECT 'vulnerability' AS feed, vuln_key AS item_id,
       CAST(1007164800000000 + ROW_NUMBER() OVER (ORDER BY ord_a, ord_b, ord_c, ord_d) - 1 AS BIGINT) AS seen_us
FROM new_active""", "v_vulns_keyed", "v_state"))
def state_stamp_order(spark, d):
    keys = new_active(spark, d).select(F.lit("vulnerability").alias("feed"), "item_id", *L.ORDER_COLS)
    return state_out(S.stamp(keys, list(L.ORDER_COLS), NOW * 1_000_000))


PROGRESS_EVERY = 1000


@register("progress_rate", V(f"""
WITH r AS (SELECT ts, ROW_NUMBER() OVER (ORDER BY ts, run_id) AS n FROM v_run_log),
t0 AS (SELECT MIN(ts) AS t0 FROM v_run_log)
SELECT CAST(n AS BIGINT) AS n, {rnd("(epoch_us(ts) - epoch_us(t0)) / 1e6", 3)} AS elapsed_s,
       {rnd("CASE WHEN (epoch_us(ts) - epoch_us(t0)) > 0 THEN n / ((epoch_us(ts) - epoch_us(t0)) / 1e6) ELSE 0 END", 2)} AS rate
FROM r, t0 WHERE n % {PROGRESS_EVERY} = 0""", "v_run_log"))
def progress_rate(spark, d):
    return metrics.progress_rows(L.run_log(spark, d), PROGRESS_EVERY)


PROGRESS_TICK_S = 3600


@register("run_progress", V(f"""
WITH t AS (
  SELECT concat('scope-', CAST(batch_id % 4 AS VARCHAR)) AS scope,
         CAST(FLOOR(epoch_us(ts) / {PROGRESS_TICK_S * 1000000}.0) AS BIGINT) AS tick,
         CAST(COALESCE(SUM(CASE WHEN status_code = 200 THEN event_count END), 0) AS BIGINT) AS events,
         CAST(SUM(CASE WHEN status_code = 200 THEN 0 ELSE 1 END) AS BIGINT) AS errors,
         MIN(epoch_us(ts)) AS t0, MAX(epoch_us(ts)) AS t1
  FROM v_delivery_log WHERE ts IS NOT NULL GROUP BY 1, 2),
r AS (
  SELECT scope, tick, events, errors, CAST(SUM(events) OVER w AS BIGINT) AS total,
         (t1 - MIN(t0) OVER w) / 1e6 AS el
  FROM t WINDOW w AS (PARTITION BY scope ORDER BY tick ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT scope, tick, events, errors, total, {rnd("el", 3)} AS elapsed_s,
       {rnd("CASE WHEN el > 0 THEN total / el ELSE 0 END", 2)} AS rate FROM r""", "v_delivery_log"))
def run_progress(spark, d):
    log = L.delivery_log(spark, d).withColumn("scope", F.concat(F.lit("scope-"), (F.col("batch_id") % 4).cast("string")))
    return metrics.delivery_progress(log, PROGRESS_TICK_S)


@register("errors_recent", V("""
SELECT error_id, feed_no, epoch_us(ts) AS ts_us FROM v_error_log ORDER BY ts DESC, error_id DESC LIMIT 10""",
                             "v_error_log"))
def errors_recent(spark, d):
    return metrics.errors_recent(L.error_log(spark, d), 10).select("error_id", "feed_no",
                                                                   X.epoch_micros("ts").alias("ts_us"))


@register("dedup_within_run", V("""
SELECT vuln_key, epoch_us(last_found) // 1000000 AS last_found_epoch, snapshot_id, severity, state FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY vuln_key ORDER BY last_found, snapshot_id, severity, state) AS rk
  FROM v_vulns_keyed) t WHERE rk = 1""", "v_vulns_keyed"))
def dedup_within_run(spark, d):
    v = L.vulns_keyed(spark, d).withColumn("last_found_epoch", X.epoch_seconds("last_found"))
    return dedup.first_per_key(v, "vuln_key", list(TIE))


EVENT_CAP = 1000


@register("limit_events", V(f"""
WITH {NEW_ACTIVE_SQL}
SELECT vuln_key, epoch_us(last_found) // 1000000 AS last_found_epoch, snapshot_id, severity, state
FROM new_active ORDER BY vuln_key, last_found, snapshot_id, severity, state LIMIT {EVENT_CAP}""",
                            "v_vulns_keyed", "v_state"))
def limit_events(spark, d):
    ev = feeds.run_incremental(REGISTRY["vulnerability"], vuln_source(spark, d), L.state(spark, d), NOW,
                               retention_days=RET, max_events=EVENT_CAP, order_cols=TIE)
    return ev.select(F.col("item_id").alias("vuln_key"), *TIE)


CAPPED_RUNS = 3


@register("capped_sequence", V(f"""
WITH firsts AS (
  SELECT vuln_key, MIN(CAST(epoch_us(last_found) // 1000000 AS BIGINT)) AS last_found_epoch
  FROM v_vulns_keyed WHERE severity IN {ACTIVE_SQL} GROUP BY vuln_key),
placed AS (SELECT *, ROW_NUMBER() OVER (ORDER BY last_found_epoch NULLS FIRST, vuln_key) AS rn FROM firsts),
cap AS (SELECT GREATEST(1, (COUNT(*) + {CAPPED_RUNS - 1}) // {CAPPED_RUNS}) AS n FROM firsts)
SELECT CAST((rn - 1) // n + 1 AS INTEGER) AS run_no, vuln_key, last_found_epoch FROM placed, cap""", "v_vulns_keyed"))
def capped_sequence(spark, d):
    """Runs under a cap of a third of all events, and one more: each goes on behind the compound mark of the one
    before, so together they send every key once, in order of (time, key), and the last one sends nothing."""
    from ..sources import paths
    from .run import run_feed

    spec, root = REGISTRY["vulnerability"], work_dir(spark, "capped")
    src = vuln_source(spark, d)
    keys = feeds.extract(spec, src).agg(F.count_distinct("item_id")).first()[0]      # one-row scalar
    cap, sent = max(1, -(-keys // CAPPED_RUNS)), []
    for run_no in range(1, CAPPED_RUNS + 2):
        run_feed(spark, spec, src, f"{root}/state", f"{root}/outbox", NOW + run_no, run_no,
                 ["item_id", "last_found_epoch"], retention_days=LANDED_RETENTION_DAYS, max_events=cap, keyset=True)
        out = f"{root}/outbox/run={run_no}/feed={spec.feed}"
        if any(n.endswith(".gz") for n in paths.names(spark, out)):
            ev = sink.read_outbox(spark, f"{out}/*.gz").select(F.lit(run_no).alias("run_no"), F.from_json(
                "event", "item_id string, last_found_epoch bigint").alias("ev"))
            sent.append(ev.select("run_no", F.col("ev.item_id").alias("vuln_key"), "ev.last_found_epoch"))
    return reduce(DataFrame.unionByName, sent) if sent else spark.createDataFrame(
        [], "run_no int, vuln_key string, last_found_epoch bigint")


# ---- 2.7 set operations ------------------------------------------------------------------

@register("set_difference", V("""
SELECT vuln_key FROM v_prev_keys EXCEPT SELECT vuln_key FROM v_curr_keys""", "v_prev_keys", "v_curr_keys"))
def set_difference(spark, d):
    return L.prev_keys(spark, d).subtract(L.curr_keys(spark, d))


@register("all_feeds_union", V(f"""
SELECT 'asset' AS feed, id AS item_id FROM v_assets WHERE NOT COALESCE(is_deleted, false)
UNION ALL
SELECT 'vulnerability', vuln_key FROM v_vulns_keyed WHERE severity IN {ACTIVE_SQL}
UNION ALL
SELECT 'plugin', CAST(fp.plugin_id AS VARCHAR) FROM v_family_plugins fp
JOIN v_families f ON fp.family_id = f.family_id JOIN v_plugin_details dd ON dd.plugin_id = fp.plugin_id""",
                               "v_assets", "v_vulns_keyed", "v_family_plugins", "v_families", "v_plugin_details"))
def all_feeds_union(spark, d):
    a = feeds.extract(REGISTRY["asset"], L.assets_native(spark, d)).select(F.lit("asset").alias("feed"), "item_id")
    v = feeds.extract(REGISTRY["vulnerability"], vuln_source(spark, d)).select(
        F.lit("vulnerability").alias("feed"), "item_id")
    cat = flatten.plugin_catalog(L.families(spark, d), L.family_details(spark, d), L.plugin_details(spark, d))
    p = feeds.extract(REGISTRY["plugin"], cat).select(F.lit("plugin").alias("feed"), "item_id")
    return a.unionByName(v).unionByName(p)


GROUP_FEEDS = ("vulnerability", "vulnerability_no_info", "vulnerability_self_scan", "fixed_vulnerability")


@register("group_run", V(f"""
WITH live AS (SELECT feed, item_id FROM v_state WHERE seen_at > {CUTOFF_SQL})
SELECT 'vulnerability' AS feed_type, vuln_key, 'vm:vulnerability' AS sourcetype FROM v_vulns_keyed k
WHERE severity IN {ACTIVE_SQL}
  AND NOT EXISTS (SELECT 1 FROM live s WHERE s.feed = 'vulnerability' AND s.item_id = k.vuln_key)
UNION ALL
SELECT 'vulnerability_info', vuln_key, 'vm:vulnerability:info' FROM v_vulns_keyed WHERE severity = 'info'
UNION ALL
SELECT 'vulnerability_self_scan', vuln_key, 'vm:vulnerability:self_scan' FROM v_vulns_keyed
WHERE state = 'OPEN' AND COALESCE(asset_has_agent, false)
UNION ALL
SELECT 'fixed_vulnerability', item_id, 'vm:vulnerability:fixed' FROM live s
WHERE feed = 'fixed_vulnerability'
  AND NOT EXISTS (SELECT 1 FROM v_vulns_keyed k WHERE k.state = 'OPEN' AND k.vuln_key = s.item_id)""",
                         "v_vulns_keyed", "v_state"))
def group_run(spark, d):
    """The four vulnerability feeds in one pass: one scan, one delivery, a state per feed; what was sent."""
    from .group import run_group

    root = work_dir(spark, "group-run")
    S.commit(L.state(spark, d), f"{root}/state", 1)
    src = vuln_source(spark, d).withColumn("doc", F.to_json(F.struct(
        X.vuln_key("asset.uuid", "plugin.id", "port.port", "port.protocol").alias("vuln_key"), "severity")))
    run_group(spark, [REGISTRY[f] for f in GROUP_FEEDS], src, f"{root}/state", f"{root}/outbox", NOW, 1, "doc",
              retention_days=RET)
    env = sink.read_outbox(spark, f"{root}/outbox/run=1/group=vulnerabilities/*.gz", "vuln_key string, vulnerability_key string")
    key = F.coalesce("event.vuln_key", "event.vulnerability_key")
    return env.select(F.col("fields.feed_type").alias("feed_type"), key.alias("vuln_key"), "sourcetype")


# ---- 2.8 scalar functions ----------------------------------------------------------------

RAW_TS_SQL = """CASE o_orderkey % 8
         WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')
         WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '.' || lpad(CAST(o_custkey % 1000 AS VARCHAR), 3, '0') || 'Z'
         WHEN 2 THEN CAST(epoch_us(o_orderdate) // 1000000 AS VARCHAR)
         WHEN 3 THEN CAST(epoch_us(o_orderdate) // 1000000 AS VARCHAR) || '.9'
         WHEN 4 THEN o_orderpriority
         WHEN 5 THEN ''
         WHEN 6 THEN NULL
         ELSE '-' || CAST(o_custkey AS VARCHAR) || '.5' END"""


@register("parse_timestamp", f"""
WITH raw AS (SELECT o_orderkey AS row_id, {RAW_TS_SQL} AS raw FROM orders)
SELECT row_id, raw,
       CAST(COALESCE(epoch_us(try_strptime(raw, ['%Y-%m-%dT%H:%M:%SZ', '%Y-%m-%dT%H:%M:%S.%fZ'])) // 1000000,
                     CAST(trunc(TRY_CAST(raw AS DOUBLE)) AS BIGINT), 0) AS BIGINT) AS epoch
FROM raw""")
def parse_timestamp(spark, d):
    o = L.table(spark, d, "orders")
    m = F.col("o_orderkey") % 8
    secs = F.unix_seconds(F.col("o_orderdate").cast("timestamp")).cast("string")
    raw = (F.when(m == 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
           .when(m == 1, F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("."),
                                  F.lpad((F.col("o_custkey") % 1000).cast("string"), 3, "0"), F.lit("Z")))
           .when(m == 2, secs)
           .when(m == 3, F.concat(secs, F.lit(".9")))
           .when(m == 4, F.col("o_orderpriority"))
           .when(m == 5, F.lit(""))
           .when(m == 6, F.lit(None).cast("string"))
           .otherwise(F.concat(F.lit("-"), F.col("o_custkey").cast("string"), F.lit(".5"))))
    r = o.select(F.col("o_orderkey").alias("row_id"), raw.alias("raw"))
    return r.select("row_id", "raw", X.parse_timestamp("raw").alias("epoch"))


@register("vuln_key", V("SELECT asset_uuid, plugin_id, port, protocol, vuln_key FROM v_vulns_keyed",
                        "v_vulns_keyed"))
def vuln_key(spark, d):
    v = L.vulns(spark, d)
    return v.select("asset_uuid", "plugin_id", "port", "protocol",
                    X.vuln_key("asset_uuid", "plugin_id", "port", "protocol").alias("vuln_key"))


@register("vuln_key_split", V("""
SELECT vuln_key, COALESCE(string_split(vuln_key, '_')[1], 'unknown') AS k_asset,
       COALESCE(string_split(vuln_key, '_')[2], 'unknown') AS k_plugin,
       COALESCE(string_split(vuln_key, '_')[3], '0') AS k_port,
       COALESCE(string_split(vuln_key, '_')[4], 'tcp') AS k_protocol,
       CAST(len(string_split(vuln_key, '_')) AS INTEGER) AS n_parts
FROM v_vulns_keyed""", "v_vulns_keyed"))
def vuln_key_split(spark, d):
    k = L.vulns_keyed(spark, d)
    parts = X.vuln_key_parts("vuln_key")
    return k.select("vuln_key", parts["asset_uuid"].alias("k_asset"), parts["plugin_id"].alias("k_plugin"),
                    parts["port"].alias("k_port"), parts["protocol"].alias("k_protocol"),
                    F.size(F.split("vuln_key", "_")).alias("n_parts"))


@register("compliance_key", V("""
SELECT scan_id, host_id, plugin_id, item_no,
       CAST(scan_id AS VARCHAR) || '_' || CAST(host_id AS VARCHAR) || '_' || COALESCE(CAST(plugin_id AS VARCHAR), 'unknown')
           AS compliance_key
FROM v_compliance""", "v_compliance"))
def compliance_key(spark, d):
    c = L.compliance(spark, d)
    return c.select("scan_id", "host_id", "plugin_id", "item_no",
                    X.compliance_key("scan_id", "host_id", "plugin_id").alias("compliance_key"))


@register("nested_default", V("""
SELECT COALESCE(asset_uuid, 'unknown') AS asset_uuid, COALESCE(port, 0) AS port,
       COALESCE(protocol, 'tcp') AS protocol FROM v_vulns""", "v_vulns"))
def nested_default(spark, d):
    n = vuln_source(spark, d)
    return n.select(X.with_default("asset.uuid", "unknown").alias("asset_uuid"),
                    X.with_default("port.port", 0).alias("port"),
                    X.with_default("port.protocol", "tcp").alias("protocol"))


@register("null_or_missing", V("""
SELECT vuln_key, CASE WHEN ord_b = 1 THEN 'no_parent' WHEN ord_b = 2 THEN 'no_parent' WHEN ord_b = 3 THEN 'missing'
                      WHEN ord_b = 4 THEN 'bad' WHEN protocol IS NULL THEN 'null' ELSE 'value' END AS presence,
       COUNT(*) AS n
FROM v_vulns_keyed GROUP BY 1, 2""", "v_vulns_keyed"))
def null_or_missing(spark, d):
    """The raw documents of all vulnerabilities, some without the port, with a null one, without a protocol or cut off."""
    full = F.to_json(F.struct("port", "severity"), {"ignoreNullFields": "false"})
    raw = (F.when(F.col("ord_b") == 1, F.to_json(F.struct("severity")))
           .when(F.col("ord_b") == 2, F.concat(F.lit('{"port":null,"severity":"'), "severity", F.lit('"}')))
           .when(F.col("ord_b") == 3, F.to_json(F.struct(F.struct(F.coalesce("port.port", F.lit(0)).alias("port")).alias("port"))))
           .when(F.col("ord_b") == 4, F.expr("substring(j, 1, length(j) - 1)")).otherwise(F.col("j")))
    docs = vuln_source(spark, d).withColumn("j", full)
    return docs.select(REGISTRY["vulnerability"].key().alias("vuln_key"), X.json_presence(raw, "port", "protocol").alias(
        "presence")).groupBy("vuln_key", "presence").agg(F.count(F.lit(1)).alias("n"))


@register("event_json", V(f"""
SELECT vuln_key, protocol, protocol IS NULL AS null_kept FROM v_vulns_keyed WHERE severity IN {ACTIVE_SQL}""",
                          "v_vulns_keyed"))
def event_json(spark, d):
    w = active_wrapped(spark, d)
    return w.select(F.get_json_object("json", "$.event.vuln_key").alias("vuln_key"),
                    F.get_json_object("json", "$.event.protocol").alias("protocol"),
                    (F.instr("json", '"protocol":null') > 0).alias("null_kept"))


@register("payload_length", V("""
SELECT seq, feed, CAST(length(payload) AS INTEGER) AS n_chars, CAST(strlen(payload) AS INTEGER) AS n_bytes
FROM v_payload""", "v_payload"))
def payload_length(spark, d):
    p = L.payloads(spark, d)
    return p.select("seq", "feed", X.payload_chars("payload").alias("n_chars"),
                    X.payload_bytes("payload").alias("n_bytes"))


@register("guarded_rate", V(f"""
SELECT run_id, {rnd("CASE WHEN duration_s > 0 THEN CAST(event_count AS DOUBLE) / duration_s ELSE 0 END", 2)} AS rate
FROM v_run_log""", "v_run_log"))
def guarded_rate(spark, d):
    return L.run_log(spark, d).select("run_id", X.guarded_rate("event_count", "duration_s", 2).alias("rate"))


SCAN_INTERVAL_H = 24


@register("scan_gate", V(f"""
SELECT feed, last_scan, {rnd(f"({NOW_EV} - last_scan) / 3600.0", 3)} AS hours_since,
       ({NOW_EV} - last_scan) / 3600.0 >= {SCAN_INTERVAL_H} AS scan_due
FROM (SELECT feed, CAST(MAX(epoch_us(ts)) // 1000000 AS BIGINT) AS last_scan FROM v_run_log GROUP BY feed) t""",
                         "v_run_log"))
def scan_gate(spark, d):
    last = L.run_log(spark, d).groupBy("feed").agg(X.epoch_seconds(F.max("ts")).alias("last_scan"))
    return last.select("feed", "last_scan", F.round(X.hours_since(NOW_EV, "last_scan"), 3).alias("hours_since"),
                       X.scan_due(NOW_EV, "last_scan", SCAN_INTERVAL_H).alias("scan_due"))


@register("throughput_status", V(f"""
SELECT CASE WHEN delay_ms <= 5.0 THEN 'FAST' WHEN delay_ms >= 500.0 THEN 'THROTTLED' ELSE 'ADAPTIVE' END AS status,
       CAST(COUNT(*) AS BIGINT) AS batches, {rnd("AVG(delay_ms)", 3)} AS avg_delay_ms
FROM v_delivery_log GROUP BY 1""", "v_delivery_log"))
def throughput_status(spark, d):
    return metrics.throughput_profile(L.delivery_log(spark, d))


# ---- 2.9 streaming -----------------------------------------------------------------------

def _stream(spark, d, with_state: bool):
    from ..streaming.runner import run_feed_available_now
    return run_feed_available_now(spark, d, with_state=with_state)


@register("stream_run_once", V(f"""
SELECT {VULN_COLS_SQL}, 'vm:vulnerability' AS sourcetype, '1007164800' AS time
FROM v_vulns_keyed WHERE severity IN {ACTIVE_SQL}""", "v_vulns_keyed"))
def stream_run_once(spark, d):
    out = _stream(spark, d, with_state=False)
    return out["events"]


@register("stream_dedup", V(f"""
WITH {NEW_ACTIVE_SQL}
SELECT {VULN_COLS_SQL}, 'vm:vulnerability' AS sourcetype, '1007164800' AS time FROM new_active""",
                            "v_vulns_keyed", "v_state"))
def stream_dedup(spark, d):
    return _stream(spark, d, with_state=True)["events"]


@register("stream_commit", V(f"""
WITH {NEW_ACTIVE_SQL},
merged AS (
  SELECT feed, item_id, MAX(seen_at) AS seen_at FROM (
    SELECT feed, item_id, seen_at FROM v_state
    UNION ALL
    SELECT 'vulnerability', vuln_key, TIMESTAMP '2001-12-01 00:00:00' FROM new_active) u
  GROUP BY feed, item_id)
SELECT feed, item_id, epoch_us(seen_at) AS seen_us FROM merged WHERE seen_at > {CUTOFF_SQL}""",
                             "v_vulns_keyed", "v_state"))
def stream_commit(spark, d):
    return state_out(_stream(spark, d, with_state=True)["state"])


@register("stream_resend", V(f"""
SELECT {VULN_COLS_SQL}, EXISTS (SELECT 1 FROM v_delivery_log dl
                                WHERE dl.batch_id = plugin_id % {RECORDED_BATCHES} AND dl.status_code = 200) AS first_try
FROM v_vulns_keyed WHERE severity IN {ACTIVE_SQL}""", "v_vulns_keyed", "v_delivery_log"))
def stream_resend(spark, d):
    """A streaming run answered as the event log has it, and a second one over the unchanged files: the
    second sends the retry table, and nothing else."""
    from ..streaming.runner import run_feed_available_now

    root = work_dir(spark, "stream-resend")
    for how in ({"deliver": recorded_delivery(spark, d)}, {}):
        run_feed_available_now(spark, d, with_state=False, root=root, **how)

    def sent(run: str, first: bool) -> DataFrame:
        env = sink.read_outbox(spark, f"{root}/outbox/run={run}/feed=vulnerability/*.gz", EVENT_SCHEMA)
        return env.select(*[F.col(f"event.{c}") for c in feeds.VULN_EVENT_COLS], F.lit(first).alias("first_try"))
    return sent("0", True).unionByName(sent("resend-*", False))


@register("snapshot_diff_sequence", V("""
SELECT 2 AS run_no, vuln_key FROM v_snap0 a WHERE NOT EXISTS (SELECT 1 FROM v_snap1 b WHERE b.vuln_key = a.vuln_key)
UNION ALL
SELECT 3 AS run_no, vuln_key FROM (SELECT vuln_key FROM v_snap0 UNION SELECT vuln_key FROM v_snap1) a
WHERE NOT EXISTS (SELECT 1 FROM v_snap2 b WHERE b.vuln_key = a.vuln_key)""", "v_snap0", "v_snap1", "v_snap2"))
def snapshot_diff_sequence(spark, d):
    snaps = [L.snapshot_keys(spark, d, i) for i in range(3)]
    return diff.diff_sequence(snaps, "vuln_key", emit="until_expiry")


@register("stream_snapshot_diff", V("""
SELECT 3 AS run_no, vuln_key FROM v_snap0 a WHERE NOT EXISTS (SELECT 1 FROM v_snap1 b WHERE b.vuln_key = a.vuln_key)""",
                                    "v_snap0", "v_snap1"))
def stream_snapshot_diff(spark, d):
    """Two snapshots land as files: the first whole, half of the second, then its rest and its manifest. Keys are
    reported as gone in the third run, when the second snapshot is complete, and not before."""
    from ..sources import paths
    from ..streaming.runner import stream_documents

    spec, root = REGISTRY["fixed_vulnerability"], work_dir(spark, "stream-snapshots")
    doc = vuln_source(spark, d).select("snapshot_id", "ord_b", F.to_json(F.struct(
        "asset", "plugin", "port", "severity", "state")).alias("value"))
    snap = {n: doc.filter(F.col("snapshot_id") % 3 == n - 1) for n in (1, 2)}
    half = F.col("ord_b") <= 3

    def put(n: int, lines: DataFrame, part: str) -> None:
        lines.select("value").write.text(f"{root}/vulns/snapshot={n}/{part}")

    def manifest(n: int) -> None:
        paths.write_text(spark, f"{root}/vulns/snapshot={n}/manifest.json", f'{{"records": {snap[n].count()}}}')

    sent = []
    for run_no, land in ((1, lambda: (put(1, snap[1], "a"), manifest(1))), (2, lambda: put(2, snap[2].filter(half), "a")),
                         (3, lambda: (put(2, snap[2].filter(~half), "b"), manifest(2)))):
        land()
        stream_documents(spark, spec, f"{root}/vulns", f"{root}/run", now=NOW + run_no, retention_days=RET)
        out = f"{root}/run/outbox/run={run_no - 1}/feed={spec.feed}"
        if any(n.endswith(".gz") for n in paths.names(spark, out)):
            sent.append(sink.read_outbox(spark, f"{out}/*.gz", "vulnerability_key string").select(
                F.lit(run_no).alias("run_no"), F.col("event.vulnerability_key").alias("vuln_key")))
    return reduce(DataFrame.unionByName, sent) if sent else spark.createDataFrame([], "run_no int, vuln_key string")


LATENESS_S = 7 * 86400


@register("incremental_late", V(f"""
SELECT id, updated_epoch FROM v_assets_n
WHERE NOT COALESCE(is_deleted, false) AND updated_epoch > {MARK_1998 - LATENESS_S}""", "v_assets_n"))
def incremental_late(spark, d):
    return feeds.extract(REGISTRY["asset"], L.assets_native(spark, d), mark=MARK_1998,
                         lateness_s=LATENESS_S).select("id", "updated_epoch")


LATE_SHARE = 0.9


@register("late_audit", V(f"""
WITH newest AS (
  SELECT vuln_key, MAX(CAST(epoch_us(last_found) // 1000000 AS BIGINT)) AS at_epoch FROM v_vulns_keyed
  WHERE severity IN {ACTIVE_SQL} GROUP BY vuln_key),
late AS (
  SELECT {MARK_1998} - at_epoch AS late_s FROM newest n WHERE at_epoch <= {MARK_1998}
    AND NOT EXISTS (SELECT 1 FROM v_state s WHERE s.feed = 'vulnerability' AND s.item_id = n.vuln_key)),
b AS (
  SELECT CASE WHEN late_s <= 0 THEN CAST(1 AS BIGINT) ELSE CAST(1 AS BIGINT) << CAST(length(bin(late_s)) AS INTEGER) END AS edge_s,
         CAST(COUNT(*) AS BIGINT) AS keys FROM late GROUP BY 1),
h AS (SELECT edge_s, keys, SUM(keys) OVER (ORDER BY edge_s) / SUM(keys) OVER () AS share FROM b)
SELECT edge_s, keys, {rnd("share", 6)} AS share,
       edge_s <= (SELECT MIN(edge_s) FROM h WHERE share >= {LATE_SHARE}) AS covered FROM h""", "v_vulns_keyed", "v_state"))
def late_audit(spark, d):
    """Keys that landed at or below a mark and are not in the state, by lateness, and the buckets that the lateness
    chosen for nine tenths of them covers."""
    spec = REGISTRY["vulnerability"]
    seen = L.state(spark, d).filter(F.col("feed") == spec.feed)
    late = lateness.undelivered(feeds.extract(spec, vuln_source(spark, d)), seen, spec.epoch_col, MARK_1998)
    hist = lateness.histogram(late).checkpoint()
    chosen = lateness.covering(hist, LATE_SHARE)
    return hist.select("edge_s", "keys", F.round("share", 6).alias("share"), (F.col("edge_s") <= F.lit(chosen)).alias("covered"))


# ---- 2.10 extension surface --------------------------------------------------------------

CUSTOM_SPEC = FeedSpec(
    feed="vulnerability_critical_licensed", group="vulnerabilities", feed_type="vulnerability_critical",
    label="Critical Licensed Vulnerabilities", sourcetype_suffix="vulnerability:critical", seq=11, source="vulns",
    predicate=lambda: (F.col("severity") == "critical") & X.truthy("is_licensed"),
    key=lambda: X.vuln_key("asset.uuid", "plugin.id", "port.port", "port.protocol"),
    epoch_col="last_found_epoch")


@register("custom_feed", V("""
SELECT vuln_key, severity, 'vm:vulnerability:critical' AS sourcetype FROM v_vulns_keyed
WHERE severity = 'critical' AND COALESCE(is_licensed, false)""", "v_vulns_keyed"))
def custom_feed(spark, d):
    from .registry import register as add_feed
    reg = add_feed(CUSTOM_SPEC)
    spec = reg[select_feeds([CUSTOM_SPEC.feed], reg)[0]]
    ev = feeds.run_incremental(spec, vuln_source(spark, d), S.empty_state(spark), NOW)
    w = feeds.wrap(ev, spec, NOW, ["item_id", "severity"])
    return w.select(F.col("item_id").alias("vuln_key"), "severity", F.col("env.sourcetype").alias("sourcetype"))

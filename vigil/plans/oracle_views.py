"""The landing-zone views as SQL text (DuckDB- and Spark-compatible).

``tpc_landing.py`` builds the same columns with the DataFrame API; the oracle
queries inline these as CTEs so both sides start from identical inputs.
"""

from __future__ import annotations

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "v_assets": ((), """
SELECT CAST(o_orderkey AS STRING) AS id,
       o_orderdate AS updated_at,
       o_orderpriority IN ('1-URGENT', '2-HIGH') AS has_agent,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'NESSUS_AGENT,NESSUS_SCAN'
            WHEN o_orderpriority = '3-MEDIUM' THEN 'NESSUS_AGENT'
            ELSE 'NESSUS_SCAN' END AS sources_csv,
       o_orderstatus = 'F' AS is_deleted,
       o_orderstatus = 'P' AS is_terminated,
       CASE WHEN o_orderstatus = 'P' AND o_custkey % 2 = 0 THEN o_orderdate END AS terminated_at,
       o_custkey % 5 <> 0 AS has_plugin_results
FROM orders"""),
    "v_assets_n": (("v_assets",), """
SELECT id, has_agent, is_deleted, is_terminated, has_plugin_results, sources_csv,
       CAST(epoch_us(updated_at) // 1000000 AS BIGINT) AS updated_epoch,
       CAST(epoch_us(terminated_at) // 1000000 AS BIGINT) AS terminated_epoch
FROM v_assets"""),
    "v_vulns": ((), """
SELECT CAST(l_orderkey AS STRING) AS asset_uuid,
       l_orderkey % 2 = 0 AS asset_has_agent,
       l_partkey AS plugin_id,
       CASE WHEN l_linenumber < 7 THEN l_linenumber END AS port,
       CASE WHEN l_returnflag = 'A' THEN NULL WHEN l_linestatus = 'O' THEN 'tcp' ELSE 'udp' END AS protocol,
       CASE WHEN l_quantity < 10 THEN 'info' WHEN l_quantity < 20 THEN 'low' WHEN l_quantity < 30 THEN 'medium'
            WHEN l_quantity < 40 THEN 'high' ELSE 'critical' END AS severity,
       CASE WHEN l_returnflag = 'R' THEN 'FIXED' ELSE 'OPEN' END AS state,
       l_suppkey % 10 <> 0 AS is_licensed,
       l_shipdate AS last_found,
       l_suppkey AS snapshot_id,
       l_orderkey AS ord_a, CAST(l_linenumber AS BIGINT) AS ord_b, l_partkey AS ord_c, l_suppkey AS ord_d
FROM lineitem"""),
    "v_vulns_keyed": (("v_vulns",), """
SELECT CONCAT(COALESCE(asset_uuid, 'unknown'), '_', COALESCE(CAST(plugin_id AS STRING), 'unknown'), '_',
              COALESCE(CAST(port AS STRING), '0'), '_', COALESCE(protocol, 'tcp')) AS vuln_key, v.*
FROM v_vulns v"""),
    "v_state": (("v_vulns_keyed",), """
SELECT 'vulnerability' AS feed, vuln_key AS item_id, MAX(last_found) AS seen_at
FROM v_vulns_keyed WHERE snapshot_id % 4 = 0 GROUP BY vuln_key
UNION ALL
SELECT 'fixed_vulnerability' AS feed, vuln_key AS item_id, MAX(last_found) AS seen_at
FROM v_vulns_keyed WHERE snapshot_id % 5 = 0 GROUP BY vuln_key"""),
    "v_prev_keys": (("v_vulns_keyed",), """
SELECT DISTINCT vuln_key FROM v_vulns_keyed WHERE state = 'OPEN' AND snapshot_id % 3 <> 0"""),
    "v_curr_keys": (("v_vulns_keyed",), """
SELECT DISTINCT vuln_key FROM v_vulns_keyed WHERE state = 'OPEN' AND snapshot_id % 2 = 0"""),
    "v_snap0": (("v_vulns_keyed",), """
SELECT DISTINCT vuln_key FROM v_vulns_keyed WHERE state = 'OPEN' AND snapshot_id % 3 = 0"""),
    "v_snap1": (("v_vulns_keyed",), """
SELECT DISTINCT vuln_key FROM v_vulns_keyed WHERE state = 'OPEN' AND snapshot_id % 3 = 1"""),
    "v_snap2": (("v_vulns_keyed",), """
SELECT DISTINCT vuln_key FROM v_vulns_keyed WHERE state = 'OPEN' AND snapshot_id % 3 = 2"""),
    "v_families": ((), """
SELECT DISTINCT CAST(SUBSTRING(p_brand, 7) AS INT) AS family_id, p_brand AS family_name FROM part"""),
    "v_family_plugins": ((), """
SELECT CAST(SUBSTRING(p_brand, 7) AS INT) AS family_id, p_partkey AS plugin_id FROM part"""),
    "v_plugin_details": ((), """
SELECT p_partkey AS plugin_id, p_name AS plugin_name, p_type AS plugin_type, p_size AS plugin_size
FROM part WHERE p_partkey % 13 <> 0"""),
    "v_scans": ((), """
SELECT o_orderkey AS scan_id, CONCAT('scan-', CAST(o_orderkey AS STRING)) AS scan_name,
       CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'P' THEN 'running' ELSE 'aborted' END AS status,
       o_orderdate AS modified_at
FROM orders"""),
    "v_scans_n": (("v_scans",), """
SELECT scan_id, scan_name, status, CAST(epoch_us(modified_at) // 1000000 AS BIGINT) AS modified_epoch
FROM v_scans"""),
    "v_scan_hosts": ((), """
SELECT DISTINCT l_orderkey AS scan_id, l_suppkey AS host_id, s_name AS hostname
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"""),
    "v_compliance": ((), """
SELECT l_orderkey AS scan_id, l_suppkey AS host_id, l_partkey AS plugin_id, l_linenumber AS item_no,
       l_returnflag AS result
FROM lineitem"""),
    "v_run_log": ((), """
SELECT event_id AS run_id, event_type AS feed,
       CASE WHEN event_type IN ('click', 'view') THEN 'assets'
            WHEN event_type IN ('purchase', 'signup') THEN 'vulnerabilities' ELSE 'plugins' END AS feed_group,
       CAST(FLOOR(value) AS BIGINT) AS event_count, user_id AS duration_s, ts
FROM events"""),
    "v_error_log": ((), """
SELECT event_id AS error_id, user_id % 10 AS feed_no, ts FROM events WHERE event_type = 'error'"""),
    "v_delivery_log": ((), """
SELECT event_id AS batch_id,
       CASE event_id % 10 WHEN 0 THEN 429 WHEN 1 THEN 503 WHEN 2 THEN 400 WHEN 3 THEN NULL ELSE 200 END
           AS status_code,
       CAST(FLOOR(value) AS BIGINT) AS event_count, value AS delay_ms, ts
FROM events"""),
    "v_payload": ((), """
SELECT doc_id AS seq, source AS feed, text AS payload, n_chars FROM documents"""),
}


def _order(names: tuple[str, ...]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in VIEWS[n][0]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the CTEs for ``names`` and their dependencies.

    ``sql`` may itself start with ``WITH``; its CTEs are appended after the views.
    """
    ctes = [f"{n} AS ({VIEWS[n][1].strip()})" for n in _order(names)]
    body = sql.strip()
    if body[:15].upper() == "WITH RECURSIVE ":
        return "WITH RECURSIVE " + ",\n".join(ctes) + ",\n" + body[15:]
    if body[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def rnd(expr: str, digits: int) -> str:
    """Half-up rounding of the shortest decimal form, as Spark's ``round`` on doubles."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38, 12)), {digits}) AS DOUBLE)"

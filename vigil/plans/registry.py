"""Declarative feed registry: one ``FeedSpec`` per feed instead of one class each.

A user adds a feed by declaring a spec (predicate, key, mark rule, mode) -- see
``custom_spec`` -- and registering it; nothing else changes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import filters as P

# ---- fixed values: the ten feeds, their groups, labels and sourcetype suffixes --------
# (feed key, group, feed_type, label, sourcetype suffix), in registration order.
FEEDS = [
    ("asset", "assets", "asset", "Asset Inventory", "asset"),
    ("asset_self_scan", "assets", "asset_self_scan", "Agent-Based Assets", "asset:self_scan"),
    ("deleted_asset", "assets", "deleted_asset", "Deleted Assets", "asset:deleted"),
    ("terminated_asset", "assets", "terminated_asset", "Terminated Assets", "asset:terminated"),
    ("vulnerability", "vulnerabilities", "vulnerability", "Active Vulnerabilities", "vulnerability"),
    ("vulnerability_no_info", "vulnerabilities", "vulnerability_info", "Informational Vulnerabilities",
     "vulnerability:info"),
    ("vulnerability_self_scan", "vulnerabilities", "vulnerability_self_scan", "Agent-Based Vulnerabilities",
     "vulnerability:self_scan"),
    ("fixed_vulnerability", "vulnerabilities", "fixed_vulnerability", "Fixed Vulnerabilities",
     "vulnerability:fixed"),
    ("plugin", "plugins", "plugin", "Plugin Metadata", "plugin"),
    ("compliance", "plugins", "compliance", "Compliance Findings", "compliance"),
]
# ---------------------------------------------------------------------------------------

# Deployment-specific naming, not part of the data contract.
SOURCETYPE_PREFIX = "vm:"
SOURCE = "vm-collector"
INDEX = "security"
HOST = "collector"


@dataclass(frozen=True)
class FeedSpec:
    feed: str
    group: str
    feed_type: str
    label: str
    sourcetype_suffix: str
    seq: int
    source: str                       # assets | vulns | plugins | compliance
    mode: str = "incremental"         # incremental | snapshot_diff | flatten
    predicate: Callable[[], Column] | None = None
    key: Callable[[], Column] | None = None
    epoch_col: str | None = None      # column compared with the high-water mark
    mark_rule: str = "clock"          # data | clock | scans | none
    honours_cap: bool = True
    transform: Callable[[DataFrame], DataFrame] | None = field(default=None, compare=False)

    @property
    def sourcetype(self) -> str:
        return SOURCETYPE_PREFIX + self.sourcetype_suffix


def _vuln_key() -> Column:
    return X.vuln_key("asset.uuid", "plugin.id", "port.port", "port.protocol")


def _id_key() -> Column:
    return F.col("id").cast("string")


_BEHAVIOUR = {
    "asset": dict(source="assets", predicate=P.live_assets, key=_id_key, epoch_col="updated_epoch",
                  mark_rule="data"),
    "asset_self_scan": dict(source="assets", predicate=P.agent_assets, key=_id_key,
                            epoch_col="updated_epoch"),
    "deleted_asset": dict(source="assets", mode="snapshot_diff", predicate=P.scanned_assets, key=_id_key,
                          mark_rule="none", honours_cap=False),
    "terminated_asset": dict(source="assets", predicate=lambda: P.terminated_assets("terminated_epoch"),
                             key=_id_key, epoch_col="updated_epoch"),
    "vulnerability": dict(source="vulns", predicate=lambda: P.severity_in(P.ACTIVE_SEVERITIES), key=_vuln_key,
                          epoch_col="last_found_epoch"),
    "vulnerability_no_info": dict(source="vulns", predicate=lambda: P.severity_in(P.INFO_SEVERITIES),
                                  key=_vuln_key, epoch_col="last_found_epoch"),
    "vulnerability_self_scan": dict(source="vulns", predicate=P.open_on_agent, key=_vuln_key,
                                    epoch_col="last_found_epoch"),
    "fixed_vulnerability": dict(source="vulns", mode="snapshot_diff",
                                predicate=lambda: F.col("state") == P.OPEN_STATE, key=_vuln_key,
                                mark_rule="none"),
    "plugin": dict(source="plugins", mode="flatten", key=lambda: F.col("plugin_id").cast("string"),
                   mark_rule="none"),
    "compliance": dict(source="compliance", mode="flatten", predicate=lambda: F.col("status") == "completed",
                       key=lambda: X.compliance_key("scan_id", "host_id", "plugin_id"), epoch_col="modified_epoch",
                       mark_rule="scans", honours_cap=False),
}

REGISTRY: dict[str, FeedSpec] = {
    f: FeedSpec(f, g, t, lab, st, i + 1, **_BEHAVIOUR[f]) for i, (f, g, t, lab, st) in enumerate(FEEDS)
}


def register(spec: FeedSpec, registry: dict[str, FeedSpec] | None = None) -> dict[str, FeedSpec]:
    reg = dict(REGISTRY if registry is None else registry)
    reg[spec.feed] = spec
    return reg


def groups(registry: dict[str, FeedSpec] | None = None) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for spec in sorted((registry or REGISTRY).values(), key=lambda s: s.seq):
        out.setdefault(spec.group, []).append(spec.feed)
    return out


def select_feeds(names: str | Iterable[str], registry: dict[str, FeedSpec] | None = None) -> list[str]:
    """``"all"`` or a subset; unknown names are rejected."""
    reg = registry or REGISTRY
    if isinstance(names, str):
        names = list(reg) if names == "all" else [n.strip() for n in names.split(",") if n.strip()]
    names = list(names)
    unknown = [n for n in names if n not in reg]
    if unknown:
        raise ValueError(f"Unknown feed type: {', '.join(unknown)}")
    return sorted(names, key=lambda n: reg[n].seq)


def registry_frame(spark: SparkSession, registry: dict[str, FeedSpec] | None = None) -> DataFrame:
    """The registry as a small DataFrame (one row per feed; bounded by construction)."""
    rows = [(s.feed, s.group, s.feed_type, s.label, s.sourcetype, s.seq)
            for s in sorted((registry or REGISTRY).values(), key=lambda s: s.seq)]
    return spark.createDataFrame(
        rows, "feed string, feed_group string, feed_type string, feed_name string, sourcetype string, seq int")

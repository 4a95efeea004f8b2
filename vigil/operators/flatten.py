"""Hierarchy flattening: family -> plugin -> detail, scan -> host -> compliance item."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X


def explode_family_details(family_details: DataFrame) -> DataFrame:
    """``family_id, plugins[]`` documents -> ``family_id, plugin_id`` rows."""
    return family_details.select("family_id", F.explode("plugins").alias("p")).select(
        "family_id", F.col("p.id").alias("plugin_id"))


def plugin_catalog(families: DataFrame, family_details: DataFrame, plugin_details: DataFrame) -> DataFrame:
    """Family x family detail x plugin detail, all inner.

    A family without a detail document and a plugin without details are dropped.
    The family columns are written onto the detail, overwriting any present.
    """
    fp = explode_family_details(family_details)
    fams = families.select("family_id", "family_name")
    detail = plugin_details.drop("family_id", "family_name")
    return fp.join(fams, "family_id").join(detail, "plugin_id")


def enriched_documents(catalog: DataFrame, raw_col: str = "raw") -> DataFrame:
    """``event_raw``: each detail document with its family written over any it names."""
    return catalog.withColumn("event_raw", X.json_overlay(raw_col, F.struct("family_name", "family_id"),
                                                          ["family_name", "family_id"]))


def enrich_detail(detail_struct_df: DataFrame, families_by_plugin: DataFrame) -> DataFrame:
    """Write ``family_name``/``family_id`` into a nested ``detail`` struct (overwrite)."""
    j = detail_struct_df.join(families_by_plugin, "plugin_id")
    return j.withColumn("detail", F.col("detail").withField("family_name", F.col("family_name"))
                        .withField("family_id", F.col("family_id"))).drop("family_name", "family_id")


def completed_since(scans: DataFrame, mark: int, modified_col: str = "modified_epoch") -> DataFrame:
    """Completed scans strictly newer than the mark; a missing date counts as 0."""
    return scans.filter((F.col("status") == "completed") & (F.coalesce(F.col(modified_col), F.lit(0)) > F.lit(mark)))


def compliance_tree(scans: DataFrame, hosts: DataFrame, items: DataFrame) -> DataFrame:
    """Scan x host x compliance item; scans without hosts and hosts without items drop out.

    The (usually selective) scan list -- completed, newer than the mark -- is
    joined to the hosts first, so the largest side, the items, is joined once to
    an already-reduced host list on ``(scan_id, host_id)``; Spark's runtime
    bloom-filter join can then prune the item scan before its shuffle.
    """
    keep = [c for c in ("scan_id", "scan_name", "status", "modified_epoch") if c in scans.columns]
    sh = hosts.join(scans.select(*keep), "scan_id")
    return items.join(sh, ["scan_id", "host_id"])

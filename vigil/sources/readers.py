"""Landing-zone readers for the export documents (one JSON document per line).

Each reader declares the schema of the fields the feeds touch and keeps the
untouched document as ``raw`` (read as text, parsed with ``from_json``), so the
delivered event is the original document, not a re-serialised struct. No schema
inference at run time. Nothing is pushed into a text scan, so ``land`` parses an
export once into a typed table whose scan does take column pruning and predicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, IntegerType, LongType, StringType, StructField,
                               StructType)

from ..functions import exprs as X

ASSET_SCHEMA = StructType([
    StructField("id", StringType()), StructField("updated_at", StringType()),
    StructField("has_agent", BooleanType()), StructField("is_deleted", BooleanType()),
    StructField("is_terminated", BooleanType()), StructField("terminated_at", StringType()),
    StructField("has_plugin_results", BooleanType()), StructField("sources", ArrayType(StringType())),
])

VULN_SCHEMA = StructType([
    StructField("asset", StructType([StructField("uuid", StringType()), StructField("hostname", StringType()),
                                     StructField("has_agent", BooleanType())])),
    StructField("plugin", StructType([StructField("id", LongType()), StructField("name", StringType())])),
    StructField("port", StructType([StructField("port", IntegerType()), StructField("protocol", StringType())])),
    StructField("severity", StringType()), StructField("severity_id", IntegerType()),
    StructField("state", StringType()), StructField("is_licensed", BooleanType()),
    StructField("last_found", StringType()),
])

FAMILY_SCHEMA = StructType([StructField("id", LongType()), StructField("name", StringType())])
FAMILY_DETAIL_SCHEMA = StructType([
    StructField("family_id", LongType()),
    StructField("plugins", ArrayType(StructType([StructField("id", LongType())]))),
])
PLUGIN_DETAIL_SCHEMA = StructType([StructField("id", LongType()), StructField("family_name", StringType()),
                                   StructField("family_id", LongType())])
SCAN_SCHEMA = StructType([StructField("id", LongType()), StructField("name", StringType()),
                          StructField("status", StringType()), StructField("last_modification_date", LongType())])
SCAN_DETAIL_SCHEMA = StructType([
    StructField("scan_id", LongType()),
    StructField("hosts", ArrayType(StructType([StructField("host_id", LongType()),
                                               StructField("hostname", StringType())]))),
])
HOST_DETAIL_SCHEMA = StructType([
    StructField("scan_id", LongType()), StructField("host_id", LongType()),
    StructField("compliance", ArrayType(StructType([StructField("plugin_id", LongType())]))),
])
LEGACY_STATE_SCHEMA = StructType([StructField("feed", StringType()),
                                  StructField("processed_ids", ArrayType(StringType())),
                                  StructField("last_timestamp", LongType())])


def parse_documents(lines: DataFrame, schema: StructType) -> DataFrame:
    """Lines (``value`` + any partition columns) -> parsed columns, ``raw`` and ``bad``.

    ``bad`` marks lines that are no JSON object (torn or foreign text); a field of an
    unexpected type is only null. Blank lines are passed by. Works on a batch read and
    on one streaming micro-batch alike.
    """
    parts = [c for c in lines.columns if c != "value"]
    flagged = StructType([*schema.fields, StructField("_corrupt", StringType())])
    # as an exploded element the parsed line is made once; a filter on it would be pushed down and parse again
    parsed = lines.filter(F.trim("value") != "").select(
        F.explode(F.array(F.from_json("value", flagged, {"columnNameOfCorruptRecord": "_corrupt"}))).alias("d"),
        F.col("value").alias("raw"), *parts)
    # only lines that the parser complains about are looked at a second time
    bad = F.when(F.col("d").isNull() | F.col("d._corrupt").isNotNull(), F.json_object_keys("raw").isNull()).otherwise(False)
    return parsed.select(*[F.col(f"d.{f.name}").alias(f.name) for f in schema.fields], "raw", bad.alias("bad"), *parts)


def good(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~F.col("bad")).drop("bad")


def rejects(parsed: DataFrame) -> DataFrame:
    """The unparseable lines, whole."""
    return parsed.filter(F.col("bad")).select("raw")


def land(spark: SparkSession, source: str, path: str, table: str, reject_path: str) -> DataFrame:
    """Parse an export once into a typed Parquet table and put its bad lines aside.

    All feeds of the export read the table: one parse per line, pruned columns, and
    predicates pushed to the scan. Partition columns of the landing zone stay columns.
    """
    PARSERS[source](spark.read.text(path)).write.mode("overwrite").option("compression", "zstd").parquet(table)
    landed = spark.read.parquet(table)
    bad = rejects(landed)
    if bad.limit(1).count():
        bad.write.mode("overwrite").parquet(reject_path)
    return good(landed)


def read_documents(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON-lines documents -> parsed columns + ``raw`` (the original line), without bad lines.

    Partition folders of the landing zone (e.g. ``ingest_date=2026-01-05``) come
    through as columns, so predicates on them prune whole folders.
    """
    return good(parse_documents(spark.read.text(path), schema))


def parse_assets(lines: DataFrame) -> DataFrame:
    a = parse_documents(lines, ASSET_SCHEMA)
    return a.withColumn("updated_epoch", X.parse_timestamp("updated_at")).withColumn(
        "terminated_epoch", F.when(F.col("terminated_at").isNotNull(), X.parse_timestamp("terminated_at")))


def parse_vulns(lines: DataFrame) -> DataFrame:
    return parse_documents(lines, VULN_SCHEMA).withColumn("last_found_epoch", X.parse_timestamp("last_found"))


def assets(spark: SparkSession, path: str) -> DataFrame:
    """Asset export with epoch columns (loose ISO / numeric timestamps)."""
    return good(parse_assets(spark.read.text(path)))


def vulns(spark: SparkSession, path: str) -> DataFrame:
    return good(parse_vulns(spark.read.text(path)))


PARSERS = {"assets": parse_assets, "vulns": parse_vulns}


def families(spark: SparkSession, path: str) -> DataFrame:
    f = read_documents(spark, path, FAMILY_SCHEMA)
    return f.select(F.col("id").alias("family_id"), X.with_default("name", "Unknown").alias("family_name"))


def family_details(spark: SparkSession, path: str) -> DataFrame:
    return read_documents(spark, path, FAMILY_DETAIL_SCHEMA).select("family_id", "plugins")


def plugin_details(spark: SparkSession, path: str) -> DataFrame:
    d = read_documents(spark, path, PLUGIN_DETAIL_SCHEMA)
    return d.select(F.col("id").alias("plugin_id"), "raw")


def scans(spark: SparkSession, path: str) -> DataFrame:
    s = read_documents(spark, path, SCAN_SCHEMA)
    return s.select(F.col("id").alias("scan_id"), X.with_default("name", "Unknown").alias("scan_name"), "status",
                    F.col("last_modification_date").alias("modified_epoch"))


def scan_hosts(spark: SparkSession, path: str) -> DataFrame:
    """Scan details -> one row per (scan, host)."""
    d = read_documents(spark, path, SCAN_DETAIL_SCHEMA)
    return d.select("scan_id", F.explode("hosts").alias("h")).select(
        "scan_id", F.col("h.host_id").alias("host_id"), X.with_default("h.hostname", "unknown").alias("hostname"))


def host_items(spark: SparkSession, path: str) -> DataFrame:
    """Host details -> one row per compliance item; the item document stays raw JSON."""
    return parse_host_items(spark.read.text(path))


def parse_host_items(lines: DataFrame) -> DataFrame:
    """Host-detail lines (batch or one micro-batch) -> one row per compliance item."""
    parsed = good(parse_documents(lines.select("value"), HOST_DETAIL_SCHEMA))
    items = parsed.select("scan_id", "host_id", F.from_json(F.get_json_object("raw", "$.compliance"), "array<string>").alias(
        "items"))
    return items.select("scan_id", "host_id", F.explode("items").alias("compliance_data")).select(
        "scan_id", "host_id", F.get_json_object("compliance_data", "$.plugin_id").cast("bigint").alias("plugin_id"),
        "compliance_data")


def legacy_state(spark: SparkSession, path: str) -> DataFrame:
    """Legacy per-feed documents with a bare ``processed_ids`` list."""
    return spark.read.schema(LEGACY_STATE_SCHEMA).json(path)

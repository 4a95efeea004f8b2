"""Event sink: gzip JSON-lines outbox, delivery outcome routing, delivered-only commit.

The outbox is the durable hand-off to the transport; a batch folder is keyed by
its batch id and overwritten on retry, so re-running a batch is idempotent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import exprs as X
from .envelope import ENVELOPE_SCHEMA


def write_outbox(envelopes_json: DataFrame, path: str, json_col: str = "json",
                 max_records_per_file: int = 1_000_000) -> None:
    """One JSON document per line, gzip-compressed; each task starts a new file after
    ``max_records_per_file`` lines, since a gzip file can't be split by its readers."""
    (envelopes_json.select(F.col(json_col).alias("value"))
     .write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", str(max_records_per_file))
     .text(path))


def read_outbox(spark: SparkSession, path: str | Sequence[str], event_schema: StructType | str | None = None) -> DataFrame:
    """Read delivered lines back; ``event`` stays raw JSON unless a schema is given, then one parse reads both.

    A pattern for file names is left to the reader of their folder: as a path it would name every batch, and
    each would be listed on its own.
    """
    paths = [path] if isinstance(path, str) else list(path)
    found = {p.rpartition("/")[2] for p in paths}
    reader = spark.read
    if len(found) == 1 and "*" in min(found):
        reader, paths = reader.option("pathGlobFilter", min(found)), [p.rpartition("/")[0] for p in paths]
    schema = ENVELOPE_SCHEMA
    if event_schema is not None:
        event = StructType.fromDDL(event_schema) if isinstance(event_schema, str) else event_schema
        schema = StructType([StructField("event", event) if f.name == "event" else f for f in schema])
    # as an exploded element the parsed line is made once, whatever reads its fields
    return reader.text(paths).select(F.explode(F.array(F.from_json("value", schema))).alias("e"), "value").select(
        "e.*", "value")


def outcome(delivery_log: DataFrame) -> DataFrame:
    return delivery_log.withColumn("outcome", X.delivery_outcome("status_code"))


def delivered_batches(delivery_log: DataFrame) -> DataFrame:
    """Batch ids with a successful attempt (any attempt)."""
    return delivery_log.filter(F.col("status_code") == 200).select("batch_id").distinct()


def committed_keys(events: DataFrame, delivery_log: DataFrame, key_col: str = "item_id",
                   batch_col: str = "batch_id") -> DataFrame:
    """Keys of events whose batch was delivered; outcome joined by batch id, never by position."""
    ok = delivered_batches(delivery_log).withColumnRenamed("batch_id", batch_col)
    return events.join(ok, batch_col, "left_semi").select(key_col).filter(F.col(key_col).isNotNull()).distinct()

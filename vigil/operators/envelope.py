"""Event envelope: the document plus sink metadata and feed classification tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import exprs as X

ENVELOPE_SCHEMA = StructType([
    StructField("event", StringType(), True),
    StructField("sourcetype", StringType(), True),
    StructField("source", StringType(), True),
    StructField("index", StringType(), True),
    StructField("fields", StructType([StructField("feed_type", StringType(), True),
                                      StructField("feed_name", StringType(), True)]), True),
    StructField("host", StringType(), True),
    StructField("time", StringType(), True),
])


def envelope(event: Column, sourcetype: Column, source: str | Column, index: str, host: str, now: int,
             feed_type: Column | None = None, feed_name: Column | None = None,
             time: Column | None = None) -> Column:
    """The delivered document as a struct (``fields`` only when the feed is tagged).

    ``time`` overrides the clock per row when given and non-null; ``sourcetype`` and
    ``source`` may be per-row columns (e.g. ``coalesce(override, lit(default))``).
    """
    src = source if isinstance(source, Column) else F.lit(source)
    parts = [event.alias("event"), sourcetype.alias("sourcetype"), src.alias("source"),
             F.lit(index).alias("index")]
    if feed_type is not None:
        parts.append(F.struct(feed_type.alias("feed_type"),
                              F.coalesce(feed_name, F.lit("")).alias("feed_name")).alias("fields"))
    parts += [F.lit(host).alias("host"),
              (F.coalesce(time.cast("string"), X.epoch_string(now)) if time is not None
               else X.epoch_string(now)).alias("time")]
    return F.struct(*parts)


def envelope_json(env: Column) -> Column:
    return X.to_json_keep_nulls(env)


def envelope_json_raw(raw: Column, env: Column) -> Column:
    """Envelope JSON with the original document spliced in as ``event``.

    The landed document is passed through byte for byte (key order, numbers and
    unknown fields intact) instead of being re-serialised from parsed columns;
    the rest of the envelope is rendered by ``to_json`` and appended.
    """
    rest = X.to_json_keep_nulls(env.dropFields("event"))
    return F.concat(F.lit('{"event":'), raw, F.lit(","), F.substring(rest, 2, 1 << 30))


def classify(events: DataFrame, registry: DataFrame, feed_col: str = "feed") -> DataFrame:
    """Tag events with their feed's labels via a broadcast join to the static registry.

    The registry is a fixed list of feeds (bounded by construction), so the
    broadcast hint is safe at any data size.
    """
    return events.join(F.broadcast(registry), feed_col, "left")

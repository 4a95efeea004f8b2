"""Scalar column builders (all JVM-side built-ins, no Python UDF).

Every builder takes and returns ``Column`` so it composes inside one
whole-stage-codegen span. ``now`` is always injected by the caller (an int
epoch second), never read from the clock inside a query.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType, StringType, TimestampNTZType, TimestampType

# ---- fixed values (must equal the reference for identical results) --------------
# Vulnerability key defaults, in key order: asset uuid, plugin id, port, protocol.
VULN_KEY_DEFAULTS = ("unknown", "unknown", "0", "tcp")
# Compliance key default for a missing part.
COMPLIANCE_KEY_DEFAULT = "unknown"
# Delivery status codes that are retried.
RETRYABLE_STATUS = (429, 500, 502, 503, 504)
# Status codes counted as throttling (a missing status = timeout also counts).
THROTTLE_STATUS = (429, 503)
# Adaptive send delay: starting delay 5 ms, ceiling 1 s; THROTTLED from half the ceiling.
INITIAL_DELAY_MS = 5.0
MAX_DELAY_MS = 1000.0
# ISO-8601 layout accepted by the timestamp parser: 1-6 fraction digits, literal Z.
ISO_Z_PATTERN = "yyyy-M-d'T'H:m:s[.SSSSSS]'Z'"
# -----------------------------------------------------------------------------------

SECONDS_PER_DAY = 86400


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c: Column | str) -> Column:
    """Loose timestamp -> epoch seconds (BIGINT), 0 when unparseable.

    ISO ``...Z`` with or without 1-6 fraction digits; otherwise a numeric string,
    truncated toward zero; null, empty and junk give 0.
    """
    c = _c(c)
    iso = F.unix_seconds(F.try_to_timestamp(c, F.lit(ISO_Z_PATTERN)))
    numeric = c.try_cast("double").try_cast("bigint")
    return F.coalesce(iso, numeric, F.lit(0).cast("bigint"))


def epoch_seconds(c: Column | str, dtype: DataType | None = None) -> Column:
    """Epoch seconds of a timestamp, numeric or loose string column."""
    c = _c(c)
    if dtype is None or isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.unix_seconds(c.cast("timestamp"))
    if isinstance(dtype, StringType):
        return parse_timestamp(c)
    if isinstance(dtype, NumericType):
        return F.coalesce(c.try_cast("bigint"), F.lit(0).cast("bigint"))
    raise TypeError(f"cannot take epoch seconds of {dtype}")


def epoch_micros(c: Column | str) -> Column:
    return F.unix_micros(_c(c).cast("timestamp"))


def vuln_key(uuid: Column | str, plugin_id: Column | str, port: Column | str,
             protocol: Column | str) -> Column:
    """``uuid_plugin_port_protocol`` with per-part defaults.

    ``concat_ws`` skips nulls, so every part is coalesced first.
    """
    d = VULN_KEY_DEFAULTS
    parts = [
        F.coalesce(_c(uuid).cast("string"), F.lit(d[0])),
        F.coalesce(_c(plugin_id).cast("string"), F.lit(d[1])),
        F.coalesce(_c(port).cast("string"), F.lit(d[2])),
        F.coalesce(_c(protocol).cast("string"), F.lit(d[3])),
    ]
    return F.concat_ws("_", *parts)


def split_key_part(key: Column | str, index: int, default: str) -> Column:
    """Part ``index`` (0-based) of an ``_``-joined key, ``default`` when absent."""
    return F.coalesce(F.get(F.split(_c(key), "_"), F.lit(index)), F.lit(default))


def vuln_key_parts(key: Column | str) -> dict[str, Column]:
    names = ("asset_uuid", "plugin_id", "port", "protocol")
    return {n: split_key_part(key, i, d) for i, (n, d) in enumerate(zip(names, VULN_KEY_DEFAULTS))}


def compliance_key(scan_id: Column | str, host_id: Column | str, plugin_id: Column | str) -> Column:
    d = COMPLIANCE_KEY_DEFAULT
    return F.concat_ws(
        "_",
        F.coalesce(_c(scan_id).cast("string"), F.lit(d)),
        F.coalesce(_c(host_id).cast("string"), F.lit(d)),
        F.coalesce(_c(plugin_id).cast("string"), F.lit(d)),
    )


def with_default(c: Column | str, default) -> Column:
    """``d.get(name, default)``: a missing or null nested field gives the default."""
    return F.coalesce(_c(c), F.lit(default))


def json_presence(raw: Column | str, *path: str) -> Column:
    """What a JSON document holds at ``path``: ``value``, ``null`` (written out), ``missing`` (the last
    name is not there), ``no_parent`` (an object above it is missing, null or no object) or ``bad`` (no JSON).

    An empty text and a null are ``bad``. Of a repeated name the parser takes none: ``bad`` as well.
    """
    doc = F.try_parse_json(_c(raw))

    def at(names):
        return doc if not names else F.try_variant_get(doc, "$" + "".join(f"['{n}']" for n in names), "variant")

    kind = F.schema_of_variant(at(path[:-1]))
    own = at(path)
    return (F.when(doc.isNull(), F.lit("bad"))
            .when(~F.coalesce(F.startswith(kind, F.lit("OBJECT")), F.lit(False)), F.lit("no_parent"))
            .when(own.isNull(), F.lit("missing"))
            .when(F.is_variant_null(own), F.lit("null"))
            .otherwise(F.lit("value")))


def to_json_keep_nulls(c: Column | str) -> Column:
    """Compact JSON that keeps null fields (the default writer drops them)."""
    return F.to_json(_c(c), {"ignoreNullFields": "false"})


def json_with_raw(base: Column, field: str, raw: Column | str) -> Column:
    """``base`` (a non-empty struct) as JSON with one more field holding a raw JSON document."""
    text = to_json_keep_nulls(base)
    return F.concat(text.substr(F.lit(1), F.length(text) - F.lit(1)), F.lit(f',"{field}":'), _c(raw), F.lit("}"))


def json_overlay(raw: Column | str, extra: Column, names: list[str]) -> Column:
    """A raw JSON object with the fields ``names`` of struct ``extra`` written over its own.

    A document without those names is kept byte for byte and ``extra`` is appended. Otherwise its
    other members are written out again beside ``extra``, so that no name occurs twice.
    """
    raw, text = _c(raw), to_json_keep_nulls(extra)
    own = F.json_object_keys(raw)
    keys = F.array_distinct(F.filter(own, lambda k: ~k.isin(*names)))
    plain = ~F.arrays_overlap(own, F.array(*[F.lit(n) for n in names])) & (F.size(own) > 0)
    spliced = F.concat(F.rtrim(raw).substr(F.lit(1), F.length(F.rtrim(raw)) - F.lit(1)), F.lit(","),
                       text.substr(F.lit(2), F.length(text)))
    typed = F.from_json(raw, "map<string,variant>")
    kept = F.transform(keys, lambda k: F.concat(F.to_json(F.array(k)).substr(F.lit(2), F.length(F.to_json(F.array(k))) - 2),
                                                F.lit(":"), F.to_json(F.element_at(typed, k))))
    rebuilt = F.concat(F.lit("{"), F.array_join(kept, ","), F.when(F.size(keys) > 0, F.lit(",")).otherwise(F.lit("")),
                       text.substr(F.lit(2), F.length(text)))
    return F.when(plain, spliced).otherwise(rebuilt)


def payload_chars(c: Column | str) -> Column:
    return F.length(_c(c))


def payload_bytes(c: Column | str) -> Column:
    return F.octet_length(_c(c))


def epoch_string(now: int) -> Column:
    """The envelope clock: epoch seconds as a string, injected."""
    return F.lit(str(int(now)))


def retention_cutoff(now: int, days: int) -> int:
    return int(now) - int(days) * SECONDS_PER_DAY


def guarded_rate(count: Column | str, elapsed: Column | str, digits: int | None = None) -> Column:
    """``count / elapsed`` when elapsed > 0, else 0 (ANSI ``/0`` would throw)."""
    count, elapsed = _c(count), _c(elapsed)
    rate = F.when(elapsed > 0, count.cast("double") / elapsed).otherwise(F.lit(0.0))
    return F.round(rate, digits) if digits is not None else rate


def floored_rate(count: Column | str, elapsed: Column | str, digits: int = 2) -> Column:
    """``round(count / max(elapsed, 0.001), digits)`` as in the run summary."""
    return F.round(_c(count).cast("double") / F.greatest(_c(elapsed).cast("double"), F.lit(0.001)),
                   digits)


def hours_since(now: int, last_epoch: Column | str) -> Column:
    return (F.lit(int(now)) - _c(last_epoch)).cast("double") / F.lit(3600.0)


def scan_due(now: int, last_epoch: Column | str, interval_hours: float) -> Column:
    """True when a full scan should run: never scanned, or interval elapsed."""
    last = F.coalesce(_c(last_epoch), F.lit(0))
    return (last <= 0) | (hours_since(now, last) >= F.lit(float(interval_hours)))


def throughput_status(delay_ms: Column | str, initial_ms: float = INITIAL_DELAY_MS,
                      max_ms: float = MAX_DELAY_MS) -> Column:
    d = _c(delay_ms)
    return (F.when(d <= F.lit(initial_ms), F.lit("FAST"))
            .when(d >= F.lit(max_ms * 0.5), F.lit("THROTTLED"))
            .otherwise(F.lit("ADAPTIVE")))


def delivery_outcome(status_code: Column | str) -> Column:
    """200 delivered; retryable codes and a missing code (timeout) retried; else dropped."""
    s = _c(status_code)
    return (F.when(s == 200, F.lit("delivered"))
            .when(s.isNull() | s.isin(*RETRYABLE_STATUS), F.lit("retryable"))
            .otherwise(F.lit("dropped")))


def is_throttle(status_code: Column | str) -> Column:
    s = _c(status_code)
    return s.isNull() | s.isin(*THROTTLE_STATUS)


def truthy(c: Column | str) -> Column:
    """Python truthiness of a boolean field: null counts as false."""
    return F.coalesce(_c(c).cast("boolean"), F.lit(False))

"""Event delivery as a Python data source (``df.write.format("vigil_events")``).

Each task packs its own partition into delivery batches -- at most
``batch_size`` events and ``max_bytes`` of newline-joined JSON (an event longer
than the limit travels alone) -- gzips each batch and hands it to an injected
transport. Batch boundaries are partition-local (no global numbering, no
funnel); the size limits are the contract. ``deliver`` clusters events by key and
sorts them, so events of one key share a batch where they fit, and a retried task
posts the same events under the same ids ``<run>-<partition>-<n>``.

Each task writes beside the data: a log row per attempt, the keys of delivered and of
undelivered batches, the lines of undelivered batches (the retry table of streams), and the
lines of batches that the receiver refused for good (dead letters). The driver sees per-task
summaries only; on commit it removes what attempts that did not win have left.

Transports (option ``transport``):
  ``file:<dir>``  write each batch to ``<dir>/<batch_id>.json.gz`` (tests, hand-off folders)
  ``python:<module>:<class>:<argument>``  a client of one's own: ``class(argument)`` with
  ``post(batch_id, gz_bytes, n_events) -> status``, importable on the executors
"""

from __future__ import annotations

import gzip
import importlib
import json
import os
import time
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..functions.exprs import RETRYABLE_STATUS
from ..session import shuffles_dropped
from .paths import require_shared

# ---- fixed values: reference defaults ------------------------------------------------
GZIP_LEVEL = 6
DEFAULT_MAX_RETRIES = 3
# ---------------------------------------------------------------------------------------

KEY_FLUSH_ROWS = 262144     # delivered keys buffered per task before a parquet row group is written


def resolve(uri: str):
    """``(filesystem, path)`` for a local path or any URI pyarrow understands."""
    from pyarrow import fs

    if "://" in uri or uri.startswith("file:"):
        if uri.startswith("file:") and not uri.startswith("file://"):
            uri = "file://" + uri[len("file:"):]
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), os.path.abspath(uri)


class FileTransport:
    """Hand-off folder transport: one gzip file per batch, written then renamed."""

    def __init__(self, target: str):
        self.fs, self.dir = resolve(target)
        self.fs.create_dir(self.dir, recursive=True)

    def post(self, batch_id: str, payload: bytes, n_events: int) -> int:
        tmp, final = f"{self.dir}/.{batch_id}.tmp", f"{self.dir}/{batch_id}.json.gz"
        with self.fs.open_output_stream(tmp) as f:
            f.write(payload)
        self.fs.move(tmp, final)
        return 200


def make_transport(spec: str):
    if spec.startswith("file:"):
        return FileTransport(spec[len("file:"):] if not spec.startswith("file://") else spec)
    if spec.startswith("python:"):
        _, module, name, argument = spec.split(":", 3)
        return getattr(importlib.import_module(module), name)(argument)
    raise ValueError(f"unsupported transport {spec!r}")


def greedy_batches(lengths, batch_size: int, max_bytes: int, keys=None) -> list[tuple[int, int]]:
    """``[start, end)`` slices: close a batch at ``batch_size`` events or when adding
    the next event would pass ``max_bytes`` (newline separators counted).

    With ``keys`` (sorted), a run of one key that fits a batch is not cut: the batch
    before it is closed instead.
    """
    import numpy as np

    n = len(lengths)
    upto = np.zeros(n + 1, np.int64)
    np.cumsum(np.asarray(lengths, np.int64) + 1, out=upto[1:])      # lines [a, b) take upto[b] - upto[a] - 1 bytes
    # where a group ends; a group is an event, or all events of a key
    ends = np.arange(1, n + 1) if keys is None else _run_ends(keys)
    ends_upto = upto[ends]
    out, start, g = [], 0, 0
    while g < len(ends):
        fit = min(int(np.searchsorted(ends, start + batch_size, "right")),
                  int(np.searchsorted(ends_upto, upto[start] + max_bytes + 1, "right")))
        g = max(g, fit)         # these groups share the batch that began at start
        if g == len(ends):
            break
        at, end = (int(ends[g - 1]) if g else 0), int(ends[g])
        if end - at <= batch_size and upto[end] - upto[at] - 1 <= max_bytes:
            out.append((start, at))
            start = at
            continue
        for i in range(at, end):
            if i > start and (i - start >= batch_size or upto[i + 1] - upto[start] - 1 > max_bytes):
                out.append((start, i))
                start = i
        g += 1
    if start < n:
        out.append((start, n))
    return out


def _run_ends(keys):
    """Ends of the runs of equal keys (a list, or an Arrow column); nulls are equal to each other."""
    import numpy as np
    import pyarrow.compute as pc

    if isinstance(keys, list):
        return np.array([i for i in range(1, len(keys) + 1) if i == len(keys) or keys[i] != keys[i - 1]], np.int64)
    if not len(keys):
        return np.zeros(0, np.int64)
    a, b = keys.slice(1), keys.slice(0, len(keys) - 1)
    differ = pc.coalesce(pc.not_equal(a, b), pc.xor(pc.is_null(a), pc.is_null(b)))
    return np.append(np.flatnonzero(differ.to_numpy(zero_copy_only=False)) + 1, len(keys))


@dataclass
class TaskSummary(WriterCommitMessage):
    partition: int
    batches: int
    events: int
    failed_batches: int
    files: tuple[str, ...]          # what this attempt wrote beside the data


class EventBatchWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.batch_size = int(options.get("batch_size", 5000))
        self.max_bytes = int(options.get("max_bytes", 1048576))
        self.transport_spec = options["transport"]
        self.log_dir = options.get("delivery_log")
        self.run_id = options.get("run_id", "0")
        self.column = options.get("column", "value")
        self.max_retries = int(options.get("max_retries", DEFAULT_MAX_RETRIES))
        self.backoff_s = float(options.get("backoff_s", 0.0))
        # optional: a key column whose values are recorded for delivered batches only
        self.key_column = options.get("key_column")
        self.delivered_keys = options.get("delivered_keys")
        self.failed_keys = options.get("failed_keys")
        self.retry_lines = options.get("retry_lines")
        self.dead_letters = options.get("dead_letters")
        self.key_flush_rows = int(options.get("key_flush_rows", KEY_FLUSH_ROWS))

    def _post(self, transport, batch_id: str, payload: bytes, n: int, size: int) -> tuple[int | None, list[dict]]:
        """Final status and a log row per attempt (``delay_ms``: the wait before it)."""
        status, rows, delay = None, [], 0.0
        for attempt in range(1, self.max_retries + 2):
            if delay:
                time.sleep(delay)
            try:
                status = transport.post(batch_id, payload, n)
            except (TimeoutError, ConnectionError):
                status = None
            final = status == 200 or (status is not None and status not in RETRYABLE_STATUS) or (
                attempt == self.max_retries + 1)
            rows.append({"batch_id": batch_id, "attempt": attempt, "status_code": status, "event_count": n,
                         "bytes": size, "delay_ms": delay * 1000.0, "final": final, "ts": time.time()})
            if final:
                break
            delay = self.backoff_s * (2 ** (attempt - 1))
        return status, rows

    def write(self, iterator):
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq
        from pyspark import TaskContext

        ctx = TaskContext.get()
        pid, attempt = (ctx.partitionId(), ctx.attemptNumber()) if ctx else (0, 0)
        transport = make_transport(self.transport_spec)
        records, seq, events, failed = [], 0, 0, 0
        writers: dict[str, tuple] = {}      # folder -> (parquet writer, file), opened on first use
        held: dict[str, list] = {}
        held_rows: dict[str, int] = {}

        def keep(folder: str | None, table, force: bool = False):
            """Buffer rows for a side table and write a row group once enough have come (bounded memory)."""
            if not folder:
                return
            if table is not None:
                held.setdefault(folder, []).append(table)
                held_rows[folder] = held_rows.get(folder, 0) + len(table)
            if held.get(folder) and (force or held_rows[folder] >= self.key_flush_rows):
                rows = pa.concat_tables(held.pop(folder))
                held_rows[folder] = 0
                if folder not in writers:
                    fs, path = resolve(folder)
                    fs.create_dir(path, recursive=True)
                    name = f"part-{self.run_id}-{pid:05d}-a{attempt}.parquet"
                    writers[folder] = (pq.ParquetWriter(f"{path}/{name}", rows.schema, filesystem=fs, compression="zstd"),
                                       f"{folder}/{name}")
                writers[folder][0].write_table(rows)

        def flush_slices(values, keys, final: bool):
            nonlocal seq, events, failed
            lengths = pc.binary_length(pc.cast(values, pa.binary())).to_numpy(zero_copy_only=False)
            slices = greedy_batches(lengths, self.batch_size, self.max_bytes, keys)
            if not final and slices:
                keep_from = slices[-1][0]          # last batch may still grow: carry it over
                slices = slices[:-1]
            else:
                keep_from = len(values)
            for a, b in slices:
                lines = values.slice(a, b - a)
                joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), lines), "\n")
                body = joined[0].as_buffer().to_pybytes()
                payload = gzip.compress(body, compresslevel=GZIP_LEVEL, mtime=0)
                batch_id = f"{self.run_id}-{pid}-{seq}"
                status, rows = self._post(transport, batch_id, payload, b - a, len(body))
                records.extend(rows)
                events += b - a
                failed += status != 200
                own = keys.slice(a, b - a) if keys is not None else pa.nulls(b - a, pa.string())
                refused = status is not None and status != 200 and status not in RETRYABLE_STATUS
                if status == 200 or refused:
                    # a refused event is settled too: it is kept as a dead letter, not sent again
                    if keys is not None:
                        keep(self.delivered_keys, pa.table({"item_id": own}))
                    if refused:
                        keep(self.dead_letters, pa.table({
                            "batch_id": pa.array([batch_id] * (b - a)), "item_id": own, "event": lines,
                            "status_code": pa.array([status] * (b - a), pa.int32())}))
                else:
                    if keys is not None:
                        keep(self.failed_keys, pa.table({"item_id": own}))
                    keep(self.retry_lines, pa.table({
                        "batch_id": pa.array([batch_id] * (b - a)), "item_id": own, "event": lines}))
                seq += 1
            return values.slice(keep_from), (keys.slice(keep_from) if keys is not None else None)

        carry, carry_keys = None, None
        for rb in iterator:
            col = pc.cast(rb.column(rb.schema.get_field_index(self.column)), pa.string())
            valid = pc.is_valid(col)
            col = col.filter(valid)
            keys = None
            if self.key_column:
                keys = pc.cast(rb.column(rb.schema.get_field_index(self.key_column)), pa.string()).filter(valid)
            if carry is not None and len(carry):
                col = pa.concat_arrays([carry, col])
                keys = pa.concat_arrays([carry_keys, keys]) if keys is not None else None
            carry, carry_keys = flush_slices(col, keys, final=False)
        if carry is not None and len(carry):
            flush_slices(carry, carry_keys, final=True)

        for folder in (self.delivered_keys, self.failed_keys, self.retry_lines, self.dead_letters):
            keep(folder, None, force=True)
        files = []
        for writer, path in writers.values():
            writer.close()
            files.append(path)
        if self.log_dir and records:
            lfs, ldir = resolve(self.log_dir)
            lfs.create_dir(ldir, recursive=True)
            name = f"part-{self.run_id}-{pid:05d}-a{attempt}.json"
            with lfs.open_output_stream(f"{ldir}/{name}") as f:
                f.write("".join(json.dumps(r) + "\n" for r in records).encode("utf-8"))
            files.append(f"{self.log_dir}/{name}")
        return TaskSummary(pid, seq, events, failed, tuple(files))

    def _clean(self, keep: set[str]) -> None:
        """Remove side files of this run's attempts other than those in ``keep``."""
        for folder in (self.delivered_keys, self.failed_keys, self.retry_lines, self.dead_letters, self.log_dir):
            if not folder:
                continue
            from pyarrow import fs as pafs

            fs, path = resolve(folder)
            for info in fs.get_file_info(pafs.FileSelector(path, allow_not_found=True)):
                name = info.path.rsplit("/", 1)[-1]
                if name.startswith(f"part-{self.run_id}-") and f"{folder}/{name}" not in keep:
                    fs.delete_file(info.path)

    def commit(self, messages):
        done = [m for m in messages if m is not None]
        self._clean({f for m in done for f in m.files})

    def abort(self, messages):
        self._clean(set())


class EventSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "vigil_events"

    def writer(self, schema, overwrite: bool):
        return EventBatchWriter(self.options)


def register(spark) -> None:
    spark.dataSource.register(EventSink)


def deliver(json_lines, transport: str, delivery_log: str, run_id: str = "0", batch_size: int = 5000,
            max_bytes: int = 1048576, column: str = "json", key_column: str | None = None,
            delivered_keys: str | None = None, failed_keys: str | None = None, retry_lines: str | None = None,
            dead_letters: str | None = None, max_retries: int = DEFAULT_MAX_RETRIES, backoff_s: float = 0.0) -> None:
    """Post a DataFrame's JSON column through the sink; a log row per attempt lands in ``delivery_log``.

    With ``key_column`` the events are clustered by key (skewed keys are split by the
    rebalance) and every task also writes the keys of its delivered and of its
    undelivered batches (parquet): a run commits the former without the latter. ``retry_lines``
    receives the undelivered events themselves (batch_id, item_id, event).
    """
    spark = json_lines.sparkSession
    for what, path in (("delivery_log", delivery_log), ("delivered_keys", delivered_keys),
                       ("failed_keys", failed_keys), ("retry_lines", retry_lines), ("dead_letters", dead_letters)):
        if path:
            require_shared(spark, path, what)
    if transport.startswith("file:"):
        require_shared(spark, transport[len("file:"):] if not transport.startswith("file:/") else transport, "transport")
    register(spark)
    cols = [json_lines[column].alias("value")]
    if key_column:
        cols.append(json_lines[key_column].cast("string").alias("_key"))
    lines = json_lines.select(*cols)
    if key_column:
        lines = lines.hint("rebalance", "_key").sortWithinPartitions("_key", "value")
    w = (lines.write.format("vigil_events")
         .option("transport", transport).option("delivery_log", delivery_log).option("run_id", run_id)
         .option("batch_size", str(batch_size)).option("max_bytes", str(max_bytes))
         .option("max_retries", str(max_retries)).option("backoff_s", str(backoff_s)))
    if key_column:
        w = w.option("key_column", "_key")
    for name, path in (("delivered_keys", delivered_keys), ("failed_keys", failed_keys), ("retry_lines", retry_lines),
                       ("dead_letters", dead_letters)):
        if path:
            w = w.option(name, path)
    with shuffles_dropped(spark):       # the sorted lines are the widest rows of a run
        w.mode("append").save()


DELIVERY_LOG_SCHEMA = ("batch_id string, attempt int, status_code int, event_count bigint, bytes bigint, "
                       "delay_ms double, final boolean, ts double")


def read_delivery_log(spark, delivery_log: str):
    """A row per delivery attempt; ``final`` marks the last one of a batch."""
    from pyspark.sql import functions as F

    log = spark.read.schema(DELIVERY_LOG_SCHEMA).json(delivery_log)
    return log.withColumn("ts", F.timestamp_micros((F.col("ts") * 1e6).cast("bigint")))

"""Helpers shared by the text operators: scratch tables, Arrow batches, word hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import work_dir

WORD = r"[^\x20\x09-\x0D]+"         # a word of every contract here; the rest is white space
SLICE_BYTES = 1 << 20               # numpy works on slices of this many bytes, whatever the Arrow batch holds
BATCH_ROWS = 1000                   # texts per Arrow batch: the default of 10,000 long rows fills a worker's memory


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back (cuts the lineage).

    The shuffles behind it are then of no use; Spark's cleaner removes their files once the
    driver's JVM has collected what refers to them, so a collection is asked for.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def packed(docs: DataFrame, **columns: Column) -> DataFrame:
    """``docs`` as one struct column ``row`` beside named columns, whatever names it has itself."""
    own = F.struct(*[docs[f"`{c.replace('`', '``')}`"] for c in docs.columns]).alias("row")
    return docs.select(own, *[c.alias(name) for name, c in columns.items()])


def with_fields(schema: StructType, **types: str) -> StructType:
    """``schema`` and further nullable fields, for the output of Arrow functions."""
    return StructType([*schema.fields, *StructType.fromDDL(", ".join(f"{k} {v}" for k, v in types.items())).fields])


def text_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of texts small for the rest of the session."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _resolve(uri: str):
    """pyarrow file system and path of a shared path (file:, hdfs:, s3: or a bare local path)."""
    from pyarrow import fs

    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri[5:])
    return fs.LocalFileSystem(), uri


def open_output(uri: str):
    """Binary output stream; the folder is made."""
    system, path = _resolve(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def open_input(uri: str):
    """Random-access binary file."""
    system, path = _resolve(uri)
    return system.open_input_file(path)


def list_files(uri: str, suffix: str, missing_ok: bool = False) -> list[str]:
    """Files of a folder that Spark wrote, by name; with ``missing_ok`` none where there is no folder."""
    from pyarrow import fs

    system, path = _resolve(uri)
    found = sorted(i.base_name for i in system.get_file_info(fs.FileSelector(path, allow_not_found=missing_ok)) if i.base_name.endswith(suffix))
    return [f"{uri.rstrip('/')}/{name}" for name in found]


def text_slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into row ranges of about ``max_bytes`` (one long text stays whole).

    Yields (first row, end row, UTF-8 bytes, offsets); nulls count as empty texts.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, offset_buffer, data = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + max_bytes, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi, raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_GOLD = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD1342543DE82EF95)
_BASE_INV = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))
with np.errstate(over="ignore"):
    _BYTE = mix64((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _GOLD)
    SHINGLE_FACTORS = mix64((np.arange(64, dtype=np.uint64) + np.uint64(1001)) * _GOLD) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, name: str, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        factors = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        factors[0] = 1
        have = _powers[name] = np.cumprod(factors, dtype=np.uint64)
    return have


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and per text the index of its first word (plus the end)."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[raw]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    cuts = offsets[(offsets > 0) & (offsets < len(raw))]
    before[cuts] = False
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[cuts - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes: differences of one running polynomial sum."""
    with np.errstate(over="ignore"):
        running = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE[raw] * _power(_BASE, "up", len(raw))[:len(raw)], out=running[1:])
        value = (running[ends] - running[starts]) * _power(_BASE_INV, "down", len(raw))[starts]
        return mix64(value + (ends - starts).astype(np.uint64) * _GOLD)


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    return _LOWER[raw]


def word_shingles(raw: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every text's word windows, repeats included, and each text's range in them.

    A text with fewer words than ``width`` gives its whole sequence as one window;
    a text without words gives none.
    """
    starts, ends, first = word_spans(raw, offsets)
    words = word_hashes(raw, starts, ends)
    counts = np.diff(first)
    n_windows = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    bounds = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(n_windows, out=bounds[1:])
    at = np.repeat(first[:-1] - bounds[:-1], n_windows) + np.arange(bounds[-1])
    with np.errstate(over="ignore"):
        value = np.full(len(at), np.uint64(width) * _GOLD, np.uint64)
        padded = np.concatenate([words, np.zeros(width, np.uint64)])
        last = np.repeat(first[1:], n_windows)
        for j in range(width):
            value += np.where(at + j < last, padded[at + j] + np.uint64(j + 1), np.uint64(0)) * SHINGLE_FACTORS[j]
        return mix64(value), bounds

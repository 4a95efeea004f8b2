"""WARC archives with revisit records.

``resolve`` shuffles small headers (id, payload digest, length) by digest: among equal
payloads of at least ``min_bytes`` bytes the record with the largest id is the response and
the others revisit it. ``write`` joins that decision to the pages and lets every task write
one gzip archive in the shared folder (a member per record, fresh headers; a revisit has no
payload); the list of finished files is a table that Spark commits, so files of lost or
repeated tasks are never read. ``read`` streams archives back into records, and
``resolve_revisits`` joins revisit records to the response they name.

Edge cases: a null payload counts as empty; a null id sorts below every id and its record
names no one; rows that repeat id and payload get one record each, all of them responses
if that id is the largest; an empty table writes no archive and reads as no rows; other
columns are passed by.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir
from .common import open_input, open_output, stored

MIN_BYTES = 0
READ_BYTES = 1 << 20
#: Fixed values of the WARC 1.1 format
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"       # the pages carry no capture time
RECORD = ("row_type string, record_id string, refers_to_id string, page_id bigint, target_uri string, "
          "payload_digest string, payload_bytes bigint, payload binary")


def digest_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    """Repeatable record id of a page and its payload."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def resolve(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html",
            min_bytes: int = MIN_BYTES) -> DataFrame:
    """(id, sha1, bytes, response_id, is_response) per distinct id and payload."""
    body = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    headers = stored(pages.select(F.col(id_col).alias("id"), F.sha1(body).alias("sha1"),
                                  F.length(body).cast("bigint").alias("bytes")).distinct(), "warc-headers")
    best = headers.groupBy("sha1", "bytes").agg(F.max("id").alias("response_id"))
    joined = headers.join(best, ["sha1", "bytes"])
    alone = F.col("bytes") < F.lit(min_bytes)
    return joined.withColumn("is_response", alone | F.col("id").eqNullSafe(F.col("response_id"))).withColumn(
        "response_id", F.when(F.col("is_response"), F.col("id")).otherwise(F.col("response_id")))


def _member(row_type: str, page_id: int | None, uri: str | None, payload: bytes, refers: int | None) -> bytes:
    """One record as a gzip member."""
    digest = digest_base32(payload)
    block = b"" if row_type == "revisit" else payload
    head = [VERSION, f"WARC-Type: {row_type}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {(uri or 'urn:page:none').translate({10: '%0A', 13: '%0D'})}",
            f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{digest_base32(block)}"]
    if row_type == "revisit":
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers, digest)}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}", "", ""]
    return gzip.compress("\r\n".join(head).encode() + block + b"\r\n\r\n", compresslevel=4, mtime=0)


def write(pages: DataFrame, folder: str, id_col: str = "page_id", payload_col: str = "html", uri_col: str = "url",
          min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write deduplicated archives below ``folder``; returns (path, records) of the finished files."""
    decided = resolve(pages, id_col, payload_col, min_bytes)
    body = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("pid"), F.col(uri_col).cast("string").alias("uri"), body.alias("body"),
                        F.sha1(body).alias("psha1"))
    joined = rows.join(decided, F.col("pid").eqNullSafe(F.col("id")) & (F.col("psha1") == F.col("sha1"))).select(
        "pid", "uri", "body", "is_response", "response_id")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, out, n = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in batches:
            for pid, uri, payload, is_response, response in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                out = out or open_output(path)
                out.write(_member("response" if is_response else "revisit", pid, uri, payload, response))
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64())], ["path", "records"])

    return stored(joined.mapInArrow(put, "path string, records bigint"), "warc-files")


def _records(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a gzip archive, holding one record at a time."""
    with open_input(path) as f:
        unzip, data, raw = zlib.decompressobj(31), bytearray(), b""
        while True:
            if not raw:
                raw = f.read(READ_BYTES)
            if not raw:
                break
            data += unzip.decompress(raw)
            raw = unzip.unused_data if unzip.eof else b""
            if unzip.eof:
                head, _, rest = bytes(data).partition(b"\r\n\r\n")
                lines = head.decode().split("\r\n")
                if lines[0] != VERSION:
                    raise ValueError(f"{path}: not a {VERSION} record")
                fields = dict(x.split(": ", 1) for x in lines[1:])
                block = rest[:int(fields["Content-Length"])]
                if fields["WARC-Block-Digest"] != f"sha1:{digest_base32(block)}":
                    raise ValueError(f"{path}: block digest of {fields['WARC-Record-ID']} is wrong")
                yield fields, block
                unzip, data = zlib.decompressobj(31), bytearray()
        if data:
            raise ValueError(f"{path}: ends inside a record")


def read(files: DataFrame, payloads: bool = True) -> DataFrame:
    """Records of the archives in column ``path``, block digests checked."""
    names = [x.split()[0] for x in RECORD.split(", ")]

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("row_type", pa.string()), ("record_id", pa.string()), ("refers_to_id", pa.string()),
                            ("page_id", pa.int64()), ("target_uri", pa.string()), ("payload_digest", pa.string()),
                            ("payload_bytes", pa.int64()), ("payload", pa.binary())])
        rows, held = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for h, block in _records(path):
                    full = h["WARC-Type"] == "response"
                    rows.append((h["WARC-Type"], h["WARC-Record-ID"], h.get("WARC-Refers-To"),
                                 int(h["X-Page-ID"]) if "X-Page-ID" in h else None, h["WARC-Target-URI"],
                                 h["WARC-Payload-Digest"].removeprefix("sha1:"), len(block) if full else None,
                                 block if full and payloads else None))
                    held += len(block) + 200
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema)

    n = files.count()
    spread = files.select("path").repartition(max(1, min(n, 4096)), "path")
    return spread.mapInArrow(get, RECORD)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``records`` with, for revisits, the page id and payload length of the response they name."""
    originals = records.filter(F.col("row_type") == "response").groupBy("record_id").agg(
        F.max("page_id").alias("original_page_id"), F.max("payload_bytes").alias("original_bytes")).withColumnRenamed(
        "record_id", "original_id")
    return records.join(originals, F.when(F.col("row_type") == "revisit", F.col("refers_to_id")) == F.col(
        "original_id"), "left").withColumn("payload_bytes", F.coalesce("payload_bytes", "original_bytes")).drop(
        "original_id", "original_bytes")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: records of all pages, written as archives and read back."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    files = write(pages, work_dir(spark, "warc"))
    records = stored(read(files, payloads=False).drop("payload"), "warc-records")
    return resolve_revisits(records).select(
        "page_id", "payload_bytes", "payload_digest", F.col("row_type").alias("record_type"),
        F.when(F.col("row_type") == "revisit", F.col("original_page_id")).alias("refers_to"), "record_id", "target_uri")

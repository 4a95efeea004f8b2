"""Token ids of whole texts in seekable binary files.

File layout (all numbers little-endian):

* one independent zstandard frame per document with its ids as unsigned 32-bit numbers,
  each with a content checksum;
* a skippable frame with the zstandard-compressed document ids (a null mask, then int64);
* a skippable frame with the seek table of the zstandard seekable format: per frame its
  compressed size, its size and the low half of its XXH64, then the footer.

``TokenFile`` reads the seek table from the end of a file and decompresses only the frames
asked for. ``write`` range-partitions by id, so that files in their order hold ascending
ids; every task writes one file in the shared folder and Spark commits the list of
finished files, so files of lost or repeated tasks are never read.

Encoding: a text of ASCII and Latin letters is cut by the vocabulary's own splitting rule
and every distinct piece is encoded once per worker (a cache of bounded size); any other
text, and one that holds an added token's string, goes whole through the library.

Edge cases: null and empty texts hold the end id alone; null ids come first; rows that
repeat an id are ordered by a hash of their text; an empty table writes no file and reads
as no rows; other columns are passed by.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import work_dir
from .common import open_input, open_output, shuffle_partitions, stored, text_batches

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
LEVEL = 3
CACHE_PIECES = 1_000_000        # distinct pieces that a worker remembers
READ_BYTES = 1 << 20
#: Fixed values of the zstandard formats
SKIPPABLE_IDS, SKIPPABLE_SEEK, SEEK_MAGIC, CHECKSUM_FLAG = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
#: Texts of these characters only may take the cached path
PLAIN = re.compile("[\t\n\r -~À-ÖØ-öø-ɏ]*")
#: The splitting rule of the vocabulary on such texts (letters first: no other case starts with one)
PIECE = re.compile("(?: ?[A-Za-zÀ-ÖØ-öø-ɏ]+)|'(?:s|t|re|ve|m|ll|d)| ?[0-9]+"
                   "| ?[^\\sA-Za-z0-9À-ÖØ-öø-ɏ]+|\\s+(?!\\S)|\\s+")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The printable letter of each byte in byte-level vocabularies: itself, or the next from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + k) for k, b in enumerate(hidden)}


class Encoder(dict):
    """Piece -> bytes of its ids; a piece met for the first time is encoded by the library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.library = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHE_PIECES:
            self.clear()
        tokens = self.library.model.tokenize("".join([self.letters[b] for b in piece.encode()]))
        out = self[piece] = np.array([t.id for t in tokens], "<u4").tobytes()
        return out

    def encode(self, text: str) -> bytes:
        if PLAIN.fullmatch(text) and not any(a in text for a in self.added):
            return b"".join(map(self.__getitem__, PIECE.findall(text)))
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


class Writer:
    """Appends documents as frames; ``close`` adds the id frame and the seek table."""

    def __init__(self, uri: str):
        self.out = open_output(uri)
        self.zip = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)
        self.entries, self.ids, self.tokens = bytearray(), [], 0

    def add(self, ident: int | None, ids: bytes) -> None:
        frame = self.zip.compress(ids)
        self.out.write(frame)
        self.entries += struct.pack("<III", len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF)
        self.ids.append(ident)
        self.tokens += len(ids) // 4

    def close(self) -> None:
        mask = np.array([i is None for i in self.ids], np.uint8).tobytes()
        known = np.array([0 if i is None else i for i in self.ids], "<i8").tobytes()
        body = self.zip.compress(mask + known)
        self.out.write(struct.pack("<II", SKIPPABLE_IDS, len(body)) + body)
        footer = struct.pack("<IBI", len(self.ids), CHECKSUM_FLAG, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK, len(self.entries) + len(footer)) + self.entries + footer)
        self.out.close()


class TokenFile:
    """Random access to the documents of one file."""

    def __init__(self, uri: str):
        self.file = open_input(uri)
        end = self.file.size()
        self.file.seek(end - 9)
        n, flags, magic = struct.unpack("<IBI", self.file.read(9))
        if magic != SEEK_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError(f"{uri}: no seek table")
        self.file.seek(end - 9 - 12 * n)
        table = np.frombuffer(self.file.read(12 * n), "<u4").reshape(n, 3)
        self.sizes, self.lengths, self.sums = table[:, 0].astype(np.int64), table[:, 1], table[:, 2]
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.file.seek(int(self.starts[-1]))
        magic, size = struct.unpack("<II", self.file.read(8))
        if magic != SKIPPABLE_IDS:
            raise ValueError(f"{uri}: no document ids")
        body = zstandard.ZstdDecompressor().decompress(self.file.read(size), max_output_size=9 * n or 1)
        ids = np.frombuffer(body[n:], "<i8")
        self.ids = [None if m else int(i) for m, i in zip(body[:n], ids, strict=True)]

    def __len__(self) -> int:
        return len(self.ids)

    def _open(self, i: int, frame: bytes, unzip: zstandard.ZstdDecompressor) -> bytes:
        ids = unzip.decompress(frame)
        if len(ids) != self.lengths[i] or xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF != self.sums[i]:
            raise ValueError(f"frame {i}: checksum is wrong")
        return ids

    def document(self, i: int) -> np.ndarray:
        """Ids of the i-th document; only its own frame is read."""
        self.file.seek(int(self.starts[i]))
        return np.frombuffer(self._open(i, self.file.read(int(self.sizes[i])), zstandard.ZstdDecompressor()), "<u4")

    def documents(self) -> Iterator[tuple[int | None, bytes]]:
        """All documents in order, reading blocks of about READ_BYTES."""
        unzip, i = zstandard.ZstdDecompressor(), 0
        while i < len(self):
            j = max(i + 1, int(np.searchsorted(self.starts, self.starts[i] + READ_BYTES, "right")) - 1)
            self.file.seek(int(self.starts[i]))
            block = self.file.read(int(self.starts[j] - self.starts[i]))
            for k in range(i, j):
                at = int(self.starts[k] - self.starts[i])
                yield self.ids[k], self._open(k, block[at:at + int(self.sizes[k])], unzip)
            i = j


def write(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
          vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Encode and write all rows; returns (part, path, n_docs, n_tokens) of the finished files."""
    text_batches(docs.sparkSession)
    path = vocabulary or vocabulary_path()
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = shuffle_partitions(docs.sparkSession)
    ordered = rows.repartitionByRange(n, "id").sortWithinPartitions("id", F.xxhash64("text"))
    end = struct.pack("<I", end_id)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        uri, out, encode = f"{folder.rstrip('/')}/part-{part:06d}-{uuid.uuid4().hex}.tok", None, encoder(path).encode
        for batch in batches:
            out = out or (Writer(uri) if batch.num_rows else None)
            for lo in range(0, batch.num_rows, 256):
                some = batch.slice(lo, 256)
                for ident, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                    out.add(ident, encode(text) + end)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([uri]), pa.array([len(out.ids)], pa.int64()),
                 pa.array([out.tokens], pa.int64())], ["part", "path", "n_docs", "n_tokens"])

    return stored(ordered.mapInArrow(put, "part int, path string, n_docs long, n_tokens long"), "token-files")


def read(files: DataFrame, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document in the files, checksums verified."""
    # one row per file, so this window holds as many rows as the write had partitions
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.select("part", "path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("first"))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids]
        for batch in batches:
            for uri, at in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                rows: list[list] = [[] for _ in names]
                held = 0
                for ident, ids in TokenFile(uri).documents():
                    values = [ident, at, len(ids) // 4, zlib.crc32(ids)]
                    if with_ids:
                        values.append(np.frombuffer(ids, "<u4").astype(np.int64))
                        held += len(ids)
                    for column, value in zip(rows, values, strict=True):
                        column.append(value)
                    at += len(ids) // 4
                    if len(rows[0]) >= 50_000 or held > 4 << 20:
                        yield _batch(rows, names)
                        rows, held = [[] for _ in names], 0
                if rows[0]:
                    yield _batch(rows, names)

    n = max(1, min(files.count(), 4096))
    return placed.repartition(n, "path").mapInArrow(get, schema)


def _batch(rows: list[list], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())] * (len(names) - 4)
    return pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds, strict=True)], names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: all documents through the files: (doc_id, start, n_tokens, ids_crc32)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return read(write(docs, work_dir(spark, "tokens")))

"""SentencePiece encoding and decoding through a relational lattice.

A text becomes its SentencePiece form (a leading word mark, spaces as word marks) and is
cut into units: word marks with a run of letters, or with a run of other characters, and line
breaks. No piece of the table spans such a cut (``load_pieces`` checks it), so each distinct
unit is segmented once:

1. rows are dealt to groups, stretches of consecutive rows of a file (``_placed``); tasks count the
   distinct units of each group, Spark sums the counts and lists the groups of every unit;
2. the substrings of up to the longest piece's length of every unit are exploded and
   equi-joined to the piece table (``MAX_PIECES`` bounds what is broadcast); a single
   character without a piece keeps an edge at the penalty of unknown characters;
3. edges are sorted by unit within the tasks and folded to the best path (highest sum of piece scores, at
   equal sums the longer last piece); unknown characters turn into their byte pieces;
4. ids go back to the texts, which stay where they are: the most frequent units (``FREQUENT`` at
   most) are one small file that every worker loads from the shared folder, all other units go
   by a shuffle to one small file per group, which the tasks load as they come to its rows.

Scores are those of the model file. Runs are never cut: the few units of more than
``MAX_RUN`` characters (unspaced letters, ruled lines, long blanks) stay out of steps 1 to 3
and of the join, and the task that writes a text's ids folds their best path itself, over the
whole unit and by the same rule (``best_ids``).

Edge cases: null and empty texts have no ids and decode to the empty text; a word mark
that is itself in a text decodes to a space, as the format has it; repeated rows are encoded
alike; an empty table gives an empty result; other columns are passed by.
"""

from __future__ import annotations

import math
import re
import struct
import zlib
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir
from .common import list_files, open_input, stored, text_batches

MODEL = "piece_bpe_32k.model"
MAX_PIECES = 1 << 20
FREQUENT = 1 << 17
MAX_RUN = 96                    # characters of a unit that goes through the relational lattice
LONG_KEPT = 4096                # long units whose ids a task remembers, each of that many characters at most
GROUP_BYTES = 1 << 25           # text of a group, by the mean length of a text
GROUP_ROWS = 1 << 13            # rows of a group at most
FLUSH_CHUNKS = 60_000           # distinct stretches between spaces that a task counts before it cuts them
FLUSH_UNITS = 250_000           # distinct units that a task holds before it hands them on
CHUNKS = 1 << 17                # stretches between spaces whose ids a task remembers
MARK = "▁"
LETTERS, OTHERS = r"[^\W\d_²]", rf"(?:[^\w{MARK}\n]|[\d_²])"     # a piece joins ² and a full stop
UNIT = re.compile(f"{MARK}*{LETTERS}+|{MARK}*{OTHERS}+|{MARK}+|\n")
#: The same rule for texts of ASCII and Latin letters only, in plain ranges (a fifth faster)
PLAIN = re.compile("[\n -~À-ÖØ-öø-ɏ▁]*")
PLAIN_UNIT = re.compile(f"{MARK}*[A-Za-zÀ-ÖØ-öø-ɏ]+|{MARK}*[!-@\\[-`{{-~]+|{MARK}+|\n")
PLACES = 1 << 7                 # more than MAX_RUN: places in a unit, as digits of an edge's number
FOLD_EDGES = 1 << 14            # edges that a task folds at a time
UNKNOWN_PENALTY = 10.0          # below the lowest score of the table


Finish = tuple[str, Callable[[pa.RecordBatch], pa.RecordBatch]]


@dataclass
class Pieces:
    """Piece table: (piece, id, score) of ordinary pieces, and the id of each byte."""
    rows: list[tuple[str, int, float]]
    byte_ids: list[int]

    @cached_property
    def longest(self) -> int:
        return max(len(p) for p, _, _ in self.rows)

    @cached_property
    def unknown(self) -> float:
        return min(s for _, _, s in self.rows) - UNKNOWN_PENALTY

    @cached_property
    def table(self) -> dict[str, tuple[int, float]]:
        return {p: (i, s) for p, i, s in self.rows}

    @cached_property
    def beginnings(self) -> set[str]:
        """Every beginning of a piece: behind a substring that is none, no longer piece starts."""
        return {p[:k] for p in self.table for k in range(1, len(p) + 1)}

    @cached_property
    def as_bytes(self) -> dict[int, bytes]:
        out = {i: p.encode() for p, i, _ in self.rows}
        out.update({i: bytes([b]) for b, i in enumerate(self.byte_ids)})
        return out


def model_path(name: str = MODEL) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def load_pieces(path: str) -> Pieces:
    """Piece table of a SentencePiece model file with byte fallback."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    byte_ids = [m.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    if not all(m.is_byte(i) for i in byte_ids):
        raise ValueError("the model has no byte pieces")
    rows = [(m.id_to_piece(i), i, m.get_score(i)) for i in range(m.get_piece_size())
            if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))]
    if len(rows) > MAX_PIECES:
        raise ValueError(f"more than {MAX_PIECES} pieces")
    if any(UNIT.findall(p) != [p] for p, _, _ in rows):
        raise ValueError("a piece spans units: letters and other characters, word marks or line breaks")
    return Pieces(rows, byte_ids)


def units_of(text: str | None) -> list[str]:
    if not text:
        return []
    return (PLAIN_UNIT if PLAIN.fullmatch(text) else UNIT).findall(MARK + text.replace(" ", MARK))


def chunks_of(text: str) -> list[str] | None:
    """The stretches between single spaces, each cut into units on its own; None where spaces meet."""
    if MARK in text or text.startswith(" ") or "  " in text:
        return None
    return text.split(" ")


def units_of_chunk(chunk: str) -> list[str]:
    if chunk.isascii() and chunk.isalpha():
        return [MARK + chunk]
    return (PLAIN_UNIT if PLAIN.fullmatch(chunk) else UNIT).findall(MARK + chunk)


def _placed(rows: DataFrame) -> DataFrame:
    """(id, text) with ``g``, the number of a row's group: consecutive rows of one file.

    A table that is read from files keeps its place in them however it is split into tasks; any other
    is written first.
    """

    def with_place(d: DataFrame) -> DataFrame:
        return d.select("id", "text", F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.row_index").alias("at"))
    try:
        told = with_place(rows)
        # rows that a shuffle has dealt out anew are no longer side by side
        scattered = "Exchange" in told._jdf.queryExecution().executedPlan().toString()
    except AnalysisException:
        scattered = True
    if scattered:
        told = with_place(stored(rows, "lattice-texts"))
    mean = told.agg(F.avg(F.octet_length("text"))).first()[0] or 1.0
    n = max(1, min(GROUP_ROWS, int(GROUP_BYTES / max(mean, 1.0))))
    return told.select("id", "text", F.pmod(F.xxhash64("file", F.floor(F.col("at") / n)), F.lit(1 << 62)).alias("g"))


def group_units(placed: DataFrame) -> DataFrame:
    """(unit, n, g): counts of the distinct units of each group, in one or more parts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks: Counter[str] = Counter()
        odd: Counter[str] = Counter()

        def cut() -> None:
            while chunks:
                chunk, n = chunks.popitem()
                for u in units_of_chunk(chunk):
                    if len(u) <= MAX_RUN:
                        odd[u] += n

        def flush(g: int) -> pa.RecordBatch:
            cut()
            out = pa.RecordBatch.from_arrays([pa.array(list(odd), pa.string()), pa.array(list(odd.values()), pa.int64()),
                                              pa.array(np.full(len(odd), g))], ["unit", "n", "g"])
            odd.clear()
            return out
        now = 0
        for batch in batches:
            for text, g in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if len(chunks) > FLUSH_CHUNKS:
                    cut()
                if (g != now or len(odd) > FLUSH_UNITS) and (chunks or odd):
                    yield flush(now)
                now = g
                if not text:
                    continue
                found = chunks_of(text)
                if found is None:
                    odd.update(u for u in units_of(text) if len(u) <= MAX_RUN)
                else:
                    chunks.update(found)
        if chunks or odd:
            yield flush(now)

    return placed.select("text", "g").mapInArrow(count, "unit string, n long, g long")


def segment(units: DataFrame, pieces: Pieces) -> DataFrame:
    """(unit, n, groups, ids) for distinct units; ids are little-endian 32-bit integers.

    A unit's edges stay in its task and are sorted by one number: the unit's number in the task, start
    and end. What else is told of a unit goes with its first edge only (of its first character, which
    is always there).
    """
    spark = units.sparkSession
    table = F.broadcast(spark.createDataFrame(pieces.rows, "piece string, id int, score double"))
    spans = units.withColumn("u", F.monotonically_increasing_id()).withColumn(
        "b", F.explode(F.sequence(F.lit(0), F.length("unit") - 1))).withColumn(
        "l", F.explode(F.sequence(F.lit(1), F.least(F.lit(pieces.longest), F.length("unit") - F.col("b")))))
    spans = spans.withColumn("piece", F.substring("unit", F.col("b") + 1, F.col("l")))
    edges = spans.join(table, "piece", "left").filter(F.col("id").isNotNull() | (F.col("l") == 1))
    place = (F.col("u") * PLACES + F.col("b")) * PLACES + F.col("b") + F.col("l")
    head = (F.col("b") == 0) & (F.col("l") == 1)
    told = [F.when(head, F.col(c)).alias(c) for c in ("unit", "n", "groups")]
    edges = edges.select(place.alias("place"), F.coalesce("score", F.lit(pieces.unknown)).alias("s"),
                         F.coalesce("id", F.lit(-1)).alias("id"), *told).sortWithinPartitions("place")
    byte_ids = pieces.byte_ids

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(part: pa.Table) -> pa.RecordBatch:
            place = part.column("place").to_numpy()
            ends, starts = place % PLACES, place // PLACES % PLACES
            heads = np.flatnonzero((starts == 0) & (ends == 1))
            own = part.take(heads).combine_chunks()
            paths = best_paths(own.column("unit").to_pylist(), np.diff(heads, append=len(place)).tolist(), starts.tolist(),
                               ends.tolist(), part.column("s").to_pylist(), part.column("id").to_pylist(), byte_ids)
            made = own.select(["unit", "n", "groups"]).append_column("ids", pa.array(paths, pa.binary()))
            return made.combine_chunks().to_batches()[0]
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= FOLD_EDGES:
                part = pa.Table.from_batches(held)
                last = int(np.flatnonzero(part.column("place").to_numpy() % (PLACES * PLACES) == 1)[-1])
                if last:            # the last unit may go on
                    yield out(part.slice(0, last))
                held = part.slice(last).to_batches()
                rows = part.num_rows - last
        if rows:
            yield out(pa.Table.from_batches(held))

    return edges.mapInArrow(fold, "unit string, n long, groups array<long>, ids binary")


def best_paths(units: list[str], sizes: list[int], starts: list[int], ends: list[int], scores: list[float],
               idents: list[int], byte_ids: list[int]) -> Iterator[bytes]:
    """Ids of each unit's best path; ``sizes`` of the edges belong to a unit, in the order of their starts.

    An edge's start has its final score when the edge comes, and at equal sums the edge from the
    earliest start (the longer piece) stays.
    """
    lo = 0
    for unit, size in zip(units, sizes, strict=True):
        best, by = [0.0] + [-math.inf] * len(unit), [-1] * (len(unit) + 1)
        for k in range(lo, lo + size):
            come, e = best[starts[k]] + scores[k], ends[k]
            if come > best[e]:
                best[e], by[e] = come, k
        lo += size
        out, e = [], len(unit)
        while e:
            k = by[e]
            if k < 0:
                raise ValueError("an edge is missing")
            if idents[k] >= 0:
                out.append(idents[k])
            else:
                out.extend([byte_ids[x] for x in reversed(unit[starts[k]:e].encode())])
            e = starts[k]
        out.reverse()
        yield struct.pack(f"<{len(out)}i", *out)


def best_ids(unit: str, pieces: Pieces) -> np.ndarray:
    """Ids of one whole unit of any length: the fold of ``segment`` in time and memory linear in its length.

    Places come in order, so at equal sums the edge from the earliest start (the longer piece) stays.
    """
    table, beginnings, size = pieces.table, pieces.beginnings, len(unit)
    score, back, ident = np.full(size + 1, -np.inf), np.zeros(size + 1, np.int64), np.full(size + 1, -1, np.int32)
    score[0] = 0.0
    score, back, ident = array("d", score.tobytes()), array("q", back.tobytes()), array("i", ident.tobytes())
    unknown = (-1, pieces.unknown)
    for b in range(size):
        here, e = score[b], b + 1
        part = unit[b]
        found = table.get(part, unknown)
        while True:
            if found is not None and here + found[1] > score[e]:
                score[e], back[e], ident[e] = here + found[1], b, found[0]
            e += 1
            part = unit[b:e]
            if e > size or part not in beginnings:
                break
            found = table.get(part)
    out, e = array("i"), size
    while e:
        if ident[e] >= 0:
            out.append(ident[e])
        else:
            out.extend(pieces.byte_ids[x] for x in reversed(unit[back[e]:e].encode()))
        e = back[e]
    return np.frombuffer(out, np.int32)[::-1].astype("<i4")


def _unit_files(known: DataFrame, most: int) -> tuple[str, str]:
    """Write the most frequent units (whole classes of log-count, ``most`` in all) to one shared file, and
    the others to one folder per group that has them."""
    spark = known.sparkSession
    step = F.floor(F.log2("n") * 16).cast("int")
    sizes = sorted(known.groupBy(step.alias("s")).count().collect(), reverse=True)      # some hundred classes
    least, total = None, 0
    for s, n in sizes:
        total += n
        if total > most:
            break
        least = s
    often = step >= least if least is not None else F.lit(False)
    frequent, by_group = work_dir(spark, "lattice-frequent"), work_dir(spark, "lattice-groups")
    known.filter(often).select("unit", "ids").repartition(1).write.parquet(frequent)
    known.filter(~often).select("unit", "ids", F.explode("groups").alias("g")).repartition("g").write.partitionBy(
        "g").parquet(by_group)
    return frequent, by_group


def _load_units(path: str) -> dict[str, bytes]:
    """Unit -> ids of one folder; none if it was not written."""
    import pyarrow.parquet as pq

    out: dict[str, bytes] = {}
    for name in list_files(path, ".parquet", missing_ok=True):
        with open_input(name) as f:
            for part in pq.ParquetFile(f).iter_batches(65536, columns=["unit", "ids"]):
                out.update(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True))
    return out


def _words(units: dict[str, bytes]) -> dict[str, bytes]:
    """The units that are a whole stretch between spaces, without their word mark."""
    return {u[1:]: ids for u, ids in units.items() if u[0] == MARK and u.count(MARK) == 1}


@lru_cache(maxsize=1)
def _load_frequent(path: str) -> tuple[dict[str, bytes], dict[str, bytes]]:
    """Once per worker; at most FREQUENT entries, and their words."""
    units = _load_units(path)
    return units, _words(units)


def encode(docs: DataFrame, pieces: Pieces, id_col: str = "doc_id", text_col: str = "text",
           frequent: int = FREQUENT, finish: Finish | None = None) -> DataFrame:
    """(id, text, ids) for every row of ``docs``.

    ``finish`` (output columns beside the id, and a function from an Arrow batch of these three to
    those columns) runs in the task that made the ids, so that they need not leave it.
    """
    spark = docs.sparkSession
    text_batches(spark)
    placed = _placed(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")))
    units = group_units(placed).repartition("unit").groupBy("unit").agg(
        F.sum("n").alias("n"), F.collect_list("g").alias("groups"))       # a group told twice does no harm
    known = segment(units, pieces)
    often, by_group = _unit_files(stored(known, "lattice-units"), frequent)
    spark.sparkContext._jvm.System.gc()     # as in ``stored``: the shuffles behind the files are done with
    kind = docs.schema[id_col].dataType.simpleString()
    held = spark.sparkContext.broadcast(pieces)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, words = _load_frequent(often)
        mine: dict[str, bytes] = {}
        now = None
        ids_of: dict[str, bytes] = {}       # of stretches between spaces
        room = 0                            # for those of more than one unit
        long_of: dict[str, bytes] = {}

        def long_ids(unit: str) -> bytes:
            if len(unit) <= MAX_RUN:
                raise KeyError(unit)
            ids = long_of.get(unit)
            if ids is None:
                ids = best_ids(unit, held.value).tobytes()
                if len(unit) <= LONG_KEPT:
                    if len(long_of) >= LONG_KEPT:
                        long_of.clear()
                    long_of[unit] = ids
            return ids
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                some = batch.slice(lo, 256)
                out = []
                for text, g in zip(some.column(1).to_pylist(), some.column(2).to_pylist(), strict=True):
                    if g != now:
                        mine, now, room = _load_units(f"{by_group}/g={g}"), g, CHUNKS
                        ids_of = {**words, **_words(mine)}
                    found = chunks_of(text) if text else []
                    if found is None:
                        parts = [common.get(u) or mine.get(u) or long_ids(u) for u in units_of(text)]
                    else:
                        parts = list(map(ids_of.get, found))
                        if None in parts:
                            for at, part in enumerate(parts):
                                if part is None:
                                    chunk = found[at]
                                    parts[at] = b"".join([common.get(u) or mine.get(u) or long_ids(u)
                                                          for u in units_of_chunk(chunk)])
                                    if room and len(chunk) <= MAX_RUN:
                                        ids_of[chunk] = parts[at]
                                        room -= 1
                    out.append(np.frombuffer(b"".join(parts), "<i4"))
                made = pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(out, pa.list_(pa.int32()))],
                                                  ["id", "text", "ids"])
                yield finish[1](made) if finish else made

    return placed.mapInArrow(fill, f"id {kind}, " + (finish[0] if finish else "text string, ids array<int>"))


def decode_ids(ids: np.ndarray, table: dict[int, bytes]) -> str:
    """Text of a sequence of piece ids; the leading word mark goes."""
    text = b"".join(map(table.__getitem__, ids.tolist())).decode("utf-8", "replace").replace(MARK, " ")
    return text[1:] if text.startswith(" ") else text


def decode(encoded: DataFrame, pieces: Pieces) -> DataFrame:
    """``encoded`` with column decoded: the text that the ids stand for."""
    table = pieces.as_bytes

    @F.pandas_udf("string")
    def back(ids):
        return ids.map(lambda x: decode_ids(np.asarray(x), table))

    return encoded.withColumn("decoded", back("ids"))


def digest_columns(pieces: Pieces) -> Finish:
    """n_tokens, ids_crc32 and round_trip from real ids and their decoded text."""
    table = pieces.as_bytes

    def look(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, crc, same = [], [], []
        for text, ids in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
            ids = np.asarray(ids.values, np.int32)
            n.append(len(ids))
            crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
            same.append(decode_ids(ids, table) == text.replace(MARK, " "))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64()),
                                           pa.array(same, pa.bool_())], ["id", "n_tokens", "ids_crc32", "round_trip"])

    return "n_tokens long, ids_crc32 long, round_trip boolean", look


def digests(encoded: DataFrame, pieces: Pieces) -> DataFrame:
    """(id, n_tokens, ids_crc32, round_trip) of encoded rows."""
    columns, look = digest_columns(pieces)
    kind = encoded.schema["id"].dataType.simpleString()
    return encoded.select("id", "text", "ids").mapInArrow(lambda batches: map(look, batches), f"id {kind}, {columns}")


def encoded_documents(docs: DataFrame) -> DataFrame:
    """Digest columns (doc_id, n_tokens, ids_crc32, round_trip) of every row of ``docs``."""
    pieces = load_pieces(model_path())
    return encode(docs.select("doc_id", "text"), pieces, finish=digest_columns(pieces)).withColumnRenamed("id", "doc_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: (doc_id, n_tokens, ids_crc32, round_trip) over all documents."""
    return encoded_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))

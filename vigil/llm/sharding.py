"""Sharding by histogram sort: splitters from exact byte histograms, one exchange.

Rows are ordered by a 64-bit hash of their text, then by a hash of their id, so that
equal texts lie together and neighbours are random. ``splitters`` finds the keys that
cut this order into ranges of near equal bytes: a first histogram counts exact bytes
and rows in 4096 key ranges; each later round splits only the ranges that hold a
wanted boundary 4096 times finer, until every boundary is within the tolerance (or
its range is a single key). ``shard`` then exchanges the rows once, by ranges of (shard,
key), and numbers them; a shard spans many partitions, so none lands in one task.

A group of equal texts stays in one shard unless it alone keeps a boundary outside
the tolerance; then it is cut by the hash of the id.

Edge cases: a null text has no bytes and size 1, and null texts form one group; rows that
repeat id and text stay together, in one shard; a null id is a value like any other; an
empty table gives an empty result; other columns ride along in ``shard``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordinal import with_ordinal
from .common import packed, shuffle_partitions, stored

SHARDS = 16
BITS = 12                   # probes per boundary and round: 2 ** BITS
TOLERANCE = 0.002           # of a shard's bytes, around each boundary
HALF = 1 << 63


def sort_keys(text: Column, ident: Column) -> tuple[Column, Column]:
    return F.xxhash64(F.lit(3), F.coalesce(text, F.lit("")), text.isNull()), F.xxhash64(F.lit(4), ident)


def _cell(key: Column, shift: int) -> Column:
    """Leading bits of an unsigned 64-bit key, as a long."""
    return F.shiftrightunsigned(key.bitwiseXOR(F.lit(-HALF)), shift)


def splitters(keys: DataFrame, total: int, targets: list[float], slack: float) -> list[tuple[int, int]]:
    """(k1, k2) from which on a row lies behind the boundary, per target, in signed order.

    ``keys`` has k1, k2, size. A boundary is the edge of a histogram cell; cells are refined
    over the bits of k1, then those of k2, where the edge nearest the target is too far off.
    """
    # per open target: (bytes below its cell, prefix value, bits known); a cell is a 128-bit prefix
    result: dict[int, int] = {}
    open_cells: dict[int, list[int]] = {0: list(range(len(targets)))}
    below: dict[int, int] = {0: 0}
    known = 0
    while open_cells and known < 128:
        step = min(BITS, 64 - known % 64)
        key, done = ("k1", known) if known < 64 else ("k2", known - 64)
        prefix = _cell(F.col("k1"), 64 - known) if 0 < known < 64 else F.lit(0)
        rows = keys
        if known:
            names = sorted(open_cells)
            if known < 64:
                rows = keys.filter(prefix.isin(names))
            else:
                full = [c >> (known - 64) if known > 64 else c for c in names]
                rows = keys.filter(F.col("k1").isin([_signed(c) for c in full]))
                rest = F.lit(0) if done == 0 else _cell(F.col("k2"), 64 - done)
                rows = rows.withColumn("_rest", rest)
        sub = F.shiftrightunsigned(F.shiftleft(F.col(key).bitwiseXOR(F.lit(-HALF)), done), 64 - step)
        by = [F.lit(0).cast("bigint").alias("p") if not known else
              (prefix.alias("p") if known < 64 else F.col("k1").alias("p")),
              (F.col("_rest") if known >= 64 else F.lit(0).cast("bigint")).alias("q"), sub.alias("s")]
        counted: dict[int, dict[int, int]] = {}
        for r in rows.groupBy(*by).agg(F.sum("size").alias("b")).collect():     # open cells x 2 ** BITS rows at most
            cell = r["p"] if known < 64 else ((r["p"] + HALF) << done) | r["q"]
            counted.setdefault(cell, {})[r["s"]] = int(r["b"])
        nxt_cells: dict[int, list[int]] = {}
        nxt_below: dict[int, int] = {}
        for cell, wanted in open_cells.items():
            edges, at = [], below[cell]
            for s in sorted(counted.get(cell, {})):
                edges.append((at, s))
                at += counted[cell][s]
            edges.append((at, 1 << step))
            for t in wanted:
                b, s = min(edges, key=lambda e: (abs(e[0] - targets[t]), e[1]))
                if abs(b - targets[t]) <= slack or known + step >= 128:
                    result[t] = ((cell << step) + s) << (128 - known - step)
                    continue
                b, s = max((e for e in edges[:-1] if e[0] <= targets[t]), key=lambda e: e[1])
                child = (cell << step) | s
                nxt_cells.setdefault(child, []).append(t)
                nxt_below[child] = b
        open_cells, below, known = nxt_cells, nxt_below, known + step
    out = []
    for t in range(len(targets)):
        v = min(result[t], (1 << 128) - 1)
        out.append((_signed(v >> 64), _signed(v & ((1 << 64) - 1))))
    return sorted(out)


def _signed(v: int) -> int:
    """Unsigned order value of a key back to the signed long."""
    return v - HALF


def _behind(cuts: list[tuple[int, int]]) -> Column:
    """How many boundaries lie at or below a row's key: binary search as nested conditions."""
    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        a, b = cuts[mid]
        reached = (F.col("k1") > F.lit(a)) | ((F.col("k1") == F.lit(a)) & (F.col("k2") >= F.lit(b)))
        return F.when(reached, search(mid + 1, hi)).otherwise(search(lo, mid))
    return search(0, len(cuts))


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
          carry: tuple[str, ...] = (), tolerance: float = TOLERANCE) -> DataFrame:
    """(id, size, text_crc32, carried columns, shard, slot): near equal bytes, slots without gaps."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    k1, k2 = sort_keys(F.col(text_col), F.col(id_col))
    rows = stored(docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), *carry, k1.alias("k1"), k2.alias("k2")), "shard-keys")
    total = int(rows.agg(F.sum("size")).first()[0] or 0)
    cuts = splitters(rows.select("k1", "k2", "size"), total, [total * i / shards for i in range(1, shards)],
                     tolerance * total / shards)
    placed = rows.withColumn("shard", _behind(cuts))
    numbered = with_ordinal(placed, ["k1", "k2", "id", "text_crc32"], by=["shard"], name="slot")
    return numbered.select("id", "size", "text_crc32", *carry, F.col("shard").cast("int").alias("shard"),
                           (F.col("slot") - 1).cast("bigint").alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Whole rows of ``docs`` (column row) and their slots as Parquet folders shard=0 .. shard=N-1, sorted by slot."""
    rows = packed(docs, doc_id=docs["doc_id"], text=docs["text"])
    placed = shard(rows, shards, carry=("row",))
    n = max(shards, shuffle_partitions(docs.sparkSession))
    placed.repartitionByRange(n, "shard", "slot").sortWithinPartitions("shard", "slot").select(
        "row", "slot", "shard").write.partitionBy("shard").parquet(path)


def query(spark, sf_dir: str) -> DataFrame:
    """op9: all documents under the law of equal bytes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return shard(docs).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))

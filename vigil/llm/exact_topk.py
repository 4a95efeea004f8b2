"""Exact top-k search by inner product through distributed histogram selection.

Component x of a vector counts as floor(256 * x); a score is the integer inner product. All rows
are packed into candidate blocks, the queries among them into query blocks, and every pair of
blocks is one group of a co-grouped exchange: a task scores one pair by matrix products over
slices of bounded size, and no score is ever kept. The k-th best score of each query is found
digit by digit, from the leading bits down: a round counts the scores that share the query's
known leading bits by their next ``DIGIT_BITS`` bits, sums the counts over all blocks, and reads from
the summed histogram which digit holds the k-th score. A block hands on only the topmost
digits that could still hold it (as many scores as are wanted lie above the others already). A last
pass lets through what lies above the k-th score and, of its ties, the block's smallest ids.

Products are exact: sums below 2^52 in floating point, larger ones in whole numbers.
Scores are kept within +-2^62 (saturated beyond).

Edge cases: vectors that are null or hold a null or non-finite component take no part; missing
components of a shorter vector count as 0, an empty vector scores 0; rows that repeat an id are
vectors of their own (each is a candidate, and a query if the id is one), and a query leaves out
its own row only; a null id is a candidate that loses ties to all others; fewer
candidates than asked for are all returned; ties, a third of all rows included, go to the smaller id;
an empty table gives an empty result; other columns are passed by.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SCALE = 256
BLOCK_CELLS = 1 << 19       # components per block of candidates or queries
SLICE_SCORES = 1 << 21      # scores that a task holds at once
DIGIT_BITS = 12             # of a score, settled per round
LIMIT = 1 << 62             # scores saturate here
_EXACT = float(1 << 52)     # floating-point sums below are whole numbers

BLOCK_SCHEMA = "block long, ids array<long>, rows array<long>, width int, kind string, vecs binary, norm double"


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(row, id, vec) of the rows that take part; ``row`` tells rows of one id apart."""
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("id"),
                          F.col(vec_col).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("vec").isNotNull() & F.coalesce(finite, F.lit(False)))


def _n_blocks(n_rows: int, width: int) -> int:
    return max(1, math.ceil(n_rows * max(width, 1) / BLOCK_CELLS))


def _packed(block: int, ids: pa.Array, rows: np.ndarray, values: np.ndarray) -> pa.Table:
    """One row of a block: rows in the order in which ties are settled, components in the smallest type."""
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    order = np.lexsort((rows, ids.fill_null(0).to_numpy(), ~known))
    values = values[order]
    top = np.abs(values).max(initial=0.0)
    kind = "int16" if top < 1 << 15 else "int32" if top < 1 << 31 else "float64"
    norm = float(np.sqrt((values ** 2).sum(axis=1)).max(initial=0.0))
    return pa.table({"block": pa.array([block], pa.int64()), "ids": pa.array([ids.take(pa.array(order)).to_pylist()],
                     pa.list_(pa.int64())), "rows": pa.array([rows[order].tolist()], pa.list_(pa.int64())),
                     "width": pa.array([values.shape[1]], pa.int32()), "kind": [kind],
                     "vecs": pa.array([values.astype(kind).tobytes()], pa.binary()), "norm": [norm]})


def _matrix(table: pa.Table) -> np.ndarray:
    """Components of a block as doubles."""
    width, kind = table["width"][0].as_py(), table["kind"][0].as_py()
    n = len(table["rows"][0])
    return np.frombuffer(table["vecs"][0].as_py(), kind).reshape(n, width).astype(float)


def candidate_blocks(rows: DataFrame, blocks: int) -> DataFrame:
    """Whole numbers of all rows, dealt into blocks."""

    def pack(key: tuple, group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        vecs = group["vec"].combine_chunks()
        sizes = np.diff(vecs.offsets.to_numpy())
        flat = np.floor(SCALE * vecs.flatten().to_numpy())
        wide = int(sizes.max(initial=0))
        values = np.zeros((len(sizes), max(wide, 1)))
        values[:, :wide][np.arange(wide) < sizes[:, None]] = flat
        return _packed(key[0].as_py(), group["id"].combine_chunks(), group["row"].to_numpy(), values)

    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block")
    return rows.select(block, "row", "id", "vec").groupBy("block").applyInArrow(pack, BLOCK_SCHEMA)


def query_blocks(candidates: DataFrame, every: int, blocks: int) -> DataFrame:
    """The rows whose id is divisible by ``every``, out of the candidate blocks into blocks of their own."""

    def pick(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                table = pa.Table.from_batches([batch.slice(i, 1)])
                ids = table["ids"][0].values
                at = np.flatnonzero(ids.is_valid().to_numpy(zero_copy_only=False) & (
                    ids.fill_null(1).to_numpy() % every == 0))
                vecs = _matrix(table)[at]
                yield pa.RecordBatch.from_arrays(
                    [table["rows"][0].values.take(pa.array(at)), ids.take(pa.array(at)), pa.array(list(vecs), pa.list_(pa.float64()))],
                    ["row", "id", "vec"])

    def pack(key: tuple, group: pa.Table) -> pa.Table:
        vecs = group["vec"].to_pylist()
        wide = max(map(len, vecs))
        values = np.array([v + [0.0] * (wide - len(v)) for v in vecs])
        return _packed(key[0].as_py(), group["id"].combine_chunks(), group["row"].to_numpy(), values)

    found = candidates.mapInArrow(pick, "row long, id long, vec array<double>")
    block = F.pmod(F.xxhash64(F.lit(2), "row"), F.lit(blocks)).alias("block")
    return found.select(block, "row", "id", "vec").groupBy("block").applyInArrow(pack, BLOCK_SCHEMA)


def exact_scores(queries: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Whole-number inner products, saturated; only pairs that floating point can't hold are done one by one."""
    wide = min(queries.shape[1], base.shape[1])
    q, b = queries[:, :wide], base[:, :wide]
    qn, bn = np.sqrt((q ** 2).sum(axis=1)), np.sqrt((b ** 2).sum(axis=1))
    if qn.max(initial=0.0) * bn.max(initial=0.0) < _EXACT:
        return (q @ b.T).astype(np.int64)
    with np.errstate(all="ignore"):
        out = np.nan_to_num(q @ b.T).clip(-_EXACT, _EXACT).astype(np.int64)
        large = ~(qn[:, None] * bn < _EXACT)
    whole = np.vectorize(int, otypes=[object])
    for i in np.flatnonzero(large.any(axis=1)):
        at = np.flatnonzero(large[i])
        sums = (whole(b[at]) * whole(q[i])).sum(axis=1)
        out[i, at] = [min(max(int(s), -LIMIT), LIMIT - 1) for s in sums]
    return out


def _slices(left: pa.Table, right: pa.Table, bits: int):
    """(first query, keys, own) over slices of queries; a key is a score moved above zero, an own row has -1."""
    base, queries = _matrix(left), _matrix(right)
    rows = left["rows"][0].values.to_numpy()
    asked = right["rows"][0].values.to_numpy()
    by_row = np.argsort(rows)
    at = by_row[np.minimum(np.searchsorted(rows, asked, sorter=by_row), len(rows) - 1)]
    own = np.where(rows[at] == asked, at, -1)
    step = max(1, SLICE_SCORES // len(rows))
    for lo in range(0, len(asked), step):
        keys = exact_scores(queries[lo:lo + step], base) + (1 << (bits - 1))
        here = own[lo:lo + step]
        keys[np.flatnonzero(here >= 0), here[here >= 0]] = -1
        yield lo, keys


def _next_digits(bits: int, high: int, low: int):
    """Counts of the bits from ``low`` up to ``high`` among the keys that share the query's leading bits."""
    size = 1 << (high - low)

    def run(_, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            lead, need = (right[c][0].values.to_numpy() for c in ("lead", "need"))
            for lo, keys in _slices(left, right, bits):
                mine, wanted = lead[lo:lo + len(keys), None], need[lo:lo + len(keys), None]
                digit = (keys >> low) - (mine << (high - low))
                ok = (digit >= 0) & (digit < size) & (keys >= 0)
                cell = digit + np.arange(len(keys))[:, None] * size
                counts = np.bincount(cell[ok], minlength=len(keys) * size).reshape(len(keys), size)
                above = counts[:, ::-1].cumsum(axis=1)[:, ::-1] - counts
                q, d = np.nonzero((counts > 0) & (above < wanted))
                out.append((lo + q, (mine[q, 0] << (high - low)) + d, counts[q, d], wanted[q, 0]))
        block = right["block"][0].as_py() if right.num_rows else 0
        at, cell, n, need = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 4
        return pa.table({"qb": pa.array(np.full(len(at), block), pa.int64()), "at": pa.array(at, pa.int64()),
                         "lead": pa.array(cell, pa.int64()), "n": pa.array(n, pa.int64()), "need": pa.array(need, pa.int64())})
    return run


def _let_through(bits: int):
    """Scores above a query's k-th, and of those equal to it the first of the block as far as wanted."""
    def run(_, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            lead, need = (right[c][0].values.to_numpy() for c in ("lead", "need"))
            for lo, keys in _slices(left, right, bits):
                mine = lead[lo:lo + len(keys), None]
                ties = keys == mine
                q, c = np.nonzero((keys > mine) | ties & (ties.cumsum(axis=1) <= need[lo:lo + len(keys), None]))
                out.append((lo + q, c, keys[q, c] - (1 << (bits - 1))))
        if not out:
            return pa.table({x: pa.array([], pa.int64()) for x in ("query_row", "query_id", "row", "vec_id", "score")})
        q, c, score = (np.concatenate(x) for x in zip(*out, strict=True))
        q, c = pa.array(q), pa.array(c)
        return pa.table({
            "query_row": right["rows"][0].values.take(q), "query_id": right["ids"][0].values.take(q),
            "row": left["rows"][0].values.take(c), "vec_id": left["ids"][0].values.take(c), "score": pa.array(score)})
    return run


def _pairs(candidates: DataFrame, queries: DataFrame, blocks: tuple[int, int], run, schema: str) -> DataFrame:
    """``run`` over every pair of a candidate block and a query block, one pair at a time."""
    each = [F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))) for n in blocks]
    left = candidates.select("*", F.col("block").alias("c"), each[1].alias("q"))
    right = queries.select("*", F.col("block").alias("q"), each[0].alias("c"))
    return left.groupBy("c", "q").cogroup(right.groupBy("c", "q")).applyInArrow(run, schema)


def _with_state(queries: DataFrame, state: DataFrame) -> DataFrame:
    """Query blocks with the known leading bits and the number still wanted of each query, in block order."""
    lists = state.groupBy("qb").agg(F.array_sort(F.collect_list(F.struct("at", "lead", "need"))).alias("s"))
    return queries.join(lists, queries["block"] == lists["qb"]).select(
        *queries.columns, F.col("s.lead").alias("lead"), F.col("s.need").alias("need"))


def search(vectors: DataFrame, k: int, every: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of every query among all other rows."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vec_col)
    n, n_queries, width = rows.agg(
        F.count(F.lit(1)), F.count(F.when(F.col("id") % every == 0, 1)), F.max(F.size("vec"))).first()
    wanted = min(k, n - 1)
    if wanted < 1 or not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    blocks = _n_blocks(n, width), _n_blocks(n_queries, width)
    candidates = stored(candidate_blocks(rows, blocks[0]), "topk-candidates")
    queries = stored(query_blocks(candidates, every, blocks[1]), "topk-queries")
    reach = [df.agg(F.max("norm")).first()[0] for df in (candidates, queries)]
    largest = min(reach[0] * reach[1] * 1.001 + 1, float(LIMIT))
    bits = min(63, math.ceil(math.log2(largest)) + 1)
    rounds = math.ceil(bits / DIGIT_BITS)
    cuts = [bits - bits * r // rounds for r in range(rounds + 1)]
    state = queries.select(F.col("block").alias("qb"), F.posexplode("rows").alias("at", "_row")).select(
        "qb", "at", F.lit(0).cast("bigint").alias("lead"), F.lit(wanted).cast("bigint").alias("need"))
    for high, low in zip(cuts, cuts[1:], strict=False):
        found = _pairs(candidates, _with_state(queries, state), blocks, _next_digits(bits, high, low),
                       "qb long, at long, lead long, n long, need long")
        summed = found.groupBy("qb", "at", "lead").agg(F.sum("n").alias("n"), F.min("need").alias("need"))
        upto = F.sum("n").over(Window.partitionBy("qb", "at").orderBy(F.desc("lead")))     # at most 2 ** DIGIT_BITS rows
        state = stored(summed.withColumn("_upto", upto).filter(
            (F.col("_upto") >= F.col("need")) & (F.col("_upto") - F.col("n") < F.col("need"))).select(
            "qb", "at", "lead", (F.col("need") - F.col("_upto") + F.col("n")).alias("need")), "topk-state")
    best = _pairs(candidates, _with_state(queries, state), blocks, _let_through(bits),
                  "query_row long, query_id long, row long, vec_id long, score long")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= wanted).select(
        "query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    """op13: the 5 best of every 50th vector among all vectors."""
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"), k=5, every=50)


ORACLE_SQL = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

"""Approximate nearest neighbours through learned partitions.

``fit`` takes a bounded sample (``SAMPLE`` vectors), builds its exact neighbour graph,
cuts the graph into balanced parts (recursive median bisection, then moves of border nodes
to the part most of their neighbours are in, within a capacity), and trains a small
classifier to predict, for a vector, how its neighbours spread over the parts. It then
sets the number of probed parts so that the sample's own searches reach ``TARGET``
recall. ``assign`` puts every row of the table into its most probable part; ``search``
routes each query to its most probable parts and reranks all rows there by exact
distance in double precision, in blocks of bounded size; the best of the blocks are
merged by a window per query. A query whose probed parts hold fewer candidates than asked
for goes on to all the others, so that fewer are returned only where there are fewer.

Edge cases: vectors that are null, all zero, hold a null or non-finite component or
have another length than most take no part; rows that repeat an id are one vector each
and may both be found; equal distances go to the smaller id; fewer candidates than
asked for are all returned; an empty table gives an empty result; other columns are
passed by.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SAMPLE = 8192           # bound of the vectors the index is fitted on (a quarter more at most)
PARTS = 64
NEIGHBOURS = 16
HIDDEN = 128
TARGET = 0.95           # recall on held-back sample searches that sets the number of probed parts
BLOCK = 32768           # candidates of one part per block
QUERY_BLOCK = 65536     # queries per block
SEED = 7


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) of the rows that take part, as arrays of double."""
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.coalesce(finite, F.lit(False)) & F.exists("vec", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return rows.filter(F.size("vec") == (sizes[0]["d"] if sizes else -1))


def _nearest(queries: np.ndarray, base: np.ndarray, k: int, skip_self: bool = False) -> np.ndarray:
    """Rows of ``base`` nearest to each query, in blocks."""
    norms = (base ** 2).sum(axis=1)
    out = []
    for lo in range(0, len(queries), 1024):
        q = queries[lo:lo + 1024]
        d = norms - 2.0 * (q @ base.T)
        if skip_self:
            d[np.arange(len(q)), lo + np.arange(len(q))] = np.inf
        near = np.argpartition(d, min(k, d.shape[1]) - 1, axis=1)[:, :k]
        out.append(near)
    return np.concatenate(out)


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12, slack: float = 1.15) -> np.ndarray:
    """Part of each node: median bisection along the widest direction, then neighbour-majority moves."""
    rng = np.random.default_rng(SEED)
    label = np.zeros(len(x), np.int64)
    groups, count = [np.arange(len(x))], 1
    while count < parts:
        nxt = []
        for g in groups:
            c = x[g] - x[g].mean(axis=0)
            v = rng.normal(size=x.shape[1])
            for _ in range(8):
                v = c.T @ (c @ v)
                v /= np.linalg.norm(v) or 1.0
            order = np.argsort(c @ v, kind="stable")
            nxt += [g[order[:len(g) // 2]], g[order[len(g) // 2:]]]
        groups, count = nxt, count * 2
    for i, g in enumerate(groups):
        label[g] = i
    cap = int(slack * len(x) / count) + 1
    for _ in range(rounds):
        votes = np.zeros((len(x), count), np.int32)
        for j in range(graph.shape[1]):
            np.add.at(votes, (np.arange(len(x)), label[graph[:, j]]), 1)
        np.add.at(votes, (graph.ravel(), np.repeat(label, graph.shape[1])), 1)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(len(x)), best] - votes[np.arange(len(x)), label]
        size = np.bincount(label, minlength=count)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[best[i]] < cap:
                size[label[i]] -= 1
                size[best[i]] += 1
                label[i] = best[i]
                moved += 1
        if not moved:
            break
    return label


@dataclass
class Index:
    weights: tuple[np.ndarray, ...]     # two layers and their biases
    probes: int

    def chances(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.maximum(x @ w1 + b1, 0.0) @ w2 + b2

    def routes(self, x: np.ndarray) -> np.ndarray:
        """Most probable parts of each vector, best first."""
        return np.argsort(-self.chances(x), axis=1, kind="stable")


def train_router(x: np.ndarray, spread: np.ndarray, epochs: int = 60, batch: int = 512, rate: float = 3e-3) -> tuple:
    """Two-layer softmax classifier for the part distribution of each vector's neighbours (Adam)."""
    rng = np.random.default_rng(SEED)
    d, p = x.shape[1], spread.shape[1]
    w = [rng.normal(size=(d, HIDDEN)) * np.sqrt(2.0 / d), np.zeros(HIDDEN),
         rng.normal(size=(HIDDEN, p)) * np.sqrt(1.0 / HIDDEN), np.zeros(p)]
    m, v, t = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for lo in range(0, len(x), batch):
            i = order[lo:lo + batch]
            h = np.maximum(x[i] @ w[0] + w[1], 0.0)
            z = h @ w[2] + w[3]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            e = (z / z.sum(axis=1, keepdims=True) - spread[i]) / len(i)
            back = (e @ w[2].T) * (h > 0)
            grads = [x[i].T @ back, back.sum(axis=0), h.T @ e, e.sum(axis=0)]
            t += 1
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                w[k] = w[k] - rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
    return tuple(w)


def fit_sample(x: np.ndarray, parts: int = PARTS, target: float = TARGET) -> Index:
    """Index from sample vectors; too few of them make a single part."""
    if len(x) < 4 * parts:
        d = x.shape[1] if x.ndim == 2 and len(x) else 1
        return Index((np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)), 1)
    center, scale = x.mean(axis=0), x.std() or 1.0
    z = (x - center) / scale
    # three quarters teach, a quarter of held-back searches sets the number of probes
    teach = np.arange(len(x)) % 4 != 3
    base, asked = z[teach], z[~teach]
    graph = _nearest(base, base, NEIGHBOURS, skip_self=True)
    label = balanced_parts(base, graph, parts)
    count = label.max() + 1
    spread = np.zeros((len(base), count))
    for j in range(graph.shape[1]):
        spread[np.arange(len(base)), label[graph[:, j]]] += 1.0
    spread[np.arange(len(base)), label] += 4.0
    w1, b1, w2, b2 = train_router(base, spread / spread.sum(axis=1, keepdims=True))
    index = Index((w1 / scale, b1 - (center / scale) @ w1, w2, b2), count)
    own = index.routes(x[teach])[:, 0]
    routes = index.routes(x[~teach])
    true = own[_nearest(asked, base, 10)]
    rank = np.zeros_like(routes)
    np.put_along_axis(rank, routes, np.arange(count)[None, :].repeat(len(routes), 0), axis=1)
    ranks = np.take_along_axis(rank, true, axis=1)
    for probes in range(1, count + 1):
        if (ranks < probes).mean() >= target:
            break
    index.probes = probes
    return index


def fit(rows: DataFrame, sample: int = SAMPLE, parts: int = PARTS) -> Index:
    total = rows.count()
    share = min(1.0, sample / max(total, 1))
    chosen = rows.filter(F.pmod(F.xxhash64(F.lit(SEED), "id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    got = chosen.orderBy("id").limit(sample * 5 // 4).select("vec").toPandas()["vec"]
    return fit_sample(np.vstack(got) if len(got) else np.zeros((0, 1)), parts)


def assign(rows: DataFrame, index: Index, probes: int | None = 1, skip: int = 0) -> DataFrame:
    """(id, vec, part) with the ``probes`` most probable parts of each row (None: all), the first ``skip`` left out."""
    held = rows.sparkSession.sparkContext.broadcast(index)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vecs = batch.column(1)
            x = vecs.flatten().to_numpy().reshape(batch.num_rows, -1)
            parts = held.value.routes(x)[:, skip:probes]
            at = pa.array(np.repeat(np.arange(batch.num_rows), parts.shape[1]))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), vecs.take(at),
                                              pa.array(parts.ravel().astype(np.int32))], ["id", "vec", "part"])

    return rows.select("id", "vec").mapInArrow(route, "id long, vec array<double>, part int")


def _best_of_block(k: int):
    def run(_, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            ids = left["id"].to_numpy()
            order = np.argsort(ids, kind="stable")
            ids, base = ids[order], np.vstack(left["vec"].to_numpy()[order])
            norms = (base ** 2).sum(axis=1)
            for lo in range(0, len(right), 256):
                part = right.iloc[lo:lo + 256]
                q, qid = np.vstack(part["vec"].to_numpy()), part["id"].to_numpy()
                rough = norms - 2.0 * (q @ base.T)
                for i in range(len(q)):
                    own = ids == qid[i]
                    rough[i, own] = np.inf
                    n = len(ids) - int(own.sum())
                    if not n:
                        continue
                    # everything near the k-th rough distance is measured exactly, ties included
                    limit = np.partition(rough[i], min(k, n) - 1)[min(k, n) - 1]
                    room = 1e-9 * (abs(limit) + norms.max() + 1.0)
                    near = np.flatnonzero((rough[i] <= limit + room) & ~own)
                    exact = np.sqrt(((base[near] - q[i]) ** 2).sum(axis=1))
                    top = np.argsort(exact, kind="stable")[:k]
                    out.append(pd.DataFrame({"query_id": qid[i], "vec_id": ids[near[top]], "score": exact[top]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"})
    return run


def _met(placed: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): the best ``k`` of every block that a query meets in its parts."""
    counts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    asks = asked.groupBy("part").agg(F.count(F.lit(1)).alias("m"))
    blocks = counts.join(asks, "part").select(
        "part", F.ceil(F.col("n") / BLOCK).cast("int").alias("cs"), F.ceil(F.col("m") / QUERY_BLOCK).cast("int").alias("qs"))
    blocks = F.broadcast(blocks)        # a row per part
    left = placed.join(blocks, "part").select(
        "part", F.pmod(F.xxhash64("id"), F.col("cs")).cast("int").alias("c"),
        F.explode(F.sequence(F.lit(0), F.col("qs") - 1)).alias("q"), "id", "vec")
    right = asked.join(blocks, "part").select(
        "part", F.explode(F.sequence(F.lit(0), F.col("cs") - 1)).alias("c"),
        F.pmod(F.xxhash64(F.lit(2), "id"), F.col("qs")).cast("int").alias("q"), "id", "vec")
    return left.groupBy("part", "c", "q").cogroup(right.groupBy("part", "c", "q")).applyInPandas(
        _best_of_block(k), "query_id long, vec_id long, score double")


def search(rows: DataFrame, queries: DataFrame, index: Index, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found per query, the query's own id left out."""
    placed = stored(assign(rows, index), "index-parts")
    found = _met(placed, stored(assign(queries, index, index.probes), "index-queries"), k)
    if index.probes < index.weights[3].size:
        found = stored(found, "index-found")
        have = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("have"))
        short = queries.select("id", "vec").join(have, F.col("id") == F.col("query_id"), "left").filter(
            F.coalesce("have", F.lit(0)) < k)
        more = stored(assign(short, index, None, index.probes), "index-short")
        if not more.isEmpty():
            found = found.unionByName(_met(placed, more, k))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    """op8: the 10 nearest of every 100th vector among all vectors."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    rows = stored(usable(vectors, "vec_id", "embedding"), "index-rows")
    return search(rows, rows.filter(F.col("id") % 100 == 0), fit(rows))

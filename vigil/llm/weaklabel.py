"""Quality classifier from weak labels.

``LABELLERS`` are overlapping heuristics over whole texts; each votes good, bad or
nothing. Spark counts the vote patterns of all documents (at most 3 ** labellers
rows), expectation-maximisation over one good class and one bad class per group of
labellers that agree estimates how often each labeller is right and gives every pattern a
posterior, and the posteriors of a bounded sample
(``FIT_ROWS`` documents, those with the smallest id hashes) train a linear scorer
over hashed features. The scorer then judges every document from its text alone.

Edge cases: null, empty and word-free texts are bad (posterior and score 0);
repeated rows are judged alike; a table in which no document or only one class
turns up gives each document its pattern's posterior as score; an empty table gives
an empty result; other columns are passed by.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chargrams import code_points, gram_buckets, segment_sums
from .common import packed, stored, text_batches, text_slices, with_fields, word_hashes, word_spans

FIT_ROWS = 8192                 # bound of the sample the linear scorer is fitted on
BLOCK_ROWS = 256                # rows of that sample whose sums are worked out at a time
BUCKETS = 1 << 13
STAT_BINS = 12
SCALE = 24.0                    # conditioning of the frequency features
TOGETHER = 0.4                  # share of common bad votes that puts two labellers into one group
STATS = ("symbols", "capitals", "shouts", "repeats", "short_words", "line_ends", "word_length")
#: (statistic, bad from, good below) or, where a low value is bad, (statistic, bad below, good from)
LABELLERS = (
    ("symbols", 0.15, 0.02, "high"), ("capitals", 0.40, 0.20, "high"), ("shouts", 0.30, 0.05, "high"),
    ("repeats", 0.40, 0.15, "high"), ("short_words", 0.06, 0.14, "low"), ("line_ends", 0.50, 0.90, "low"),
    ("word_length", 8.5, 6.5, "high"),
)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_END = np.zeros(256, bool)
_END[list(b".!?:;\"')")] = True


def statistics(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(texts x STATS) and the number of words per text."""
    starts, ends, first = word_spans(raw, offsets)
    n_texts = len(offsets) - 1
    words = np.diff(first)
    per_repeat = np.maximum(words - 2, 1)
    running = {k: np.concatenate([[0], np.cumsum(v, dtype=np.int64)]) for k, v in {
        "symbols": _SYMBOL[raw], "upper": (raw >= 65) & (raw <= 90), "shouts": raw == 33,
        "letters": ((raw | 32) >= 97) & ((raw | 32) <= 122) | (raw >= 0xC0), "chars": (raw & 0xC0) != 0x80}.items()}
    of = {k: v[offsets[1:]] - v[offsets[:-1]] for k, v in running.items()}
    letters = running["letters"][ends] - running["letters"][starts]
    real = letters > 0
    short = np.concatenate([[0], np.cumsum(real & (letters <= 3))])
    reals = np.concatenate([[0], np.cumsum(real)])
    in_words = np.concatenate([[0], np.cumsum(letters)])
    n_real = reals[first[1:]] - reals[first[:-1]]
    # share of three-word windows that the same text has already had
    windows = np.zeros(0, np.uint64)
    repeats = np.zeros(n_texts)
    if len(starts):
        h = word_hashes(raw, starts, ends)
        with np.errstate(over="ignore"):
            windows = h.copy()
            windows[:-1] += h[1:] * np.uint64(0x9E3779B97F4A7C15)
            windows[:-2] += h[2:] * np.uint64(0xD1342543DE82EF95)
        owner = np.repeat(np.arange(n_texts), words)
        room = np.arange(len(starts)) + 2 < np.repeat(first[1:], words)
        order = np.lexsort((windows[room], owner[room]))
        o, w = owner[room][order], windows[room][order]
        again = np.zeros(len(o), bool)
        again[1:] = (o[1:] == o[:-1]) & (w[1:] == w[:-1])
        repeats = np.bincount(o[again], minlength=n_texts) / per_repeat
    # lines with a word that end in closing punctuation: a word before a line break or a text's end
    nl = np.concatenate([[0], np.cumsum(raw == 10)])
    last = np.zeros(len(starts), bool)
    if len(starts):
        nxt = np.append(starts[1:], len(raw))
        last = nl[np.minimum(nxt, len(raw))] > nl[ends]
        last[first[1:][words > 0] - 1] = True
    closed = np.concatenate([[0], np.cumsum(last & _END[raw[ends - 1]] if len(starts) else last)])
    lines = np.concatenate([[0], np.cumsum(last)])
    n_lines = lines[first[1:]] - lines[first[:-1]]
    # shares lean on a few words of plain prose, so that short texts are not judged by one word
    table = np.column_stack([
        of["symbols"] / (words + 4), of["upper"] / (of["letters"] + 24), of["shouts"] / (words + 4),
        repeats * per_repeat / (per_repeat + 6),
        (short[first[1:]] - short[first[:-1]] + 2.4) / (n_real + 8),
        (closed[first[1:]] - closed[first[:-1]] + 1) / (n_lines + 1),
        (in_words[first[1:]] - in_words[first[:-1]] + 40) / (n_real + 8)])
    return table, words


def votes(table: np.ndarray) -> np.ndarray:
    """(texts x labellers): 1 good, 2 bad, 0 no vote."""
    out = np.zeros((len(table), len(LABELLERS)), np.int64)
    for j, (name, bad, good, side) in enumerate(LABELLERS):
        x = table[:, STATS.index(name)]
        out[:, j] = np.where(x >= bad, 2, np.where(x < good, 1, 0)) if side == "high" else np.where(
            x < bad, 2, np.where(x >= good, 1, 0))
    return out


def pattern_numbers(vote: np.ndarray, words: np.ndarray) -> np.ndarray:
    """One number per vote pattern; -1 where there is no word to judge."""
    return np.where(words > 0, vote @ (3 ** np.arange(vote.shape[1])), -1)


def _unpack(numbers: np.ndarray) -> np.ndarray:
    return numbers[:, None] // (3 ** np.arange(len(LABELLERS))) % 3


@dataclass
class WeakLabels:
    posterior: dict[int, float]     # pattern -> probability of a good document
    accuracy: list[float]           # per labeller, of the votes it gives
    share_good: float


def reasons(bad: np.ndarray, voted: np.ndarray, weight: np.ndarray) -> list[list[int]]:
    """Groups of labellers that tend to say bad of the same documents.

    Two labellers are grouped when, where both vote, ``TOGETHER`` of the rarer one's bad votes
    meet one of the other; groups are the connected sets. Junk comes in kinds (shouting, symbols,
    one word over and over), and the labellers of one kind say nothing about another.
    """
    k = bad.shape[1]
    groups = [{j} for j in range(k) if (weight @ bad[:, j]) > 0]
    for i in range(k):
        for j in range(i):
            both = voted[:, i] & voted[:, j]
            rarer = min(weight @ (bad[:, i] & both), weight @ (bad[:, j] & both))
            if rarer > 0 and weight @ (bad[:, i] & bad[:, j]) >= TOGETHER * rarer:
                met = [g for g in groups if i in g or j in g]
                groups = [g for g in groups if g not in met] + [set().union(*met)]
    return sorted(sorted(g) for g in groups) or [list(range(k))]


def expectation_maximisation(numbers: np.ndarray, counts: np.ndarray, rounds: int = 50) -> WeakLabels:
    """Class share and vote tables per labeller from pattern counts (smoothed, started at the majority).

    One class of good documents and one of bad ones per group of ``reasons``: with a single bad class,
    votes that most bad documents share would outweigh the bad votes of a rarer kind of junk.
    """
    seen = numbers >= 0
    vote, weight = _unpack(numbers[seen]), counts[seen].astype(float)
    good, bad = vote == 1, vote == 2
    k = vote.shape[1]
    groups = reasons(bad, vote > 0, weight)
    n_bad = bad.sum(axis=1)
    q = np.where(n_bad > 0, np.where(good.sum(axis=1) > 2 * n_bad, 0.6, 0.1), 0.95)
    by_group = np.column_stack([bad[:, g].sum(axis=1) for g in groups]).astype(float)
    by_group[n_bad == 0] = 1.0
    part = np.column_stack([q, (1 - q)[:, None] * by_group / by_group.sum(axis=1, keepdims=True)])
    share = np.full(len(groups) + 1, 0.5)
    for _ in range(rounds if len(q) else 0):
        share = weight @ part + 1.0
        share /= share.sum()
        tables = np.stack([(weight[:, None] * part).T @ (vote == v) + (0.5 if v else 0.1) for v in range(3)], axis=2)
        tables /= tables.sum(axis=2, keepdims=True)
        logs = np.log(tables)[:, np.arange(k), vote].sum(axis=2).T + np.log(share)
        part = np.exp(logs - logs.max(axis=1, keepdims=True))
        part /= part.sum(axis=1, keepdims=True)
    q = part[:, 0]
    right = [float((weight @ (good[:, j] * q + bad[:, j] * (1 - q))) / max(weight @ (vote[:, j] > 0), 1e-9))
             for j in range(k)]
    posterior = dict(zip(numbers[seen].tolist(), q.tolist(), strict=True))
    posterior[-1] = 0.0
    return WeakLabels(posterior, right, float(share[0]))


def _hashed(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Character-window buckets with their ranges, and the (texts x stats) buckets of binned statistics."""
    points, bounds = code_points(raw, offsets)
    grams, ranges = gram_buckets(points, bounds, 3, BUCKETS)
    bins = np.minimum((np.sqrt(np.maximum(table, 0.0)) * 6).astype(np.int64), STAT_BINS - 1)
    return grams, ranges, BUCKETS + np.arange(len(STATS)) * STAT_BINS + bins


N_FEATURES = BUCKETS + len(STATS) * STAT_BINS


def _sparse(grams: np.ndarray, stat: np.ndarray) -> bytes:
    """A text's features: float32 frequencies of its buckets and ones for its statistic bins."""
    at, n = np.unique(grams, return_counts=True)
    index = np.concatenate([at, stat]).astype(np.int32)
    value = np.concatenate([n * (SCALE / max(len(grams), 1)), np.ones(len(stat))]).astype(np.float32)
    return index.tobytes() + value.tobytes()


def fit_linear(blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray]], target: np.ndarray, rounds: int = 150,
               step: float = 0.5, ridge: float = 1e-5) -> np.ndarray:
    """Logistic regression on soft targets, full-batch Adagrad; the last weight is the bias.

    ``blocks`` are (features per row, buckets, values) of ``BLOCK_ROWS`` rows each, in the order of
    ``target``; what is worked out beside them is only as long as one block. Sums run over all rows in
    that order, so the weights do not depend on where blocks end.
    """
    w, seen = np.zeros(N_FEATURES + 1), np.full(N_FEATURES + 1, 1e-8)
    balance = np.where(target >= 0.5, 0.5 / max((target >= 0.5).mean(), 1e-9), 0.5 / max((target < 0.5).mean(), 1e-9))
    for _ in range(rounds):
        error, slope, lo = np.zeros(len(target)), np.zeros(N_FEATURES), 0
        for sizes, col, val in blocks:
            hi = lo + len(sizes)
            at, row = col.astype(np.intp), np.repeat(np.arange(len(sizes)), sizes)
            z = np.bincount(row, val * w[at], len(sizes)) + w[-1]
            error[lo:hi] = (1.0 / (1.0 + np.exp(-np.clip(z, -60, 60))) - target[lo:hi]) * balance[lo:hi]
            np.add.at(slope, at, val * error[lo:hi][row])
            lo = hi
        g = np.append(slope, error.sum()) / len(target) + ridge * w
        seen += g * g
        w -= step * g / np.sqrt(seen)
    return w


def feature_blocks(rows: Iterable[tuple[int, bytes]]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Patterns of (pattern, features) rows, and the features as the blocks of ``fit_linear``.

    Rows are taken one by one; of each only its numbers stay, six bytes for a bucket and its value.
    """
    patterns, blocks = [], []
    rows = iter(rows)
    while some := list(islice(rows, BLOCK_ROWS)):
        patterns += [p for p, _ in some]
        halves = [(memoryview(f)[:len(f) // 2], memoryview(f)[len(f) // 2:]) for _, f in some]
        blocks.append((np.array([len(a) // 4 for a, _ in halves]),
                       np.concatenate([np.frombuffer(a, np.int32) for a, _ in halves]).astype(np.uint16),
                       np.concatenate([np.frombuffer(b, np.float32) for _, b in halves])))
    return np.array(patterns, np.int64), blocks


@dataclass
class Scorer:
    labels: WeakLabels
    weights: np.ndarray | None


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_rows: int = FIT_ROWS) -> Scorer:
    """Vote patterns over all rows, EM, and the linear scorer from the bounded sample."""
    text_batches(docs.sparkSession)
    total = docs.count()
    share = min(1.0, fit_rows / max(total, 1))
    chosen = F.pmod(F.xxhash64(F.lit(5), F.col(id_col)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in batches:
            use = batch.column(1).to_numpy(zero_copy_only=False)
            numbers, rows = [], []
            for lo, hi, raw, offsets in text_slices(batch.column(0)):
                table, words = statistics(raw, offsets)
                own = pattern_numbers(votes(table), words)
                for k, n in zip(*np.unique(own, return_counts=True), strict=True):
                    seen[int(k)] = seen.get(int(k), 0) + int(n)
                pick = np.flatnonzero(use[lo:hi] & (own >= 0))
                if len(pick):
                    grams, ranges, stat = _hashed(raw, offsets, table)
                    for i in pick:
                        numbers.append(int(own[i]))
                        rows.append(_sparse(grams[ranges[i]:ranges[i + 1]], stat[i]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array([1] * len(rows), pa.int64()),
                                                  pa.array(rows, pa.binary())], ["pattern", "n", "features"])
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64()),
                 pa.nulls(len(seen), pa.binary())], ["pattern", "n", "features"])

    looked = stored(docs.select(F.col(text_col).alias("t"), chosen.alias("use")).mapInArrow(
        look, "pattern long, n long, features binary"), "weak-votes")
    counts = looked.filter(F.col("features").isNull()).groupBy("pattern").agg(F.sum("n").alias("n")).toPandas()
    labels = expectation_maximisation(counts["pattern"].to_numpy(np.int64), counts["n"].to_numpy(np.int64))
    # the sample holds about fit_rows rows in expectation; a quarter more is the hard bound
    sample = looked.filter(F.col("features").isNotNull()).select("pattern", "features").toLocalIterator()
    patterns, blocks = feature_blocks(islice(sample, fit_rows * 5 // 4))
    target = np.array([labels.posterior[p] for p in patterns.tolist()])
    if not len(target) or target.min() >= 0.5 or target.max() < 0.5:
        return Scorer(labels, None)
    return Scorer(labels, fit_linear(blocks, target))


def judge(docs: DataFrame, scorer: Scorer, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``posterior`` of the votes, ``score`` of the linear model, per row."""
    text_batches(docs.sparkSession)
    posterior, weights = scorer.labels.posterior, scorer.weights
    source = docs.select(F.col(text_col).alias("_text"), *keep)
    schema = with_fields(source.drop("_text").schema, posterior="double", score="double")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weak, final = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            for lo, hi, raw, offsets in text_slices(batch.column(0)):
                table, words = statistics(raw, offsets)
                numbers = pattern_numbers(votes(table), words)
                weak[lo:hi] = [posterior.get(k, 0.0) for k in numbers.tolist()]
                if weights is None:
                    final[lo:hi] = weak[lo:hi]
                    continue
                grams, ranges, stat = _hashed(raw, offsets, table)
                z = segment_sums(weights[grams], ranges) * (SCALE / np.maximum(np.diff(ranges), 1))
                z += weights[stat].sum(axis=1) + weights[-1]
                final[lo:hi] = np.where(words > 0, 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60))), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(weak), pa.array(final)],
                                             [*batch.schema.names[1:], "posterior", "score"])

    return source.mapInArrow(score, schema)


def query(spark, sf_dir: str) -> DataFrame:
    """op5: (doc_id, posterior, score, kept) over all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return judge(docs, fit(docs)).withColumn("kept", F.col("score") >= 0.5)


def accept(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """Rows of ``docs`` that the scorer judges good; the others go."""
    told = judge(packed(docs, text=docs["text"]), fit(docs.select("doc_id", "text")), keep=("row",))
    return told.filter(F.col("score") >= min_score).select("row.*")

"""Language identification: multinomial naive Bayes over hashed character windows.

``train`` counts the windows of one to three characters of every labelled text in
``BUCKETS`` hash buckets per language (summed inside each task, then by Spark) and
returns the matrix of log-probabilities. ``predict`` broadcasts the matrix with the
tasks (languages x buckets doubles; ``MAX_LANGS`` bounds it) and scores batches.

Edge cases: a null text and a text without a letter get ``und`` with score 0, as
does every text when no labelled row exists; null labels teach nothing; rows that
repeat are scored alike; ties go to the language first in code-point order; an
empty table gives an empty result; other columns are passed by.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .chargrams import code_points, fold_letters, gram_buckets, segment_sums
from .common import packed, text_batches, text_slices, with_fields

ORDERS = (1, 2, 3)
BUCKETS = 1 << 15
MAX_LANGS = 512          # 512 x 32768 doubles = 128 MB; a larger label set is refused
SMOOTHING = 0.1
UNKNOWN = "und"


@dataclass
class Model:
    langs: list[str]
    log_prob: np.ndarray        # buckets x languages
    log_prior: np.ndarray


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def held_out(doc_id: Column) -> Column:
    """Rows that training leaves out (a null id is not one of them, but teaches nothing either)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(rows: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Model from all rows with a label; counts are exact whatever the partitioning."""
    text_batches(rows.sparkSession)
    rows = rows.filter(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.when(has_letter(F.col(text_col)), F.col(text_col)).alias("text"))
    per_lang = sorted((r["lang"], r["n"]) for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
                      .limit(MAX_LANGS + 1).collect())
    if len(per_lang) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} labels")
    langs = [x for x, _ in per_lang]
    number = {x: i for i, x in enumerate(langs)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(langs) * BUCKETS, np.int64)
        for batch in batches:
            lang = np.array([number[x] for x in batch.column(0).to_pylist()], np.int64)
            for lo, hi, raw, offsets in text_slices(batch.column(1)):
                points, bounds = code_points(raw, offsets)
                points = fold_letters(points)
                for order in ORDERS:
                    grams, ranges = gram_buckets(points, bounds, order, BUCKETS)
                    total += np.bincount(np.repeat(lang[lo:hi] * BUCKETS, np.diff(ranges)) + grams,
                                         minlength=len(total))
        at = np.flatnonzero(total)
        for k in range(0, len(at), 65536):
            part = at[k:k + 65536]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], ["cell", "n"])

    counts = np.zeros(len(langs) * BUCKETS)
    if langs:
        cells = rows.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
        counts[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    matrix = counts.reshape(len(langs), BUCKETS).T + SMOOTHING
    prior = np.array([n for _, n in per_lang], float)
    return Model(langs, np.log(matrix / matrix.sum(axis=0)), np.log(prior / max(prior.sum(), 1.0)))


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score`` (posterior of the predicted language) per row."""
    text_batches(docs.sparkSession)
    langs = model.langs
    held = docs.sparkSession.sparkContext.broadcast((model.log_prob, model.log_prior))
    source = docs.select(F.when(has_letter(F.col(text_col)), F.col(text_col)).alias("_text"), *keep)
    schema = with_fields(source.drop("_text").schema, lang_pred="string", score="double")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_prob, log_prior = held.value
        for batch in batches:
            known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            total = np.zeros((batch.num_rows, max(1, len(langs))))
            if langs:
                total += log_prior
                for lo, hi, raw, offsets in text_slices(batch.column(0)):
                    points, bounds = code_points(raw, offsets)
                    points = fold_letters(points)
                    for order in ORDERS:
                        grams, ranges = gram_buckets(points, bounds, order, BUCKETS)
                        total[lo:hi] += segment_sums(log_prob[grams], ranges)
            best = total.argmax(axis=1)
            odds = np.exp(total - total.max(axis=1, keepdims=True))
            sure = odds[np.arange(len(best)), best] / odds.sum(axis=1)
            known &= bool(langs)
            names = [langs[i] if ok else UNKNOWN for i, ok in zip(best, known, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(names, pa.string()), pa.array(np.where(known, sure, 0.0))],
                [*batch.schema.names[1:], "lang_pred", "score"])

    return source.mapInArrow(score, schema)


def query(spark, sf_dir: str) -> DataFrame:
    """op6: (doc_id, held_out, lang_pred, score) over all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = train(docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))
    out = predict(docs.drop("lang"), model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def accept(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """Rows of ``docs`` whose language is told with at least ``min_score``; the others go."""
    model = train(docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("text", "lang"))
    if not model.langs:      # nothing to learn from: only texts without a letter are rejected
        return docs.filter(has_letter(F.col("text")))
    told = predict(packed(docs, text=docs["text"]), model, keep=("row",))
    return told.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)).select("row.*")

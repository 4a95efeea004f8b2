"""Filter interaction audit by truth-table survival words.

Each document fails some of five filters. ``survival_words`` turns the failures into a 32-bit
word whose bit S tells whether the document survives the filters of subset S (bit j of S:
filter j). ``positional_counts`` adds up such words bit by bit: a tree of carry-save adders
turns three words of one weight into a sum word of that weight and a carry word of twice
the weight, so most of the work is a few bitwise operations per word; tasks keep the few
words left per weight from batch to batch. The counters of a (part, label) pair give, for any
order of the filters, what every step keeps and removes.

Filters (a word is a maximal run of other than white space, case-sensitive): A under 100 words;
B 100 * distinct words < 80 * words; C 100 * letters A-Z > 10 * code points; D holds any of
``#$%&*|``; E identical to the text of any smaller id in the whole table. E needs no join on the texts:
the smallest id per text digest (a partial aggregate) is joined back on (id, digest), so a
text that a third of all rows hold never meets in one task.

Edge cases: a null text is empty (it fails A, and E if a smaller id has an empty text); a null
part is the empty string; rows without id have no smaller id and are none, so they never
fail E, and they have no label; repeated rows count each, and do not make each other fail E;
a label counts if any label row of the id says so; very long texts are split into words piece by
piece; an empty table gives no row; other columns are passed by.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, text_batches

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]
LABELS = ("all", "good", "toxic")
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#$%&*|"
PIECE = 1 << 20             # bytes of a long text that are split into words at a time
HELD = 4096                 # (part, label) pairs whose counters a task keeps before it hands them on

_SPACE = re.compile(b"[" + SPACES + b"]")
_NOT_UPPER = bytes(b for b in range(256) if not 65 <= b <= 90)
_NOT_SYMBOL = bytes(b for b in range(256) if b not in SYMBOLS)
_INNER_BYTES = bytes(range(0x80, 0xC0))         # continuation bytes: all others start a code point


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces of about ``PIECE`` bytes, cut at white space only."""
    at = 0
    while at < len(text):
        gap = _SPACE.search(text, at + PIECE) if at + PIECE < len(text) else None
        end = gap.start() if gap else len(text)
        yield text[at:end]
        at = end


def own_failures(text: bytes) -> int:
    """Bits of the filters A to D that a text fails by itself."""
    n_words, distinct = 0, set()
    for piece in _pieces(text):
        words = piece.split()
        n_words += len(words)
        distinct.update(words)
    upper = len(text.translate(None, _NOT_UPPER))
    points = len(text.translate(None, _INNER_BYTES))
    return ((n_words < 100) | (100 * len(distinct) < 80 * n_words) << 1 | (100 * upper > 10 * points) << 2
            | (len(text.translate(None, _NOT_SYMBOL)) > 0) << 3)


def survival_words() -> np.ndarray:
    """Word of every failure pattern: bit S is set where no filter of S fails."""
    fails, subset = np.arange(SUBSETS)[:, None], np.arange(SUBSETS)
    return ((fails & subset) == 0).astype(np.uint32) @ (np.uint32(1) << subset.astype(np.uint32))


class PositionalCounter:
    """Counts set bits per position over a stream of 32-bit words."""

    def __init__(self):
        self.planes: dict[int, np.ndarray] = {}     # weight (power of two) -> at most two words

    def add(self, words: np.ndarray, times: np.ndarray | None = None) -> None:
        """Add words, each ``times`` times (once by default)."""
        waiting: dict[int, list[np.ndarray]] = {}
        if times is None:
            waiting[0] = [words]
        else:
            for k in range(int(times.max(initial=0)).bit_length()):
                waiting[k] = [words[(times >> k) & 1 == 1]]
        for k, left in self.planes.items():
            waiting.setdefault(k, []).append(left)
        self.planes, k = {}, 0
        while waiting:
            now = np.concatenate(waiting.pop(k, [np.zeros(0, np.uint32)]))
            carried = []
            while len(now) > 2:
                third = len(now) // 3
                a, b, c = now[:third], now[third:2 * third], now[2 * third:3 * third]
                half = a ^ b
                carried.append((a & b) | (half & c))
                now = np.concatenate([half ^ c, now[3 * third:]])
            if carried:
                waiting.setdefault(k + 1, []).extend(carried)
            if len(now):
                self.planes[k] = now
            k += 1

    def counts(self) -> list[int]:
        """Per bit position, how many of the added words have it."""
        return [sum(int(((left >> np.uint32(bit)) & 1).sum()) << k for k, left in self.planes.items())
                for bit in range(SUBSETS)]


def positional_counts(words: np.ndarray, times: np.ndarray | None = None) -> list[int]:
    counter = PositionalCounter()
    counter.add(words.astype(np.uint32), times)
    return counter.counts()


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(id, part, fails, times): the failure pattern of every document; equal rows are one with their number."""
    text_batches(docs.sparkSession)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).cast(pa.binary()).to_pylist()
            fails = pa.array([own_failures(t) for t in texts], pa.int32())
            digests = pa.array([hashlib.blake2b(t, digest_size=16).digest() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), fails, digests],
                                             ["id", "part", "fails", "digest"])

    looked = stored(docs.select(
        F.coalesce(F.col(text_col), F.lit("")).alias("t"), F.col(id_col).cast("bigint").alias("id"),
        F.coalesce(F.col(part_col), F.lit("")).alias("part")).mapInArrow(
        look, "id long, part string, fails int, digest binary"), "audit-looked")
    named = looked.filter(F.col("id").isNotNull())
    first = named.groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    equal = named.groupBy("id", "digest", "part", "fails").agg(F.count(F.lit(1)).alias("times"))
    copy = F.when(F.col("first").isNull(), F.lit(1 << FILTERS.index("E"))).otherwise(0)
    told = equal.join(first, ["id", "digest"], "left").select(
        "id", "part", (F.col("fails") + copy).alias("fails"), "times")
    unnamed = looked.filter(F.col("id").isNull()).groupBy("id", "part", "fails").agg(F.count(F.lit(1)).alias("times"))
    return told.unionByName(unnamed)


def survivors(fails: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(part, label, subset, n): how many documents of a part and label survive each subset of the filters."""
    truth = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("bigint").alias("id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    rows = fails.filter(F.col("id").isNotNull()).join(truth, "id", "left").select("part", "fails", "times", "good", "toxic")
    rows = rows.unionByName(fails.filter(F.col("id").isNull()).select("part", "fails", "times"), allowMissingColumns=True)
    rows = rows.select("part", "fails", "times", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])
    table = survival_words()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], PositionalCounter] = {}

        def handed() -> pa.RecordBatch:
            keys = [k for k in held for _ in range(SUBSETS)]
            n = [x for c in held.values() for x in c.counts()]
            out = pa.RecordBatch.from_arrays([
                pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                pa.array(list(range(SUBSETS)) * len(held), pa.int32()), pa.array(n, pa.int64())],
                ["part", "label", "subset", "n"])
            held.clear()
            return out

        for batch in batches:
            parts = batch.column(0).dictionary_encode()
            part = parts.indices.to_numpy()
            words, times = table[batch.column(1).to_numpy()], batch.column(2).to_numpy()
            for label, mark in zip(LABELS, (None, batch.column(3), batch.column(4)), strict=True):
                use = np.arange(len(part)) if mark is None else np.flatnonzero(mark.to_numpy(zero_copy_only=False))
                order = use[np.argsort(part[use], kind="stable")]
                cuts = np.flatnonzero(np.diff(part[order])) + 1
                for rows_of in np.split(order, cuts) if len(order) else []:
                    key = (parts.dictionary[int(part[rows_of[0]])].as_py(), label)
                    held.setdefault(key, PositionalCounter()).add(words[rows_of], times[rows_of])
            if len(held) > HELD:
                yield handed()
        if held:
            yield handed()

    return rows.mapInArrow(count, "part string, label string, subset int, n long").groupBy(
        "part", "label", "subset").agg(F.sum("n").alias("n"))


def _count(label: str, subset: str) -> str:
    """SQL of the survivors of a label and a subset in the array ``n``."""
    return f"n[{LABELS.index(label) * SUBSETS} + ({subset})]"


def _shapley(j: int) -> str:
    """SQL of what filter j removes, summed over all orders: a weight per set of filters before it."""
    facts = [1, 1, 2, 6, 24]
    terms = []
    for before in range(SUBSETS):
        if not before >> j & 1:
            weight = facts[before.bit_count()] * facts[len(FILTERS) - 1 - before.bit_count()]
            terms.append(f"{weight} * ({_count('all', before)} - {_count('all', before | 1 << j)})")
    return " + ".join(terms)


def audit(counted: DataFrame) -> DataFrame:
    """A row per part, order of the filters and step, from the subset survivors."""
    whole, size = SUBSETS - 1, len(FILTERS)
    slot = F.array_position(F.array(*map(F.lit, LABELS)), F.col("label")).cast("int") - 1
    per_part = counted.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct(
        (slot * SUBSETS + F.col("subset")).alias("k"), "n"))).alias("m"))       # 96 entries a part at most
    per_part = per_part.selectExpr(
        "part", f"transform(sequence(0, {len(LABELS) * SUBSETS - 1}), k -> coalesce(m[k], 0L)) AS n").selectExpr(
        "part", "n", "array(" + ", ".join(_shapley(j) for j in range(size)) + ") AS fair")
    steps = per_part.selectExpr("*", f"explode(split('{','.join(ORDERS)}', ',')) AS filter_order").selectExpr(
        "*", f"explode(sequence(1, {size})) AS step").selectExpr(
        "*", f"instr('{FILTERS}', substring(filter_order, step, 1)) - 1 AS own", " + ".join(
            f"IF(instr(filter_order, '{x}') < step, {1 << j}, 0)" for j, x in enumerate(FILTERS)) + " AS earlier")
    steps = steps.selectExpr("*", "shiftleft(1, own) AS bit")

    def lost(label: str) -> str:
        return f"{_count(label, 'earlier')} - {_count(label, 'earlier + bit')}"

    return steps.selectExpr(
        "part", "filter_order", "step", f"{_count('all', 'earlier + bit')} AS kept", f"{lost('all')} AS removed",
        f"{_count('all', '0')} - {_count('all', 'bit')} - ({lost('all')}) AS redundant",
        f"{_count('all', f'{whole} - bit')} - {_count('all', str(whole))} AS unique_fails",
        f"{lost('good')} AS good_lost", f"{lost('toxic')} AS toxic_lost", "fair[own] AS shapley")


def query(spark, sf_dir: str) -> DataFrame:
    """op11: (part, filter_order, step, counts) over all documents and labels."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    return audit(survivors(failures(docs), labels))


ORACLE_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
first_ids AS (SELECT t, min(doc_id) AS first_id FROM docs GROUP BY t),
truth AS (SELECT doc_id, coalesce(bool_or(quality = 1), FALSE) AS good, coalesce(bool_or(toxic = 1), FALSE) AS toxic
          FROM labels GROUP BY doc_id),
failing AS (
  SELECT part, coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic, [
           len(words) < 100, 100 * len(list_distinct(words)) < 80 * len(words),
           100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t),
           regexp_matches(t, '[#$%&*|]'), coalesce(docs.doc_id > first_id, FALSE)] AS f
  FROM docs JOIN first_ids USING (t) LEFT JOIN truth ON truth.doc_id = docs.doc_id),
patterns AS (
  SELECT part, f, count(*) AS n, count(*) FILTER (WHERE good) AS n_good, count(*) FILTER (WHERE toxic) AS n_toxic
  FROM failing GROUP BY part, f),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
  SELECT filter_order, step, instr('ABCDE', filter_order[step]) AS own,
         list_transform(range(1, step), lambda i: instr('ABCDE', filter_order[i])) AS earlier
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
seen AS (
  SELECT part, filter_order, step, n, n_good, n_toxic, f[own] AS fails,
         len(list_filter(earlier, lambda x: f[x])) > 0 AS gone,
         len(list_filter(f, lambda x: x)) = 1 AS alone, filter_order[step] AS letter
  FROM patterns, steps),
counted AS (
  SELECT part, filter_order, step, letter,
         sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN gone AND fails THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN fails AND alone THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN NOT gone AND fails THEN n_good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN NOT gone AND fails THEN n_toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM seen GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, letter)::BIGINT AS shapley
FROM counted
"""

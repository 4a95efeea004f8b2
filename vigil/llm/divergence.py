"""Source divergence audit over run-length encoded columns of term counts.

Terms are maximal runs of letters (ASCII letters, lower-cased, and everything beyond ASCII). Tasks
count terms per (lang, source) before anything is shuffled; one exchange by (lang, term) then
gives document frequencies and totals, and each lang keeps its terms in ``min_docs`` documents or more.

The kept terms of a lang get positions in an order that brings equal counts together: terms
with the same set of sources, then the same total, then the same counts. Along this
order a source's column of counts is cut into blocks of ``BLOCK`` positions and run-length encoded;
positions without a row are runs of zeros. A pair of sources is compared block by block: the
boundaries of their runs are merged, and the term of the sum that belongs to a stretch is multiplied by
its length. Blocks spread a lang over many tasks, and sources are dealt into tiles of
``TILE``, so a task holds the runs of two tiles in one block whatever their number.

With p = 1 + floor(10^9 (count + 2) / (N + 2 V)) for a group's count of a term (N over its
kept terms, V kept terms of the lang), f = floor((p - q)^2 / (p + q)): all integers,
the quotient in 38 digits.

Edge cases: null text, lang and source are empty strings; a group without terms has counts of
zero everywhere, and its terms are no items of part ``term``; with V = 0 every pair is 0; a source alone in
its lang has no pair; ties go to the smaller item by UTF-8; repeated rows are documents of
their own; a long text is cut into pieces between terms, and its distinct terms are held whole; an
empty table gives no row; other columns are passed by.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordinal import with_ordinal
from .common import stored, text_batches

MIN_DOCS = 10
TOP = 10
BLOCK = 256             # positions of the vocabulary per block
TILE = 64               # sources per tile
HELD = 1 << 18          # (group, term) counts that a task gathers before it hands them on
PIECE = 1 << 20         # bytes of a text that are split at a time

_FOLD = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_GAP = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")


def text_terms(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, by pieces of about ``PIECE`` bytes."""
    at = 0
    while at < len(text):
        gap = _GAP.search(text, at + PIECE) if at + PIECE < len(text) else None
        end = gap.start() if gap else len(text)
        yield text[at:end].translate(_FOLD).split(b" ")
        at = end


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents; a null term marks that the group occurs."""
    text_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def handed() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, files) in groups.items():
                terms = pa.array([None, *n], pa.binary()).cast(pa.string())
                size = len(terms)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * size, pa.string()), pa.array([source] * size, pa.string()), terms,
                     pa.array([0, *n.values()], pa.int64()), pa.array([0, *(files[t] for t in n)], pa.int64())],
                    ["lang", "source", "term", "n", "docs"])
            groups.clear()

        held = 0
        for batch in batches:
            texts = batch.column(0).cast(pa.binary())
            for text, lang, source in zip(texts, batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                n, files = groups.setdefault((lang, source), (Counter(), Counter()))
                before, own = len(n), set()
                for terms in text_terms(text.as_py()):
                    n.update(terms)
                    own.update(terms)
                if n.pop(b"", None) is not None:
                    own.discard(b"")
                files.update(own)
                held += len(n) - before
                if held > HELD:
                    yield from handed()
                    held = 0
        yield from handed()

    rows = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(name) for c, name in (
        (text_col, "text"), (lang_col, "lang"), (source_col, "source"))])
    return rows.mapInArrow(count, "lang string, source string, term string, n long, docs long")


def _share(count: str, total: str, terms: str) -> str:
    """SQL of p, exact: the product has up to 31 digits."""
    return f"1 + (1000000000BD * ({count} + 2)) div ({total} + 2 * {terms})"


class Audit:
    """Kept terms and groups of a corpus, stored once and read by both parts."""

    def __init__(self, docs: DataFrame, min_docs: int = MIN_DOCS, **columns: str):
        counted = stored(term_counts(docs, **columns), "divergence-counts")
        per_term = Window.partitionBy("lang", "term")
        # one exchange by (lang, term) serves the sums of a group's term and those of the lang's term
        summed = counted.filter(F.col("term").isNotNull()).repartition("lang", "term").groupBy(
            "lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        sources = F.bit_xor(F.xxhash64("source")).over(per_term)
        alike = F.bit_xor(F.xxhash64("source", "n")).over(per_term)
        kept = summed.select(
            "lang", "term", "source", "n", F.sum("docs").over(per_term).alias("_docs"),
            F.sum("n").over(per_term).alias("total"), sources.alias("support"), alike.alias("alike"),
            (F.col("source") == F.min("source").over(per_term)).alias("first")).filter(F.col("_docs") >= min_docs)
        self.kept = stored(kept.drop("_docs"), "divergence-kept")
        langs = self.kept.groupBy("lang").agg(F.sum(F.col("first").cast("bigint")).alias("v"),
                                              F.sum("n").alias("lang_n"))
        own = self.kept.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
        groups = counted.filter(F.col("term").isNull()).select("lang", "source").distinct()
        groups = groups.join(own, ["lang", "source"], "left").join(langs, "lang", "left").select(
            "lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("group_n", "v", "lang_n")])
        # the number of a source inside its lang deals the sources into tiles
        self.groups = stored(with_ordinal(groups, ["source"], by=["lang"], name="number"), "divergence-groups")

    def runs(self) -> DataFrame:
        """(lang, source, number, block, start, length, p): equal shares side by side, zeros included.

        Runs of zeros between a group's terms are left to the reader of a block; the row of
        length 0 that every (group, block) has tells their p and the block's length.
        """
        terms = self.kept.filter("first").select("lang", "term", "support", "total", "alike")
        placed = with_ordinal(terms, ["support", F.desc("total"), "alike", "term"], by=["lang"], name="at")
        spots = placed.select("lang", "term", (F.col("at") - 1).alias("at"))
        cells = self.kept.select("lang", "term", "source", "n").join(spots, ["lang", "term"]).select(
            "lang", "source", F.expr(f"at div {BLOCK}").alias("block"),
            F.expr(f"cast(at % {BLOCK} as int)").alias("at"), "n")
        column = Window.partitionBy("lang", "source", "block").orderBy("at")     # at most BLOCK rows
        starts = (F.lag("n").over(column).eqNullSafe(F.col("n")) & (F.lag("at").over(column) == F.col("at") - 1))
        run = F.sum(F.when(F.coalesce(starts, F.lit(False)), 0).otherwise(1)).over(column)
        encoded = cells.withColumn("_new", F.coalesce(starts, F.lit(False))).withColumn("_run", run).groupBy(
            "lang", "source", "block", "_run").agg(F.min("at").alias("start"), F.count(F.lit(1)).cast("int").alias("length"),
                                                   F.min("n").alias("n"))
        shares = self.groups.select("lang", "source", "number", "group_n", "v")
        encoded = encoded.join(shares, ["lang", "source"]).select(
            "lang", "source", "number", "block", "start", "length", F.expr(_share("n", "group_n", "v")).alias("p"))
        whole = shares.filter("v > 0").select(
            "*", F.explode(F.expr(f"sequence(0L, (v - 1) div {BLOCK})")).alias("block")).select(
            "lang", "source", "number", "block", F.expr(f"cast(least({BLOCK}, v - block * {BLOCK}) as int)").alias("start"),
            F.lit(0).alias("length"), F.expr(_share("0", "group_n", "v")).alias("p"))
        return encoded.unionByName(whole)

    def pairs(self) -> DataFrame:
        """(lang, source, item, value) of all ordered pairs of sources of a lang."""
        tiles = self.groups.groupBy("lang").agg(F.expr(f"(max(number) - 1) div {TILE}").alias("last"))
        tile = F.expr(f"(number - 1) div {TILE}")
        dealt = self.runs().withColumn("tile", tile).join(tiles, "lang").select(
            "*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last"))).alias("_other")).select(
            "lang", "block", F.least("tile", "_other").alias("low"), F.greatest("tile", "_other").alias("high"),
            "number", "tile", "start", "length", "p")
        summed = dealt.groupBy("lang", "block", "low", "high").applyInArrow(
            _compare, "lang string, a long, b long, value long").groupBy("lang", "a", "b").agg(
            F.sum("value").alias("value"))
        both = summed.unionByName(summed.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
        names = self.groups.select("lang", "number", "source")
        named = both.join(names.withColumnRenamed("number", "a"), ["lang", "a"]).join(
            names.select("lang", F.col("number").alias("b"), F.col("source").alias("item")), ["lang", "b"]).select(
            "lang", "source", "item", "value")
        # a lang without kept terms has no block: its pairs are all zero
        bare = self.groups.filter("v = 0").select("lang", "source")
        zero = bare.join(bare.withColumnRenamed("source", "item"), "lang").filter("source != item").select(
            "lang", "source", "item", F.lit(0).cast("bigint").alias("value"))
        return named.unionByName(zero)

    def terms(self) -> DataFrame:
        """(lang, source, item, value) of the terms a group has more often than its lang."""
        told = self.kept.join(self.groups.drop("number"), ["lang", "source"]).select(
            "lang", "source", F.col("term").alias("item"), F.expr(_share("n", "group_n", "v")).alias("p"),
            F.expr(_share("total", "lang_n", "v")).alias("q")).filter("p > q")
        return told.selectExpr("lang", "source", "item", "(p - q) * (p - q) div (p + q) AS value")


def _compare(key: tuple, runs: pa.Table) -> pa.Table:
    """Sums of f over one block for the pairs of two tiles (or inside one)."""
    lang, _, low, high = (k.as_py() for k in key)
    number, tile, start, length, p = (runs.column(c).to_numpy() for c in ("number", "tile", "start", "length", "p"))
    columns: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    of_tile: dict[int, list[int]] = {low: [], high: []}
    order = np.lexsort((start, length == 0, number))
    for rows in np.split(order, np.flatnonzero(np.diff(number[order])) + 1):
        *at, whole = rows                           # the row of the whole block comes last
        size, rest = int(start[whole]), p[whole]
        begin, end = start[at], start[at] + length[at]
        # run bounds of the column: its own runs and the zeros before, between and after them
        bounds = np.concatenate([[0], np.column_stack([begin, end]).ravel(), [size]])
        value = np.full(len(bounds) - 1, rest, np.int64)
        value[1::2] = p[at]
        real = np.diff(bounds) > 0
        columns[int(number[whole])] = bounds[1:][real], value[real]
        of_tile[int(tile[whole])].append(int(number[whole]))
    out = []
    for i, a in enumerate(sorted(of_tile[low])):
        ends_a, p_a = columns[a]
        for b in sorted(of_tile[high])[i + 1 if low == high else 0:]:
            ends_b, p_b = columns[b]
            ends = np.union1d(ends_a, ends_b)
            x, y = p_a[np.searchsorted(ends_a, ends)], p_b[np.searchsorted(ends_b, ends)]
            f = (x - y) * (x - y) // (x + y)
            out.append((a, b, int((f * np.diff(ends, prepend=0)).sum())))
    a, b, value = zip(*out, strict=True) if out else ((), (), ())
    return pa.table({"lang": pa.array([lang] * len(out), pa.string()), "a": pa.array(a, pa.int64()),
                     "b": pa.array(b, pa.int64()), "value": pa.array(value, pa.int64())})


def ranked(items: DataFrame, part: str, top: int | None = None) -> DataFrame:
    """Rank per group by value (largest first), then by item."""
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    out = items.withColumn("rank", F.row_number().over(order))
    out = out.filter(F.col("rank") <= top) if top else out
    return out.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def query(spark, sf_dir: str) -> DataFrame:
    """op12: (lang, source, part, item, value, rank) over all documents."""
    audit = Audit(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang", "source"))
    return ranked(audit.pairs(), "pair").unionByName(ranked(audit.terms(), "term", TOP))


ORACLE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
occurring AS (SELECT lang, source, doc, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term FROM occurring GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
all_groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM occurring JOIN kept USING (lang, term)
           GROUP BY lang, source, term),
cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, s.v,
         sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
  FROM all_groups g JOIN kept k USING (lang) JOIN sizes s USING (lang)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
shares AS (SELECT lang, source, term, n,
                  1 + (1000000000::HUGEINT * (n + 2)) // (total + 2 * v)::HUGEINT AS p FROM cells),
lang_cells AS (SELECT lang, term, sum(n) AS n, any_value(v) AS v FROM cells GROUP BY lang, term),
lang_shares AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * v)::HUGEINT AS q
  FROM lang_cells),
pair_values AS (
  SELECT a.lang, a.source, b.source AS item,
         coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0) AS value
  FROM all_groups a JOIN all_groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY a.lang, a.source, b.source),
term_values AS (
  SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value
  FROM shares JOIN lang_shares USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value,
         row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pair_values
  UNION ALL
  SELECT lang, source, 'term', item, value,
         row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM term_values)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""

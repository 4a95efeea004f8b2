"""Quality rules: a learned decision list as ordered Spark conditional expressions.

``base_features`` are counts of each whole text. ``learn`` covers sequentially: from
labelled rows it grows a conjunction of thresholds for bad documents, condition by
condition, on the statistics of the rows not yet covered (per feature and bin, how
many good and bad rows lie there); prunes its last conditions on the rows held back
for pruning; takes the rule if it stays precise there; removes what it covers and goes
on. ``verdict`` turns the list into one CASE expression. Cuts come from percentiles of
the labelled rows, so a step sends features x bins rows to the driver.

Only DataFrame functions run here.

Edge cases: a null text counts as empty (all counts 0); ties go to the feature and cut
named first; labels of unknown documents and null labels teach nothing; repeated rows
are judged alike; without labels of both kinds the list is empty and the base rules
alone decide; an empty table gives an empty result; other columns are passed by.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, stored

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
CUTS = 16                   # percentiles of each class that may serve as thresholds
MAX_RULES = 10
MAX_CONDITIONS = 4
MIN_PRECISION = 0.9         # on the rows held back for pruning
MIN_COVERED = 3
#: what a condition may test: name -> SQL over the base columns
TESTED = {
    "symbols_per_word": "n_symbols / n_words",
    "repeat_share": "n_repeat_words / n_words",
    "word_length": "word_chars / n_words",
    "marks_per_word": "n_marks / n_words",
    "capital_share": "n_capitals / word_chars",
    "dup_lines": "cast(n_dup_lines as double)",
    "words": "cast(n_words as double)",
}


def base_features(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, the base counts, n_capitals (A-Z) and n_marks (exclamation marks)."""
    rows = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    rows = rows.withColumn("_w", F.transform(F.regexp_extract_all("_t", F.lit(WORD), F.lit(0)), lambda x: F.xxhash64(x)))
    n = F.size("_w")
    windows = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(
        F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)).alias("h"), i.alias("i"))))
    lines = F.filter(F.split("_t", "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)

    def count_of(chars: str) -> Column:
        return (F.length("_t") - F.length(F.translate("_t", chars, ""))).cast("bigint")

    rows = rows.select(
        *keep, n.cast("bigint").alias("n_words"), F.length(F.translate("_t", SPACES, "")).cast("bigint").alias(
            "word_chars"), count_of(SYMBOLS).alias("n_symbols"), lines.alias("_l"), F.sort_array(windows).alias("_s"),
        count_of("ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_capitals"), count_of("!").alias("n_marks"))
    # sorted by hash, a window found twice or more has an equal neighbour
    again = F.filter("_s", lambda x, i: (F.get("_s", i - 1)["h"] == x["h"]) | (F.get("_s", i + 1)["h"] == x["h"]))
    rows = rows.withColumn("n_dup_lines", (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint")).withColumn(
        "_p", F.sort_array(F.transform(again, lambda x: x["i"])))
    # each place adds the words of its window that the place before has not covered
    start = F.struct(F.lit(-3).alias("at"), F.lit(0).alias("n"))
    covered = F.aggregate("_p", start, lambda acc, p: F.struct(
        p.alias("at"), (acc["n"] + F.least(F.lit(3), p - acc["at"])).alias("n")), lambda acc: acc["n"])
    return rows.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"), "n_capitals", "n_marks")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float
    bin: int = field(compare=False, default=0)      # above: bins >= bin, else bins < bin

    def column(self) -> Column:
        value = F.coalesce(F.expr(TESTED[self.feature]), F.lit(0.0))
        return value > F.lit(self.cut) if self.above else value <= F.lit(self.cut)

    def on_bins(self) -> Column:
        b = F.col("bins")[list(TESTED).index(self.feature)]
        return b >= self.bin if self.above else b < self.bin

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def _all(conditions, how) -> Column:
    return reduce(lambda x, y: x & y, [how(c) for c in conditions], F.lit(True))


def _gain(p: float, n: float, p0: float, n0: float) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p > 0 else 0.0


def _best(stats: dict[tuple[int, int], tuple[float, float]], cuts: dict[str, list[float]]) -> tuple[float, Condition | None]:
    """The condition of most information gain from (feature, bin) -> (bad, good) counts."""
    best: tuple[float, Condition | None] = (1e-9, None)
    for f, (name, values) in enumerate(cuts.items()):
        rows = [stats.get((f, b), (0.0, 0.0)) for b in range(len(values) + 1)]
        p0, n0 = sum(r[0] for r in rows), sum(r[1] for r in rows)
        p = n = 0.0
        for b, cut in enumerate(values):            # bins 0..b hold values up to the cut
            p, n = p + rows[b][0], n + rows[b][1]
            for above, q, m in ((True, p0 - p, n0 - n), (False, p, n)):
                if (q < p0 or m < n0) and (g := _gain(q, m, p0, n0)) > best[0]:
                    best = (g, Condition(name, above, cut, b + 1))
    return best


def learn(labelled: DataFrame, bad: Column, key: Column) -> list[Rule]:
    """Ordered rules for bad rows; ``labelled`` has the base columns, ``key`` deals rows to grow or prune."""
    names = list(TESTED)
    rows = stored(labelled.select(
        F.array(*[F.coalesce(F.expr(x), F.lit(0.0)) for x in TESTED.values()]).alias("v"), bad.alias("bad"),
        (F.pmod(F.xxhash64(F.lit(11), key), F.lit(3)) > 0).alias("grow")).filter(F.col("bad").isNotNull()), "rules-labelled")
    steps = [i / CUTS for i in range(1, CUTS)] + [0.995, 1.0]
    found = rows.groupBy("bad").agg(*[F.percentile_approx(F.col("v")[i], steps, 10000).alias(name)
                                      for i, name in enumerate(names)]).collect()
    if len(found) < 2:
        return []
    # a cut lies half way between two neighbouring percentiles, so that a rule leaves a margin on both sides
    points = {name: sorted({float(x) for r in found for x in r[name]}) for name in names}
    cuts = {name: [(a + b) / 2 for a, b in zip(v, v[1:])] for name, v in points.items()}

    def bin_of(i: int) -> Column:
        return F.size(F.filter(F.array(*[F.lit(c) for c in cuts[names[i]]]), lambda c: c < F.col("v")[i]))

    bins = F.array(*[bin_of(i) for i in range(len(names))])
    cells = stored(rows.groupBy(bins.alias("bins"), "bad", "grow").agg(F.count(F.lit(1)).alias("w")), "rules-cells")
    p, n = F.sum(F.when(F.col("bad"), F.col("w")).otherwise(0)), F.sum(F.when(F.col("bad"), 0).otherwise(F.col("w")))
    rules: list[Rule] = []
    left = F.lit(True)
    while len(rules) < MAX_RULES:
        rule: list[Condition] = []
        while len(rule) < MAX_CONDITIONS:
            seen = cells.filter(F.col("grow") & left & _all(rule, Condition.on_bins)).select(
                "bad", "w", F.posexplode("bins").alias("f", "b")).groupBy("f", "b").agg(p.alias("p"), n.alias("n"))
            stats = {(r["f"], r["b"]): (float(r["p"]), float(r["n"])) for r in seen.collect()}
            if not any(v[1] for v in stats.values()):
                break
            _, condition = _best(stats, cuts)
            if condition is None:
                break
            rule.append(condition)
        if not rule:
            break
        # prune: the shortest head of the rule that does best on the rows held back
        heads = [_all(rule[:k], Condition.on_bins) for k in range(1, len(rule) + 1)]
        row = cells.filter(~F.col("grow") & left).agg(*[
            F.sum(F.when(h & (F.col("bad") == b), F.col("w")).otherwise(0)).alias(f"x{k}{int(b)}")
            for k, h in enumerate(heads) for b in (True, False)]).first()
        worth = [((row[2 * k] or 0), (row[2 * k + 1] or 0)) for k in range(len(heads))]
        k = max(range(len(worth)), key=lambda k: ((worth[k][0] - worth[k][1]) / max(sum(worth[k]), 1), -k))
        if worth[k][0] < MIN_COVERED or worth[k][0] < MIN_PRECISION * sum(worth[k]):
            break
        rules.append(tuple(rule[:k + 1]))
        left = left & ~_all(rules[-1], Condition.on_bins)
    return rules


def matched_rule(rules: list[Rule]) -> Column:
    """1-based number of the first rule that a row meets, 0 if none."""
    if not rules:
        return F.lit(0)
    out = None
    for k, rule in enumerate(rules, 1):
        test = _all(rule, Condition.column)
        out = F.when(test, k) if out is None else out.when(test, k)
    return out.otherwise(0)


def apply_rules(features: DataFrame, rules: list[Rule]) -> DataFrame:
    """``features`` with base_failed, rule (which one rejects, 0: none) and kept."""
    failed = base_failed()
    return features.withColumn("base_failed", failed).withColumn(
        "rule", F.when(F.col("base_failed"), F.lit(0)).otherwise(matched_rule(rules))).withColumn(
        "kept", ~F.col("base_failed") & (F.col("rule") == 0))


def query(spark, sf_dir: str) -> DataFrame:
    """op10: base counts, base_failed, kept and the rejecting rule over all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    features = stored(base_features(docs), "rules-features")
    labelled = features.filter(~base_failed()).join(labels, "doc_id")
    rules = learn(labelled, F.col("quality") == 0, F.col("doc_id"))
    return apply_rules(features, rules)

"""Mixing sources to target weights with whole copies of documents.

``source_targets`` shares a total over the sources by weight, with a ceiling of
``max_repeat`` times what a source has. ``mix`` then gives every document a whole
number of copies whose expected value is target / source size: the whole part is
taken outright, and the fractions are settled by pivotal dependent rounding. Two
documents with fractional copies trade mass (copies x size) at random, without
bias, until one of the two is whole; the other goes on. Trades run inside small
hash buckets of one source, each leaves one unsettled document, and these meet
in the buckets of the next level, a tree of fan-in ``FAN_IN``. A source's taken
size differs from its target by at most half the one document that is left at the
root, and no group grows with the data.

Edge cases: null or empty texts have size 0 and take nothing; a null source is a
source of its own, after all others; rows that repeat id, source and size share
one draw (each gets the same copies); an empty table gives an empty result.
Only DataFrame functions run here.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordinal import with_ordinal
from .common import WORD, packed, stored

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEAT = 3
FAN_IN = 32
SEED = 20240117


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT,
                   share: float = 1.0) -> DataFrame:
    """(source, source_size, n_docs, weight, target) from rows of (source, size).

    Sources in code-point order, null last, take ``weights`` in turn. Each round caps
    the sources whose share passes ``max_repeat`` times their size and deals the rest
    again by weight, until none is above; a round is one aggregate over the sources.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"),
                                             F.count(F.lit(1)).alias("n_docs"))
    per_source = per_source.withColumn("_null", F.col("source").isNull().cast("int")) \
        .withColumn("_key", F.coalesce(F.col("source"), F.lit("")))
    ranked = with_ordinal(per_source, ["_null", "_key"], name="_rank")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.col("_rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    table = stored(ranked.select("source", "source_size", "n_docs", w.alias("weight")), "mix-sources")
    limit = F.col("source_size") * F.lit(float(max_repeat))
    rate, done = 0.0, -1            # a source is capped when weight * rate reaches its ceiling
    capped = F.lit(False)
    while True:
        row = table.agg(
            F.sum("source_size"), F.sum(F.when(capped, limit)), F.sum(F.when(~capped, F.col("weight"))),
            F.count(F.when(capped, 1))).first()
        total, held, free, n_capped = (float(row[0] or 0) * share, float(row[1] or 0.0), float(row[2] or 0.0), row[3])
        if free <= 0 or n_capped == done:
            break
        rate, done = max(0.0, total - held) / free, n_capped
        capped = capped | (F.col("weight") * F.lit(rate) > limit)
    target = F.when(capped, limit).otherwise(F.col("weight") * F.lit(rate))
    return table.withColumn("target", target)


def _uniform(*cols: Column) -> Column:
    """Repeatable uniform number in (0, 1) from the given columns."""
    return ((F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") + 0.5) / float(1 << 53))


def _settled(doc: Column, copies: Column) -> Column:
    return F.array(F.struct(doc.alias("d"), copies.cast("int").alias("c")))


def _trade(level: int):
    """Fold step: the unsettled document trades with the next one; one of them gets whole."""
    eps = 1e-12

    def step(acc: Column, x: Column) -> Column:
        a, pa, sa = acc["d"], acc["p"], acc["s"]
        b, pb, sb = x["d"], x["p"], x["s"]
        up = F.least((1.0 - pa) * sa, pb * sb)       # mass that can move from b to a
        down = F.least(pa * sa, (1.0 - pb) * sb)     # and from a to b
        move = F.when(_uniform(F.lit(SEED), F.lit(level), a, b) * (up + down) < down, up).otherwise(-down)
        qa, qb = pa + move / sa, pb - move / sb
        a_whole = F.least(F.abs(qa), F.abs(1.0 - qa)) <= F.least(F.abs(qb), F.abs(1.0 - qb))
        keep = F.when(a_whole, F.struct(b.alias("d"), qb.alias("p"), sb.alias("s"))).otherwise(
            F.struct(a.alias("d"), qa.alias("p"), sa.alias("s")))
        out = F.when(a_whole, _settled(a, F.round(qa))).otherwise(_settled(b, F.round(qb)))
        # a first or a finished document has nothing to trade
        idle = a.isNull() | (pa <= eps) | (pa >= 1.0 - eps)
        return F.when(idle, F.struct(
            b.alias("d"), pb.alias("p"), sb.alias("s"),
            F.when(a.isNull(), acc["out"]).otherwise(F.concat(acc["out"], _settled(a, F.round(pa)))).alias("out"),
        )).otherwise(F.struct(keep["d"].alias("d"), keep["p"].alias("p"), keep["s"].alias("s"),
                              F.concat(acc["out"], out).alias("out")))
    return step


def _round_level(units: DataFrame, level: int, buckets: Column) -> DataFrame:
    """One level of the tree: every bucket of a source folds to one unsettled unit."""
    # large units first, so that what is left over tends to be small
    entry = F.struct((-F.col("size")).alias("o"), F.xxhash64(F.lit(SEED + level), F.col("doc")).alias("h"),
                     F.col("doc").alias("d"), F.col("p"), F.col("size").alias("s"))
    bucket = F.pmod(F.xxhash64(F.lit(SEED), F.lit(level), F.col("doc")), buckets)
    grouped = units.groupBy("source", bucket.alias("bucket")).agg(F.array_sort(F.collect_list(entry)).alias("xs"))
    start = F.struct(F.lit(None).cast("string").alias("d"), F.lit(0.0).alias("p"), F.lit(0.0).alias("s"),
                     F.array().cast("array<struct<d:string,c:int>>").alias("out"))
    return grouped.select("source", F.aggregate("xs", start, _trade(level)).alias("r"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", size: Column | None = None,
        weights: tuple[float, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(id, source, size, source_size, target, copies) for every row of ``docs``."""
    size = n_words(F.col("text")) if size is None else size
    rows = stored(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size")),
                  "mix-sizes")
    targets = stored(source_targets(rows, weights, max_repeat), "mix-targets")
    # equal rows share one draw, so a repeated row can't crowd a bucket
    doc_key = F.sha2(F.to_json(F.struct("id", "source", "size")), 256)
    units = rows.groupBy("id", "source", "size").agg(F.count(F.lit(1)).alias("m"))
    drawn = units.alias("u").join(targets.alias("t"), F.col("u.source").eqNullSafe(F.col("t.source"))).select(
        "u.id", "u.source", "u.size", "m", "source_size", "target", "n_docs",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("ratio"))
    drawn = stored(drawn.withColumn("doc", F.substring(doc_key, 1, 32))
                   .withColumn("whole", F.floor("ratio").cast("int"))
                   .withColumn("p", F.col("ratio") - F.floor("ratio")), "mix-drawn")
    open_units = drawn.filter((F.col("p") > 0) & (F.col("size") > 0)).select(
        "source", "doc", "p", (F.col("size") * F.col("m")).cast("double").alias("size"), "n_docs")
    most = targets.agg(F.max("n_docs")).first()[0] or 0
    levels = max(1, math.ceil(math.log(max(most, 2), FAN_IN)))
    out, level_units, expect = [], open_units, F.col("n_docs")
    for level in range(levels):
        expect = F.ceil(expect / F.lit(FAN_IN)) if level < levels - 1 else F.lit(1)
        folded = stored(_round_level(level_units.select("source", "doc", "p", "size", "n_docs"), level, expect
                                     ).join(targets.select(F.col("source").alias("ts"), "n_docs"),
                                            F.col("source").eqNullSafe(F.col("ts"))).drop("ts"),
                        f"mix-level{level}")
        out.append(folded.select(F.inline("r.out")))
        level_units = folded.select("source", F.col("r.d").alias("doc"), F.col("r.p").alias("p"),
                                    F.col("r.s").alias("size"), "n_docs")
    # what is left at the root of each source goes to the nearer whole number of copies
    last = level_units.select(F.col("doc").alias("d"), F.round("p").cast("int").alias("c"))
    settled = last
    for part in out:
        settled = settled.unionByName(part)
    joined = drawn.join(settled, drawn["doc"] == settled["d"], "left")
    copies = F.when(F.col("size") > 0, F.col("whole") + F.coalesce("c", F.lit(0))).otherwise(F.lit(0))
    return joined.select("id", "source", "size", "source_size", "target", copies.cast("int").alias("copies"), "m")\
        .withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("m")))).drop("m", "_row")


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS,
                    max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``docs`` with every row repeated by its copies (rows without a copy go)."""
    plan = mix(docs, weights=weights, max_repeat=max_repeat).select(
        F.col("id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"),
        "copies").dropDuplicates(["_id", "_source", "_size"]).filter(F.col("copies") > 0)
    rows = packed(docs, id=docs["doc_id"], source=docs["source"], size=n_words(docs["text"]))
    return rows.join(plan, F.col("id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source"))
                     & (F.col("size") == F.col("_size"))).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    """op1: (doc_id, size, source_size, target, taken) over all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix(docs).select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                            (F.col("copies") * F.col("size")).cast("bigint").alias("taken"), "source", "copies")

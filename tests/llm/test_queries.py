"""Registered queries on the smallest table, and the pipeline against its operators."""

import duckdb
import pytest
import texts as T
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from vigil.llm import jaccard, langid, weaklabel
from vigil.llm.common import stored
from vigil.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLE = {"op7_warc": "pages"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op8_learned_index"} - set(ORACLE)))
def test_one_row_per_input_row(spark, name):
    table = TABLE.get(name, "documents")
    key = "page_id" if table == "pages" else "doc_id"
    out = entry.queries()[name](spark, SF)
    want = spark.read.parquet(f"{SF}/{table}.parquet")
    assert sorted(r[0] for r in out.select(key).collect()) == sorted(r[0] for r in want.select(key).collect())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    want = con.execute(ORACLE[name])
    columns = sorted(d[0] for d in want.description)
    at = [[d[0] for d in want.description].index(c) for c in columns]
    want = sorted(tuple(r[i] for i in at) for r in want.fetchall())
    out = entry.queries()[name](spark, SF)
    assert sorted(out.columns) == columns
    assert sorted(tuple(r) for r in out.select(*columns).collect()) == want and want


def test_search_query(spark):
    out = entry.queries()["op8_learned_index"](spark, SF)
    n = spark.read.parquet(f"{SF}/embeddings.parquet").filter("vec_id % 100 = 0").count()
    assert out.count() == 10 * n


def test_stages_take_effect(spark):
    docs = T.documents(spark)
    seen = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, seen = seen, stored(stage(spark, seen, SF), f"test-{name}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert seen.columns == docs.columns
        if name == "language":
            assert seen.count() == langid.accept(before).count() < before.count()
        if name == "quality":
            assert seen.count() == weaklabel.accept(before).count() <= before.count()
        if name == "near_duplicates":
            found = jaccard.near_duplicates(before).filter(F.col("id") == F.col("component_id")).select("id").distinct().count()
            assert seen.filter("doc_id is not null").count() == found
        if name == "mix":
            assert seen.select("doc_id").distinct().count() <= before.count()
        if name == "encode":
            assert seen.count() == before.count() and seen.filter("not round_trip").count() == 0


def test_pipeline_of_nothing(spark):
    seen = T.empty(spark)
    for name, stage in corpus_pipeline.STAGES:
        seen = stored(stage(spark, seen, SF), f"test-{name}")
    assert seen.count() == 0

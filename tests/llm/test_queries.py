"""The registered queries against their SQL, and the pipeline against its parts."""

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from listloom.llm import queries
from listloom.llm.common import prepare, stored

DATA = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark", "labels", "conversations")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_gives_the_rows_of_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    cur = con.execute(queries.SQL[name])
    columns = sorted(c[0] for c in cur.description)
    place = [[c[0] for c in cur.description].index(c) for c in columns]
    wanted = sorted((str([r[i] for i in place]) for r in cur.fetchall()))
    got = queries.QUERIES[name](spark, DATA)
    assert sorted(got.columns) == columns
    assert sorted(str(list(r)) for r in got.select(*columns).collect()) == wanted


def test_all_queries_are_registered():
    found = __spark_entry__.queries()
    assert {"pipeline", *queries.QUERIES} <= set(found)
    assert {name.split("_")[0] for name in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(queries.SQL) <= set(__spark_entry__.oracle_sql())


def test_pipeline_stages_keep_columns_and_only_drop(spark):
    docs = prepare(spark).read.parquet(f"{DATA}/documents.parquet")
    columns, before = docs.columns, {tuple(r) for r in docs.collect()}
    sizes = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, DATA), "stage")
        rows = [tuple(r) for r in docs.collect()]
        assert docs.columns == columns and set(rows) <= before
        before = set(rows)
        sizes.append(len(rows))
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == {r[0] for r in before}


def test_pipeline_of_an_empty_table(spark, tmp_path):
    for t in TABLES:
        spark.read.parquet(f"{DATA}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_takes_nulls_and_clashing_columns(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("doc_id < 60")
    odd = docs.withColumns({c: F.lit("x") for c in ("_mark", "_id", "_hash", "_text_hash", "_key", "key", "row", "label", "group", "mark")})
    gaps = odd.withColumns({"doc_id": F.when(F.col("doc_id") % 9 != 0, F.col("doc_id")), "text": F.when(F.col("doc_id") % 7 != 0, F.col("text")), "lang": F.lit(None).cast("string")})
    docs = stored(gaps.unionByName(gaps.where("doc_id < 5")), "odd")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, DATA), "stage")
        assert docs.columns == gaps.columns
    assert docs.count() > 0

"""The registered queries against their SQL, and the pipeline, on the smallest tables."""

import os

import duckdb
import pytest

import corpus_pipeline
from ledgerloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
WITH_SQL = sorted(name for name, (_, sql) in QUERIES.items() if sql)


@pytest.fixture(scope="module")
def engine():
    if not os.path.isdir(FOLDER):
        pytest.skip("the given tables are not here")
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_equals_sql(spark, engine, name):
    query, sql = QUERIES[name]
    df = query(spark, FOLDER)
    columns = sorted(df.columns)
    got = [tuple(row[c] for c in columns) for row in df.collect()]
    result = engine.sql(sql)
    assert sorted(result.columns) == columns
    place = [result.columns.index(c) for c in columns]
    want = [tuple(row[i] for i in place) for row in result.fetchall()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_pipeline(spark, engine):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "personal_data", "packing",
    ]
    packed = corpus_pipeline.run(spark, FOLDER)
    kept = {r.doc_id for r in packed.select("doc_id").distinct().collect()}
    assert 0 < len(kept) < docs.count()
    toxic = {r[0] for r in engine.sql("SELECT doc_id FROM documents").fetchall()} - kept
    assert toxic
    pieces = packed.toPandas().sort_values(["doc_id", "start"])
    assert (pieces.groupby("doc_id").length.sum() == pieces.groupby("doc_id").doc_tokens.first()).all()

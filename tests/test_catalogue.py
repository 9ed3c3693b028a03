"""Registered queries against their SQL on the smallest tables.

By default a few queries of each module; LEDGERLOOM_ALL=1 takes all of them.
"""

import os

import duckdb
import pytest

from catalogue import all_queries, all_sql
from catalogue.profiles import TABLES

FOLDER = "/root/testdata/sf0.001"
SAMPLE = (
    "field_profile value_distribution rows_per_entity_buckets orphan_rows field_differences label_collision_profile "
    "xid_conflicts entity_xid_identity identity_consistency dob_sources gender_identity redirect_walk redirect_detail "
    "final_audit search_text_quality norm_conservative feed_fingerprint progress_violations"
).split()
NAMES = sorted(all_sql()) if os.environ.get("LEDGERLOOM_ALL") else SAMPLE


@pytest.fixture(scope="module")
def engine():
    if not os.path.isdir(FOLDER):
        pytest.skip("the given tables are not here")
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(all_sql()) == set(all_queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, engine, name):
    df = all_queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = [tuple(row[c] for c in columns) for row in df.collect()]
    result = engine.sql(all_sql()[name])
    assert sorted(result.columns) == columns
    place = [result.columns.index(c) for c in columns]
    want = [tuple(row[i] for i in place) for row in result.fetchall()]
    assert sorted(got, key=str) == sorted(want, key=str)

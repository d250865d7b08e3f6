"""Registered queries against their SQL at the smallest scale."""

import os

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, normal
from recollect.plans import registry

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the test tables")

# the others differ from these in data only, and check.py runs all of them
NAMES = [
    "t5_transcripts",
    "t9_keep_user_lines",
    "e5_hashing_embedder",
    "w1_ingest_sessions",
    "w2_apply_delta",
    "w5_upsert_rules",
    "q6_top_k_split_tenants",
    "q7_approximate_search",
    "q9_shape_results",
    "q11_search",
    "r3_isolation_report",
    "p6_policy",
]


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert all(sql for _, sql in registry().values())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, con, name):
    got = normal(queries()[name](spark, SF_DIR).toPandas())
    want = normal(con.execute(oracle_sql()[name]).df())
    assert len(got) > 0
    pd.testing.assert_frame_equal(got, want, rtol=0, atol=0)


def test_entry(spark):
    assert entry(spark).count() > 0

"""A sample of queries against their SQL at the smallest scale; check.py runs them all."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"
SAMPLE = [
    "inventory_customer_orders",
    "upsert_lineitem",
    "cascade_delete",
    "fk_suite",
    "completeness",
    "running_throughput",
    "ema_latency",
    "throttle_stats",
    "map_clients",
    "map_quotes",
    "deferred_notes_stored",
    "extract_pass",
    "download_pass",
    "content_dedup",
    "stream_upsert",
    "stream_rate",
]


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, con, name):
    df = queries()[name](spark, FOLDER)
    cursor = con.execute(oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, cursor.fetchall())


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())

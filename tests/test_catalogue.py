"""Every catalogue query against the equivalent SQL on the same tables."""

import os

import oracle
import pyarrow.parquet as pq
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from flowkit.catalogue import streams
from flowkit.catalogue.registry import GAPPY_ORDERS_SQL, QUERIES, SQL

SPARK_TYPES = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "INTEGER": "int"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle.connect(sf_dir)


def test_sql_belongs_to_queries():
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql())
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, duck, name):
    names, rows = oracle.spark_rows(QUERIES[name](spark, sf_dir))
    expected_names, expected = oracle.sql_rows(duck, SQL[name])
    assert names == expected_names
    assert rows and not rows - expected and not expected - rows


def test_entry_gives_rows(spark):
    assert entry(spark).count() == 3


STREAMS = ["stream_load", "stream_split", "stream_ledger", "load_summary", "stream_dedupe", "circuit_states"]


@pytest.fixture(scope="module")
def odd_times(spark, small_dir, tmp_path_factory):
    """Tables whose events have no time in part and one time far from the others."""
    path = str(tmp_path_factory.mktemp("odd"))
    for name in oracle.TABLES:
        if name != "events":
            os.symlink(f"{small_dir}/{name}.parquet", f"{path}/{name}.parquet")
    connection = oracle.connect(small_dir)
    ts = "CASE WHEN event_id % 9 = 0 THEN NULL WHEN event_id = 1 THEN ts + INTERVAL 1 DAY * 9000 ELSE ts END AS ts"
    connection.execute(f"COPY (SELECT * REPLACE ({ts}) FROM events) TO '{path}/events.parquet'")
    return path


@pytest.mark.parametrize("name", STREAMS)
def test_streams_read_events_without_a_time(spark, odd_times, name):
    names, rows = oracle.spark_rows(QUERIES[name](spark, odd_times))
    expected_names, expected = oracle.sql_rows(oracle.connect(odd_times), SQL[name])
    assert names == expected_names and rows and rows == expected


def test_streams_have_parts_of_equal_rows(spark, odd_times, small_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "ROWS_PER_FILE", 100)
    path, files = streams._split_events(spark, odd_times)
    parts = sorted(os.path.getmtime(f"{path}/{f}") for f in os.listdir(path) if f.startswith("part-"))
    assert files > 1 and len(parts) == files * streams.FILES
    assert spark.read.parquet(path).count() == spark.read.parquet(f"{odd_times}/events.parquet").count()
    ledger = QUERIES["stream_ledger"](spark, odd_times).first()
    assert ledger["batches"] == streams.FILES
    monkeypatch.undo()
    path, _ = streams._split_events(spark, small_dir)
    sizes = [pq.read_metadata(f"{path}/{f}").num_rows for f in os.listdir(path) if f.startswith("part-")]
    assert len(sizes) == streams.FILES and max(sizes) - min(sizes) <= 1
    spark.read.parquet(f"{small_dir}/events.parquet").where("false").write.parquet(f"{tmp_path}/events.parquet")
    assert QUERIES["stream_load"](spark, str(tmp_path)).count() == 0

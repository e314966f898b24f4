import datetime as dt
import json
import pathlib

import pytest
from pyspark.sql import functions as F

from flowkit.functions.schema import DOUBLE, LONG, schema
from flowkit.operators import batches, health, ledger, masking, metrics, quarantine
from flowkit.operators.rules import RuleSet, annotate

NAN = float("nan")


def rows(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


# --- quarantine


def queue(spark):
    data = [
        (dt.datetime(2024, 1, day, hour), source, error, retries, json.dumps({"id": i, "v": value}))
        for i, (day, hour, source, error, retries, value) in enumerate([
            (1, 1, "load", "timed out", 0, 5.0),
            (2, 1, "load", "Duplicate key error", 3, 50.0),
            (3, 1, "load", "connection refused", 2, 500.0),
            (1, 2, "load_create_table", "bad name", 1, 7.0),
        ])
    ]
    df = spark.createDataFrame(data, quarantine.RECORD_SCHEMA)
    return df.withColumn("dt", F.to_date("ts"))


def test_enqueue_keeps_the_whole_record(spark):
    df = spark.createDataFrame([(1, None, [1, 2])], "id INT, s STRING, a ARRAY<INT>")
    now = F.lit(dt.datetime(2024, 5, 6, 7))
    row = quarantine.enqueue(df, F.lit("boom"), "load", 2, now).first()
    assert json.loads(row["record"]) == {"id": 1, "s": None, "a": [1, 2]}
    assert (row["source"], row["error"], row["retry_count"], row["dt"]) == ("load", "boom", 2, dt.date(2024, 5, 6))


def test_quarantine_table(spark, tmp_path):
    path = str(tmp_path / "q")
    quarantine.write_quarantine(queue(spark), path)
    stored = quarantine.read_quarantine(spark, path)
    assert sorted(rows(quarantine.stats_by_source(stored))) == [("load", 3), ("load_create_table", 1)]
    files = quarantine.stats_by_file(spark, path).collect()
    assert sum(f["records"] for f in files) == 4 and all(f["size_bytes"] > 0 for f in files)
    newest = quarantine.latest_records(stored, "load", limit=2)
    assert [r["ts"].day for r in newest.collect()] == [3, 2]
    kept = quarantine.retained(stored, "load", older_than_days=1, as_of=dt.date(2024, 1, 3))
    assert sorted(r["dt"].day for r in kept.collect()) == [1, 2, 3]
    assert rows(quarantine.stats_by_source(quarantine.retained(stored, "load"))) == [("load_create_table", 1)]
    assert quarantine.retained(stored).count() == 0
    cleared = quarantine.clear(spark, path, str(tmp_path / "q2"), "load")
    assert rows(quarantine.stats_by_source(cleared)) == [("load_create_table", 1)]
    plan = stored.where("source = 'load'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(source" in plan


def test_json_lines_skip_corrupt_ones(spark, tmp_path):
    good = {"ts": "2024-01-01T00:00:00", "source": "load", "error": "e", "retry_count": 0, "record": "{}"}
    (tmp_path / "dlq.jsonl").write_text(json.dumps(good) + "\n{broken\n" + json.dumps(good) + "\n")
    assert quarantine.read_json_lines(spark, str(tmp_path)).count() == 2


def test_replay(spark):
    rules = RuleSet().add_range_rule("v", 0, 100)
    broken = queue(spark).limit(1).withColumn("record", F.lit("{oops"))
    fields = schema(id=LONG, v=DOUBLE)
    replayed = quarantine.replay(queue(spark).unionByName(broken), fields, lambda df: annotate(df, rules))
    assert rows(quarantine.replay_counts(replayed)) == [(5, 3, 2)]
    again = {r["error"]: r["retry_count"] for r in quarantine.requeued(replayed).collect()}
    assert again["unreadable record"] == 1
    assert [n for e, n in again.items() if "between 0 and 100" in e] == [3]
    assert rows(quarantine.replay_counts(quarantine.replay(queue(spark), fields, lambda df: annotate(df, rules), "load"))) == [
        (3, 2, 1)
    ]


def test_backoff(spark):
    attempts = spark.createDataFrame([(n,) for n in range(8)], "n INT")
    assert [r[0] for r in rows(attempts, quarantine.backoff_seconds(F.col("n")))] == [1, 2, 4, 8, 16, 32, 60, 60]
    assert [r[0] for r in rows(attempts, quarantine.backoff_seconds(F.col("n"), longest=10))][4] == 10
    jittered = rows(
        spark.range(1000), quarantine.backoff_seconds(F.lit(3), jitter_key=F.col("id")), F.col("id")
    )
    delays = [r[0] for r in jittered]
    assert all(7.2 <= d <= 8.8 for d in delays) and len(set(delays)) > 900
    planned = {r["error"]: (r["retriable"], r["state"]) for r in quarantine.with_retry_schedule(queue(spark)).collect()}
    assert planned == {
        "timed out": (True, "due"),
        "Duplicate key error": (False, "dead"),
        "connection refused": (True, "due"),
        "bad name": (False, "dead"),
    }


# --- ledger


def history(spark):
    frames = [
        ledger.checkpoint_row(spark, p, {"offset": i}, {"seconds": 1.5}, dt.datetime(2024, 1, 1, 0, 0, i, 123456))
        for p in ("a", "a_x")
        for i in range(7)
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def test_ledger(spark, tmp_path):
    ledger.save(history(spark), str(tmp_path / "l"))
    book = spark.read.parquet(str(tmp_path / "l"))
    assert book.agg(F.max("id")).first()[0] == "20240101_000006_123"
    newest = {r["pipeline"]: json.loads(r["data"])["offset"] for r in ledger.latest(book).collect()}
    assert newest == {"a": 6, "a_x": 6}
    assert [json.loads(r[0])["offset"] for r in rows(ledger.recovery_point(book, "a"))] == [6]
    assert ledger.load(book, "a", "20240101_000002_123").count() == 1
    assert ledger.load(book, "nobody").count() == 0
    ids = [r["id"] for r in ledger.list_checkpoints(book, "a").collect()]
    assert len(ids) == 7 and ids == sorted(ids, reverse=True)
    assert [r["total_checkpoints"] for r in ledger.stats(book).collect()] == [7, 7]
    assert ledger.keep_newest(book, 5).count() == 10
    kept = ledger.keep_newest(book, 5, "a").groupBy("pipeline").count()
    assert sorted(rows(kept)) == [("a", 5), ("a_x", 7)]
    assert sorted(rows(ledger.deleted_counts(book, 5))) == [("a", 2), ("a_x", 2)]
    assert ledger.without(book, "a").count() == 7
    assert ledger.without(book, "a", ids[0]).count() == 13
    assert ledger.rewrite(ledger.without(book, "a"), str(tmp_path / "l2")).count() == 7


def test_checkpoint_id_of_a_column(spark):
    ts = F.lit("2024-02-03 04:05:06.789").cast("timestamp")
    assert rows(spark.range(1), ledger.checkpoint_id(ts)) == [("20240203_040506_789",)]


# --- batches


def test_batches_isolate_failures(spark):
    def total(pdf):
        if (pdf["id"] == 25).any():
            raise ValueError("twenty-five")
        return int(pdf["id"].sum())

    out = {r["batch_id"]: r for r in batches.process_items(spark.range(45), total, "BIGINT", ["id"], 10, 3).collect()}
    assert {k: r["data"] for k, r in out.items()} == {0: 45, 1: 145, 2: None, 3: 345, 4: 210}
    assert out[2]["error"] == "Batch 2 failed: twenty-five" and not out[2]["success"]
    assert all(r["duration_ms"] >= 0 for r in out.values())


def test_map_reduce(spark):
    squares = batches.map_reduce(spark.range(10), lambda row: int(row["id"]) ** 2, lambda a, b: a + b, "BIGINT")
    assert rows(squares) == [(285,)]

    def odd_only(row):
        if row["id"] % 2 == 0:
            raise ValueError("even")
        return int(row["id"])

    assert rows(batches.map_reduce(spark.range(10), odd_only, max, "BIGINT")) == [(9,)]
    assert rows(batches.map_reduce(spark.range(0), odd_only, max, "BIGINT")) == [(None,)]


@pytest.mark.parametrize(
    "total,size,budget,expected",
    [(1_000_000, 0.1, 500, 5000), (100, 0.001, 500, 100), (50, 0.0, 500, 100), (5000, -1.0, 500, 500), (10, 900.0, 500, 1)],
)
def test_chunk_size(spark, total, size, budget, expected):
    df = spark.createDataFrame([(total, size)], "t BIGINT, s DOUBLE")
    assert rows(df, batches.optimal_chunk_size(F.col("t"), F.col("s"), budget)) == [(expected,)]


def test_column_bytes(spark):
    df = spark.createDataFrame([("é", 1, 1.0, True), (None, 2, None, None)], "s STRING, i INT, d DOUBLE, b BOOLEAN")
    assert rows(batches.column_bytes(df)) == [("s", 2), ("i", 8), ("d", 16), ("b", 2)]
    assert rows(batches.estimated_megabytes(df)) == [(28 / 1048576,)]


# --- metrics and health


def test_metric_values(spark):
    samples = spark.createDataFrame([("n", 1.0, 1), ("n", 5.0, 2), ("g", 3.0, 1)], "name STRING, value DOUBLE, ts INT")
    assert sorted(rows(metrics.metric_values(samples))) == [("g", 3.0, 3.0), ("n", 5.0, 6.0)]


def test_summary(spark):
    t = dt.datetime(2024, 1, 1)
    data = [(t, t + dt.timedelta(seconds=10), 1000, 0, 0), (t, t + dt.timedelta(seconds=30), 0, 500, 10)]
    runs = spark.createDataFrame(data, "started_at TIMESTAMP, ended_at TIMESTAMP, extracted INT, attempted INT, failed INT")
    assert rows(metrics.metrics_summary(runs)) == [(1000, 490, 10, 30.0)]
    assert rows(metrics.metrics_summary(runs.limit(0))) == [(0, 0, 0, 0.0)]


def test_throughput_progress_and_numeric(spark):
    one = spark.range(1)
    assert rows(one, metrics.throughput(F.lit(10), F.lit(4)), metrics.throughput(F.lit(10), F.lit(0))) == [(2.5, 0.0)]
    parts = [metrics.progress_percent(F.lit(a), F.lit(b)) for a, b in ((1, 3), (5, 0), (7, 7), (2, 3))]
    assert rows(one, *parts) == [(33, 0, 100, 66)]
    maps = spark.createDataFrame([(1, {"a": "1.5", "b": "x", "c": None})], "id INT, m MAP<STRING, STRING>")
    assert rows(metrics.numeric_metrics(maps, "m", "id")) == [(1, "a", 1.5)]


def test_operation_counts(spark):
    data = [("db", "read", True, 1.0, 1), ("db", "read", False, 2.0, 3), ("db", "read", True, 3.0, 2)]
    df = spark.createDataFrame(data, "component STRING, operation STRING, ok BOOLEAN, duration DOUBLE, ts INT")
    assert rows(metrics.operation_counts(df)) == [("db", "read", 2, 1, 2.0)]


def test_job_progress(spark):
    data = [("j", 1, 10, True, 40), ("j", 2, 10, False, 40), ("j", 3, 20, True, 40), ("k", 1, 5, True, 0)]
    chunks = spark.createDataFrame(data, "job STRING, chunk INT, rows INT, ok BOOLEAN, total_rows INT")
    out = metrics.job_progress(chunks, ["chunk"], buckets=3)
    seen = {(r["job"], r["chunk"]): (r["rows_extracted"], r["rows_loaded"], r["rows_failed"], r["progress"]) for r in out.collect()}
    assert seen == {("j", 1): (10, 10, 0, 25), ("j", 2): (20, 10, 10, 50), ("j", 3): (40, 30, 10, 100), ("k", 1): (5, 5, 0, 0)}


def test_logs(spark):
    lines = ['{"timestamp": "2024-01-01T00:10:00", "level": "INFO", "logger": "l", "message": "m", "rows": 5}', "not json"]
    parsed = metrics.parse_logs(spark.createDataFrame([(x,) for x in lines], "value STRING"))
    good = parsed.where("level = 'INFO'").collect()
    assert len(good) == 1 and good[0]["extra"] == {"rows": "5"}
    counted = metrics.log_counts(parsed)
    assert set(rows(counted)) == {(None, "UNPARSED", 1), (dt.datetime(2024, 1, 1), "INFO", 1)}
    assert parsed.where("level = 'UNPARSED'").first()["message"] == "not json"


def test_status_boundaries(spark):
    def one(c):
        return rows(spark.range(1), c)[0][0]

    database, warehouse = F.lit("database"), F.lit("warehouse")
    assert one(health.latency_status(database, F.lit(999.9))) == "healthy"
    assert one(health.latency_status(database, F.lit(1000.0))) == "degraded"
    assert one(health.latency_status(warehouse, F.lit(1999.0))) == "healthy"
    assert one(health.latency_status(warehouse, F.lit(2000.0))) == "degraded"
    assert one(health.latency_status(database, F.lit(None).cast("double"))) == "unhealthy"
    assert one(health.latency_status(database, F.lit(1.0), F.lit("refused"))) == "unhealthy"
    assert one(health.latency_status(F.lit("other"), F.lit(1.0))) == "unknown"
    assert [one(health.memory_status(F.lit(p))) for p in (69.9, 70.0, 84.9, 85.0)] == [
        "healthy", "degraded", "degraded", "unhealthy",
    ]
    assert [one(health.pipeline_status(F.lit(f), F.lit(q))) for f, q in ((100, 50), (100, 51), (101, 51))] == [
        "healthy", "degraded", "unhealthy",
    ]


@pytest.mark.parametrize(
    "statuses,overall",
    [
        ([], "unknown"),
        (["healthy"], "healthy"),
        (["healthy", "unknown"], "unknown"),
        (["degraded", "unknown"], "degraded"),
        (["degraded", "unhealthy", "healthy"], "unhealthy"),
    ],
)
def test_overall_status(spark, statuses, overall):
    results = spark.createDataFrame([(s,) for s in statuses], "status STRING")
    assert rows(health.overall_status(results)) == [(overall,)]
    report = health.health_report(results).first()
    assert report["healthy_count"] == statuses.count("healthy") and report["unhealthy_count"] == statuses.count("unhealthy")


def test_due_checks(spark):
    t = dt.datetime(2024, 1, 1, 0, 1, 0)
    results = spark.createDataFrame(
        [("a", "healthy", t), ("a", "degraded", t - dt.timedelta(seconds=300)), ("b", "healthy", t + dt.timedelta(seconds=1))],
        "component STRING, status STRING, ts TIMESTAMP",
    )
    components = spark.createDataFrame([("a",), ("b",), ("c",)], "component STRING")
    due = health.due_checks(components, results, F.lit(t + dt.timedelta(seconds=60)))
    assert {r["component"]: r["is_due"] for r in due.collect()} == {"a": True, "b": False, "c": True}
    assert {r["component"]: r["status"] for r in health.latest_results(results).collect()} == {"a": "healthy", "b": "healthy"}


# --- masking


def test_masking_at_any_depth(spark):
    df = spark.sql(
        """SELECT 1 AS id, 'p' AS Password,
          named_struct('host', 'h', 'private_key', 'k', 'deep', named_struct('client_email', 'e', 'n', 2)) AS db,
          array(named_struct('token_uri', 't', 'n', 1)) AS list, array('plain') AS texts,
          map('PASSWORD', 'x', 'user', 'u') AS m, map('password', 5, 'n', 6) AS numbers,
          named_struct('a', 1) AS credentials, CAST(NULL AS STRUCT<private_key: STRING>) AS nothing"""
    )
    row = masking.mask_sensitive(df).first().asDict(recursive=True)
    mask = masking.MASK
    assert row == {
        "id": 1,
        "Password": mask,
        "db": {"host": "h", "private_key": mask, "deep": {"client_email": mask, "n": 2}},
        "list": [{"token_uri": mask, "n": 1}],
        "texts": ["plain"],
        "m": {"PASSWORD": mask, "user": "u"},
        "numbers": {"password": None, "n": 6},
        "credentials": mask,
        "nothing": None,
    }


def test_missing_fields(spark):
    documents = [('{"type": 1, "client_email": 2}',), ("{broken",), (None,), ('{"type":1,"project_id":1,"private_key":1,"client_email":1}',)]
    df = spark.createDataFrame(documents, "d STRING")
    found = [r[0] for r in rows(df, masking.missing_fields(F.col("d")))]
    every = list(masking.REQUIRED_FIELDS)
    assert found == [["project_id", "private_key"], every, every, []]


def test_map_reduce_by_batch_drops_only_the_rows_that_raise(spark):
    def total(batch):
        ids = batch.column("id").to_pylist()
        if {7, 500, 501} & set(ids):
            raise ValueError("bad row")
        return sum(ids)

    found = batches.map_reduce(spark.range(0, 1_000, 1, 3), total, lambda a, b: a + b, "BIGINT", by_batch=True)
    assert rows(found) == [(sum(range(1_000)) - 7 - 500 - 501,)]


def stored_files(path):
    return {f: f.stat().st_mtime_ns for f in sorted(pathlib.Path(path).rglob("part-*.parquet"))}


def test_ledger_in_place_touches_only_what_changes(spark, tmp_path):
    path = str(tmp_path / "ledger")
    rows = [(f"2024010{i}_000000_000", p, dt.datetime(2024, 1, i), "{}", "{}") for p in ("a", "a b/c", "keep") for i in range(1, 8)]
    rows = [r for r in rows if r[1] != "keep" or r[0] < "20240104"]
    ledger.save_by_pipeline(spark.createDataFrame(rows, ledger.LEDGER_SCHEMA), path)
    before = stored_files(path)
    assert ledger.prune_in_place(spark, path, keep=5) == ["a", "a b/c"]
    ledger.delete_in_place(spark, path, "keep", "no such checkpoint")
    untouched = {f: t for f, t in before.items() if "pipeline=keep" in str(f)}
    assert untouched and untouched == {f: t for f, t in stored_files(path).items() if "pipeline=keep" in str(f)}
    kept = ledger.read_by_pipeline(spark, path)
    assert {r["pipeline"]: r["n"] for r in kept.groupBy("pipeline").agg(F.count("*").alias("n")).collect()} == {"a": 5, "a b/c": 5, "keep": 3}
    assert kept.where("pipeline = 'a'").agg(F.min("id")).first()[0].startswith("20240103")
    ledger.delete_in_place(spark, path, "a b/c", "20240107_000000_000")
    ledger.delete_in_place(spark, path, "keep")
    now = ledger.read_by_pipeline(spark, path).collect()
    assert sorted(r["pipeline"] for r in now) == ["a"] * 5 + ["a b/c"] * 4
    assert ledger.prune_in_place(spark, path, keep=5) == []
    for i in range(3, 7):
        ledger.delete_in_place(spark, path, "a b/c", f"2024010{i}_000000_000")
    assert {r["pipeline"] for r in ledger.read_by_pipeline(spark, path).collect()} == {"a"}


def test_quarantine_in_place_deletes_folders_only(spark, tmp_path):
    path = str(tmp_path / "q")
    rows = [(dt.datetime(2024, 1, d), s, "e", 0, f"{s}{d}", dt.date(2024, 1, d)) for s in ("load", "load x") for d in (1, 5, 9)]
    rows.append((None, "load", "e", 0, "undated", None))
    columns = "ts timestamp, source string, error string, retry_count int, record string, dt date"
    quarantine.write_quarantine(spark.createDataFrame(rows, columns), path)
    before = stored_files(path)
    assert quarantine.clear_in_place(spark, path, "load", older_than_days=4, as_of=dt.date(2024, 1, 9)) == 1
    assert stored_files(path).items() < before.items()
    left = {r["record"] for r in quarantine.read_quarantine(spark, path).collect()}
    assert left == {"load5", "load9", "undated", "load x1", "load x5", "load x9"}
    assert quarantine.clear_in_place(spark, path, "load x") == 3
    assert quarantine.clear_in_place(spark, path) == 3 and quarantine.read_quarantine(spark, path).count() == 0

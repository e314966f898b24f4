import datetime as dt
import json
import subprocess
import sys

import pytest
from pyspark.serializers import CloudPickleSerializer
from pyspark.sql import functions as F

from flowkit.functions.schema import TEXT, schema
from flowkit.operators.rules import RuleSet
from flowkit.sources.tables import read_stream
from flowkit.streaming.circuit import Circuit, CircuitLog
from flowkit.streaming.events import (
    LateSplit,
    deduplicate_stream,
    latest_updates,
    orphans_in_stream,
    window_progress,
    write_updates,
)
from flowkit.operators.metrics import metrics_summary
from flowkit.streaming.load import (
    StreamLoad,
    ledger_batches,
    ledger_runs,
    load_progress,
    query_progress,
    read_ledger,
    read_loaded,
)


@pytest.fixture
def event_files(spark, small_dir, tmp_path):
    """The events split over 16 files."""
    events = spark.read.parquet(f"{small_dir}/events.parquet")
    path = str(tmp_path / "events")
    events.repartition(16, "event_id").write.parquet(path)
    return path, events


def sink(spark, stream, tmp_path, mode="append"):
    out = {}

    def keep(batch, _):
        rows = [tuple(r) for r in batch.collect()]
        out.setdefault("rows", []).extend(rows) if mode == "append" else out.update(rows=rows)

    query = stream.writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / "state"))
    query.outputMode(mode).trigger(availableNow=True).start().awaitTermination()
    return out["rows"]


def paths(tmp_path):
    return {k: str(tmp_path / k) for k in ("target", "checkpoint", "ledger", "quarantine")}


def test_load_resumes_without_loss_or_duplicates(spark, event_files, tmp_path):
    source, events = event_files
    where = paths(tmp_path)

    class Stop(Exception):
        pass

    def stop_at_third(batch):
        calls.append(1)
        if len(calls) == 3:
            raise Stop("killed")
        return batch

    calls = []
    stream = read_stream(spark, source, events.schema, max_files=4)
    where.pop("quarantine")
    broken = StreamLoad(**where, transform=stop_at_third)
    with pytest.raises(Exception, match="killed"):
        broken.run_to_end(stream)
    partly = read_loaded(spark, where["target"], events.schema).count()
    assert 0 < partly < events.count()
    StreamLoad(**where).run_to_end(read_stream(spark, source, events.schema, max_files=4))
    loaded = read_loaded(spark, where["target"], events.schema)
    assert loaded.count() == events.count() and loaded.exceptAll(events).count() == 0
    batches = ledger_batches(read_ledger(spark, where["ledger"])).collect()
    assert sorted(b["batch_id"] for b in batches) == [0, 1, 2, 3]
    assert sum(b["rows_loaded"] for b in batches) == events.count()
    recorded = query_progress(read_ledger(spark, where["ledger"]))
    assert recorded.agg(F.sum("input_rows")).first()[0] == events.count() and recorded.where("seconds > 0").count() == 4
    totals = metrics_summary(ledger_runs(read_ledger(spark, where["ledger"]))).first()
    assert totals["records_loaded"] == events.count() and totals["uptime_seconds"] > 0
    progress = load_progress(read_ledger(spark, where["ledger"]), F.lit(events.count())).orderBy("batch_id").collect()
    assert [p["progress"] for p in progress] == sorted(p["progress"] for p in progress)
    assert (progress[-1]["progress"], progress[-1]["extracted_so_far"]) == (100, events.count())
    events.limit(3).write.mode("append").parquet(source)
    StreamLoad(**where).run_to_end(read_stream(spark, source, events.schema, max_files=4))
    assert read_loaded(spark, where["target"], events.schema).count() == events.count() + 3


def test_repeated_batch_replaces_itself(spark, event_files, tmp_path):
    _, events = event_files
    load = StreamLoad(**paths(tmp_path), rules=RuleSet().add_range_rule("value", 0, 50))
    for _ in range(2):
        load.write_batch(events, 0)
    good = read_loaded(spark, load.target, events.schema).count()
    bad = read_loaded(spark, load.quarantine, schema(record=TEXT)).count()
    assert good == events.where("value <= 50").count() and good + bad == events.count()
    assert ledger_batches(read_ledger(spark, load.ledger)).count() == 1


def test_batches_without_valid_or_invalid_rows(spark, event_files, tmp_path):
    _, events = event_files
    load = StreamLoad(**paths(tmp_path), rules=RuleSet().add_range_rule("value", 0, 10**9))
    load.write_batch(events, 0)
    load.write_batch(events.limit(0), 1)
    none = StreamLoad(**paths(tmp_path / "none"), rules=RuleSet().add_range_rule("value", -2, -1))
    none.write_batch(events, 0)
    counts = ledger_batches(read_ledger(spark, load.ledger)).orderBy("batch_id").collect()
    assert [(r["rows_loaded"], r["rows_failed"]) for r in counts] == [(events.count(), 0), (0, 0)]
    counts = ledger_batches(read_ledger(spark, none.ledger)).collect()
    assert [(r["rows_loaded"], r["rows_failed"]) for r in counts] == [(0, events.count())]


def test_failed_batch_is_kept_and_the_run_goes_on(spark, event_files, tmp_path):
    source, events = event_files
    calls = []

    def second_fails(batch):
        calls.append(1)
        return batch.select("no_such_column") if len(calls) == 2 else batch

    load = StreamLoad(**paths(tmp_path), run="r1", transform=second_fails)
    load.run_to_end(read_stream(spark, source, events.schema, max_files=4))
    kept = read_loaded(spark, load.quarantine, schema(source=TEXT, error=TEXT, record=TEXT))
    loaded = read_loaded(spark, load.target, events.schema)
    assert loaded.count() + kept.count() == events.count() and kept.count() > 0
    assert "no_such_column" in kept.first()["error"]
    ids = kept.select(F.get_json_object("record", "$.event_id").cast("long").alias("event_id"))
    assert ids.intersect(loaded.select("event_id")).count() == 0
    failed = [r for r in ledger_batches(read_ledger(spark, load.ledger)).collect() if r["error"]]
    assert len(failed) == 1 and failed[0]["rows_failed"] == kept.count()


def test_rules_need_a_quarantine(tmp_path):
    with pytest.raises(ValueError, match="quarantine"):
        StreamLoad(str(tmp_path), str(tmp_path), rules=RuleSet().add_not_null_rule("x"))


@pytest.mark.parametrize("salt_by", [[], ["value"]])
def test_stream_dedupe_over_repeated_files(spark, event_files, tmp_path, salt_by):
    source, events = event_files
    events.write.mode("append").parquet(source)
    stream = read_stream(spark, source, events.schema, max_files=5)
    rows = sink(spark, deduplicate_stream(stream, ["event_id"], delay="60 days", salt_by=salt_by), tmp_path)
    assert sorted(r[0] for r in rows) == sorted(r[0] for r in events.select("event_id").collect())


def test_windows_equal_the_batch_form(spark, event_files, tmp_path):
    source, events = event_files

    def windows(df):
        return window_progress(df, F.col("value") > 60, every="1 day", keys=["event_type"], delay="60 days")

    batch = sorted(tuple(r) for r in windows(events).collect())
    stream = windows(read_stream(spark, source, events.schema, max_files=3))
    assert sorted(sink(spark, stream, tmp_path, "complete")) == batch
    where, state = str(tmp_path / "updates"), str(tmp_path / "updates-state")
    query = write_updates(stream, where, state)
    query.awaitTermination()
    latest = latest_updates(spark, where, stream.schema, ["window_start", "event_type"])
    assert sorted(tuple(r) for r in latest.collect()) == batch


def test_circuit_opens_tries_and_closes():
    c = Circuit(threshold=5, recovery=60)
    seen = [(c.apply(t, False), c.state) for t in range(5)]
    assert seen[3:] == [("applied", "closed"), ("applied", "open")]
    assert (c.apply(30, True), c.state) == ("rejected", "open")
    assert (c.apply(64, True), c.state) == ("applied", "half_open")
    assert (c.apply(65, False), c.state) == ("applied", "open")
    assert (c.apply(20, True), c.state) == ("late", "open")
    assert (c.apply(125, True), c.state) == ("applied", "half_open")
    assert (c.apply(126, True), c.state) == ("applied", "closed")
    assert [c.apply(127 + i, False) for i in range(4)] == ["applied"] * 4
    c.apply(131, True)
    c.apply(132, False)
    assert c.state == "closed"


def test_circuit_stream_equals_a_replay(spark, tmp_path):
    """Files arrive in time order, one per batch; the states equal one pass over each key."""
    import random

    r = random.Random(11)
    events = [(i, r.choice(["a", "b", "hot", "hot"]), dt.datetime(2024, 1, 1) + dt.timedelta(seconds=20 * i), r.random() < 0.45) for i in range(300)]
    columns = "event_id BIGINT, k STRING, ts TIMESTAMP, ok BOOLEAN"
    source = tmp_path / "events"
    for part in range(3):
        spark.createDataFrame(events[part * 100 : part * 100 + 100], columns).coalesce(1).write.mode("append").parquet(str(source))
    stream = read_stream(spark, str(source), spark.createDataFrame([], columns).schema, max_files=1)
    log = CircuitLog(str(tmp_path / "log"), str(tmp_path / "state"), "k", "ok", threshold=3, recovery_seconds=90)
    log.run_to_end(stream)
    log.write_batch(spark.read.parquet(str(source)).where("event_id >= 200"), 2)  # a repeated batch
    rows = [tuple(r) for r in log.outcomes(spark, stream.schema).collect()]
    expected, circuits = {}, {}
    for i, k, ts, ok in events:
        c = circuits.setdefault(k, Circuit(3, 90_000_000))
        before = c.state
        outcome = c.apply(int(ts.timestamp() * 1e6), ok)
        expected[i] = (before, c.state, outcome)
    assert {x[2]: (x[4], x[5], x[6]) for x in rows} == expected
    assert {o for _, _, o in expected.values()} == {"applied", "rejected"}


def test_circuit_forgets_idle_keys(spark, tmp_path):
    columns = "event_id BIGINT, k STRING, ts TIMESTAMP, ok BOOLEAN"
    source = str(tmp_path / "events")
    t = dt.datetime(2024, 1, 1)
    steps = [
        [(1, "a", t, False)],
        [(2, "b", t + dt.timedelta(hours=5), True)],
        [(3, "b", t + dt.timedelta(hours=6), True)],
        [(4, "a", t + dt.timedelta(hours=7), False)],
    ]
    kinds = spark.createDataFrame([], columns).schema
    for idle, state in ((3600, "closed"), (None, "open")):
        log = CircuitLog(str(tmp_path / f"log{idle}"), str(tmp_path / f"state{idle}"), "k", "ok", threshold=2, idle_seconds=idle)
        for step in steps:
            if idle:
                spark.createDataFrame(step, columns).coalesce(1).write.mode("append").parquet(source)
            log.run_to_end(read_stream(spark, source, kinds, max_files=1))
        assert {r["tie_break"]: r["state_after"] for r in log.outcomes(spark, kinds).collect()}[4] == state


def test_circuits_of_many_keys_over_many_arrow_batches(spark, tmp_path):
    import random

    r = random.Random(5)
    t = dt.datetime(2024, 1, 1)
    events = [(i, r.choice([None, "hot", "hot", *"abcdef"]), None if i % 17 == 0 else t + dt.timedelta(seconds=r.randrange(900)), r.choice([True, False, None])) for i in range(400)]
    frame = spark.createDataFrame(events, "event_id BIGINT, k STRING, ts TIMESTAMP, ok BOOLEAN")
    log = CircuitLog(str(tmp_path / "log"), str(tmp_path / "state"), "k", "ok", threshold=2, recovery_seconds=60)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        log.write_batch(frame.where("event_id < 250"), 0)
        log.write_batch(frame.where("event_id < 0"), 1)
        log.write_batch(frame.where("event_id >= 250"), 2)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    expected, circuits = {}, {}
    for part in (events[:250], events[250:]):
        for i, k, ts, ok in sorted(part, key=lambda e: (e[2] is None, e[2] or t, e[0])):
            c = circuits.setdefault(k, Circuit(2, 60_000_000))
            was = c.state
            outcome = c.apply(None if ts is None else int(ts.timestamp() * 1e6), bool(ok))
            expected[i] = (was, c.state, outcome)
    found = log.outcomes(spark, frame.schema).collect()
    assert {r["tie_break"]: (r["state_before"], r["state_after"], r["outcome"]) for r in found} == expected
    assert {o for _, _, o in expected.values()} == {"applied", "rejected", "late"}


def test_code_for_executors_needs_no_copy_of_the_package(tmp_path):
    sent = tmp_path / "sent"
    sent.write_bytes(CloudPickleSerializer().dumps(Circuit))
    check = "import pickle; c = pickle.load(open('sent', 'rb'))(1, 60); c.apply(5, False); assert c.state == 'open'"
    subprocess.run([sys.executable, "-c", check], cwd=tmp_path, env={"PATH": ""}, check=True)


def test_repeated_batch_that_fails_lands_once(spark, event_files, tmp_path):
    _, events = event_files
    load = StreamLoad(**paths(tmp_path))
    load.write_batch(events, 0)
    broken = StreamLoad(**paths(tmp_path), transform=lambda df: df.select("no_such_column"))
    load.write_batch(events.limit(5), 1)
    broken.write_batch(events, 0)
    assert read_loaded(spark, load.target, events.schema).count() == 5
    assert read_loaded(spark, load.quarantine, schema(record=TEXT)).count() == events.count()


def test_transient_failure_stops_the_run(spark, event_files, tmp_path):
    _, events = event_files

    def unreachable(batch):
        raise OSError("connection reset by peer")

    load = StreamLoad(**paths(tmp_path), transform=unreachable)
    with pytest.raises(OSError, match="reset"):
        load.write_batch(events, 0)


def test_unique_rule_is_refused_in_a_stream(tmp_path):
    with pytest.raises(ValueError, match="unique"):
        StreamLoad(**paths(tmp_path), rules=RuleSet().add_unique_rule("event_id"))


@pytest.mark.parametrize("with_rules", [False, True])
def test_batch_that_fails_and_then_succeeds_stands_in_the_target_only(spark, event_files, tmp_path, with_rules):
    _, events = event_files
    rules = RuleSet().add_range_rule("value", 0, 50) if with_rules else None
    broken = StreamLoad(**paths(tmp_path), rules=rules, transform=lambda df: df.select("no_such_column"))
    load = StreamLoad(**paths(tmp_path), rules=rules)
    broken.write_batch(events, 0)
    assert read_loaded(spark, load.quarantine, schema(record=TEXT)).count() == events.count()
    load.write_batch(events, 0)
    good = read_loaded(spark, load.target, events.schema)
    bad = spark.read.schema("record STRING").parquet(f"{load.quarantine}").count() if with_rules else 0
    assert good.count() + bad == events.count() and (bad > 0) == with_rules
    assert good.count() == events.where("value <= 50").count() if with_rules else good.exceptAll(events).count() == 0


def timed_files(spark, rows, columns, path, files):
    """The rows in so many files, in order, each written after the one before."""
    size = -(-len(rows) // files)
    for i in range(files):
        spark.createDataFrame(rows[i * size : (i + 1) * size], columns).coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("files", [1, 3, 10])
def test_unique_rule_holds_over_all_batches_and_a_restart(spark, tmp_path, files):
    import random

    turns = random.Random(files)
    columns = "event_id BIGINT, k STRING, ts TIMESTAMP"
    keys = [None, "hot", "hot", "hot", *[f"k{i}" for i in range(40)]]
    rows = [(i, turns.choice(keys), dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i)) for i in range(300)]
    source = str(tmp_path / "in")
    timed_files(spark, rows, columns, source, files)
    kinds = spark.createDataFrame([], columns).schema
    load = StreamLoad(
        **paths(tmp_path), keys=str(tmp_path / "keys"), order=("ts",), key_buckets=4,
        rules=RuleSet().add_unique_rule("k").add_range_rule("event_id", 0, 250),
    )
    calls = []

    def halting(batch, batch_id):
        load.write_batch(batch, batch_id)
        calls.append(batch_id)
        if len(calls) == 2:
            raise RuntimeError("stopped after the batch was written and before it was recorded")

    def stream():
        return read_stream(spark, source, kinds, max_files=1)

    query = stream().writeStream.foreachBatch(halting).option("checkpointLocation", load.checkpoint).trigger(availableNow=True).start()
    if files > 1:
        with pytest.raises(Exception, match="stopped"):
            query.awaitTermination()
    else:
        query.awaitTermination()
    load.run_to_end(stream())
    first = {}
    for i, k, _ in rows:
        first.setdefault(k, i)
    good = {r["event_id"] for r in read_loaded(spark, load.target, kinds).collect()}
    assert good == {i for i in first.values() if i <= 250}
    kept = read_loaded(spark, load.quarantine, schema(error=TEXT, record=TEXT)).collect()
    assert len(kept) + len(good) == len(rows)
    repeated = {json.loads(r["record"])["event_id"] for r in kept if "must be unique" in r["error"]}
    assert repeated == {i for i, k, _ in rows if first[k] != i}


def test_batch_that_fails_claims_no_keys(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "event_id BIGINT, k STRING")
    where = {**paths(tmp_path), "keys": str(tmp_path / "keys"), "order": ("event_id",), "key_buckets": 2}
    rules = RuleSet().add_unique_rule("k").add_arrow_rule("event_id", lambda values: values.no_such_method(), "bad")
    StreamLoad(**where, rules=rules).write_batch(rows, 0)
    load = StreamLoad(**where, rules=RuleSet().add_unique_rule("k"), keys_kept=1)
    load.write_batch(rows.where("event_id > 1"), 1)
    assert sorted(r["event_id"] for r in read_loaded(spark, load.target, rows.schema).collect()) == [2, 3]
    load.write_batch(rows.where("event_id = 1"), 2)
    assert read_loaded(spark, load.target, rows.schema).count() == 2
    load.write_batch(rows.where("event_id = 3").limit(0), 3)
    load.write_batch(rows.where("event_id = 3"), 4)  # batch 1 is more than one batch ago
    assert sorted(r["event_id"] for r in read_loaded(spark, load.target, rows.schema).collect()) == [2, 3, 3]


def late_rows(rows_per_file, delay):
    """Ids of the rows behind the latest time of the files before by more than the delay."""
    late, latest = set(), None
    for part in rows_per_file:
        for i, ts in part:
            if ts is None or (latest is not None and ts < latest - delay):
                late.add(i)
        latest = max([t for _, t in part if t is not None] + ([latest] if latest else []), default=None)
    return late


def test_late_rows_are_kept_aside_over_a_restart_and_state_falls(spark, tmp_path):
    import random

    turns, start = random.Random(2), dt.datetime(2024, 1, 1)
    columns, source = "event_id BIGINT, ts TIMESTAMP, value DOUBLE", str(tmp_path / "in")
    parts = []
    for part in range(8):
        times = [start + dt.timedelta(hours=12 * part + turns.random() * 12 - (30 if turns.random() < 0.1 else 0)) for _ in range(50)]
        parts.append([(100 * part + i, None if i == 49 and part % 2 else t) for i, t in enumerate(times)])
    kinds = spark.createDataFrame([], columns).schema
    split = LateSplit(str(tmp_path / "split"), str(tmp_path / "state"), delay_seconds=6 * 3600)
    for half in (parts[:4], parts[4:]):
        for part in half:
            spark.createDataFrame([(i, t, 1.0) for i, t in part], columns).coalesce(1).write.mode("append").parquet(source)
        split.run_to_end(read_stream(spark, source, kinds, max_files=1))
    late = {r["event_id"] for r in split.late(spark, kinds).collect()}
    assert late == late_rows(parts, dt.timedelta(hours=6)) and len(late) > 10
    on_time = [(i, t) for part in parts for i, t in part if i not in late]
    windows = window_progress(split.on_time(spark, kinds, max_files=1), F.lit(False), every="4 hours", delay="6 hours")
    out = str(tmp_path / "out")
    query = windows.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "w"))
    query = query.outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    found = {r["window_start"]: r["rows"] for r in spark.read.schema(windows.schema).parquet(out).collect()}
    expected = {}
    for _, t in on_time:
        w = t.replace(hour=t.hour // 4 * 4, minute=0, second=0, microsecond=0)
        expected[w] = expected.get(w, 0) + 1
    line = max(t for _, t in on_time) - dt.timedelta(hours=6)
    assert found == {w: n for w, n in expected.items() if w + dt.timedelta(hours=4) <= line}
    states = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
    assert sum(s["numRowsDroppedByWatermark"] for s in states) == 0
    held = [s["numRowsTotal"] for s in states]
    assert max(held) < len(expected) and held[-1] <= len(expected) - len(found)


def test_a_repeated_batch_is_split_by_the_same_line(spark, tmp_path):
    columns = "event_id BIGINT, ts TIMESTAMP"
    t = dt.datetime(2024, 1, 1)
    split = LateSplit(str(tmp_path / "split"), str(tmp_path / "state"), delay_seconds=60)
    first = spark.createDataFrame([(1, t), (2, t + dt.timedelta(hours=1)), (3, None)], columns)
    second = spark.createDataFrame([(4, t), (5, t + dt.timedelta(hours=2))], columns)
    for batch, number in ((first, 0), (second, 1), (second, 1), (first.limit(0), 2), (second, 3)):
        split.write_batch(batch, number)
    assert sorted(r["event_id"] for r in split.late(spark, first.schema).collect()) == [3, 4, 4]


def test_orphans_are_told_when_no_parent_can_come(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)

    def hour(h):
        return start + dt.timedelta(hours=h)

    columns = "id BIGINT, k STRING, ts TIMESTAMP"
    kinds = spark.createDataFrame([], columns).schema
    children = [(1, "a", hour(1)), (2, "b", hour(1)), (3, "c", hour(1)), (4, None, hour(1)), (5, "d", hour(9)), (6, "a", hour(9))]
    parents = [(0, "a", hour(2)), (0, "a", hour(3)), (0, "b", hour(7)), (0, None, hour(1)), (0, "d", hour(1))]
    where = {"child": str(tmp_path / "children"), "parent": str(tmp_path / "parents")}
    told, state, seen = str(tmp_path / "told"), str(tmp_path / "state"), []
    # Each step adds files to both sides and starts the query again; the last one only moves the time on.
    steps = [(children[:4], parents[:1]), (children[4:], parents[1:]), ([(9, "z", hour(40))], [(9, "y", hour(40))])]
    for some_children, some_parents in steps:
        spark.createDataFrame(some_children, columns).coalesce(1).write.mode("append").parquet(where["child"])
        spark.createDataFrame(some_parents, columns).coalesce(1).write.mode("append").parquet(where["parent"])
        left, right = (read_stream(spark, where[side], kinds) for side in ("child", "parent"))
        orphans = orphans_in_stream(left, right, ("k", "ts"), ("k", "ts"), "1 hour", wait="2 hours", since="5 hours", salts=3)
        query = orphans.writeStream.format("parquet").option("path", told).option("checkpointLocation", state)
        query.outputMode("append").trigger(availableNow=True).start().awaitTermination()
        seen.append(sorted(r["id"] for r in spark.read.schema(kinds).parquet(told).collect()))
    # 2: its parent comes six hours later; 3: none; 5: its parent came eight hours before; 6: six hours before.
    assert seen[0] == [] and seen[-1] == [2, 3, 5, 6]


def test_resent_rows_pass_once_and_keys_leave_the_state(spark, tmp_path):
    columns, source = "event_id BIGINT, ts TIMESTAMP", str(tmp_path / "in")
    start = dt.datetime(2024, 1, 1)
    parts = [[(100 * p + i, start + dt.timedelta(hours=24 * p + i / 5)) for i in range(100)] for p in range(8)]
    sent = [parts[0], *[parts[p] + parts[p - 1][::3] for p in range(1, 8)]]
    for part in sent:
        spark.createDataFrame(part, columns).coalesce(1).write.mode("append").parquet(source)
    stream = read_stream(spark, source, spark.createDataFrame([], columns).schema, max_files=1)
    out = str(tmp_path / "out")
    query = deduplicate_stream(stream, ["event_id"], delay="2 days").writeStream.format("parquet").option("path", out)
    query = query.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination()
    found = [r["event_id"] for r in spark.read.schema(columns).parquet(out).collect()]
    assert sorted(found) == [i for part in parts for i, _ in part]
    states = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
    assert sum(s["numRowsDroppedByWatermark"] for s in states) == 0
    assert 0 < states[-1]["numRowsTotal"] < max(s["numRowsTotal"] for s in states) < len(found)

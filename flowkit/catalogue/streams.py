"""Streaming operators, run to the end over the events; each equals its batch form in SQL.

Targets, checkpoints and ledgers go below the shared folder that `spark.checkpoint.dir` names.
"""

from __future__ import annotations

import hashlib
import math
import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowkit.catalogue.registry import query, table
from flowkit.functions.schema import DOUBLE, LONG, TEXT, schema
from flowkit.operators.metrics import metrics_summary
from flowkit.operators.quarantine import read_quarantine
from flowkit.operators.rules import RuleSet
from flowkit.plans.jobs import migrate
from flowkit.plans.ordered import with_row_index
from flowkit.plans.staging import exists, kept_path, remove, scratch_path
from flowkit.sources.tables import read_stream
from flowkit.streaming.circuit import CircuitLog
from flowkit.streaming.events import (
    LateSplit,
    deduplicate_stream,
    latest_updates,
    orphans_in_stream,
    window_progress,
    write_updates,
)
from flowkit.streaming.load import StreamLoad, ledger_batches, ledger_runs, read_ledger, read_loaded

FILES, FILES_PER_BATCH = 10, 1
ROWS_PER_FILE = 1_000_000


def _placed_events(spark: SparkSession, sf_dir: str, shifts: Column | None = None) -> tuple[DataFrame, int]:
    """The events by the part they come in (`__part`), stored by part, and the files that a part needs.

    Parts have equal rows in the order of time; events without a time go with the last one.  `shifts` is an array: an
    event comes so many parts later than its time says, once for each of them.
    """
    events = table(spark, sf_dir, "events")
    timed, untimed = events.agg(F.count("ts"), F.count_if(F.col("ts").isNull())).first()
    placed = with_row_index(events.withColumn("__untimed", F.col("ts").isNull()), ["__untimed", "ts", "event_id"], name="__at")
    part = F.when(F.col("__untimed"), FILES - 1).otherwise(F.expr(f"CAST(__at * {FILES} DIV {max(1, timed)} AS INT)"))
    shifted = placed.withColumn("__shift", F.explode(F.array(F.lit(0)) if shifts is None else shifts))
    placed = shifted.withColumn("__part", F.least(F.lit(FILES - 1), part + F.col("__shift"))).drop("__untimed", "__at", "__shift")
    staged = scratch_path(spark, "parts")
    placed.write.partitionBy("__part").parquet(staged)
    return spark.read.schema(placed.schema).parquet(staged), max(1, math.ceil((timed / FILES + untimed) / ROWS_PER_FILE))


def _write_part(placed: DataFrame, part: int, path: str, files: int) -> None:
    """One part as files of their own, by as many tasks as its rows need; parts are written one after the other, so that
    a stream reads them in order."""
    rows = placed.where(F.col("__part") == part).drop("__part")
    (rows.coalesce(1) if files == 1 else rows.repartition(files)).write.mode("append").parquet(path)


def _split_events(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    """The folder of the events in parts and the files of each part, made once in an application and kept.

    (Runs: counts, and where the parts are not there yet, the order and a write for each of them.)
    """
    events = table(spark, sf_dir, "events")
    timed, untimed = events.agg(F.count("ts"), F.count_if(F.col("ts").isNull())).first()
    files = max(1, math.ceil((timed / FILES + untimed) / ROWS_PER_FILE))
    path = kept_path(spark, f"events-{hashlib.md5(sf_dir.encode()).hexdigest()}-{FILES}-{files}-{timed}")
    if not exists(spark, f"{path}.done"):
        remove(spark, path)
        placed, _ = _placed_events(spark, sf_dir)
        for i in range(FILES):
            _write_part(placed, i, path, files)
        spark.range(1).write.mode("overwrite").parquet(f"{path}.done")
    return path, files


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream of `FILES` parts in the order of their time, some per micro-batch."""
    columns = table(spark, sf_dir, "events").schema
    path, files = _split_events(spark, sf_dir)
    return read_stream(spark, f"{path}/*.parquet", columns, max_files=FILES_PER_BATCH * files)


def _collected(spark: SparkSession, stream: DataFrame, label: str) -> DataFrame:
    """The rows of a stream that appends, written by a file sink and read back."""
    path, state = scratch_path(spark, label), scratch_path(spark, f"{label}-state")
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", state)
    writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


@query("SELECT event_id, user_id, event_type, value, upper(event_type) AS level FROM events")
def stream_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    load = StreamLoad(
        target=scratch_path(spark, "target"),
        checkpoint=scratch_path(spark, "state"),
        transform=lambda df: df.withColumn("level", F.upper("event_type")).drop("ts", "props"),
    )
    stream = event_stream(spark, sf_dir)
    load.run_to_end(stream)
    columns = schema(event_id=LONG, user_id=LONG, event_type=TEXT, value=DOUBLE, level=TEXT)
    return read_loaded(spark, load.target, columns)


def _split_load(spark: SparkSession, sf_dir: str) -> tuple[StreamLoad, T.StructType]:
    rules = RuleSet().add_range_rule("value", 0, 100).add_pattern_rule("event_type", "(?!error)")
    paths = {k: scratch_path(spark, k) for k in ("target", "checkpoint", "ledger", "quarantine")}
    load = StreamLoad(**paths, run="events", rules=rules)
    stream = event_stream(spark, sf_dir)
    load.run_to_end(stream)
    return load, stream.schema


@query(
    """SELECT event_id, value > 100 OR event_type = 'error' AS quarantined,
      CAST(value > 100 AS INT) + CAST(event_type = 'error' AS INT) AS problems FROM events"""
)
def stream_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that break a rule land in the quarantine, all others in the target."""
    load, columns = _split_load(spark, sf_dir)
    good = read_loaded(spark, load.target, columns).select(
        "event_id", F.lit(False).alias("quarantined"), F.lit(0).alias("problems")
    )
    rejected = schema(error=TEXT, record=TEXT)
    record = F.from_json("record", "event_id BIGINT")
    bad = read_loaded(spark, load.quarantine, rejected).select(
        record["event_id"].alias("event_id"),
        F.lit(True).alias("quarantined"),
        F.size(F.split("error", "; ")).alias("problems"),
    )
    return good.unionByName(bad)


@query(
    """SELECT 'events' AS pipeline, 10 AS batches, count(*) FILTER (value <= 100 AND event_type <> 'error') AS rows_loaded,
      count(*) FILTER (value > 100 OR event_type = 'error') AS rows_failed FROM events"""
)
def stream_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the ledger of the same load recorded, over all its batches."""
    load, _ = _split_load(spark, sf_dir)
    recorded = ledger_batches(read_ledger(spark, load.ledger)).groupBy("pipeline")
    batches = F.count_distinct("batch_id").cast("int").alias("batches")
    return recorded.agg(batches, F.sum("rows_loaded").alias("rows_loaded"), F.sum("rows_failed").alias("rows_failed"))


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    distinct = deduplicate_stream(
        event_stream(spark, sf_dir), ["user_id", "event_type"], delay="90 days", salt_by=["event_id"]
    )
    return _collected(spark, distinct.select("user_id", "event_type"), "distinct")


@query(
    """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS hour, event_type, count(*) AS rows,
      count(*) FILTER (value > 60) AS failed_rows, round(count(*) / 3600, 8) AS rows_per_second,
      CASE WHEN count(*) FILTER (value > 60) > 1 THEN 'unhealthy' ELSE 'healthy' END AS status
    FROM events GROUP BY 1, 2"""
)
def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly progress and status; the last update of each window."""
    windows = window_progress(
        event_stream(spark, sf_dir), F.col("value") > 60, keys=["event_type"], max_failed=1, delay="90 days"
    )
    path = scratch_path(spark, "windows")
    write_updates(windows, path, scratch_path(spark, "state")).awaitTermination()
    hour = F.date_format("window_start", "yyyy-MM-dd HH:mm")
    speed = F.round("rows_per_second", 8)
    result = latest_updates(spark, path, windows.schema, ["window_start", "event_type"])
    return result.select(
        hour.alias("hour"), "event_type", "rows", "failed_rows", speed.alias("rows_per_second"), "status"
    )


# One step of every user's circuit at a time: two failures open it, six hours later a trial starts.
CIRCUIT_SQL = """
WITH RECURSIVE outcomes AS (
  SELECT user_id, event_id, epoch_us(ts) AS stamp, event_type <> 'error' AS ok,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
steps AS (
  SELECT DISTINCT user_id, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS BOOLEAN) AS ok,
    '' AS state_before, 'closed' AS state_after, '' AS outcome, 0 AS failures, 0 AS successes,
    CAST(NULL AS BIGINT) AS last_failure FROM events
  UNION ALL
  SELECT user_id, n, event_id, ok, state_before,
    CASE WHEN now = 'open' THEN 'open' WHEN ok AND now = 'half_open' AND successes = 0 THEN 'half_open'
      WHEN ok THEN 'closed' WHEN now = 'half_open' OR failures + 1 >= 2 THEN 'open' ELSE 'closed' END,
    CASE WHEN now = 'open' THEN 'rejected' ELSE 'applied' END,
    CASE WHEN now = 'open' THEN failures WHEN ok THEN 0 ELSE failures + 1 END,
    CASE WHEN now = 'half_open' AND ok THEN 1 - successes ELSE successes END,
    CASE WHEN now <> 'open' AND NOT ok THEN stamp ELSE last_failure END
  FROM (SELECT * REPLACE (CASE WHEN trial THEN 0 ELSE failures END AS failures,
      CASE WHEN trial THEN 0 ELSE successes END AS successes),
      CASE WHEN trial THEN 'half_open' ELSE state_before END AS now
    FROM (SELECT o.*, s.state_after AS state_before, s.failures, s.successes, s.last_failure,
        s.state_after = 'open' AND o.stamp - s.last_failure >= 21600000000 AS trial
      FROM steps s JOIN outcomes o ON o.user_id = s.user_id AND o.n = s.n + 1)))
SELECT user_id, event_id, ok, state_before, state_after, outcome FROM steps WHERE n > 0"""


@query(CIRCUIT_SQL)
def circuit_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Circuit state of each user's event stream; an error event is a failed call."""
    outcomes = event_stream(spark, sf_dir).withColumn("ok", F.col("event_type") != "error")
    log = CircuitLog(
        scratch_path(spark, "circuits"), scratch_path(spark, "state"), "user_id", "ok", threshold=2, recovery_seconds=6 * 3600
    )
    log.run_to_end(outcomes)
    named = log.outcomes(spark, outcomes.schema).withColumnsRenamed({"key": "user_id", "tie_break": "event_id"})
    return named.select("user_id", "event_id", "ok", "state_before", "state_after", "outcome")


@query(
    """SELECT 'completed' AS status, 100 AS progress, count(*) AS rows_extracted, count(*) AS rows_loaded,
      CAST(0 AS BIGINT) AS rows_failed FROM orders WHERE o_totalprice > 100000"""
)
def migration_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count, create, load as a stream, and compare."""
    return migrate(
        spark,
        f"{sf_dir}/orders.parquet*",
        "migrated_orders",
        where="o_totalprice > 100000",
        drop=True,
        location=scratch_path(spark, "migrated"),
        max_files=FILES_PER_BATCH,
    )


@query("SELECT event_id, 'completed' AS status FROM events ORDER BY event_type, event_id LIMIT 4000")
def migration_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A capped migration that is started again with the same arguments, drop included."""
    source = f"{_split_events(spark, sf_dir)[0]}/*.parquet"
    run = {
        "limit": 4000, "order": ["event_type", "event_id"], "drop": True, "max_files": 1,
        "location": scratch_path(spark, "migrated"), "checkpoint": scratch_path(spark, "migration"),
    }
    migrate(spark, source, "migrated_events", **run)
    status = migrate(spark, source, "migrated_events", **run).first()["status"]
    return spark.table("migrated_events").select("event_id", F.lit(status).alias("status"))


@query("SELECT event_id, event_id % 7 = 0 AS quarantined FROM events")
def load_with_failed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch is written, fails when it is repeated, and then stands in the quarantine only; one that fails first and
    succeeds when it is repeated stands in the target only."""
    paths = {k: scratch_path(spark, k) for k in ("target", "checkpoint", "ledger", "quarantine")}
    events = table(spark, sf_dir, "events").select("event_id", "value")
    load = StreamLoad(**paths)
    broken = StreamLoad(**paths, transform=lambda df: df.select("no_such_column"))
    broken.write_batch(events.where("event_id % 7 > 3"), 2)
    load.write_batch(events.where("event_id % 7 BETWEEN 1 AND 3"), 0)
    load.write_batch(events.where("event_id % 7 = 0"), 1)
    broken.write_batch(events.where("event_id % 7 = 0"), 1)
    load.write_batch(events.where("event_id % 7 > 3"), 2)
    good = read_loaded(spark, load.target, schema(event_id=LONG)).select("event_id", F.lit(False).alias("quarantined"))
    kept = read_quarantine(spark, load.quarantine)
    ids = F.get_json_object("record", "$.event_id").cast("long").alias("event_id")
    return good.unionByName(kept.select(ids, F.lit(True).alias("quarantined")))


@query(
    """SELECT event_id, row_number() OVER (PARTITION BY user_id, floor(value) ORDER BY ts, event_id) > 1
      AS quarantined FROM events"""
)
def stream_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A unique rule over all micro-batches of a load, stopped half-way and started again: the first row of a key wins."""
    paths = {k: scratch_path(spark, k) for k in ("target", "checkpoint", "quarantine", "keys")}
    key = F.concat_ws(":", "user_id", F.floor("value"))
    load = StreamLoad(
        **paths, rules=RuleSet().add_unique_rule("key"), order=("ts", "event_id"), key_buckets=8,
        transform=lambda df: df.withColumn("key", key),
    )
    path, files = _split_events(spark, sf_dir)
    columns = table(spark, sf_dir, "events").schema
    calls = []

    def stopping(batch: DataFrame, batch_id: int) -> None:
        calls.append(batch_id)
        if len(calls) == 3:
            raise RuntimeError("stopped")
        load.write_batch(batch, batch_id)

    stream = read_stream(spark, f"{path}/*.parquet", columns, max_files=2 * files)
    halted = stream.writeStream.foreachBatch(stopping).option("checkpointLocation", load.checkpoint)
    try:
        halted.trigger(availableNow=True).start().awaitTermination()
    except StreamingQueryException:
        pass  # the stop that was planned
    load.run_to_end(read_stream(spark, f"{path}/*.parquet", columns, max_files=2 * files))
    good = read_loaded(spark, load.target, schema(event_id=LONG)).select("event_id", F.lit(False).alias("quarantined"))
    ids = F.get_json_object("record", "$.event_id").cast("long").alias("event_id")
    return good.unionByName(read_quarantine(spark, load.quarantine).select(ids, F.lit(True).alias("quarantined")))


# A child belongs to the parent with the same number; some parents are missing, some come far too early or too late.
CHILDREN = "event_id % 2 = 1"
PARENTS = "event_id % 2 = 0 AND event_id % 5 <> 0"


@query(
    f"""SELECT event_id, event_id // 2 AS number FROM events c WHERE {CHILDREN} AND ts IS NOT NULL AND NOT EXISTS (
      SELECT 1 FROM events p WHERE {PARENTS} AND p.event_id // 2 = c.event_id // 2
        AND p.ts <= c.ts + INTERVAL 2 DAY AND p.ts >= c.ts - INTERVAL 6 DAY)"""
)
def stream_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Children without a parent, told by a join of two streams; a later event on both sides closes them."""
    path, files = _split_events(spark, sf_dir)
    events = table(spark, sf_dir, "events")
    closing, state, told = f"{path}-closing-{uuid.uuid4().hex}", scratch_path(spark, "state"), scratch_path(spark, "orphans")

    def run() -> DataFrame:
        names = ",".join(p.rpartition("/")[2] for p in (path, closing))
        where = f"{path.rpartition('/')[0]}/{{{names}}}/*.parquet"
        streams = [read_stream(spark, where, events.schema, max_files=2 * files) for _ in range(2)]
        numbered = [s.where("ts IS NOT NULL").withColumn("number", F.expr("event_id DIV 2")) for s in streams]
        children, parents = numbered[0].where(CHILDREN), numbered[1].where(PARENTS)
        orphans = orphans_in_stream(
            children, parents, ("number", "ts"), ("number", "ts"), "1 hour", wait="2 days", since="6 days", salts=2
        ).select("event_id", "number")
        writer = orphans.writeStream.format("parquet").option("path", told).option("checkpointLocation", state)
        writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()
        return spark.read.schema(orphans.schema).parquet(told)

    run()
    # Started again with one last event on each side, long after all others.
    last = events.agg(F.max("ts").alias("ts")).select((F.col("ts") + F.expr("INTERVAL 90 DAYS")).alias("ts"))
    far = 2 * 10**15
    ends = last.select(F.explode(F.array(F.lit(far + 2), F.lit(far + 5))).alias("event_id"), "ts")
    ends.select(*[(F.col(f.name) if f.name in ends.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in events.schema]).coalesce(1).write.parquet(closing)
    found = run()
    remove(spark, closing)
    return found


# Every fiftieth event comes two parts later than its time says.
ARRIVALS_SQL = f"""
WITH placed AS (
  SELECT *, CASE WHEN ts IS NULL THEN {FILES - 1} ELSE least({FILES - 1}, (row_number() OVER (ORDER BY ts NULLS LAST, event_id) - 1) * {FILES}
      // greatest(1, (SELECT count(ts) FROM events)) + CASE WHEN event_id % 50 = 0 THEN 2 ELSE 0 END) END AS part FROM events),
ends AS (SELECT part, max(ts) AS latest FROM placed GROUP BY part),
lines AS (SELECT part, max(latest) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 1 DAY AS line FROM ends),
split AS (SELECT p.*, ts IS NULL OR coalesce(ts < line, false) AS late FROM placed p JOIN lines USING (part))"""


def _late_events(spark: SparkSession, sf_dir: str) -> tuple[LateSplit, T.StructType]:
    """The events with some that come late, split in two runs: over half the files, and again when all are there."""
    placed, files = _placed_events(spark, sf_dir, F.array(F.when(F.col("event_id") % 50 == 0, 2).otherwise(0)))
    fields = placed.drop("__part").schema
    path = scratch_path(spark, "arrivals")
    split = LateSplit(scratch_path(spark, "split"), scratch_path(spark, "state"), delay_seconds=86_400)
    for half in (range(FILES // 2), range(FILES // 2, FILES)):
        for i in half:
            _write_part(placed, i, path, files)
        split.run_to_end(read_stream(spark, f"{path}/*.parquet", fields, max_files=files))
    return split, fields


@query("SELECT event_id, event_type FROM events WHERE ts IS NOT NULL")
def stream_dedupe_resent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh event is sent again with the next part; the watermark moves on, and keys leave the state behind it."""
    again = F.when(F.col("event_id") % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    sent, files = _placed_events(spark, sf_dir, again)
    fields, path = sent.drop("__part").schema, scratch_path(spark, "resent")
    for i in range(FILES):
        _write_part(sent.where("ts IS NOT NULL"), i, path, files)
    stream = read_stream(spark, f"{path}/*.parquet", fields, max_files=files)
    distinct = deduplicate_stream(stream, ["event_id"], delay="8 days")
    return _collected(spark, distinct.select("event_id", "event_type"), "distinct")


@query(f"{ARRIVALS_SQL} SELECT event_id, late FROM split WHERE late")
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that come more than a day behind the latest time seen, kept aside."""
    split, columns = _late_events(spark, sf_dir)
    return split.late(spark, columns).select("event_id", F.lit(True).alias("late"))


@query(
    f"""{ARRIVALS_SQL}
    SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS rows,
      count(*) FILTER (value > 60) AS failed_rows FROM split WHERE NOT late GROUP BY date_trunc('day', ts), event_type
    HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM split WHERE NOT late)"""
)
def stream_final_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts of the rows on time, each written once, when the watermark has passed its day."""
    split, columns = _late_events(spark, sf_dir)
    windows = window_progress(
        split.on_time(spark, columns, max_files=4), F.col("value") > 60, every="1 day", keys=["event_type"], delay="1 day"
    )
    found = _collected(spark, windows, "final")
    return found.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type", "rows", "failed_rows")


@query(
    """SELECT count(*) AS records_extracted, count(*) FILTER (value <= 100 AND event_type <> 'error') AS records_loaded,
      count(*) FILTER (value > 100 OR event_type = 'error') AS records_failed, true AS ran FROM events"""
)
def load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run summary of a load, from its ledger."""
    load, _ = _split_load(spark, sf_dir)
    totals = metrics_summary(ledger_runs(read_ledger(spark, load.ledger)))
    return totals.withColumn("ran", F.col("uptime_seconds") > 0).drop("uptime_seconds")

"""Quarantine, run ledger, batches, run metrics, health and masking; mostly over the events."""

from __future__ import annotations

import datetime as dt
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowkit.catalogue.registry import query, table
from flowkit.functions.schema import DOUBLE, LONG, TEXT, schema
from flowkit.functions.text import mask_log_text
from flowkit.operators import batches, health, ledger, masking, metrics, quarantine
from flowkit.operators.redrive import Redrive
from flowkit.operators.rules import RuleSet, annotate
from flowkit.operators.subsets import KeptSubset
from flowkit.plans.kept_medians import KeptMedians
from flowkit.plans.skew import attach_by_key
from flowkit.plans.staging import scratch_path

# --- quarantine: error events are the failing records

SOURCE = "CASE user_id % 3 WHEN 0 THEN 'load' WHEN 1 THEN 'load_create_table' ELSE 'transform' END"
ERROR = "CASE event_id % 4 WHEN 0 THEN 'connection reset by peer' WHEN 1 THEN 'timed out' ELSE 'bad value' END"
QUEUED_SQL = f"""SELECT ts, {SOURCE} AS source, {ERROR} AS error, CAST(event_id % 5 AS INT) AS retry_count,
  CAST(to_json(struct_pack(event_id := event_id, user_id := user_id, value := value, props := props)) AS VARCHAR)
    AS record, CAST(ts AS DATE) AS dt, event_id, value FROM events WHERE event_type = 'error'"""


RECORD = schema(event_id=LONG, user_id=LONG, value=DOUBLE, props=TEXT)


def queued(spark: SparkSession, sf_dir: str) -> DataFrame:
    failing = table(spark, sf_dir, "events").where("event_type = 'error'")
    retries = (F.col("event_id") % 5).cast("int")
    payload = ["event_id", "user_id", "value", "props"]
    return quarantine.enqueue(failing, F.expr(ERROR), F.expr(SOURCE), retries, F.col("ts"), payload)


@query(f"SELECT source, error, retry_count, record, CAST(dt AS VARCHAR) AS dt FROM ({QUEUED_SQL})")
def quarantine_enqueue(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = queued(spark, sf_dir)
    return rows.select("source", "error", "retry_count", "record", F.col("dt").cast("string").alias("dt"))


@query(f"SELECT source, count(*) AS records FROM ({QUEUED_SQL}) GROUP BY source")
def quarantine_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine.stats_by_source(queued(spark, sf_dir))


@query(f"SELECT source, CAST(dt AS VARCHAR) AS dt, count(*) AS records FROM ({QUEUED_SQL}) GROUP BY ALL")
def quarantine_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written by source and day, and read back."""
    path = scratch_path(spark, "quarantine")
    quarantine.write_quarantine(queued(spark, sf_dir), path)
    stored = quarantine.read_quarantine(spark, path)
    return stored.groupBy("source", F.col("dt").cast("string").alias("dt")).agg(F.count(F.lit(1)).alias("records"))


@query(
    f"""SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, error, record FROM ({QUEUED_SQL}) WHERE source = 'load'
    ORDER BY ts DESC, record LIMIT 100"""
)
def quarantine_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = quarantine.latest_records(queued(spark, sf_dir), "load")
    return newest.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"), "error", "record")


@query(
    f"""SELECT source, CAST(dt AS VARCHAR) AS dt, count(*) AS records FROM ({QUEUED_SQL})
    WHERE NOT (source = 'load' AND dt < DATE '2024-01-20' - INTERVAL 7 DAY) GROUP BY ALL"""
)
def quarantine_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = quarantine.retained(queued(spark, sf_dir), "load", older_than_days=7, as_of=dt.date(2024, 1, 20))
    return kept.groupBy("source", F.col("dt").cast("string").alias("dt")).agg(F.count(F.lit(1)).alias("records"))


@query(
    f"""SELECT source, CAST(dt AS VARCHAR) AS dt, count(*) AS records FROM ({QUEUED_SQL})
    WHERE NOT (source = 'load' AND dt < DATE '2024-01-20' - INTERVAL 7 DAY) AND source <> 'transform' GROUP BY ALL"""
)
def quarantine_cleared_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored quarantine whose old folders of one source, and all folders of another, are deleted."""
    path = scratch_path(spark, "quarantine")
    quarantine.write_quarantine(queued(spark, sf_dir), path)
    quarantine.clear_in_place(spark, path, "load", older_than_days=7, as_of=dt.date(2024, 1, 20))
    quarantine.clear_in_place(spark, path, "transform")
    kept = quarantine.read_quarantine(spark, path)
    return kept.groupBy("source", F.col("dt").cast("string").alias("dt")).agg(F.count(F.lit(1)).alias("records"))


@query(
    f"""SELECT record, least(2 * pow(2.0, retry_count), 20.0) AS delay_seconds, error <> 'bad value' AS retriable,
      CASE WHEN error <> 'bad value' AND retry_count < 3 THEN 'due' ELSE 'dead' END AS state FROM ({QUEUED_SQL})"""
)
def quarantine_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = quarantine.with_retry_schedule(queued(spark, sf_dir), initial=2, longest=20, jitter=False)
    return planned.select("record", "delay_seconds", "retriable", "state")


@query(
    f"""SELECT source, value <= 60 AS succeeded, CASE WHEN value > 60 THEN retry_count + 1 END AS retries,
      count(*) AS records FROM ({QUEUED_SQL}) WHERE source = 'load' GROUP BY ALL"""
)
def quarantine_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of one source that pass a rule on the second try, and those that go back with one more retry."""
    rules = RuleSet().add_range_rule("value", 0, 60)
    replayed = quarantine.replay(queued(spark, sf_dir), RECORD, lambda df: annotate(df, rules), "load")
    outcome = replayed.groupBy("succeeded", F.col("requeued.retry_count").alias("retries"))
    return outcome.agg(F.count(F.lit(1)).alias("records")).select(F.lit("load").alias("source"), "*")


@query(
    f"""SELECT count(*) AS total, count(*) FILTER (value <= 60) AS succeeded, count(*) FILTER (value > 60) AS failed
    FROM ({QUEUED_SQL})"""
)
def quarantine_replay_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = RuleSet().add_range_rule("value", 0, 60)
    replayed = quarantine.replay(queued(spark, sf_dir), RECORD, lambda df: annotate(df, rules))
    return quarantine.replay_counts(replayed)


REDRIVE_SQL = f"""
WITH queue AS (SELECT *, retry_count AS tries, error = 'bad value' OR retry_count >= 3 AS dead FROM ({QUEUED_SQL})),
passed AS (SELECT *, CASE WHEN NOT dead THEN greatest(tries, CAST(ceil((value - 40) / 20) AS INT)) END AS loads_at FROM queue)
SELECT event_id, CASE WHEN loads_at < 3 THEN 'loaded' ELSE 'parked' END AS place,
  CASE WHEN dead THEN tries WHEN loads_at < 3 THEN NULL ELSE 3 END AS tries FROM passed"""


@query(REDRIVE_SQL)
def redrive_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantined records loaded again until none is open: at each attempt a larger value passes, the third is the last."""
    drive = Redrive(scratch_path(spark, "redrive"), RECORD, initial=60, longest=3600, jitter=False)

    def check(rows: DataFrame) -> DataFrame:
        limit = 40 + 20 * F.col("retry_count")
        late = F.struct(F.lit("timed out").alias("message"))
        return rows.withColumns({"is_valid": F.col("value") <= limit, "violations": F.array(late)})

    drive.admit(queued(spark, sf_dir))
    for day in range(1, 5):
        drive.run(spark, check, F.lit(dt.datetime(2024, 2, day, tzinfo=dt.UTC)))
    good = drive.loaded(spark).select("event_id", F.lit("loaded").alias("place"), F.lit(None).cast("int").alias("tries"))
    lost = [drive.parked(spark).withColumn("place", F.lit("parked")), drive.open(spark).withColumn("place", F.lit("open"))]
    ids = F.get_json_object("record", "$.event_id").cast("long").alias("event_id")
    return good.unionByName(lost[0].unionByName(lost[1]).select(ids, "place", F.col("retry_count").alias("tries")))


# --- run ledger: each order is a checkpoint of the run of its priority

LEDGER_SQL = """SELECT strftime(stamp, '%Y%m%d_%H%M%S_%g') AS id, o_orderpriority AS pipeline,
  CAST(to_json(struct_pack(last_record_id := o_orderkey, "offset" := o_custkey)) AS VARCHAR) AS data,
  CAST(to_json(struct_pack(status := o_orderstatus)) AS VARCHAR) AS metadata
  FROM (SELECT *, o_orderdate + to_milliseconds(o_orderkey) AS stamp FROM orders)"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.checkpoint_rows(
        table(spark, sf_dir, "orders"),
        F.col("o_orderpriority"),
        F.expr("o_orderdate + make_dt_interval(0, 0, 0, o_orderkey / 1000)"),
        F.struct(F.col("o_orderkey").alias("last_record_id"), F.col("o_custkey").alias("offset")),
        F.struct(F.col("o_orderstatus").alias("status")),
    )


@query(
    f"SELECT * FROM ({LEDGER_SQL}) "
    "QUALIFY row_number() OVER (PARTITION BY pipeline ORDER BY id DESC, data DESC) = 1"
)
def ledger_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.latest(runs(spark, sf_dir)).drop("timestamp")


@query(
    f"""SELECT id, pipeline, data FROM ({LEDGER_SQL}) WHERE pipeline <> '5-LOW'
    QUALIFY pipeline <> '1-URGENT' OR row_number() OVER (PARTITION BY pipeline ORDER BY id DESC, data) <= 5"""
)
def ledger_pruned_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored ledger in which one pipeline is pruned and one deleted, while the folders of the others stay."""
    path = scratch_path(spark, "ledger")
    ledger.save_by_pipeline(runs(spark, sf_dir), path)
    ledger.prune_in_place(spark, path, keep=5, pipeline="1-URGENT")
    ledger.delete_in_place(spark, path, "5-LOW")
    return ledger.read_by_pipeline(spark, path).select("id", "pipeline", "data")


@query(
    f"""SELECT pipeline, count(*) AS total_checkpoints,
      CAST(sum(octet_length(encode(data)) + octet_length(encode(metadata))) AS BIGINT) AS total_size_bytes,
      min(id) AS oldest, max(id) AS newest FROM ({LEDGER_SQL}) GROUP BY pipeline"""
)
def ledger_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.stats(runs(spark, sf_dir))


@query(
    f"SELECT id, pipeline, data FROM ({LEDGER_SQL}) "
    "QUALIFY row_number() OVER (PARTITION BY pipeline ORDER BY id DESC, data) <= 5"
)
def ledger_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.keep_newest(runs(spark, sf_dir)).select("id", "pipeline", "data")


@query(f"SELECT pipeline, greatest(count(*) - 5, 0) AS deleted FROM ({LEDGER_SQL}) GROUP BY pipeline")
def ledger_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.deleted_counts(runs(spark, sf_dir))


@query(f"SELECT id FROM ({LEDGER_SQL}) WHERE pipeline = '1-URGENT' ORDER BY id DESC")
def ledger_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.list_checkpoints(runs(spark, sf_dir), "1-URGENT").select("id")


@query(f"SELECT id, pipeline FROM ({LEDGER_SQL}) WHERE pipeline <> '1-URGENT'")
def ledger_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.without(runs(spark, sf_dir), "1-URGENT").select("id", "pipeline")


# --- batches

CENTS = "CAST(round(value * 100) AS BIGINT)"


@query(
    f"""SELECT batch_id, failures <= 25 AS success, CASE WHEN failures <= 25 THEN cents END AS data,
      CASE WHEN failures > 25 THEN concat('Batch ', batch_id, ' failed: ', failures, ' errors') END AS error
    FROM (SELECT batch_id, CAST(sum({CENTS}) AS BIGINT) AS cents, count(*) FILTER (event_type = 'error') AS failures
      FROM (SELECT *, (row_number() OVER (ORDER BY ts, event_id) - 1) // 100 AS batch_id FROM events)
      GROUP BY batch_id)"""
)
def batch_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Python function per consecutive batch of 100 events; batches with many error events raise."""

    def total_cents(events: pd.DataFrame) -> int:
        failures = int((events["event_type"] == "error").sum())
        if failures > 25:
            raise ValueError(f"{failures} errors")
        return int((events["value"] * 100).round().astype("int64").sum())

    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    results = batches.process_items(events, total_cents, "BIGINT", ["ts", "event_id"], batch_size=100)
    return results.drop("duration_ms")


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, (row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey,
      l_suppkey, l_quantity, l_extendedprice) - 1) // 1000 AS batch_id FROM lineitem"""
)
def batch_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    numbered = batches.with_batch_id(table(spark, sf_dir, "lineitem").select(*order), order, 1000)
    return numbered.select("l_orderkey", "l_linenumber", "l_partkey", "batch_id")


@query(f"SELECT CAST(sum({CENTS}) AS BIGINT) AS result FROM events WHERE event_type <> 'error'")
def map_reduce_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Python map that fails on error events, which drops them, and a sum."""

    def cents(event: dict[str, Any]) -> int:
        if event["event_type"] == "error":
            raise ValueError("error event")
        return round(event["value"] * 100)

    events = table(spark, sf_dir, "events").select("event_type", "value")
    return batches.map_reduce(events, cents, lambda a, b: a + b, "BIGINT")


@query(
    """SELECT source, total, CAST(CASE WHEN item_mb <= 0 THEN greatest(100, total // 10)
      ELSE greatest(1, least(floor(0.05 / item_mb), total)) END AS BIGINT) AS chunk_size
    FROM (SELECT source, count(*) AS total, CAST(sum(n_chars) AS DOUBLE) / count(*) / 1048576 AS item_mb
      FROM documents GROUP BY source)"""
)
def chunk_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    total, chars = F.count(F.lit(1)), F.sum("n_chars").cast("double")
    sizes = table(spark, sf_dir, "documents").groupBy("source").agg(
        total.alias("total"), (chars / total / 1048576).alias("item_mb")
    )
    chunk = batches.optimal_chunk_size(F.col("total"), F.col("item_mb"), max_mb=0.05)
    return sizes.select("source", "total", chunk.alias("chunk_size"))


@query(
    """SELECT 'doc_id' AS "column", count(*) * 8 AS bytes FROM documents
    UNION ALL SELECT 'text', CAST(sum(octet_length(encode(text))) AS BIGINT) FROM documents
    UNION ALL SELECT 'lang', CAST(sum(octet_length(encode(lang))) AS BIGINT) FROM documents
    UNION ALL SELECT 'source', CAST(sum(octet_length(encode(source))) AS BIGINT) FROM documents
    UNION ALL SELECT 'n_chars', count(*) * 8 FROM documents"""
)
def column_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.column_bytes(table(spark, sf_dir, "documents"))


# --- run metrics


@query(
    """WITH sized AS (SELECT doc_id, 8 + coalesce(octet_length(encode(text)), 0) AS bytes FROM documents),
    cut AS (SELECT *, bytes > 20000 AS wide, CASE WHEN bytes > 20000 THEN 0 ELSE bytes END AS narrow FROM sized),
    summed AS (SELECT *, sum(narrow) OVER before - narrow AS start, sum(wide::INT) OVER before AS wides FROM cut
      WINDOW before AS (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    SELECT (2 * wides - wide::INT + start // 20000)::BIGINT AS chunk_id, count(*) AS rows, sum(bytes)::BIGINT AS bytes,
      sum(bytes) <= 40000 OR count(*) = 1 AS fits FROM summed GROUP BY 1"""
)
def chunks_by_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, whose widths differ a thousandfold, in chunks of at most 40,000 bytes."""
    cut = batches.cut_by_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"), 40_000, ["doc_id"])
    size = F.sum(8 + F.coalesce(F.octet_length("text"), F.lit(0))).alias("bytes")
    grouped = cut.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("rows"), size)
    return grouped.withColumn("fits", (F.col("bytes") <= 40_000) | (F.col("rows") == 1))


@query(
    """SELECT o_orderkey, o_totalprice * (1 + o_orderkey % 10 * 0.25) AS price FROM orders
    WHERE o_totalprice * (1 + o_orderkey % 10 * 0.25) > 200000 AND o_orderkey % 97 <> 0"""
)
def subset_from_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dear orders, kept from ten batches of changed prices and one of deletions, with a new base in between."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    kept = KeptSubset(scratch_path(spark, "subset"), orders.schema, ("o_orderkey",), "price > 200000")
    kept.apply(orders, 0, ["price"])
    for batch in range(1, 10):
        changed = orders.where(F.col("o_orderkey") % 10 >= batch)
        # An older state comes along in the same batch; the larger `at` is the newer one.
        states = changed.withColumn("at", F.explode(F.array(F.lit(batch - 1), F.lit(batch))))
        kept.apply(states.withColumn("price", F.col("price") * (1 + F.col("at") * 0.25)), batch, ["at"])
        if batch == 5:
            kept.compact(spark)
    kept.apply(orders.where("o_orderkey % 97 = 0"), 10, ["price"], deleted=F.lit(True))
    return kept.read(spark)


@query(
    """SELECT 'o_totalprice' AS name, median(o_totalprice) AS median FROM orders
    UNION ALL SELECT 'o_custkey', median(o_custkey) FROM orders"""
)
def median_over_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians of three parts that are added one after the other, the second one twice."""
    orders = table(spark, sf_dir, "orders")
    kept = KeptMedians(scratch_path(spark, "medians"), ("o_totalprice", "o_custkey"))
    year = F.year("o_orderdate")
    for part, rows in (("a", year < 1997), ("b", year.between(1997, 1999)), ("b", year.between(1997, 1999)), ("c", year > 1999)):
        kept.add(orders.where(rows), part)
    return spark.createDataFrame(list(kept.medians(spark).items()), "name STRING, median DOUBLE")


@query(
    """SELECT event_type AS name, arg_max(value, ts) AS last_value, round(sum(value), 2) AS total
    FROM events GROUP BY event_type"""
)
def metric_last_and_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = table(spark, sf_dir, "events").withColumnRenamed("event_type", "name")
    return metrics.metric_values(samples, "event_id").withColumn("total", F.round("total", 2))


@query(
    """SELECT CAST(sum(attempted) AS BIGINT) AS records_extracted, CAST(sum(attempted - failed) AS BIGINT)
      AS records_loaded, CAST(sum(failed) AS BIGINT) AS records_failed,
      CAST(epoch(max(ended_at)) - epoch(min(started_at)) AS DOUBLE) AS uptime_seconds
    FROM (SELECT min(l_shipdate) AS started_at, max(l_shipdate) AS ended_at, count(*) AS attempted,
      count(*) FILTER (l_returnflag = 'R') AS failed FROM lineitem GROUP BY l_orderkey)"""
)
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order is a run; its returned lines are the rows that failed to load."""
    per_run = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_shipdate").cast("timestamp").alias("started_at"),
        F.max("l_shipdate").cast("timestamp").alias("ended_at"),
        F.count(F.lit(1)).alias("extracted"),
        F.count(F.lit(1)).alias("attempted"),
        F.count_if(F.col("l_returnflag") == "R").alias("failed"),
    )
    return metrics.metrics_summary(per_run)


@query(
    """SELECT event_type AS component, CAST(user_id AS VARCHAR) AS operation, count(*) FILTER (value <= 80)
      AS success_count, count(*) FILTER (value > 80) AS failure_count, arg_max(value, ts) AS last_duration
    FROM events GROUP BY ALL"""
)
def operation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("component"),
        F.col("user_id").cast("string").alias("operation"),
        (F.col("value") <= 80).alias("ok"),
        F.col("value").alias("duration"),
        "ts",
        "event_id",
    )
    return metrics.operation_counts(outcomes, "event_id")


@query(
    """SELECT l_shipmode, n AS rows, seconds, CASE WHEN seconds > 0 THEN round(n / seconds, 8) ELSE 0 END
      AS rows_per_second
    FROM (SELECT l_returnflag || l_linestatus AS l_shipmode, count(*) AS n,
      CAST(epoch(max(l_shipdate)) - epoch(min(l_shipdate)) AS DOUBLE) AS seconds FROM lineitem GROUP BY 1)
    UNION ALL SELECT 'instant', count(*), 0, 0 FROM lineitem"""
)
def stage_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    shipped = F.unix_micros(F.col("l_shipdate").cast("timestamp")) / 1_000_000
    stages = lines.groupBy(F.concat("l_returnflag", "l_linestatus").alias("l_shipmode")).agg(
        F.count(F.lit(1)).alias("rows"), (F.max(shipped) - F.min(shipped)).alias("seconds")
    )
    instant = lines.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit("instant").alias("l_shipmode"), "rows", F.lit(0.0).alias("seconds")
    )
    speed = F.round(metrics.throughput(F.col("rows"), F.col("seconds")), 8)
    return stages.unionByName(instant).withColumn("rows_per_second", speed)


@query(
    """SELECT event_id, 'k' AS name, CAST(props->>'k' AS DOUBLE) AS value FROM events
    UNION ALL SELECT event_id, 'user', user_id FROM events"""
)
def numeric_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of a metrics map that are numbers; the event type is not."""
    parsed = F.from_json("props", "map<string,string>")
    extra = F.create_map(
        F.lit("user"), F.col("user_id").cast("string"), F.lit("kind"), F.col("event_type")
    )
    samples = table(spark, sf_dir, "events").select("event_id", F.map_concat(parsed, extra).alias("metrics"))
    return metrics.numeric_metrics(samples, "metrics", "event_id")


CHUNKS_SQL = f"""SELECT event_id, ts, event_type AS job, {CENTS} AS rows, event_id % 10 <> 0 AS ok FROM events"""


@query(
    f"""SELECT event_id, job, rows_extracted, rows_loaded, rows_failed,
      CAST(floor(rows_extracted * 100.0 / total_rows) AS INT) AS progress
    FROM (SELECT event_id, job, CAST(sum(rows) OVER w AS BIGINT) AS rows_extracted,
        CAST(sum(CASE WHEN ok THEN rows ELSE 0 END) OVER w AS BIGINT) AS rows_loaded,
        CAST(sum(CASE WHEN ok THEN 0 ELSE rows END) OVER w AS BIGINT) AS rows_failed,
        CAST(sum(rows) OVER (PARTITION BY job) AS BIGINT) * 2 AS total_rows
      FROM ({CHUNKS_SQL}) WINDOW w AS (PARTITION BY job ORDER BY ts, event_id))"""
)
def job_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event is a chunk of the job of its type; twice the rows present are expected."""
    chunks = table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        F.col("event_type").alias("job"),
        F.expr(CENTS).alias("rows"),
        (F.col("event_id") % 10 != 0).alias("ok"),
    )
    facts = chunks.groupBy("job").agg(F.count(F.lit(1)).alias("__rows"), (F.sum("rows") * 2).alias("total_rows"))
    expected = attach_by_key(chunks, facts, ["job"], "__rows").drop("__rows")
    running = metrics.job_progress(expected, ["ts", "event_id"])
    return running.select("event_id", "job", "rows_extracted", "rows_loaded", "rows_failed", "progress")


@query(
    """SELECT CASE WHEN event_id % 11 <> 0 AND event_id % 13 <> 0 THEN strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M')
        END AS hour, CASE WHEN event_id % 11 = 0 THEN 'UNPARSED' ELSE upper(event_type) END AS level,
      count(*) AS records, CAST(sum(user_id) FILTER (event_id % 11 <> 0) AS BIGINT) AS users FROM events GROUP BY ALL"""
)
def log_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON log lines made from the events, some broken and some without a time, counted per hour and level."""
    broken, timeless = F.col("event_id") % 11 == 0, F.col("event_id") % 13 == 0
    fields = F.struct(
        F.when(timeless, "noon").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("timestamp"),
        F.upper("event_type").alias("level"),
        F.lit("loader").alias("logger"),
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("message"),
        "user_id",
    )
    line = F.when(broken, F.concat(F.lit("no JSON {"), F.col("event_id").cast("string"))).otherwise(F.to_json(fields))
    logs = metrics.parse_logs(table(spark, sf_dir, "events").select(line.alias("value")))
    counts = metrics.log_counts(logs, users=F.sum(F.col("extra")["user_id"].cast("long")))
    hour = F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("hour")
    return counts.select(hour, "level", "records", "users")


# --- health

COMPONENT = "CASE event_id % 3 WHEN 0 THEN 'database' WHEN 1 THEN 'warehouse' ELSE 'cache' END"
LATENCY = "CASE WHEN event_id % 19 = 0 THEN NULL ELSE value * 20 END"
LATENCY_STATUS_SQL = f"""CASE WHEN component = 'cache' THEN 'unknown'
  WHEN latency_ms IS NULL OR event_type = 'error' THEN 'unhealthy'
  WHEN latency_ms < CASE component WHEN 'database' THEN 1000 ELSE 2000 END THEN 'healthy' ELSE 'degraded' END"""
PROBES_SQL = f"SELECT *, {COMPONENT} AS component, {LATENCY} AS latency_ms FROM events"


@query(
    f"SELECT component, {LATENCY_STATUS_SQL} AS status, count(*) AS probes FROM ({PROBES_SQL}) GROUP BY ALL"
)
def latency_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    error = F.when(F.col("event_type") == "error", "probe failed")
    status = health.latency_status(F.expr(COMPONENT), F.expr(LATENCY), error)
    probes = table(spark, sf_dir, "events").select(F.expr(COMPONENT).alias("component"), status.alias("status"))
    return probes.groupBy("component", "status").agg(F.count(F.lit(1)).alias("probes"))


@query(
    """SELECT CASE WHEN value < 70 THEN 'healthy' WHEN value < 85 THEN 'degraded' ELSE 'unhealthy' END AS status,
      CASE WHEN value < 70 THEN 'Memory usage normal' WHEN value < 85 THEN 'Memory usage elevated'
        ELSE 'Memory usage critical' END AS message, count(*) AS samples FROM events GROUP BY ALL"""
)
def memory_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = F.col("value")
    statuses = table(spark, sf_dir, "events").select(
        health.memory_status(used).alias("status"), health.memory_message(used).alias("message")
    )
    return statuses.groupBy("status", "message").agg(F.count(F.lit(1)).alias("samples"))


@query(
    """SELECT user_id, CASE WHEN failed > 15 THEN 'unhealthy' WHEN queued > 10 THEN 'degraded' ELSE 'healthy' END
      AS status, CASE WHEN failed > 15 THEN concat('Too many failed records: ', failed)
        WHEN queued > 10 THEN concat('DLQ has ', queued, ' entries') ELSE 'Pipeline operating normally' END AS message
    FROM (SELECT user_id, count(*) FILTER (event_type = 'error') AS failed, count(*) FILTER (value > 80) AS queued
      FROM events GROUP BY user_id)"""
)
def run_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "error").alias("failed"), F.count_if(F.col("value") > 80).alias("queued")
    )
    failed, waiting = F.col("failed"), F.col("queued")
    return counts.select(
        "user_id",
        health.pipeline_status(failed, waiting, 15, 10).alias("status"),
        health.pipeline_message(failed, waiting, 15, 10).alias("message"),
    )


@query(
    f"""SELECT CASE WHEN unhealthy_count > 0 THEN 'unhealthy' WHEN degraded_count > 0 THEN 'degraded'
      WHEN healthy_count = n AND n > 0 THEN 'healthy' ELSE 'unknown' END AS overall_status,
      healthy_count, degraded_count, unhealthy_count
    FROM (SELECT count(*) AS n, count(*) FILTER (status = 'healthy') AS healthy_count,
      count(*) FILTER (status = 'degraded') AS degraded_count, count(*) FILTER (status = 'unhealthy') AS unhealthy_count
      FROM (SELECT user_id, arg_max({LATENCY_STATUS_SQL}, ts) AS status FROM ({PROBES_SQL}) GROUP BY user_id))"""
)
def health_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest probe of each user's component, counted by status."""
    error = F.when(F.col("event_type") == "error", "probe failed")
    status = health.latency_status(F.expr(COMPONENT), F.expr(LATENCY), error)
    results = table(spark, sf_dir, "events").select(F.col("user_id").alias("component"), status.alias("status"), "ts")
    return health.health_report(health.latest_results(results))


@query(
    """SELECT event_type AS period, CASE WHEN bool_or(value > 340) THEN 'unhealthy' WHEN bool_or(value > 335)
      THEN 'degraded' ELSE 'healthy' END AS overall_status FROM events GROUP BY event_type"""
)
def status_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The worst status in each group of results."""
    status = F.when(F.col("value") > 340, health.UNHEALTHY).when(F.col("value") > 335, health.DEGRADED)
    results = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("period"), status.otherwise(health.HEALTHY).alias("status")
    )
    return results.groupBy("period").agg(health.worst_status().alias("overall_status"))


@query(
    """SELECT c_custkey AS component,
      (epoch_us(TIMESTAMP '2024-01-29 12:00:00') - epoch_us(max(ts))) / 1000000 AS age_seconds,
      coalesce(epoch_us(TIMESTAMP '2024-01-29 12:00:00') - epoch_us(max(ts)) >= 43200000000, true) AS is_due
    FROM customer LEFT JOIN events ON user_id = c_custkey GROUP BY c_custkey"""
)
def due_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer is a component, each of its events a check; a check is due after twelve hours."""
    components = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("component"))
    results = table(spark, sf_dir, "events").select(F.col("user_id").alias("component"), "ts")
    due = health.due_checks(components, results, F.lit("2024-01-29 12:00:00"), 43200)
    return due.select("component", "age_seconds", "is_due")


# --- masking


@query(
    """SELECT c_custkey, c_name AS name, '********' AS "Password", '********' AS private_key, c_acctbal AS balance,
      '********' AS client_email, c_nationkey AS nation, '********' AS token_uri, c_mktsegment AS zone,
      '********' AS credentials FROM customer"""
)
def mask_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "c_name AS name",
        "c_mktsegment AS Password",
        "named_struct('private_key', c_name, 'balance', c_acctbal) AS account",
        "array(named_struct('Client_Email', c_name, 'nation', c_nationkey)) AS contacts",
        "map('Token_URI', c_name, 'zone', c_mktsegment) AS settings",
        "named_struct('type', c_name, 'id', c_custkey) AS credentials",
    )
    return masking.mask_sensitive(nested).selectExpr(
        "c_custkey",
        "name",
        "Password",
        "account.private_key AS private_key",
        "account.balance AS balance",
        "contacts[0].Client_Email AS client_email",
        "contacts[0].nation AS nation",
        "settings['Token_URI'] AS token_uri",
        "settings['zone'] AS zone",
        "credentials",
    )


@query(
    """SELECT c_custkey, concat('{"password": "****", "user": "', c_mktsegment, '", "private_key": "****"} ',
      '{''client_email'': ''****'', ''nation'': ''', c_nationkey, '''}') AS line FROM customer"""
)
def mask_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, name, segment, nation = (F.col(c) for c in ("c_custkey", "c_name", "c_mktsegment", "c_nationkey"))
    line = F.concat(
        F.lit('{"password": "'), name, F.lit('", "user": "'), segment, F.lit('", "private_key":"k'),
        key.cast("string"), F.lit("\"} {'client_email':  '"), name, F.lit("', 'nation': '"),
        nation.cast("string"), F.lit("'}"),
    )
    return table(spark, sf_dir, "customer").select("c_custkey", mask_log_text(line).alias("line"))


@query(
    """SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'private_key,client_email'
      WHEN 1 THEN 'type,project_id,private_key,client_email' ELSE '' END AS missing FROM events"""
)
def missing_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = F.to_json(
        F.struct(
            F.col("event_type").alias("type"),
            F.col("user_id").alias("project_id"),
            F.col("props").alias("private_key"),
            F.col("ts").cast("string").alias("client_email"),
        )
    )
    partial = F.to_json(F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("project_id"), "value"))
    kind = F.col("event_id") % 3
    document = F.when(kind == 0, partial).when(kind == 1, F.lit("{broken")).otherwise(full)
    missing = F.array_join(masking.missing_fields(document), ",")
    return table(spark, sf_dir, "events").select("event_id", missing.alias("missing"))

"""Cleaning operators over orders, line items, events and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowkit.catalogue.registry import GAPPY_ORDERS_SQL, gappy_orders, query, table
from flowkit.operators import clean as cl
from flowkit.operators.rules import RuleSet
from flowkit.plans.jobs import Transformations, process

# Characters that count as whitespace, for engines whose class covers ASCII only.
SPACES = r"[\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
STRIP_SQL = f"regexp_replace(%s, '^{SPACES}+|{SPACES}+$', '', 'g')"


@query("SELECT lang, source, md5(text) AS digest FROM (SELECT DISTINCT text, lang, source FROM documents)")
def dedupe_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cl.drop_duplicate_rows(table(spark, sf_dir, "documents").select("text", "lang", "source"))
    return rows.select("lang", "source", F.md5(F.col("text").cast("binary")).alias("digest"))


LINE_ORDER = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate")


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem "
    f"QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(LINE_ORDER)}) = 1"
)
def keep_first_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = cl.keep_first(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], LINE_ORDER)
    return first.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@query(
    "SELECT lang, source, md5(text) AS digest, min(doc_id) AS created_at FROM documents GROUP BY text, lang, source"
)
def dedupe_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("text", "lang", "source", F.col("doc_id").alias("created_at"))
    kept = cl.deduplicate_rows(documents, order=["created_at"])
    return kept.select("lang", "source", F.md5(F.col("text").cast("binary")).alias("digest"), "created_at")


@query(
    f"""WITH dirty AS ({GAPPY_ORDERS_SQL})
    SELECT o_orderkey, o_custkey, round(coalesce(price, (SELECT median(price) FROM dirty)), 4) AS price FROM dirty"""
)
def median_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = cl.fill_numeric_median(gappy_orders(spark, sf_dir))
    return filled.select("o_orderkey", "o_custkey", F.round("price", 4).alias("price"))


@query(
    f"""SELECT o_orderkey, price IS NULL AS filled, abs((SELECT avg(CAST(o.price <= (SELECT median(price) FROM
        ({GAPPY_ORDERS_SQL})) AS INT)) FROM ({GAPPY_ORDERS_SQL}) o WHERE o.price IS NOT NULL) - 0.5) <= 0.001 AS close
      FROM ({GAPPY_ORDERS_SQL}) g"""
)
def median_fill_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows the sketched median fills, and whether its rank is within a thousandth of the middle."""
    raw = gappy_orders(spark, sf_dir)
    filled = cl.fill_numeric_median(raw, exact=False)
    median = filled.join(raw.where("price IS NULL").select("o_orderkey"), "o_orderkey").agg(F.max("price")).first()[0]
    rank = raw.where("price IS NOT NULL").agg(F.avg((F.col("price") <= median).cast("int"))).first()[0]
    missing = raw.select("o_orderkey", F.col("price").isNull().alias("filled"))
    value = filled.select("o_orderkey", "price").join(missing, "o_orderkey")
    close = F.lit(abs(rank - 0.5) <= 0.001) & (~F.col("filled") | (F.col("price") == median))
    return value.select("o_orderkey", "filled", close.alias("close"))


@query(f"SELECT o_orderkey, coalesce(status, '') AS status, priority FROM ({GAPPY_ORDERS_SQL})")
def string_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.fill_string_empty(gappy_orders(spark, sf_dir)).select("o_orderkey", "status", "priority")


RAW_TYPES = (
    "o_orderkey",
    "CASE WHEN o_orderkey % 5 = 0 THEN 'n/a' ELSE CAST(o_custkey AS STRING) END AS customer",
    "CAST(o_orderkey AS STRING) AS order_text",
    "o_totalprice AS price",
)
TYPES = {"customer": "bigint", "order_text": "bigint", "price": "int", "absent": "int"}


@query(
    f"SELECT o_orderkey, TRY_CAST(customer AS BIGINT) AS customer, TRY_CAST(order_text AS BIGINT) AS order_text, "
    f"CAST(trunc(price) AS INT) AS price FROM (SELECT {', '.join(RAW_TYPES)} FROM orders)"
)
def coerce_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.coerce_types(table(spark, sf_dir, "orders").selectExpr(*RAW_TYPES), TYPES)


@query(
    "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS customer, "
    "o_orderkey AS order_text, CAST(trunc(o_totalprice) AS INT) AS price FROM orders"
)
def coerce_whole_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.coerce_types(table(spark, sf_dir, "orders").selectExpr(*RAW_TYPES), TYPES, whole_columns=True)


@query(
    f"""WITH raw AS (SELECT {', '.join(RAW_TYPES)} FROM orders)
    SELECT 'customer' AS "column", count(*) FILTER (TRY_CAST(customer AS BIGINT) IS NULL) AS cast_failed FROM raw
    UNION ALL SELECT 'order_text', count(*) FILTER (TRY_CAST(order_text AS BIGINT) IS NULL) FROM raw
    UNION ALL SELECT 'price', count(*) FILTER (TRY_CAST(price AS INT) IS NULL) FROM raw"""
)
def cast_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.cast_failures(table(spark, sf_dir, "orders").selectExpr(*RAW_TYPES), TYPES).drop("target")


PADDED = "concat(CASE WHEN doc_id % 2 = 0 THEN chr(9) ELSE chr(160) END, text, chr(10), '  ')"


@query(
    "SELECT doc_id, md5(lower(text)) AS digest, length(text) AS chars "
    f"FROM (SELECT doc_id, {STRIP_SQL % PADDED} AS text FROM documents)"
)
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(
        F.when(F.col("doc_id") % 2 == 0, "\t").otherwise(" "), F.col("text"), F.lit("\n"), F.lit("  ")
    )
    texts = cl.normalize_text(table(spark, sf_dir, "documents").select("doc_id", padded.alias("text")))
    digest = F.md5(F.col("text").cast("binary"))
    return texts.select("doc_id", digest.alias("digest"), F.length("text").cast("long").alias("chars"))


@query(
    """SELECT o_orderkey, strftime(CASE WHEN o_orderkey % 10 IN (3, 4) THEN NULL
        WHEN o_orderkey % 10 = 6 THEN o_orderdate + INTERVAL 8 HOUR WHEN o_orderkey % 10 = 7
        THEN o_orderdate + INTERVAL 10 HOUR + INTERVAL 5 MINUTE ELSE o_orderdate END,
      '%Y-%m-%d %H:%M:%S') AS order_date, o_orderstatus AS status FROM orders"""
)
def standardize_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate")
    kind = F.col("o_orderkey") % 10
    text = (
        F.when(kind == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(kind == 1, F.date_format(day, "yyyyMMdd"))
        .when(kind == 2, F.date_format(day, "yyyy/MM/dd"))
        .when(kind == 3, F.lit("not a date"))
        .when(kind == 4, F.lit(""))
        .when(kind == 5, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss.'000000001Z'"))
        .when(kind == 6, F.date_format(day, "yyyy-MM-dd'T10:00:00+02:00'"))
        .when(kind == 7, F.date_format(day, "yyyy-MM-dd 10:05"))
        .when(kind == 8, F.date_format(day, "MM/dd/yyyy"))
        .otherwise(F.concat(F.lit("\t"), F.date_format(day, "MMM d, yyyy"), F.lit("\n")))
    )
    status = F.col("o_orderstatus").alias("status")
    raw = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("Order_Date"), status)
    parsed = cl.standardize_dates(raw)
    shown = F.date_format("Order_Date", "yyyy-MM-dd HH:mm:ss")
    return parsed.select("o_orderkey", shown.alias("order_date"), "status")


GAPPY_EVENTS = (
    "event_id",
    "ts",
    "user_id",
    "CASE WHEN event_id % 3 = 1 THEN value ELSE NULL END AS value",
    "CASE WHEN event_id % 4 = 2 THEN event_type ELSE NULL END AS kind",
)


def _fill_sql(partition: str) -> str:
    def filled(c: str) -> str:
        over = f"({partition} ORDER BY ts, event_id ROWS BETWEEN"
        return (
            f"coalesce(last_value({c} IGNORE NULLS) OVER {over} UNBOUNDED PRECEDING AND CURRENT ROW), "
            f"first_value({c} IGNORE NULLS) OVER {over} CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}"
        )

    return f"SELECT event_id, {filled('value')}, {filled('kind')} FROM (SELECT {', '.join(GAPPY_EVENTS)} FROM events)"


@query(_fill_sql("PARTITION BY user_id"))
def fill_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").selectExpr(*GAPPY_EVENTS)
    filled = cl.handle_missing_values(events, ["ts", "event_id"], ["user_id"])
    return filled.select("event_id", "value", "kind")


@query(_fill_sql(""))
def fill_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").selectExpr(*GAPPY_EVENTS)
    filled = cl.handle_missing_values(events, ["ts", "event_id"], columns=["value", "kind"])
    return filled.select("event_id", "value", "kind")


# Orders without their key: few distinct rows, many copies.
COPIES = (
    "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS status",
    "o_orderpriority AS priority",
    "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE floor(o_totalprice / 10000) END AS band",
)
COPIES_SQL = f"SELECT {', '.join(COPIES)} FROM orders"


@query(
    f"""WITH raw AS ({COPIES_SQL}), kept AS (SELECT DISTINCT * FROM raw),
    totals AS (SELECT (SELECT count(*) FROM raw) AS rows_in, (SELECT count(*) FROM kept) AS rows_out),
    counts AS (
      SELECT 'status' AS "column", count(*) FILTER (status IS NULL) AS null_count, 'empty' AS strategy FROM kept
      UNION ALL SELECT 'priority', count(*) FILTER (priority IS NULL), 'none' FROM kept
      UNION ALL SELECT 'band', count(*) FILTER (band IS NULL), 'median' FROM kept)
    SELECT rows_in, rows_out, rows_in - rows_out AS duplicates_removed, counts.* FROM totals, counts"""
)
def cleaning_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.cleaning_report(table(spark, sf_dir, "orders").selectExpr(*COPIES))


@query(
    f"""WITH kept AS (SELECT DISTINCT * FROM ({COPIES_SQL}))
    SELECT coalesce(status, '') AS status, priority,
      CAST(trunc(coalesce(band, (SELECT median(band) FROM kept))) AS BIGINT) AS band FROM kept"""
)
def clean_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "orders").selectExpr(*COPIES)
    return cl.clean(raw, {"band": "bigint"})


@query(
    """SELECT lower(o_orderpriority) AS priority, o_orderkey, o_totalprice * 2 AS doubled FROM orders
    WHERE o_orderstatus = 'F'"""
)
def transform_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registered chain with a step that fails and one that does not exist; both are skipped."""
    chain = (
        Transformations()
        .register("only_f", lambda df: df.where("o_orderstatus = 'F'"))
        .register("broken", lambda df: df.select("no_such_column"))
        .register("doubled", lambda df: df.withColumn("doubled", F.col("o_totalprice") * 2))
        .register("normalized", lambda df: cl.normalize_text(df, ["o_orderpriority"]))
    )
    result, _ = chain.apply(table(spark, sf_dir, "orders"), ["only_f", "broken", "unknown", "doubled", "normalized"])
    return result.select(F.col("o_orderpriority").alias("priority"), "o_orderkey", "doubled")


@query(
    f"""WITH kept AS (SELECT DISTINCT * FROM ({COPIES_SQL})),
    filled AS (SELECT coalesce(status, '') AS status, priority,
      coalesce(band, (SELECT median(band) FROM kept)) AS band FROM kept)
    SELECT lower(priority) AS priority, count(*) AS rows, CAST(sum(floor(band)) AS BIGINT) AS bands
    FROM filled WHERE status <> '' AND band BETWEEN 5 AND 45 GROUP BY ALL"""
)
def clean_check_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = RuleSet().add_not_null_rule("status").add_range_rule("band", 5, 45)
    chain = Transformations().register("normalized", lambda df: cl.normalize_text(df, ["priority"]))
    raw = table(spark, sf_dir, "orders").selectExpr(*COPIES)
    result = process(raw, rules=rules, transformations=chain, drop_invalid=True)
    return result.data.groupBy("priority").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.floor("band")).cast("long").alias("bands")
    )

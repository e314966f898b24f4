"""Nested records, derived from the documents, flattened and conformed to targets; sources and caps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowkit.catalogue.registry import query, table
from flowkit.functions.schema import DOUBLE, INT, LONG, SHORT_TEXT, TEXT, TIME, schema
from flowkit.functions.text import array_literal, is_identifier
from flowkit.operators import flatten as fl
from flowkit.plans.staging import scratch_path
from flowkit.sources import footers, sinks, tables
from flowkit.sources.keyed import KeyedTarget

# Integer dates with months 0 to 12 and days 0 to 31: some are no calendar day.
FILING_DATE = (
    "CASE WHEN doc_id % 9 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN 18000101 "
    "ELSE CAST(19900001 + (n_chars % 30) * 10000 + (doc_id % 13) * 100 + doc_id % 31 AS INT) END"
)
PUBLICATION_DATE = "CASE WHEN doc_id % 4 = 0 THEN NULL ELSE CAST(20100115 + (doc_id % 9) * 10000 AS INT) END"
PLAIN = (
    "concat('DOC-', CAST(doc_id AS STRING)) AS publication_number",
    "CAST(n_chars AS STRING) AS application_number",
    "lang AS country_code",
    "substring(source, 1, 4) AS kind_code",
    "source AS family_id",
    f"{FILING_DATE} AS filing_date",
    f"{PUBLICATION_DATE} AS publication_date",
    "CASE WHEN doc_id % 3 = 0 THEN 'active' ELSE 'expired' END AS entity_status",
    "CAST(doc_id % 100 AS STRING) AS art_unit",
)

NESTED_SQL = f"""
SELECT {', '.join(PLAIN)},
  CASE WHEN doc_id % 10 = 7 THEN NULL WHEN doc_id % 10 = 8 THEN [] ELSE
    list_transform(string_split(text, chr(10)), lambda l, i: struct_pack(
      "text" := l, "language" := CASE WHEN (i - 1 + doc_id) % 3 = 2 THEN 'en' ELSE 'xx' END)) END AS title_localized,
  CASE WHEN doc_id % 10 = 6 THEN NULL ELSE list_transform(string_split(text, '. '), lambda s: struct_pack(
      "name" := CASE WHEN length(s) < 30 THEN NULL ELSE s END)) END AS inventor_harmonized,
  list_transform(string_split(text, ', '), lambda s: struct_pack(
      "name" := CASE WHEN length(s) % 4 = 0 THEN NULL ELSE s END)) AS assignee_harmonized,
  list_transform(string_split(text, ', '), lambda s: struct_pack(
      "code" := CASE WHEN length(s) % 5 = 0 THEN NULL ELSE concat('L', length(s) % 40) END)) AS cpc,
  CASE WHEN doc_id % 10 = 5 THEN NULL ELSE string_split(text, chr(10)) END AS citation
FROM documents"""

FLAT_SQL = f"""
SELECT publication_number, application_number, country_code, kind_code, family_id,
  coalesce(list_filter(title_localized, lambda t: t.language = 'en')[1].text, title_localized[1].text, '')
    AS title_english,
  CASE WHEN filing_date > 18000101 THEN CAST(try_strptime(CAST(filing_date AS VARCHAR), '%Y%m%d') AS DATE) END
    AS filing_date,
  CASE WHEN publication_date > 18000101
    THEN CAST(try_strptime(CAST(publication_date AS VARCHAR), '%Y%m%d') AS DATE) END AS publication_date,
  len(inventor_harmonized) AS inventor_count,
  coalesce(list_filter(list_transform(inventor_harmonized, lambda x: x.name), lambda v: v IS NOT NULL), [])
    AS inventor_names,
  len(assignee_harmonized) AS assignee_count,
  coalesce(list_filter(list_transform(assignee_harmonized, lambda x: x.name), lambda v: v IS NOT NULL), [])
    AS assignee_names,
  list_filter(list_transform(cpc, lambda x: x.code), lambda v: v IS NOT NULL) AS codes,
  len(citation) AS citation_count, entity_status, art_unit, filing_date AS raw_date
FROM ({NESTED_SQL})
WHERE filing_date > 18000101"""

# First-appearance order of the distinct codes.
DISTINCT_CODES_SQL = """list_filter(codes, lambda c, i: list_position(codes, c) = i)[1:5]"""


def _literal_sql(array: str) -> str:
    """An array without NULLs as a literal."""
    element = r"""concat('"', regexp_replace(x, '([\\"])', '\\\1', 'g'), '"')"""
    return f"concat('{{', coalesce(array_to_string(list_transform({array}, lambda x: {element}), ','), ''), '}}')"


SHOWN_SQL = f"""
SELECT publication_number, application_number, country_code, kind_code, family_id, title_english,
  CAST(filing_date AS VARCHAR) AS filing_date, CAST(publication_date AS VARCHAR) AS publication_date,
  CAST(inventor_count AS BIGINT) AS inventor_count, md5({_literal_sql('inventor_names')}) AS inventor_names,
  CAST(assignee_count AS BIGINT) AS assignee_count, md5({_literal_sql('assignee_names')}) AS assignee_names,
  {_literal_sql(DISTINCT_CODES_SQL)} AS cpc_codes, CAST(citation_count AS BIGINT) AS citation_count,
  entity_status, art_unit
FROM """


def nested_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested record per document; arrays come from the whole text, so no group has to be collected.

    The records are derived as they are read.  Stored, their five arrays would take several times the space of the texts.
    """

    def parts(separator: str) -> Column:
        return F.split("text", separator)

    def named(s: Column, missing: Column, field: str) -> Column:
        return F.struct(F.when(~missing, s).alias(field))

    def language(i: Column) -> Column:
        return F.when((i + doc) % 3 == 2, "en").otherwise("xx")

    def code(s: Column) -> Column:
        return F.concat(F.lit("L"), (F.length(s) % 40).cast("string"))

    doc = F.col("doc_id")
    title_type = "array<struct<text:string,language:string>>"
    titles = F.transform(parts("\n"), lambda s, i: F.struct(s.alias("text"), language(i).alias("language")))
    return table(spark, sf_dir, "documents").select(
        *[F.expr(e) for e in PLAIN],
        F.when(doc % 10 == 7, None)
        .when(doc % 10 == 8, F.array().cast(title_type))
        .otherwise(titles)
        .alias("title_localized"),
        F.when(doc % 10 != 6, F.transform(parts(r"\. "), lambda s: named(s, F.length(s) < 30, "name"))).alias(
            "inventor_harmonized"
        ),
        F.transform(parts(", "), lambda s: named(s, F.length(s) % 4 == 0, "name")).alias("assignee_harmonized"),
        F.transform(parts(", "), lambda s: named(code(s), F.length(s) % 5 == 0, "code")).alias("cpc"),
        F.when(doc % 10 != 5, F.transform(parts("\n"), lambda s: F.struct(s.alias("publication_number")))).alias("citation"),
    )


def _shown(flat: DataFrame) -> DataFrame:
    """Dates as text; arrays as the literals that a load sends, long ones by their digest."""
    literals = sinks.encode_arrays(flat)
    return literals.select(
        *fl.IDENTIFIERS,
        "title_english",
        *[F.col(c).cast("string").alias(c) for c in ("filing_date", "publication_date")],
        *[F.col(c).cast("long").alias(c) for c in ("inventor_count", "assignee_count", "citation_count")],
        *[F.md5(F.col(c).cast("binary")).alias(c) for c in ("inventor_names", "assignee_names")],
        "cpc_codes",
        *fl.ATTRIBUTES,
    )


@query(f"{SHOWN_SQL} ({FLAT_SQL})")
def flatten_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(fl.flatten(nested_records(spark, sf_dir), ordered=False))


@query(
    f"{SHOWN_SQL} (SELECT * FROM ({FLAT_SQL}) WHERE year(filing_date) = 2003 "
    "ORDER BY filing_date DESC NULLS LAST, publication_number LIMIT 25)"
)
def flatten_year_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(fl.flatten(nested_records(spark, sf_dir), limit=25, year=2003))


@query(f"{SHOWN_SQL} (SELECT * FROM ({FLAT_SQL}) WHERE filing_date >= DATE '2016-03-01' - INTERVAL 365 DAY)")
def flatten_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = nested_records(spark, sf_dir)
    return _shown(fl.flatten(nested, recent_days=365, as_of=dt.date(2016, 3, 1), ordered=False))


@query(
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date, o_totalprice FROM orders "
    "ORDER BY o_orderdate DESC, o_orderkey LIMIT 100"
)
def top_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = fl.newest_first(table(spark, sf_dir, "orders"), "o_orderdate", "o_orderkey", 100)
    return newest.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"), "o_totalprice")


@query(
    "SELECT * EXCLUDE (o_orderdate) FROM orders WHERE o_totalprice > 400000 AND o_orderstatus = 'F' "
    "ORDER BY o_orderkey LIMIT 500"
)
def where_limit_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    wanted = "o_totalprice > 400000 AND o_orderstatus = 'F'"
    return tables.select_rows(orders, wanted, limit=500, order=["o_orderkey"]).drop("o_orderdate")


@query(
    "SELECT 'filtered' AS source, least(count(*), 1000000) AS total_rows FROM orders WHERE o_totalprice > 250000 "
    "UNION ALL SELECT 'capped', least(count(*), 5000) FROM lineitem"
)
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    filtered = tables.row_count(
        table(spark, sf_dir, "orders"), "o_totalprice > 250000", limit=tables.MAX_ROWS_PER_RUN
    )
    capped = tables.row_count(table(spark, sf_dir, "lineitem"), limit=5000)
    return filtered.select(F.lit("filtered").alias("source"), "total_rows").unionByName(
        capped.select(F.lit("capped").alias("source"), F.col("total_rows").cast("long"))
    )


@query(
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, user_id, value FROM events "
    "ORDER BY ts, event_id LIMIT 4000"
)
def capped_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    capped = tables.cap_rows(table(spark, sf_dir, "events"), 4000, ["ts", "event_id"])
    return capped.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"), "user_id", "value")


@query(
    "SELECT event_id, event_type, user_id FROM events ORDER BY event_type DESC, user_id, event_id DESC LIMIT 4500"
)
def capped_by_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["event_type", "user_id", "event_id"]
    capped = tables.cap_rows(table(spark, sf_dir, "events"), 4500, order, descending=["event_type", "event_id"])
    return capped.select("event_id", "event_type", "user_id")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5('7:' || o_orderkey), o_orderkey LIMIT 10000")
def preview_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return tables.sample_rows(orders, ["o_orderkey"], seed=7).select("o_orderkey", "o_totalprice")


@query("SELECT CAST(14 AS BIGINT) AS files, CAST(5.0 AS DOUBLE) AS usd_per_tib, true AS sizes_add_up")
def scan_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price of a scan of all tables, per TiB, over as many files as there are tables."""
    cost = tables.estimate_cost(spark, sf_dir).first()
    files = tables.scan_files(spark, sf_dir).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    per_tib = F.round(F.lit(cost["cost_usd"]) * 1024**4 / F.col("bytes"), 6)
    return files.select("files", per_tib.alias("usd_per_tib"), (F.col("bytes") == cost["bytes_processed"]).alias("sizes_add_up"))


@query(
    """SELECT c AS column, (SELECT count(*) FROM orders) AS rows, 5.0::DOUBLE AS usd_per_tib
    FROM (VALUES ('o_orderkey'), ('o_orderdate'), ('o_totalprice')) t(c)"""
)
def scan_cost_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price of two columns and the one a bound is on, from the footers; the bound excludes no row group."""
    bounds = [("o_totalprice", ">", 0.0)]
    chunks = footers.column_chunks(spark, f"{sf_dir}/orders.parquet*", ["o_orderkey", "o_orderdate"], bounds)
    per_tib = F.round(F.col("cost_usd") * 1024**4 / F.col("bytes"), 6)
    return footers.column_cost(chunks).select("column", "rows", per_tib.alias("usd_per_tib"))


@query(
    "SELECT o_orderstatus AS status, o_orderpriority AS priority, o_totalprice AS price FROM orders "
    "WHERE o_orderkey >= 100"
)
def sql_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    query_text = (
        "SELECT o_orderstatus AS status, o_orderpriority AS priority, o_totalprice AS price "
        f"FROM parquet.`{sf_dir}/orders.parquet` WHERE o_orderkey >= 100"
    )
    return tables.read_query(spark, query_text)


CANDIDATE_NAMES = (
    "CASE o_orderkey % 6 WHEN 0 THEN o_orderpriority WHEN 1 THEN concat('t_', o_orderstatus, '.', "
    "CAST(o_custkey AS STRING)) WHEN 2 THEN '' WHEN 3 THEN NULL WHEN 4 THEN concat('a-b', chr(10)) "
    "ELSE concat('x;drop ', o_orderstatus) END"
)


@query(
    f"SELECT o_orderkey, coalesce(regexp_full_match({CANDIDATE_NAMES}, '[a-zA-Z0-9_.-]+'), false) AS is_identifier "
    "FROM orders"
)
def identifier_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", is_identifier(F.expr(CANDIDATE_NAMES)).alias("is_identifier")
    )


@query(
    "SELECT 'active' AS subset, count(*) AS rows FROM orders WHERE o_orderstatus = 'F' "
    "UNION ALL SELECT 'recent', count(*) FROM orders WHERE o_orderdate >= DATE '2001-08-01' - INTERVAL 30 DAY"
)
def conditional_subsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "active").otherwise("closed")
    records = table(spark, sf_dir, "orders").select(status.alias("status"), F.col("o_orderdate").alias("created_at"))
    active = fl.active_only(records).agg(F.count(F.lit(1)).alias("rows"))
    recent = fl.recent_only(records, 30, dt.date(2001, 8, 1)).agg(F.count(F.lit(1)).alias("rows"))
    return active.select(F.lit("active").alias("subset"), "rows").unionByName(
        recent.select(F.lit("recent").alias("subset"), "rows")
    )


@query(
    "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS value, "
    "CASE WHEN event_id % 7 = 0 THEN NULL ELSE value / 2 END AS half FROM events"
)
def nan_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    nan = "CAST('NaN' AS DOUBLE)"
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        f"CASE WHEN event_id % 5 = 0 THEN {nan} ELSE value END AS value",
        f"CASE WHEN event_id % 7 = 0 THEN {nan} ELSE value / 2 END AS half",
    )
    return sinks.nan_to_null(events)


@query(
    f"""SELECT publication_number, application_number, country_code, kind_code,
      CAST(filing_date AS VARCHAR) AS filing_date, CAST(publication_date AS VARCHAR) AS publication_date,
      CAST(NULL AS VARCHAR) AS grant_date, title_english AS title, CAST(NULL AS VARCHAR) AS abstract,
      family_id AS assignee, CAST(to_json({DISTINCT_CODES_SQL}) AS VARCHAR) AS cpc_codes,
      CAST(len(inventor_names) AS BIGINT) AS inventors
      FROM ({FLAT_SQL})"""
)
def conform_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = fl.flatten(nested_records(spark, sf_dir), ordered=False)
    named = flat.withColumnsRenamed({"title_english": "title", "family_id": "assignee", "inventor_names": "inventors"})
    target = T.StructType([f for f in sinks.ENHANCED_TARGET if f.name != "loaded_at"])
    conformed = sinks.conform_to_schema(named, target)
    inventors = F.array_size(F.from_json("inventors", "array<string>")).cast("long")
    dates = {c: F.col(c).cast("string") for c in ("filing_date", "publication_date", "grant_date")}
    return conformed.withColumns(dates).withColumn("inventors", inventors)


@query(
    "SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_custkey AS INT) END AS customer, "
    "CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS note FROM orders"
)
def conform_bad_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text that does not cast to the target type becomes NULL."""
    raw = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "CASE WHEN o_orderkey % 7 = 0 THEN 'unknown' ELSE CAST(o_custkey AS STRING) END AS customer",
        "floor(o_totalprice) AS note",
    )
    return sinks.conform_to_schema(raw, schema(o_orderkey=LONG, customer=INT, note=TEXT))


@query("SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, c_acctbal AS balance FROM customer")
def table_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A typed table: dropped, created, loaded with a load time, and read back."""
    columns = schema(id=LONG, name=TEXT, segment=SHORT_TEXT, balance=DOUBLE, loaded_at=TIME)
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id", "c_name AS name", "c_mktsegment AS segment", "c_acctbal AS balance"
    )
    sinks.create_table(spark, "loaded_customers", columns, location=scratch_path(spark, "customers"), replace=True)
    rows = sinks.conform_to_schema(sinks.stamp_loaded_at(customers), columns)
    sinks.write_table(sinks.prepare_for_load(rows), "loaded_customers")
    return spark.table("loaded_customers").where("loaded_at IS NOT NULL").drop("loaded_at")


@query(
    """SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY o_custkey"""
)
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "customer").where("c_acctbal > 0").withColumnRenamed("c_custkey", "o_custkey")
    new = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    return sinks.absent_rows(new, known, ["o_custkey"], ["o_orderkey"])


@query(
    """WITH a AS (SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'
      GROUP BY o_custkey),
    b AS (SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders WHERE o_orderkey % 2 = 1
      AND o_custkey NOT IN (SELECT o_custkey FROM a) GROUP BY o_custkey),
    c AS (SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders WHERE o_custkey % 50 = 7
      AND o_custkey NOT IN (SELECT o_custkey FROM a UNION ALL SELECT o_custkey FROM b) GROUP BY o_custkey)
    SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c"""
)
def insert_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three inserts into a target with a key index, the second one repeated after the third."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    target = KeyedTarget(scratch_path(spark, "keyed"), ("o_custkey",), buckets=8)
    runs = {"a": "o_orderdate < TIMESTAMP '1996-01-01'", "b": "o_orderkey % 2 = 1", "c": "o_custkey % 50 = 7"}
    for run in ("a", "b", "c", "b"):
        target.insert(orders.where(runs[run]).drop("o_orderdate"), run, ["o_orderkey"])
    return target.rows(spark, orders.drop("o_orderdate").schema)


@query(
    "SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer "
    "UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier"
)
def append_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS key", "c_name AS name", "c_mktsegment AS segment"
    )
    suppliers = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS key", "s_name AS name")
    return sinks.append_frames(customers, suppliers)


@query(
    r"""SELECT conv_id, turn, concat('{', array_to_string(list_transform(string_split(text, ' '), lambda w:
      CASE WHEN length(w) = 2 THEN 'NULL' ELSE concat('"', regexp_replace(w, '([\\"])', '\\\1', 'g'), '"') END), ','),
      '}') AS words FROM conversations"""
)
def array_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.transform(F.split("text", " "), lambda w: F.when(F.length(w) != 2, w))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", array_literal(words).alias("words"))

"""Column checks, row rules, and the history of checks."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowkit.catalogue.registry import GAPPY_ORDERS_SQL, gappy_orders, query, table
from flowkit.functions.schema import TEXT, schema
from flowkit.operators import checks, report
from flowkit.operators.clean import standardize_dates
from flowkit.operators.rules import RuleSet, annotate, counts_by_rule, split, validity_counts, violation_rows
from flowkit.plans.staging import scratch_path


def _issues(df: DataFrame) -> DataFrame:
    return df.withColumn("percentage", F.round("percentage", 6))


def _issue_sql(check: str, column: str, kind: str, bad: str, severity: str, source: str) -> str:
    return (
        f"SELECT '{check}' AS \"check\", '{column}' AS \"column\", '{kind}' AS issue_type, "
        f"count(*) FILTER ({bad}) AS count, round(count(*) FILTER ({bad}) * 100.0 / count(*), 6) AS percentage, "
        f"'{severity}' AS severity FROM {source} HAVING count(*) FILTER ({bad}) > 0"
    )


# Mostly-null and partly-null columns, required and allowed to be null.
NULLS = (
    "o_orderkey",
    "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS price",
    "CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus ELSE NULL END AS rare",
    "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS common",
)
NULLS_SQL = f"(SELECT {', '.join(NULLS)} FROM orders)"


@query(
    _issue_sql("null_values", "price", "unexpected_nulls", "price IS NULL", "error", NULLS_SQL)
    + " UNION ALL "
    + _issue_sql("null_values", "rare", "high_null_percentage", "rare IS NULL", "warning", NULLS_SQL)
)
def check_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").selectExpr(*NULLS)
    return _issues(checks.check_nulls(rows, nullable=["rare", "common"]))


DUPLICATES_SQL = """SELECT 'duplicates' AS "check", '{columns}' AS "column", 'duplicate_rows' AS issue_type,
  CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS count,
  round(coalesce(sum(n) FILTER (n > 1), 0) * 100.0 / sum(n), 6) AS percentage, 'error' AS severity
  FROM (SELECT count(*) AS n FROM {source} GROUP BY {columns}) HAVING coalesce(sum(n) FILTER (n > 1), 0) > 0"""


@query(DUPLICATES_SQL.format(columns="l_orderkey,l_linenumber", source="lineitem"))
def check_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _issues(checks.check_duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]))


RANGES = {"l_quantity": (5, 45), "l_discount": (0.0, 0.08), "l_tax": (0.0, 1.0), "absent": (0, 1)}


@query(
    _issue_sql("ranges", "l_quantity", "out_of_range", "l_quantity < 5 OR l_quantity > 45", "info", "lineitem")
    + " UNION ALL "
    + _issue_sql("ranges", "l_discount", "out_of_range", "l_discount < 0 OR l_discount > 0.08", "info", "lineitem")
)
def check_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _issues(checks.check_ranges(table(spark, sf_dir, "lineitem"), RANGES))


PATTERNS = {"c_name": r"Customer#0{5}\d+", "c_mktsegment": "[A-H]", "c_nationkey": r"1?\d\b"}
WORD_PATTERN = r"(?P<first_word>\w+)[ ,.&[]*\w"


@query(
    " UNION ALL ".join(
        _issue_sql("string_patterns", c, "pattern_mismatch", bad, "info", "customer")
        for c, bad in ((c, f"NOT regexp_matches({c}::VARCHAR, '^(?:{p})')") for c, p in PATTERNS.items())
    )
)
def check_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _issues(checks.check_patterns(table(spark, sf_dir, "customer"), PATTERNS))


@query(
    _issue_sql(
        "string_patterns", "text", "pattern_mismatch",
        r"NOT regexp_matches(text, '^[\p{L}\p{M}\p{N}\p{Pc}]+[ ,.&\[]*[\p{L}\p{M}\p{N}\p{Pc}]')", "info", "documents",
    )
)
def check_text_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word classes on texts in four languages."""
    return _issues(checks.check_patterns(table(spark, sf_dir, "documents"), {"text": WORD_PATTERN}))


DIRTY_PRICE = "CASE WHEN o_orderkey % 9 = 0 THEN 'n/a' ELSE CAST(o_custkey AS STRING) END AS price"


@query(
    _issue_sql(
        "ranges", "price", "out_of_range", "coalesce(TRY_CAST(price AS DOUBLE) NOT BETWEEN 100 AND 900, true)", "info",
        f"(SELECT {DIRTY_PRICE} FROM orders)",
    )
)
def check_dirty_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric bounds on a text column in which some values are no numbers."""
    return _issues(checks.check_ranges(table(spark, sf_dir, "orders").selectExpr(DIRTY_PRICE), {"price": (100, 900)}))


@query(f"SELECT count_if(coalesce(TRY_CAST(price AS DOUBLE) BETWEEN 100 AND 900, false)) AS valid_rows, "
       f"count_if(NOT coalesce(TRY_CAST(price AS DOUBLE) BETWEEN 100 AND 900, false)) AS invalid_rows "
       f"FROM (SELECT {DIRTY_PRICE} FROM orders)")
def rules_on_dirty_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").selectExpr(DIRTY_PRICE)
    return validity_counts(annotate(rows, RuleSet().add_range_rule("price", 100, 900)))


ALL_CHECKS = {
    "nullable": ["status"],
    "keys": ["o_custkey"],
    "types": {"price": "numeric", "status": "numeric", "priority": "string", "o_custkey": "string", "absent": "string"},
    "ranges": {"price": (1000, 400000)},
    "patterns": {"priority": "[1-3]-"},
}
ALL_CHECKS_SQL = " UNION ALL ".join([
    _issue_sql("null_values", "price", "unexpected_nulls", "price IS NULL", "error", f"({GAPPY_ORDERS_SQL})"),
    _issue_sql("ranges", "price", "out_of_range", "price < 1000 OR price > 400000", "info", f"({GAPPY_ORDERS_SQL})"),
    _issue_sql(
        "string_patterns", "priority", "pattern_mismatch", "NOT regexp_matches(priority, '^[1-3]-')", "info",
        f"({GAPPY_ORDERS_SQL})",
    ),
    DUPLICATES_SQL.format(columns="o_custkey", source="orders"),
    "SELECT 'data_types', 'status', 'type_mismatch', NULL, NULL, 'error'",
    "SELECT 'data_types', 'o_custkey', 'type_mismatch', NULL, NULL, 'warning'",
    "SELECT 'data_types', 'absent', 'missing_column', NULL, NULL, 'info'",
])


@query(ALL_CHECKS_SQL)
def check_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _issues(checks.check_all(gappy_orders(spark, sf_dir), **ALL_CHECKS))


@query(
    f"""WITH issues AS ({ALL_CHECKS_SQL})
    SELECT c AS "check", count(*) FILTER (severity = 'error') = 0 AS passed, count("check") AS issue_count
    FROM unnest(['null_values', 'duplicates', 'data_types', 'ranges', 'string_patterns']) AS t(c)
    LEFT JOIN issues ON c = "check" GROUP BY c"""
)
def check_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.check_results(checks.check_all(gappy_orders(spark, sf_dir), **ALL_CHECKS))


@query("SELECT count(*) AS row_count, CAST(5 AS BIGINT) AS column_count, false AS passed FROM orders")
def check_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gappy_orders(spark, sf_dir)
    summary = checks.validation_summary(rows, checks.check_all(rows, **ALL_CHECKS))
    return summary.withColumn("column_count", F.col("column_count").cast("long"))


MIXED_TEXT = (
    "CASE WHEN o_orderkey % 5 = 0 THEN 'n/a' ELSE CAST(o_custkey AS STRING) END AS customer",
    "CAST(o_orderkey AS STRING) AS order_text",
)


@query(
    _issue_sql(
        "data_types", "customer", "not_castable", "TRY_CAST(customer AS BIGINT) IS NULL", "error",
        f"(SELECT {', '.join(MIXED_TEXT)} FROM orders)",
    )
)
def check_castable(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").selectExpr(*MIXED_TEXT)
    return _issues(checks.check_castable(rows, {"customer": "bigint", "order_text": "bigint"}))


# --- row rules

BAD_STATUS = "status IS NULL OR trim(status) = ''"
BAD_PRICE = "price IS NULL OR price < 1000 OR price > 450000"
BAD_PRIORITY = "NOT coalesce(regexp_matches(priority, '^[1-4]-'), false)"


def order_rules() -> RuleSet:
    return (
        RuleSet("orders")
        .add_not_null_rule("status")
        .add_range_rule("price", 1000, 450000)
        .add_pattern_rule("priority", "[1-4]-", severity="warning")
    )


VALIDITY_SQL = f"""SELECT *, {BAD_STATUS} AS bad_status, {BAD_PRICE} AS bad_price, {BAD_PRIORITY} AS bad_priority
  FROM ({GAPPY_ORDERS_SQL})"""


@query(
    f"""SELECT o_orderkey, 'status_not_null' AS rule, 'status' AS "column", 'error' AS severity,
      concat('Column ''status'' cannot be null (value: ', coalesce(status, 'None'), ')') AS message
      FROM ({VALIDITY_SQL}) WHERE bad_status
    UNION ALL SELECT o_orderkey, 'priority_pattern', 'priority', 'warning',
      concat('Column ''priority'' does not match pattern ''[1-4]-'' (value: ', priority, ', pattern: [1-4]-)')
      FROM ({VALIDITY_SQL}) WHERE bad_priority
    UNION ALL SELECT o_orderkey, 'price_range', 'price', 'error',
      'Column ''price'' must be between 1000 and 450000' FROM ({VALIDITY_SQL}) WHERE bad_price"""
)
def rule_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = violation_rows(annotate(gappy_orders(spark, sf_dir), order_rules()), "o_orderkey")
    # The engines print large doubles differently, so the price's message is compared without its value.
    shown = F.when(F.col("column") == "price", F.split_part("message", F.lit(" (value"), F.lit(1)))
    return found.withColumn("message", F.coalesce(shown, "message"))


@query(
    f"""SELECT count(*) FILTER (NOT (bad_status OR bad_price OR bad_priority)) AS valid_rows,
      count(*) FILTER (bad_status OR bad_price OR bad_priority) AS invalid_rows FROM ({VALIDITY_SQL})"""
)
def rule_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validity_counts(annotate(gappy_orders(spark, sf_dir), order_rules()))


@query(
    f"""SELECT count(*) FILTER (NOT (bad_status OR bad_price)) AS valid_rows,
      count(*) FILTER (bad_status OR bad_price) AS invalid_rows FROM ({VALIDITY_SQL})"""
)
def rule_summary_errors_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validity_counts(annotate(gappy_orders(spark, sf_dir), order_rules(), ignore_warnings=True))


@query(
    f"""SELECT 'status_not_null' AS rule, count(*) AS violations FROM ({VALIDITY_SQL}) WHERE bad_status
    UNION ALL SELECT 'price_range', count(*) FROM ({VALIDITY_SQL}) WHERE bad_price
    UNION ALL SELECT 'priority_pattern', count(*) FROM ({VALIDITY_SQL}) WHERE bad_priority
    UNION ALL SELECT 'priority_pattern_2', count(*) FROM orders WHERE o_orderpriority <> '2-HIGH'
    UNION ALL SELECT 'priority_pattern_3', count(*) FROM orders WHERE o_orderpriority = '2-HIGH'
    UNION ALL SELECT 'absent_missing', count(*) FROM orders"""
)
def rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two of the patterns agree in their first 24 characters."""
    rules = order_rules().add_pattern_rule("priority", r"(?P<rank_no>[1-5])-(?:LOW)?(?<=2-)HIGH$")
    rules.add_pattern_rule("priority", r"(?P<rank_no>[1-5])-(?:LOW)?(?!HIGH$)|[13-5]-").add_not_null_rule("absent")
    return counts_by_rule(annotate(gappy_orders(spark, sf_dir), rules)).select("rule", "violations")


@query(f"SELECT o_orderkey, status, priority FROM ({VALIDITY_SQL}) WHERE NOT (bad_status OR bad_price OR bad_priority)")
def valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = split(annotate(gappy_orders(spark, sf_dir), order_rules()))
    return valid.select("o_orderkey", "status", "priority")


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, count(*) OVER (PARTITION BY l_partkey) = 1 AS is_valid FROM lineitem"
)
def unique_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = annotate(table(spark, sf_dir, "lineitem"), RuleSet().add_unique_rule("l_partkey"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "is_valid")


SHIFTED = "CASE WHEN o_orderkey % 6 = 0 THEN o_custkey + 100000000 ELSE o_custkey END AS customer"


@query(
    f"""SELECT o_orderkey, customer, concat('Column ''customer'' has no match in ''c_custkey'' (value: ', customer, ')')
      AS message FROM (SELECT o_orderkey, {SHIFTED} FROM orders)
    WHERE customer NOT IN (SELECT c_custkey FROM customer)"""
)
def referential_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey", SHIFTED)
    rules = RuleSet().add_referential_rule("customer", table(spark, sf_dir, "customer"), "c_custkey")
    return violation_rows(annotate(orders, rules), "o_orderkey", "customer").select("o_orderkey", "customer", "message")


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'even price (error: no price)' ELSE 'even price' END
      AS message FROM orders
    WHERE o_orderkey % 7 = 0 OR CAST(floor(o_totalprice) AS BIGINT) % 2 = 1
    UNION ALL SELECT o_orderkey, 'status is F' FROM orders WHERE o_orderstatus = 'F'"""
)
def custom_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One predicate as a Column, and one as a Python function that raises on missing values."""

    def not_f(status: Column) -> Column:
        return status != "F"

    def even_price(price: float | None) -> bool:
        if price is None:
            raise ValueError("no price")
        return int(price) % 2 == 0

    rules = RuleSet().add_custom_rule("o_orderstatus", not_f, "status is F")
    rules.add_python_rule("price", even_price, "even price")
    price = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice"))
    orders = table(spark, sf_dir, "orders").withColumn("price", price)
    return violation_rows(annotate(orders, rules), "o_orderkey").select("o_orderkey", "message")


BIG = 9007199254740993


@query(
    f"""SELECT o_orderkey, message FROM (SELECT o_orderkey, unnest([
        CASE WHEN o_orderkey % 5 <> 0 AND ({BIG} + o_custkey) % 2 = 1 THEN 'odd' END,
        CASE WHEN o_orderkey % 5 = 0 THEN 'none' END,
        CASE WHEN o_orderkey % 3 = 0 THEN 'short' END]) AS message FROM orders) WHERE message IS NOT NULL"""
)
def python_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Python functions of large whole numbers between NULLs, of arrays, and of whole Arrow arrays."""
    big = F.when(F.col("o_orderkey") % 5 != 0, F.lit(BIG) + F.col("o_custkey")).alias("big")
    items = F.sequence(F.lit(0), (F.col("o_orderkey") % 3).cast("int")).alias("items")
    rules = RuleSet().add_python_rule("big", lambda v: v is None or v % 2 == 0, "odd")
    rules.add_arrow_rule("big", lambda values: values.is_valid(), "none")
    rules.add_python_rule("items", functools.partial(_longer, 1), "short")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", big, items)
    return violation_rows(annotate(rows, rules), "o_orderkey").select("o_orderkey", "message")


def _longer(least: int, items: list[int]) -> bool:
    return len(items) > least


# --- score, history and report

FLAGSHIP_SQL = """
WITH raw AS (SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS priority,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS price,
    CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderdate END AS order_date FROM orders),
  checked AS (SELECT *, order_date IS NOT NULL AND price IS NOT NULL AND price BETWEEN 1000 AND 450000 AS ok FROM raw)
SELECT status, count(*) AS total_rows, count(*) FILTER (ok) AS valid_rows,
  round(count(*) FILTER (ok) * 100.0 / count(*), 4) AS quality_score,
  strftime(max(order_date) FILTER (ok), '%Y-%m-%d') AS newest_valid
FROM checked GROUP BY status"""


@query(FLAGSHIP_SQL)
def order_quality_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse dates, check the rows, and score each order status: one scan and one combined shuffle."""
    key = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    raw = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_orderstatus").alias("status"),
        F.when(key % 7 != 0, F.col("o_totalprice")).alias("price"),
        F.when(key % 17 == 0, "not a date").otherwise(day).alias("order_date"),
    )
    rules = RuleSet().add_not_null_rule("order_date").add_not_null_rule("price").add_range_rule("price", 1000, 450000)
    checked = annotate(standardize_dates(raw), rules)
    valid = F.col("is_valid")
    return checked.groupBy("status").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(valid).alias("valid_rows"),
        F.round(F.count_if(valid) * 100.0 / F.count(F.lit(1)), 4).alias("quality_score"),
        F.date_format(F.max(F.when(valid, F.col("order_date"))), "yyyy-MM-dd").alias("newest_valid"),
    )


@query(
    f"""SELECT count(*) AS total_rows, count(*) FILTER (NOT (bad_status OR bad_price OR bad_priority)) AS valid_rows,
      round(count(*) FILTER (NOT (bad_status OR bad_price OR bad_priority)) * 100.0 / count(*), 6) AS quality_score
      FROM ({VALIDITY_SQL})"""
)
def dataset_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = checks.dataset_score(annotate(gappy_orders(spark, sf_dir), order_rules()))
    return scored.withColumn("quality_score", F.round("quality_score", 6))


HISTORY_SQL = f"""SELECT priority AS check_name, count(*) AS records_total,
  count(*) FILTER (NOT (bad_status OR bad_price)) AS records_valid,
  count(*) FILTER (bad_status OR bad_price) AS records_invalid FROM ({VALIDITY_SQL}) GROUP BY priority"""


def check_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One check record per order priority."""
    checked = annotate(gappy_orders(spark, sf_dir), order_rules(), ignore_warnings=True)
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return report.check_records(checked, F.col("priority"), F.col("is_valid"), now)


@query(
    f"""SELECT check_name, records_invalid = 0 AS passed, records_total, records_valid, records_invalid,
      format('{{:.2f}}%', records_valid * 100.0 / records_total) AS valid_percentage FROM ({HISTORY_SQL})"""
)
def quality_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the CSV export."""
    return report.csv_rows(check_history(spark, sf_dir)).drop("timestamp")


@query(
    f"""SELECT check_name, CAST(records_invalid = 0 AS VARCHAR) AS passed,
      CAST(records_total AS VARCHAR) AS records_total,
      format('{{:.2f}}%', records_valid * 100.0 / records_total) AS valid_percentage FROM ({HISTORY_SQL})"""
)
def report_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CSV export, read back as text."""
    path = scratch_path(spark, "report")
    report.export_report_csv(check_history(spark, sf_dir), path)
    columns = schema(**dict.fromkeys(report.CSV_COLUMNS, TEXT))
    exported = spark.read.schema(columns).option("header", True).csv(path)
    return exported.select("check_name", "passed", "records_total", "valid_percentage")


REPORT_LINES_SQL = f"""SELECT 'total' AS part, CAST(sum(records_total) AS BIGINT) AS records,
  CAST(sum(records_valid) AS BIGINT) AS valid FROM ({HISTORY_SQL})
  UNION ALL SELECT check_name, records_total, records_valid FROM ({HISTORY_SQL})"""


@query(REPORT_LINES_SQL)
def report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON export, totals and checks, read back."""
    path = scratch_path(spark, "report")
    report.export_report_json(check_history(spark, sf_dir), path)
    totals = spark.read.schema("total_records_checked long, total_valid_records long").json(f"{path}/totals")
    lines = spark.read.schema("check_name string, records_total long, records_valid long").json(f"{path}/checks")
    return totals.select(
        F.lit("total").alias("part"), F.col("total_records_checked").alias("records"), F.col("total_valid_records").alias("valid")
    ).union(lines)


@query(f"SELECT round(sum(records_valid) * 100.0 / sum(records_total), 6) AS overall_score FROM ({HISTORY_SQL})")
def quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = report.quality_score(check_history(spark, sf_dir))
    return score.select(F.round("overall_score", 6).alias("overall_score"))


REPORT_SQL = """round(sum(records_valid) * 100.0 / sum(records_total), 6) AS overall_score, count(*) AS total_checks,
  count(*) FILTER (records_invalid = 0) AS passed_checks, count(*) FILTER (records_invalid > 0) AS failed_checks,
  CAST(sum(records_total) AS BIGINT) AS total_records_checked,
  CAST(sum(records_valid) AS BIGINT) AS total_valid_records,
  CAST(sum(records_invalid) AS BIGINT) AS total_invalid_records"""


@query(f"SELECT {REPORT_SQL} FROM ({HISTORY_SQL})")
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = report.quality_report(check_history(spark, sf_dir))
    return totals.withColumn("overall_score", F.round("overall_score", 6))


@query(f"SELECT check_name, {REPORT_SQL} FROM ({HISTORY_SQL}) GROUP BY ROLLUP (check_name)")
def quality_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = report.quality_rollup(check_history(spark, sf_dir))
    return totals.withColumn("overall_score", F.round("overall_score", 6))

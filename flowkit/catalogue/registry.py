"""Registry of catalogue queries and their plain-SQL counterparts.

The source tables hold no NULLs, bad dates or nested columns.  A query therefore derives such values from the whole
table first, by expressions that both SQL dialects share, and then applies the operator.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the equivalent SQL where there is one."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Orders with missing prices and statuses, as expressions that both dialects read alike.
GAPPY_ORDERS = (
    "o_orderkey",
    "o_custkey",
    "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS price",
    "CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN '  ' ELSE o_orderstatus END AS status",
    "o_orderpriority AS priority",
)
GAPPY_ORDERS_SQL = f"SELECT {', '.join(GAPPY_ORDERS)} FROM orders"


def gappy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*GAPPY_ORDERS)

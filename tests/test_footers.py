import duckdb
import pytest
from pyspark.sql import functions as F

from flowkit.sources import footers


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("footers") / "orders")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").orderBy("o_orderkey").repartitionByRange(3, "o_orderkey")
    orders.withColumn("names", F.array("o_orderstatus", "o_orderpriority")).write.option("parquet.block.size", 40_000).parquet(path)
    return path


def test_bytes_equal_the_file_metadata(spark, stored):
    found = footers.column_cost(footers.column_chunks(spark, stored)).collect()
    sql = f"SELECT split_part(path_in_schema, ', ', 1) AS c, sum(total_compressed_size) FROM parquet_metadata('{stored}/*.parquet') GROUP BY 1"
    assert {r["column"]: r["bytes"] for r in found} == {k.split(".")[0]: int(v) for k, v in duckdb.sql(sql).fetchall()}
    rows = spark.read.parquet(stored).count()
    assert {r["rows"] for r in found} == {rows}
    total = footers.scan_cost(footers.column_chunks(spark, stored, ["o_orderkey", "names"])).first()
    assert total["bytes_processed"] == sum(r["bytes"] for r in found if r["column"] in ("o_orderkey", "names"))
    assert total["cost_usd"] == pytest.approx(total["bytes_processed"] / 1024**4 * 5)


def test_row_groups_out_of_bounds_cost_nothing(spark, stored):
    most = spark.read.parquet(stored).agg(F.max("o_orderkey")).first()[0]
    sql = "SELECT sum(total_compressed_size) FROM parquet_metadata('{}/*.parquet') WHERE path_in_schema IN ('o_custkey', 'o_orderkey') AND {}"
    key = "row_group_id || file_name IN (SELECT row_group_id || file_name FROM parquet_metadata('{}/*.parquet') WHERE path_in_schema = 'o_orderkey' AND {})"
    for sign, value, kept in (("<", most // 4, "stats_min_value::BIGINT < {}"), (">=", most // 2, "stats_max_value::BIGINT >= {}"), ("=", 5, "stats_min_value::BIGINT <= {0} AND stats_max_value::BIGINT >= {0}")):
        chunks = footers.column_chunks(spark, stored, ["o_custkey"], [("o_orderkey", sign, value)])
        expected = duckdb.sql(sql.format(stored, key.format(stored, kept.format(value)))).fetchall()[0][0]
        assert footers.scan_cost(chunks).first()["bytes_processed"] == expected
    nothing = footers.column_chunks(spark, stored, ["o_custkey"], [("o_orderkey", ">", most)])
    assert footers.scan_cost(nothing).first()["bytes_processed"] == 0
    absent = footers.column_chunks(spark, stored, ["no_such_column"])
    assert absent.count() == 0
    with pytest.raises(ValueError, match="operator"):
        footers.column_chunks(spark, stored, None, [("o_orderkey", "~", 1)])

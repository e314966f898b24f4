import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from flowkit.functions.schema import DOUBLE, INT, TEXT, schema
from flowkit.operators.rules import RuleSet
from flowkit.plans.jobs import migrate
from flowkit.sources import sinks, tables

NAN = float("nan")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_table_names():
    assert tables.resolve_table_name("p", "d", "t") == "p.d.t"
    assert tables.resolve_table_name("p", "other.d", "t") == "other.d.t"


def test_predicate_cannot_carry_a_statement(spark):
    with pytest.raises(Exception, match="PARSE"):
        tables.select_rows(spark.range(3), "id > 1; DROP TABLE x")


def test_limit_needs_an_order(spark):
    with pytest.raises(ValueError, match="order"):
        tables.select_rows(spark.range(3), limit=2)


@pytest.mark.parametrize("small", [0, 1_000])
@pytest.mark.parametrize("limit", [0, 1, 37, 200, 301, 500, 900])
def test_cap_is_exact(spark, limit, small, monkeypatch):
    monkeypatch.setattr(tables, "SMALL_LIMIT", small)
    data = [(None if i % 10 == 0 else (5 if i % 3 else i % 50), i) for i in range(500)]
    df = spark.createDataFrame(data, "t INT, id INT").repartition(6)
    expected = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))[:limit]
    assert rows(tables.cap_rows(df, limit, ["t", "id"])) == sorted(expected, key=str)
    expected = sorted(data, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))[:limit]
    assert rows(tables.cap_rows(df, limit, ["t", "id"], descending=["t"])) == sorted(expected, key=str)


@pytest.mark.parametrize("small", [0, 1_000])
def test_cap_on_text(spark, small, monkeypatch):
    monkeypatch.setattr(tables, "SMALL_LIMIT", small)
    df = spark.createDataFrame([(f"k{i:03d}",) for i in range(100)], "k STRING")
    assert [r[0] for r in rows(tables.cap_rows(df, 10, ["k"]))] == [f"k{i:03d}" for i in range(10)]


@pytest.mark.parametrize("small", [0, 1_000])
def test_sample_is_exact_and_repeatable(spark, small, monkeypatch):
    monkeypatch.setattr(tables, "SMALL_LIMIT", small)
    df = spark.range(100_000)
    sample = [r[0] for r in tables.sample_rows(df, ["id"], 1000).collect()]
    assert len(set(sample)) == 1000
    assert sorted(sample) == sorted(r[0] for r in tables.sample_rows(df.repartition(7), ["id"], 1000).collect())
    brute = df.orderBy(F.md5(F.concat(F.lit("0:"), F.col("id").cast("string")).cast("binary"))).limit(1000).collect()
    assert sorted(sample) == sorted(r[0] for r in brute)
    assert tables.sample_rows(spark.range(5), ["id"], 1000).count() == 5


def test_row_count(spark):
    assert tables.row_count(spark.range(10), "id > 3").first()[0] == 6
    assert tables.row_count(spark.range(10), limit=4).first()[0] == 4


def test_cost_counts_whole_files(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    size = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    assert rows(tables.estimate_cost(spark, str(tmp_path))) == [(size, size / 1024**4 * 5)]


def test_write_modes(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.range(5)
    sinks.write_parquet(df, path, "fail")
    with pytest.raises(Exception, match="exists"):
        sinks.write_parquet(df, path, "fail")
    sinks.write_parquet(df, path)
    assert spark.read.parquet(path).count() == 10
    sinks.write_parquet(df, path, "replace", file_rows=2)
    assert spark.read.parquet(path).count() == 5


def test_tables(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    columns = schema(id=INT, note=TEXT, x=DOUBLE)
    sinks.create_table(spark, name, columns)
    df = spark.createDataFrame([(1, "a", 1.0)], columns)
    sinks.write_table(df, name)
    sinks.write_table(df, name)
    assert spark.table(name).count() == 2
    sinks.create_table(spark, name, columns)
    assert spark.table(name).count() == 2
    assert tables.read_source(spark, "spark_catalog", "default", name, "id = 1").count() == 2
    assert tables.read_source(spark, "ignored", "spark_catalog.default", name, limit=1, order=["id"]).count() == 1
    sinks.create_table(spark, name, columns, replace=True)
    assert spark.table(name).count() == 0
    sinks.drop_table(spark, name)
    sinks.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)
    with pytest.raises(ValueError):
        sinks.drop_table(spark, "x; DROP TABLE y")


def test_varchar_table_refuses_longer_text(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    sinks.create_table(spark, name, sinks.SIMPLE_TARGET)
    row = ("n", "a", "DE", dt.date(2024, 1, 1), dt.datetime(2024, 1, 1))
    good = sinks.conform_to_schema(spark.createDataFrame([row], sinks.SIMPLE_TARGET.names), sinks.SIMPLE_TARGET)
    good.write.insertInto(name)
    assert spark.table(name).count() == 1
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        good.withColumn("country_code", F.lit("x" * 11)).write.insertInto(name)
    sinks.drop_table(spark, name)


def test_insert_if_absent(spark, tmp_path):
    path = str(tmp_path / "t")
    columns = "k INT, t INT"
    spark.createDataFrame([(1, 0), (2, 0)], columns).write.parquet(path)
    new = spark.createDataFrame([(2, 5), (3, 9), (3, 4), (4, 1)], columns)
    sinks.insert_if_absent(new, path, ["k"], ["t"])
    sinks.insert_if_absent(new, path, ["k"], ["t"])
    assert rows(spark.read.parquet(path)) == [(1, 0), (2, 0), (3, 4), (4, 1)]


def test_append_fills_absent_columns(spark):
    a, b = spark.createDataFrame([(1, "x")], "k INT, s STRING"), spark.createDataFrame([(2,)], "k INT")
    assert rows(sinks.append_frames(a, b, a)) == [(1, "x"), (1, "x"), (2, None)]


def test_rows_prepared_for_a_relational_target(spark):
    df = spark.createDataFrame(
        [(1, ["a", 'b"c'], NAN), (2, [], 1.5), (3, None, None)], "id INT, inventor_names ARRAY<STRING>, x DOUBLE"
    )
    assert rows(sinks.prepare_for_load(df)) == [(1, '{"a","b\\"c"}', None), (2, "{}", 1.5), (3, "{}", None)]


def test_migration(spark, tmp_path):
    source = str(tmp_path / "src")
    spark.range(1000).selectExpr("id", "id % 7 AS k").repartition(4).write.parquet(source)
    name, run = f"m_{uuid.uuid4().hex[:8]}", {"location": str(tmp_path / "m"), "max_files": 1}
    status = migrate(spark, source, name, where="k < 3", drop=True, **run).first().asDict()
    assert status == {"status": "completed", "progress": 100, "rows_extracted": 429, "rows_loaded": 429, "rows_failed": 0}
    assert spark.table(name).select("batch_id").distinct().count() == 4
    with pytest.raises(ValueError, match="already loaded"):
        migrate(spark, source, name, where="k < 3")
    second = migrate(spark, source, name, limit=100, order=["id"], run="second").first()
    assert (second["rows_loaded"], second["status"]) == (100, "completed")
    assert spark.table(name).count() == 529
    sinks.drop_table(spark, name)


def test_migration_counts_failed_rows_and_goes_on(spark, tmp_path):
    source = str(tmp_path / "in")
    for part in range(3):
        frame = spark.range(part * 100, part * 100 + 100).selectExpr("id", "id % 5 AS k")
        frame.coalesce(1).write.mode("append").parquet(source)
    rules = RuleSet().add_range_rule("k", 0, 3)
    run = {"checkpoint": str(tmp_path / "state"), "location": str(tmp_path / "out"), "max_files": 1, "rules": rules}
    status = migrate(spark, source, "counted_rows", **run).first()
    assert (status["status"], status["rows_loaded"], status["rows_failed"], status["progress"]) == ("failed", 240, 60, 100)
    again = migrate(spark, source, "counted_rows", drop=True, **run).first()
    assert (again["rows_loaded"], again["rows_failed"]) == (240, 60)
    sinks.drop_table(spark, "counted_rows", files=True)
    assert not (tmp_path / "out").exists()


def test_replaced_table_with_a_location_is_empty(spark, tmp_path):
    columns = spark.range(1).schema
    sinks.create_table(spark, "placed_rows", columns, location=str(tmp_path / "t"))
    spark.range(5).write.mode("append").insertInto("placed_rows")
    sinks.create_table(spark, "placed_rows", columns, location=str(tmp_path / "t"), replace=True)
    assert spark.table("placed_rows").count() == 0
    sinks.drop_table(spark, "placed_rows", files=True)

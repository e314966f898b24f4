import datetime as dt

import pytest
from pyspark.sql import functions as F

from flowkit.operators import clean as cl
from flowkit.plans.jobs import Transformations, process
from flowkit.operators.rules import RuleSet

NAN = float("nan")


def rows(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def test_full_row_dedupe_treats_nan_and_null_as_equal(spark):
    df = spark.createDataFrame([(NAN, None), (NAN, None), (1.0, "a"), (1.0, "a"), (1.0, None)], "x DOUBLE, s STRING")
    assert cl.drop_duplicate_rows(df).count() == 3


def test_dedupe_with_maps(spark):
    df = spark.createDataFrame([(1, {"a": 1, "b": 2}), (1, {"b": 2, "a": 1}), (1, {"a": 2})], "k INT, m MAP<STRING, INT>")
    assert cl.drop_duplicate_rows(df).count() == 2


def test_keep_first(spark):
    data = [("x", 3), ("x", 1), ("x", 2), ("y", 5), ("y", 4), ("z", 9), (None, 7), (None, 6)]
    kept = cl.keep_first(spark.createDataFrame(data, "k STRING, t INT"), ["k"], ["t"])
    assert sorted(rows(kept), key=str) == sorted([("x", 1), ("y", 4), ("z", 9), (None, 6)], key=str)


def test_deduplicate_rows_ignores_bookkeeping_columns(spark):
    data = [(1, "a", 30, 1), (1, "a", 10, 2), (2, "a", 20, 3)]
    df = spark.createDataFrame(data, "id INT, s STRING, created_at INT, updated_at INT")
    assert sorted(rows(cl.deduplicate_rows(df, ["created_at"]))) == [(1, "a", 10, 2), (2, "a", 20, 3)]


def test_median_fill(spark):
    data = [(1.0, 1, None, 7), (2.0, 2, None, 7), (None, None, None, 8), (4.0, 4, None, 9), (NAN, 3, None, 9)]
    df = spark.createDataFrame(data, "x DOUBLE, i INT, none DOUBLE, full INT")
    filled = cl.fill_numeric_median(df)
    assert [f.dataType.simpleString() for f in filled.schema] == ["double", "double", "double", "int"]
    out = rows(filled)
    assert out[2][0] == 2.0 and out[4][0] == 2.0 and out[2][1] == 2.5 and all(r[2] is None for r in out)
    sketched = rows(cl.fill_numeric_median(df, exact=False))
    assert sketched[2][0] == 2.0 and all(r[2] is None for r in sketched)


def test_string_fill(spark):
    df = spark.createDataFrame([("a", None, 1), (None, None, 2)], "s STRING, t STRING, n INT")
    assert rows(cl.fill_string_empty(df)) == [("a", "", 1), ("", "", 2)]


def test_coerce_types(spark):
    df = spark.createDataFrame([("1", "1"), ("x", "2"), (None, "3")], "a STRING, b STRING")
    types = {"a": "int", "b": "int", "absent": "int"}
    assert rows(cl.coerce_types(df, types)) == [(1, 1), (None, 2), (None, 3)]
    assert rows(cl.coerce_types(df, types, whole_columns=True)) == [("1", 1), ("x", 2), (None, 3)]
    assert rows(cl.cast_failures(df, types)) == [("a", "int", 1), ("b", "int", 0)]


def test_standardize_dates(spark):
    data = [("2024-01-02", "20240103", "2024-01-02"), ("not a date", "2024-01-02 03:04:05", "n"), ("", None, "m")]
    df = spark.createDataFrame(data, "created_date STRING, RunTime STRING, name STRING")
    day = dt.datetime(2024, 1, 2)
    assert rows(cl.standardize_dates(df)) == [
        (day, dt.datetime(2024, 1, 3), "2024-01-02"),
        (None, dt.datetime(2024, 1, 2, 3, 4, 5), "n"),
        (None, None, "m"),
    ]
    typed = spark.createDataFrame([(dt.date(2024, 1, 2),)], "a_date DATE")
    assert cl.standardize_dates(typed).schema == typed.schema


def test_gaps_fill_forward_then_backward(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, None), (4, 7), (5, None)], "t INT, v INT")
    assert sorted(rows(cl.handle_missing_values(df, ["t"]))) == [(1, 5), (2, 5), (3, 5), (4, 7), (5, 7)]
    empty = spark.createDataFrame([(1, None), (2, None)], "t INT, v INT")
    assert sorted(rows(cl.handle_missing_values(empty, ["t"]))) == [(1, None), (2, None)]


def test_null_counts_and_report(spark):
    df = spark.createDataFrame([(1.0, "a"), (1.0, "a"), (NAN, None), (None, "b")], "x DOUBLE, s STRING")
    assert rows(cl.null_counts(df)) == [("x", 2), ("s", 1)]
    assert sorted(rows(cl.cleaning_report(df))) == [(4, 3, 1, "s", 1, "empty"), (4, 3, 1, "x", 2, "median")]
    none = df.limit(0)
    assert sorted(rows(cl.cleaning_report(none))) == [(0, 0, 0, "s", 0, "none"), (0, 0, 0, "x", 0, "none")]


def test_clean(spark):
    df = spark.createDataFrame([(1, "5", None), (1, "5", None), (2, "x", "s"), (None, None, "t")], "n INT, c STRING, s STRING")
    out = sorted(rows(cl.clean(df, {"c": "int"})))
    assert out == sorted([(1.0, 5, ""), (2.0, None, "s"), (1.5, None, "t")])


def test_transformations_skip_what_fails(spark):
    chain = Transformations().register("add", lambda df: df.withColumn("y", F.col("x") + 1))
    chain.register("bad", lambda df: df.select("nope")).register("raises", lambda df: 1 / 0)
    out, steps = chain.apply(spark.createDataFrame([(1,)], "x INT"))
    assert rows(out) == [(1, 2)]
    assert [(s.name, s.status) for s in steps] == [("add", "applied"), ("bad", "failed"), ("raises", "failed")]
    _, steps = chain.apply(out, ["missing", "add"])
    assert [s.status for s in steps] == ["unknown", "applied"]


def test_process_counts_rows_per_step(spark):
    df = spark.createDataFrame([(1, "A"), (1, "A"), (2, " B "), (300, "C")], "n INT, s STRING")
    rules = RuleSet().add_range_rule("n", 0, 100)
    chain = Transformations().register("norm", cl.normalize_text)
    result = process(df, rules=rules, transformations=chain, drop_invalid=True)
    assert sorted(rows(result.data)) == [(1, "a"), (2, "b")]
    assert result.steps == ["clean", "validate", "transform"]
    assert result.row_counts() == {"clean": 3, "validate": 2, "transform": 2}
    assert rows(result.invalid, "n") == [(300,)]
    kept = process(df, rules=rules)
    assert kept.data.count() == 3 and "violations" in kept.data.columns



@pytest.mark.parametrize("columns", [["s"], None])
def test_normalize_columns(spark, columns):
    df = spark.createDataFrame([(" A ", 1)], "s STRING, n INT")
    assert rows(cl.normalize_text(df, columns)) == [("a", 1)]


def test_duplicates_with_maps_at_any_depth(spark):
    kinds = "id INT, m MAP<STRING,INT>, s STRUCT<a: ARRAY<MAP<STRING,INT>>>"
    data = [(1, {"a": 1, "b": 2}, ([{"x": 1}],)), (1, {"b": 2, "a": 1}, ([{"x": 1}],)), (1, {"a": 1}, ([{"x": 1}],)), (1, None, None), (1, None, None)]
    df = spark.createDataFrame(data, kinds)
    assert cl.drop_duplicate_rows(df).count() == 3
    assert cl.deduplicate_rows(df.withColumn("created_at", F.monotonically_increasing_id()), ["created_at"]).count() == 3

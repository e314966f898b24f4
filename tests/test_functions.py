import pytest
from pyspark.sql import functions as F

from flowkit.functions import dates, text
from flowkit.operators import flatten
from flowkit.sources import sinks


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_strip_covers_unicode_whitespace(spark):
    rows = [("\tA b \n",), (" x ",), ("",), ("  ",), (None,)]
    assert values(spark, rows, "s STRING", text.normalized(F.col("s"))) == ["a b", "x", "", "", None]


def test_identifiers(spark):
    rows = [("a_b-c.d",), ("",), (None,), ("a b",), ("a\n",), ("x;drop",)]
    assert values(spark, rows, "s STRING", text.is_identifier(F.col("s"))) == [True] + [False] * 5
    assert text.require_identifier("t_1.x") == "t_1.x"
    for bad in ("", "a b", "a\n", "x;y"):
        with pytest.raises(ValueError):
            text.require_identifier(bad)


def test_array_literals(spark):
    rows = [(["a", 'q"x', "b\\c", None],), ([],), (None,)]
    literals = values(spark, rows, "a ARRAY<STRING>", text.array_literal(F.col("a")))
    assert literals == ['{"a","q\\"x","b\\\\c",NULL}', "{}", "{}"]


def test_patterns_match_from_the_start(spark):
    rows = [("ab1",), ("xab1",), (None,)]
    assert values(spark, rows, "s STRING", text.matches_at_start(F.col("s"), "ab|zz")) == [True, False, None]
    assert values(spark, rows, "s STRING", text.matches_at_start(F.col("s"), r"(?P<x>a)b\d\Z")) == [True, False, None]


def test_log_masking(spark):
    rows = [("""{"password": "p1", "private_key":"k", 'client_email':  'e', "user": "u"}""",)]
    masked = values(spark, rows, "s STRING", text.mask_log_text(F.col("s")))
    assert masked == ["""{"password": "****", "private_key": "****", 'client_email': '****', "user": "u"}"""]


def test_integer_dates(spark):
    rows = [(20240229,), (18000101,), (18000102,), (20241399,), (20240230,), (None,)]
    found = values(spark, rows, "d INT", dates.int_to_date(F.col("d")).cast("string"))
    assert found == ["2024-02-29", None, "1800-01-02", None, None, None]
    in_year = values(spark, rows, "d INT", dates.int_date_in_year(F.col("d"), 2024))
    assert in_year == [True, False, False, False, False, False]


def test_timestamps_in_several_formats(spark):
    texts = ["2024-01-02", "20240102", "2024/01/02", "2024-01-02T03:04:05.25", " 2024-01-02 03:04:05 ", "2024-13-02", "1/2/24"]
    found = values(spark, [(t,) for t in texts], "s STRING", dates.parse_timestamp(F.col("s")).cast("string"))
    day, moment = "2024-01-02 00:00:00", "2024-01-02 03:04:05"
    assert found == [day, day, day, f"{moment}.25", moment, None, None]
    loose = dates.parse_timestamp(F.col("s"), ["d/M/yy", "dd MMM yyyy"]).cast("string")
    assert values(spark, [("1/2/24",), ("02 Jan 2024",)], "s STRING", loose) == ["2024-02-01 00:00:00", day]


NESTED = [
    # number, title, filing, inventors, codes
    ("second", [("eins", "de"), ("one", "en"), ("two", "en")], 20200102, [("A",), (None,), ("B",)],
     [("c1",), ("c2",), ("c1",), (None,), ("c3",), ("c4",), ("c5",), ("c6",)]),
    ("none", [("eins", "de")], 20200103, [], []),
    ("empty", [], 20200102, None, None),
    ("null", None, 20190101, [(None,)], [("x",)]),
    ("early", None, 18000101, None, None),
    ("no_day", None, 20200230, None, None),
    ("undated", None, None, None, None),
]


def nested(spark):
    schema = (
        "publication_number STRING, title_localized ARRAY<STRUCT<text: STRING, language: STRING>>, filing_date INT, "
        "inventor_harmonized ARRAY<STRUCT<name: STRING>>, cpc ARRAY<STRUCT<code: STRING>>"
    )
    df = spark.createDataFrame(NESTED, schema)
    have = {f.name for f in df.schema}
    return df.select(
        *[F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in flatten.NESTED_SCHEMA]
    )


def test_flatten(spark):
    flat = {r["publication_number"]: r for r in flatten.flatten(nested(spark)).collect()}
    assert set(flat) == {"second", "none", "empty", "null", "no_day"}
    assert [flat[k]["title_english"] for k in ("second", "none", "empty", "null")] == ["one", "eins", "", ""]
    assert [flat[k]["inventor_count"] for k in ("second", "none", "empty")] == [3, 0, None]
    assert [flat[k]["inventor_names"] for k in ("second", "none", "empty", "null")] == [["A", "B"], [], [], []]
    assert flat["second"]["cpc_codes"] == ["c1", "c2", "c3", "c4", "c5"] and flat["empty"]["cpc_codes"] == []
    assert flat["no_day"]["filing_date"] is None and flat["second"]["citation_count"] is None


def test_flatten_order_limit_and_filters(spark):
    def numbers(**kwargs):
        return [r["publication_number"] for r in flatten.flatten(nested(spark), **kwargs).collect()]

    import datetime as dt

    assert numbers() == ["none", "empty", "second", "null", "no_day"]
    assert numbers(limit=2) == ["none", "empty"]
    assert numbers(year=2020) == ["none", "empty", "second"]
    assert numbers(recent_days=1, as_of=dt.date(2020, 1, 4)) == ["none"]


def test_conform_to_targets(spark):
    flat = flatten.flatten(nested(spark), ordered=False).withColumnRenamed("title_english", "title")
    rows = sinks.conform_to_schema(sinks.stamp_loaded_at(flat), sinks.ENHANCED_TARGET)
    assert rows.columns == sinks.ENHANCED_TARGET.names
    second = rows.where("publication_number = 'second'").first()
    assert second["cpc_codes"] == '["c1","c2","c3","c4","c5"]' and second["grant_date"] is None
    assert second["loaded_at"] is not None
    assert sinks.conform_to_schema(flat, sinks.SIMPLE_TARGET).columns == sinks.SIMPLE_TARGET.names
    full = sinks.conform_to_schema(flatten.flatten(nested(spark)), sinks.FLATTENED_TARGET)
    assert full.columns == sinks.FLATTENED_TARGET.names


def test_oversized_text(spark):
    df = spark.createDataFrame([("a" * 11,), ("a" * 10,), (None,)], "country_code STRING")
    schema = sinks.T.StructType([f for f in sinks.SIMPLE_TARGET if f.name == "country_code"])
    assert [r[0] for r in df.select(sinks.is_oversized(schema)).collect()] == [True, False, False]

"""Physical plans: what must hold whatever the size of the data."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from flowkit.catalogue.registry import QUERIES, gappy_orders, table

from flowkit.operators import checks, clean, flatten
from flowkit.operators.rules import annotate
from flowkit.catalogue.checking import order_rules
from flowkit.catalogue.flattening import nested_records
from flowkit.plans.staging import SETTING




def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text):
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<(.*?)>", text)]


LAZY = sorted(set(QUERIES) - {n for n in QUERIES if n.startswith("stream")} - {"circuit_states", "migration_job"})


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_row_scale_single_task(spark, small_dir, name):
    text = plan(QUERIES[name](spark, small_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # A single partition may only collect partial aggregates, a top-n, or the few rows that carry buckets over.
    for after in re.findall(r"Exchange SinglePartition.*\n(.*)", text):
        assert re.search(r"HashAggregate|ObjectHashAggregate|SortAggregate|LocalLimit|MapInPandas|MapInArrow", after), after


def test_filters_and_columns_reach_the_scan(spark, small_dir):
    text = plan(QUERIES["where_limit_source"](spark, small_dir))
    assert "PushedFilters: [IsNotNull(o_totalprice), IsNotNull(o_orderstatus), GreaterThan(o_totalprice,400000.0)" in text
    assert scans(plan(QUERIES["order_quality_by_status"](spark, small_dir))) == [
        {"o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"}
    ]
    assert scans(plan(QUERIES["check_ranges"](spark, small_dir))) == [{"l_quantity", "l_discount", "l_tax"}]


def test_date_filters_are_ranges_on_the_stored_integer(spark, small_dir, tmp_path):
    path = str(tmp_path / "nested")
    nested_records(spark, small_dir).drop("citation").withColumn("citation", F.array()).write.parquet(path)
    text = plan(flatten.flatten(spark.read.parquet(path), year=2003, recent_days=10))
    assert "GreaterThan(filing_date,18000101)" in text
    assert "GreaterThanOrEqual(filing_date,20030101), LessThanOrEqual(filing_date,20031231)" in text
    assert "Generate" not in text and "Join" not in text


@pytest.mark.parametrize(
    ("name", "arrays"), [("flatten_recent", 5), ("flatten_nested", 5), ("flatten_year_newest", 5), ("conform_schema", 3)]
)
def test_flattening_stores_no_copy_of_its_input(spark, tmp_path, name, arrays):
    rows = [(i, f"Line {i}, part. Next sentence\nof, text", "en", "web", 13 + i % 2 * 12) for i in range(400)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    shared = Path(spark.conf.get(SETTING))
    before = set(shared.rglob("*"))
    flat = QUERIES[name](spark, str(tmp_path))
    text = plan(flat)
    assert flat.collect()
    assert set(shared.rglob("*")) == before
    # Rows are filtered before their arrays are made, and each array is made once.
    assert text.count("FileScan") == 1 and text.count("split(") == arrays
    assert text.rindex("split(") < text.index("Filter ")


def test_derived_records_have_the_nested_schema(spark, small_dir):
    types = {f.name: f.dataType.simpleString() for f in nested_records(spark, small_dir).schema}
    assert types == {f.name: f.dataType.simpleString() for f in flatten.NESTED_SCHEMA}


def test_one_pass_over_the_table(spark, small_dir):
    rows = gappy_orders(spark, small_dir)
    wide = checks.check_all(rows, ranges={"price": (0, 1)}, patterns={"priority": "1"})
    assert plan(wide).count("FileScan") == 1
    annotated = annotate(rows, order_rules())
    assert plan(annotated).count("FileScan") == 1 and "Exchange" not in plan(annotated)
    assert "Python" not in plan(annotated)


def test_python_rule_runs_once(spark, small_dir):
    assert plan(QUERIES["custom_rules"](spark, small_dir)).count("ArrowEvalPython") == 1


def test_first_per_key_is_limited_before_the_shuffle(spark, small_dir):
    lines = table(spark, small_dir, "lineitem")
    text = plan(clean.keep_first(lines, ["l_partkey"], ["l_orderkey", "l_linenumber"]))
    assert re.search(r"WindowGroupLimit.*Final[\s\S]*Exchange hashpartitioning[\s\S]*WindowGroupLimit.*Partial", text)


def test_hot_keys_meet_broadcast_facts(spark, small_dir):
    text = plan(QUERIES["unique_rule"](spark, small_dir))
    assert text.count("BroadcastHashJoin") >= 1 and "partial_count" in text

import random

import pytest
from pyspark.sql import functions as F

from flowkit.functions.schema import INT, TEXT, schema
from flowkit.plans.staging import children, remove
from flowkit.sources.keyed import BUCKET, DONE, KeyedTarget

FIELDS = schema(k=INT, s=TEXT, t=INT)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def inserted(known, new):
    """The rows that an insert adds, in plain Python: the first per key in the order of t."""
    seen, out = {(k, s) for k, s, _ in known}, []
    for row in sorted(new, key=lambda r: r[2]):
        if row[:2] not in seen:
            seen.add(row[:2])
            out.append(row)
    return out


@pytest.fixture
def target(tmp_path):
    return KeyedTarget(str(tmp_path / "t"), ("k", "s"), buckets=4, keys_per_bucket=100)


def test_runs_equal_plain_python(spark, target):
    turns, known = random.Random(1), []
    for run in range(4):
        keys = [(turns.choice([None, *range(60)]), turns.choice([None, "", "x", "y"])) for _ in range(150)]
        new = [(*key, 1_000 * run + i) for i, key in enumerate(keys)]
        assert target.insert(spark.createDataFrame(new, FIELDS), f"r{run}", ["t"])
        known += inserted(known, new)
        assert rows_of(target.rows(spark, FIELDS)) == sorted(known, key=str)
    assert target.runs(spark) == ["r0", "r1", "r2", "r3"]


def test_a_repeat_changes_nothing(spark, target, tmp_path):
    a = spark.createDataFrame([(1, "x", 5), (1, "x", 4), (2, "x", 0)], FIELDS)
    b = spark.createDataFrame([(1, "x", 0), (3, "x", 0)], FIELDS)
    target.insert(a, "a", ["t"])
    target.insert(b, "b", ["t"])
    files = {f: sorted(children(spark, f"{target.path}/rows/insert=a/{f}")) for f in children(spark, f"{target.path}/rows/insert=a")}
    assert not target.insert(a, "a", ["t"]) and not target.insert(b.limit(0), "b", ["t"])
    assert files == {f: sorted(children(spark, f"{target.path}/rows/insert=a/{f}")) for f in files}
    assert rows_of(target.rows(spark, FIELDS)) == [(1, "x", 4), (2, "x", 0), (3, "x", 0)]


@pytest.mark.parametrize("stage", ["rows", "filters"])
def test_a_run_that_stopped_half_way_is_written_anew(spark, target, stage):
    a = spark.createDataFrame([(1, "x", 5), (2, "x", 0)], FIELDS)
    target.insert(a, "a", ["t"])
    # As a job leaves it that dies before its commit, or between the two writes.
    remove(spark, f"{target.path}/filters/insert=a" + (f"/{DONE}" if stage == "filters" else ""))
    assert target.runs(spark) == [] and target.rows(spark, FIELDS).count() == 0
    target.insert(spark.createDataFrame([(2, "x", 9)], FIELDS), "b", ["t"])
    assert target.insert(a, "a", ["t"])
    assert rows_of(target.rows(spark, FIELDS)) == [(1, "x", 5), (2, "x", 9)]


def test_only_buckets_that_may_hold_a_new_key_are_read(spark, tmp_path):
    target = KeyedTarget(str(tmp_path / "t"), ("id",), buckets=16, keys_per_bucket=1_000)
    rows = spark.range(8_000)
    target.insert(rows, "a", ["id"])
    new = target.placed(spark.createDataFrame([(3,), (10**9,), (10**9 + 7,)], "id long"))
    known = target.known_keys(new, ["a"])
    assert [r["id"] for r in known.collect()] == [3]
    plan = known._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "PartitionFilters" in line and BUCKET in line]
    assert any(f"{BUCKET}" in s and (" IN (" in s or "INSET" in s or f"({BUCKET}" in s.replace("#", "")) for s in scans) or "PartitionFilters: [isnotnull(key_bucket" in plan
    read = target.read(spark, rows.schema, ["a"]).where(F.col(BUCKET).isin([r[0] for r in new.where("id = 3").select(BUCKET).collect()]))
    assert 0 < len(read.inputFiles()) <= 16 and read.count() < 1_000
    # Absent keys seldom pass the filters, so most of them cost no look-up.
    absent = target.placed(spark.range(10**6, 10**6 + 20_000))
    assert target._maybe_known(absent, ["a"]).count() < 20_000 * 0.05
    assert target._maybe_known(target.placed(rows), ["a"]).count() == 8_000


def test_refusals(spark, target, tmp_path):
    target.insert(spark.createDataFrame([(1, "x", 5)], FIELDS), "a", ["t"])
    with pytest.raises(ValueError, match="laid out"):
        KeyedTarget(target.path, ("k",), 4, 100).insert(spark.createDataFrame([(1, "x", 5)], FIELDS), "b", ["t"])
    with pytest.raises(ValueError, match="column"):
        target.insert(spark.createDataFrame([(1, "x", 5)], FIELDS).withColumn(BUCKET, F.lit(1)), "c", ["t"])
    with pytest.raises(ValueError, match="key"):
        KeyedTarget(str(tmp_path), ())


def test_an_empty_insert(spark, target):
    target.insert(spark.createDataFrame([], FIELDS), "a", ["t"])
    assert target.rows(spark, FIELDS).count() == 0 and target.runs(spark) == ["a"]
    target.insert(spark.createDataFrame([(1, None, 5)], FIELDS), "b", ["t"])
    assert rows_of(target.rows(spark, FIELDS)) == [(1, None, 5)]

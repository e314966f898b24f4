"""Staged, ordered, skew-safe and median building blocks against plain Python."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from flowkit.plans import ordered, skew, staging
from flowkit.plans.medians import exact_medians


def skewed_rows(seed, n=400):
    """Rows (id, k, t, v) in which one key holds over a third of them, and order values repeat."""
    r = random.Random(seed)
    return [
        (i, None if r.random() < 0.1 else ("hot" if r.random() < 0.4 else f"k{r.randrange(20)}"),
         r.randrange(60), None if r.random() < 0.6 else r.randrange(1000))
        for i in range(n)
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id INT, k STRING, t INT, v INT").repartition(5)


def in_order(rows, keyed):
    groups = {}
    for row in sorted(rows, key=lambda r: (r[2], r[0])):
        groups.setdefault(row[1] if keyed else 0, []).append(row)
    return groups.values()


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("keyed", [True, False])
def test_running_sum_and_index(spark, seed, keyed):
    rows = skewed_rows(seed)
    keys = ["k"] if keyed else []
    out = ordered.running_sums(frame(spark, rows), {"s": F.coalesce("v", F.lit(0))}, ["t", "id"], keys, buckets=7)
    index = ordered.with_row_index(frame(spark, rows), ["t", "id"], keys, buckets=7)
    sums, positions = {}, {}
    for group in in_order(rows, keyed):
        total = 0
        for position, row in enumerate(group):
            total += row[3] or 0
            sums[row[0]], positions[row[0]] = total, position
    assert {r["id"]: r["s"] for r in out.collect()} == sums
    assert {r["id"]: r["row_index"] for r in index.collect()} == positions


@pytest.mark.parametrize("seed", [3, 4])
@pytest.mark.parametrize("keyed", [True, False])
def test_fill_both_ways(spark, seed, keyed):
    rows = skewed_rows(seed)
    filled = ordered.fill_along(frame(spark, rows), ["v"], ["t", "id"], ["k"] if keyed else [], buckets=9)
    expected = {}
    for group in in_order(rows, keyed):
        known = [r[3] for r in group]
        forward = []
        for v in known:
            forward.append(v if v is not None else (forward[-1] if forward else None))
        first = next((v for v in known if v is not None), None)
        expected |= {r[0]: first if f is None else f for r, f in zip(group, forward, strict=True)}
    assert {r["id"]: r["v"] for r in filled.collect()} == expected


def test_buckets_are_balanced_and_carry_is_small(spark):
    rows = [(i, "hot", 1, i) for i in range(1000)]
    staged = ordered.stage_in_order(frame(spark, rows), ["t", "id"], ["k"], buckets=10)
    sizes = [r["count"] for r in staged.groupBy(ordered.BUCKET).count().collect()]
    assert len(sizes) == 10 and max(sizes) < 300


@pytest.mark.parametrize("share", [0.2, 0.001, 1.0])
def test_duplicates_flagged_with_hot_and_cold_keys(spark, share):
    rows = skewed_rows(5)
    seen = [r[1] for r in rows]
    out = skew.flag_duplicates(frame(spark, rows), ["k"], hot_share=share).collect()
    assert {r["id"]: r["is_duplicate"] for r in out} == {r[0]: seen.count(r[1]) > 1 for r in rows}


@pytest.mark.parametrize("share", [0.2, 0.001])
def test_orphans_flagged(spark, share):
    rows = skewed_rows(6)
    parent = spark.createDataFrame([("k1",), ("k2",), ("k2",), (None,)], "p STRING")
    out = skew.flag_orphans(frame(spark, rows), "k", parent, "p", hot_share=share).collect()
    expected = {r[0]: r[1] is not None and r[1] not in ("k1", "k2") for r in rows}
    assert {r["id"]: r["is_orphan"] for r in out} == expected


@pytest.mark.parametrize("ranked,accuracy", [(5, 50), (50, 100), (10**6, 10000)])
def test_exact_medians(spark, ranked, accuracy):
    r = random.Random(7)
    spread = [r.gauss(0, 1000) for _ in range(3001)]
    hot = [5.0 if r.random() < 0.7 else r.random() for _ in range(3001)]
    two = [r.choice([1.0, 2.0]) for _ in range(3000)] + [None]
    rows = list(zip(spread, hot, two, [None] * 3001, strict=True))
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE")
    found = exact_medians(df, ["a", "b", "c", "d"], ranked, accuracy)
    assert found == {
        "a": statistics.median(spread),
        "b": statistics.median(hot),
        "c": statistics.median(two[:-1]),
        "d": None,
    }


def test_median_skips_nan(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,), (4.0,)], "x DOUBLE")
    assert exact_medians(df, ["x"]) == {"x": 2.0}


def test_staging_uses_the_configured_folder(spark):
    staged = staging.stage(spark.range(10), "numbers")
    assert staged.count() == 10
    assert spark.conf.get("spark.checkpoint.dir") in staged.inputFiles()[0]


def test_index_is_one_shuffle(spark):
    df = spark.range(0, 5_000, 1, 7).selectExpr("(id * 7919) % 5003 AS k", "id")
    indexed = ordered.with_row_index(df, ["k"], buckets=5)
    expected = {k: i for i, k in enumerate(sorted(r["k"] for r in df.collect()))}
    assert {r["k"]: r["row_index"] for r in indexed.collect()} == expected
    plan = indexed._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(k" not in plan and "SortMergeJoin" not in plan


def test_nothing_stays_behind(spark):
    ordered.with_row_index(spark.range(10), ["id"]).count()
    staging.clear_staged(spark)
    assert not staging.exists(spark, f"{staging.scratch_root(spark)}/flowkit/{spark.sparkContext.applicationId}")

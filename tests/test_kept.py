import random
import statistics

import pytest
from pyspark.sql import functions as F

from flowkit.operators.batches import cut_by_bytes
from flowkit.operators.subsets import KeptSubset
from flowkit.plans import kept_medians
from flowkit.plans.kept_medians import KeptMedians, fill_medians
from flowkit.plans.staging import remove

NAN = float("nan")


def parts(turns, count, size):
    for _ in range(count):
        scale = turns.choice([1, 1_000])
        yield [(turns.choice([None, NAN, float(turns.randint(0, 20) * scale), turns.gauss(0, 1) * scale]), turns.choice([None, 1, 2]), None) for _ in range(size)]


def test_medians_over_parts_equal_plain_python(spark, tmp_path):
    turns = random.Random(4)
    kept, known = KeptMedians(str(tmp_path / "m"), ("x", "k", "none")), []
    assert kept.medians(spark) == {"x": None, "k": None, "none": None}
    for i, rows in enumerate(parts(turns, 3, 400)):
        source = str(tmp_path / f"in{i}")
        spark.createDataFrame(rows, "x double, k int, none int").write.parquet(source)
        assert kept.add(spark.read.parquet(source), f"p{i}")
        remove(spark, source)  # a part is read once
        known += rows
        medians = kept.medians(spark)
        for j, c in enumerate(("x", "k")):
            values = [r[j] for r in known if r[j] is not None and r[j] == r[j]]
            assert medians[c] == pytest.approx(statistics.median(values))
        assert medians["none"] is None
    filled = fill_medians(spark.createDataFrame(known, "x double, k int, none int"), medians)
    assert filled.where("x IS NULL OR isnan(x) OR k IS NULL").count() == 0 and filled.where("none IS NOT NULL").count() == 0


def test_a_part_counts_once_and_a_stopped_one_is_made_anew(spark, tmp_path):
    kept = KeptMedians(str(tmp_path / "m"), ("x",))
    a, b = (spark.createDataFrame([(float(v),) for v in values], "x double") for values in ([1, 2, 3, 4], [100, 101, 102]))
    kept.add(a, "a")
    assert not kept.add(a, "a") and kept.medians(spark) == {"x": 2.5}
    kept.add(b, "b")
    assert kept.medians(spark) == {"x": 4.0}
    remove(spark, f"{kept.path}/sketches/part=b/_SUCCESS")
    assert kept.parts(spark) == ["a"] and kept.medians(spark) == {"x": 2.5}
    assert kept.add(b, "b") and kept.medians(spark) == {"x": 4.0}


def test_a_bracket_that_misses_is_widened(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(kept_medians, "SPREAD", 1e-9)
    monkeypatch.setattr(kept_medians, "SKETCH_SIZE", 8)
    kept = KeptMedians(str(tmp_path / "m"), ("id",))
    kept.add(spark.range(0, 5_001), "a")
    kept.add(spark.range(20_000, 25_000), "b")
    assert kept.medians(spark) == {"id": 5_000.0}


COLUMNS = "k int, v int, at int, gone boolean"


def test_subset_equals_the_plain_filter_after_ten_batches(spark, tmp_path):
    turns = random.Random(7)
    fields = spark.createDataFrame([], "k int, v int").schema
    kept = KeptSubset(str(tmp_path / "s"), fields, ("k",), "v > 5")
    state, ops = {}, 0
    for batch in range(10):
        rows = [(turns.choice([None, *range(40)]), turns.choice([None, *range(12)]), at, turns.random() < 0.1) for at in range(30)]
        before = {k: v for k, v in state.items() if v is not None and v > 5}
        for k, v, _, gone in rows:
            state[k] = None if gone else v
        frame = spark.createDataFrame(rows, COLUMNS)
        for _ in range(2):  # applied again, it replaces its changes
            kept.apply(frame, batch, ["at"], deleted=F.col("gone"))
        now = {k: v for k, v in state.items() if v is not None and v > 5}
        assert {r["k"]: r["v"] for r in kept.read(spark).collect()} == now
        told = {r["k"]: r["op"] for r in kept.changes(spark, batch - 1).collect()}
        expected = {k: "in" for k in now.keys() - before.keys()} | {k: "out" for k in before.keys() - now.keys()}
        assert told == expected | {k: "changed" for k in now.keys() & before.keys() if now[k] != before[k]}
        ops += len(told)
        if batch == 4:
            kept.compact(spark)
            assert {r["k"]: r["v"] for r in kept.read(spark).collect()} == now
    assert ops > 50
    with pytest.raises(ValueError, match="base"):
        kept.apply(frame, 4, ["at"])


def test_an_empty_subset(spark, tmp_path):
    kept = KeptSubset(str(tmp_path / "s"), spark.createDataFrame([], "k int, v int").schema, ("k",), "v > 5")
    kept.compact(spark)
    assert kept.read(spark).count() == 0
    kept.apply(spark.createDataFrame([], COLUMNS), 0, ["at"])
    assert kept.read(spark).count() == 0 and kept.changes(spark).count() == 0


@pytest.mark.parametrize("budget", [60, 1_000, 10**9])
def test_no_chunk_passes_the_budget(spark, budget):
    turns = random.Random(budget)
    rows = [(i, "x" * turns.choice([0, 1, 5, 20, 49, 52, 900, 990]) if turns.random() < 0.9 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, t string").repartition(5)
    found = cut_by_bytes(df, budget, ["id"]).orderBy("id").collect()
    assert [r["id"] for r in found] == list(range(400))
    numbers, sizes = [r["chunk_id"] for r in found], {}
    assert numbers == sorted(numbers)
    for r in found:
        sizes.setdefault(r["chunk_id"], []).append(8 + len(r["t"] or ""))
    assert all(sum(s) <= budget or len(s) == 1 for s in sizes.values())
    total = sum(map(sum, sizes.values()))
    assert len(sizes) <= 4 * total / budget + 2 if budget > 1_000 or budget == 1_000 else len(sizes) <= 400
    assert cut_by_bytes(df.limit(0), budget, ["id"]).count() == 0

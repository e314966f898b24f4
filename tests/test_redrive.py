import datetime as dt

import pytest
from pyspark.sql import functions as F

from flowkit.functions.schema import INT, LONG, schema
from flowkit.operators.redrive import Redrive
from flowkit.plans.staging import remove

FIELDS = schema(id=LONG, v=INT)
START = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)


def at(hours):
    return F.lit(START + dt.timedelta(hours=hours))


def queue(spark, n=40):
    rows = []
    for i in range(n):
        record = "not json" if i == 7 else f'{{"id": {i}, "v": {i % 5}}}'
        rows.append((START, "load", "bad value" if i % 10 == 3 else "timed out", i % 2, record))
    return spark.createDataFrame(rows, "ts timestamp, source string, error string, retry_count int, record string")


def check(rows):
    passed = F.col("v") <= F.col("retry_count") + 1
    return rows.withColumns({"is_valid": passed, "violations": F.array(F.struct(F.lit("connection lost").alias("message")))})


def places(drive, spark):
    """Where each record stands; fails if one stands in two places."""
    found = [(r["id"], "loaded") for r in drive.loaded(spark).collect()]
    for name, rows in (("open", drive.open(spark)), ("parked", drive.parked(spark))):
        for r in rows.collect():
            found.append((7 if r["record"] == "not json" else int(r["record"].split()[1].strip(",")), name))
    assert len({i for i, _ in found}) == len(found)
    return dict(found)


@pytest.fixture
def drive(tmp_path):
    return Redrive(str(tmp_path / "drive"), FIELDS, initial=600, longest=3600, jitter=False)


def expected(n=40):
    """Loaded at the first attempt r in retry_count..2 with v <= r + 1, else parked."""
    out = {}
    for i in range(n):
        tries = range(i % 2, 3)
        fits = i % 10 != 3 and i != 7 and any(i % 5 <= r + 1 for r in tries)
        out[i] = "loaded" if fits else "parked"
    return out


def test_every_record_is_loaded_or_parked(spark, drive):
    drive.admit(queue(spark))
    assert sum(p == "open" for p in places(drive, spark).values()) == 36
    for hour in (2, 4, 6, 8):
        drive.run(spark, check, at(hour))
        assert len(places(drive, spark)) == 40
    assert places(drive, spark) == expected()
    parked = {r["record"]: r for r in drive.parked(spark).collect()}
    assert parked["not json"]["error"] == "unreadable record"
    assert parked['{"id": 4, "v": 4}']["retry_count"] == 3 and parked['{"id": 4, "v": 4}']["error"] == "connection lost"
    assert parked['{"id": 13, "v": 3}']["retry_count"] == 1


def test_only_due_records_are_tried(spark, drive):
    drive.admit(queue(spark))
    drive.run(spark, check, at(0.1))
    assert set(places(drive, spark).values()) == {"open", "parked"}
    drive.run(spark, check, at(0.2))  # ten minutes after the first failure, twenty after the second
    now = places(drive, spark)
    assert {i for i, p in now.items() if p == "loaded"} == {i for i in range(40) if i % 2 == 0 and i % 5 <= 1}


@pytest.mark.parametrize("kill", ["before", "while writing", "after"])
def test_a_crash_leaves_each_record_in_one_place(spark, drive, kill):
    drive.admit(queue(spark))
    drive.run(spark, check, at(2))
    before = places(drive, spark)
    if kill == "while writing":
        # What a job leaves that dies after some of its files and before its commit.
        drive.run(spark, check, at(4))
        remove(spark, f"{drive.path}/round=2/_SUCCESS")
        assert places(drive, spark) == before
    elif kill == "after":
        drive.run(spark, check, at(4))
        assert places(drive, spark) != before
    for hour in (4, 6, 8):
        drive.run(spark, check, at(hour))
    assert places(drive, spark) == expected()


def test_a_check_that_fails_as_a_whole_counts_as_an_attempt(spark, drive):
    def broken(rows):
        return rows.select("no_such_column")

    drive.admit(queue(spark))
    drive.run(spark, broken, at(2))
    assert set(places(drive, spark).values()) == {"parked"}  # a missing column does not go away
    assert "no_such_column" in drive.parked(spark).where("error LIKE '%no_such_column%'").first()["error"]

    other = Redrive(drive.path + "2", FIELDS, initial=600, longest=3600, jitter=False)

    def down(rows):
        raise ConnectionError("connection refused")

    other.admit(queue(spark))
    other.run(spark, down, at(2))
    tries = {r["record"]: r["retry_count"] for r in other.open(spark).collect()}
    assert tries['{"id": 0, "v": 0}'] == 1 and tries['{"id": 1, "v": 1}'] == 2
    for hour in (4, 6, 8):
        other.run(spark, check, at(hour))
    assert len(places(other, spark)) == 40 and "open" not in places(other, spark).values()


def test_later_arrivals_join_the_open_records(spark, drive):
    drive.admit(queue(spark, 10))
    more = queue(spark, 20).where(F.get_json_object("record", "$.id") >= 10)
    drive.admit(more)
    assert len(places(drive, spark)) == 20
    drive.admit(queue(spark, 0))
    assert len(places(drive, spark)) == 20


def test_nothing_admitted(spark, drive):
    assert drive.open(spark).count() == drive.loaded(spark).count() == drive.parked(spark).count() == 0
    drive.run(spark, check, at(1))
    assert drive.rounds(spark) == [0]

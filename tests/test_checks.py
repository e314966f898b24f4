import random
import re

import pytest
from pyspark.sql import functions as F

from flowkit.operators import checks, report
from flowkit.operators.batches import map_reduce
from flowkit.operators.rules import (
    Rule,
    RuleSet,
    RuleType,
    annotate,
    counts_by_rule,
    split,
    validity_counts,
    violation_rows,
)

NAN = float("nan")
SCHEMA = "k STRING, x DOUBLE, s STRING"


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_null_checks(spark):
    df = spark.createDataFrame([(None, NAN, "a"), (None, None, "a"), ("b", 1.0, None), (None, 2.0, "c")], SCHEMA)
    found = rows(checks.check_nulls(df, nullable=["k", "s"]))
    assert found == [
        ("null_values", "k", "high_null_percentage", 3, 75.0, "warning"),
        ("null_values", "x", "unexpected_nulls", 2, 50.0, "error"),
    ]


def test_duplicates_count_every_member(spark):
    keys = ["a"] * 3 + ["b"] * 2 + ["c"] + [None] * 2
    df = spark.createDataFrame([(k, 1.0, "s") for k in keys], SCHEMA)
    assert rows(checks.check_duplicates(df, ["k"])) == [("duplicates", "k", "duplicate_rows", 7, 87.5, "error")]
    assert rows(checks.check_duplicates(df, [])) == []
    assert rows(annotate(df, RuleSet().add_unique_rule("k")).agg(F.count_if(~F.col("is_valid")))) == [(7,)]


RANGES = [(0.0,), (10.0,), (-1.0,), (11.0,), (None,), (NAN,)]


def test_ranges(spark):
    df = spark.createDataFrame(RANGES, "x DOUBLE")
    found = rows(checks.check_ranges(df, {"x": (0, 10), "absent": (0, 1)}))
    assert [(r[1], r[3], r[5]) for r in found] == [("x", 2, "info")]
    assert rows(checks.check_ranges(df, {"x": (0, 10)}, strict=True))[0][5] == "error"
    assert rows(validity_counts(annotate(df, RuleSet().add_range_rule("x", 0, 10)))) == [(2, 4)]


def test_patterns(spark):
    df = spark.createDataFrame([("ab",), ("xab",), (None,)], "s STRING")
    assert [r[3] for r in rows(checks.check_patterns(df, {"s": "ab"}))] == [1]
    assert rows(validity_counts(annotate(df, RuleSet().add_pattern_rule("s", "ab")))) == [(1, 2)]


def test_types(spark):
    df = spark.createDataFrame([("a", 1.0, "s")], SCHEMA)
    found = rows(checks.check_types(df, {"x": "numeric", "k": "numeric", "absent": "string"}))
    assert [(r[1], r[2], r[5]) for r in found] == [
        ("k", "type_mismatch", "error"),
        ("absent", "missing_column", "info"),
    ]
    assert rows(checks.check_types(df, {"x": "string"}))[0][5] == "warning"


def test_all_checks_on_an_empty_frame(spark):
    df = spark.createDataFrame([], SCHEMA)
    issues = checks.check_all(df, keys=["k"], ranges={"x": (0, 1)}, patterns={"s": "a"}, types={"x": "numeric"})
    assert rows(issues) == []
    assert all(r["passed"] for r in checks.check_results(issues).collect())
    assert rows(checks.validation_summary(df, issues)) == [(0, 3, True)]
    annotated = annotate(df, RuleSet().add_not_null_rule("k"))
    assert rows(checks.dataset_score(annotated)) == [(0, 0, 100.0)]
    assert rows(validity_counts(annotated)) == [(0, 0)]


def test_all_checks_report_outcomes(spark):
    df = spark.createDataFrame([("a", 5.0, "q"), ("a", 50.0, None)], SCHEMA)
    issues = checks.check_all(df, nullable=["s"], keys=["k"], ranges={"x": (0, 10)})
    outcomes = {r["check"]: (r["passed"], r["issue_count"]) for r in checks.check_results(issues).collect()}
    assert outcomes == {
        "null_values": (True, 0),
        "duplicates": (False, 1),
        "data_types": (True, 0),
        "ranges": (True, 1),
        "string_patterns": (True, 0),
    }


def rule_set():
    return (
        RuleSet()
        .add_not_null_rule("k")
        .add_range_rule("x", 0, 10, severity="warning")
        .add_rule(Rule("absent_rule", RuleType.NOT_NULL, "absent", None, "never shown"))
    )


def test_messages_and_order(spark):
    df = spark.createDataFrame([(" ", 11.5, "s")], SCHEMA)
    found = annotate(df, rule_set().add_pattern_rule("k", "a+")).first()
    assert [v["message"] for v in found["violations"]] == [
        "Column 'k' cannot be null (value:  )",
        "Column 'k' does not match pattern 'a+' (value:  , pattern: a+)",
        "Column 'x' must be between 0 and 10 (value: 11.5, range: 0-10)",
        "Column 'absent' not found in row",
    ]
    assert not found["is_valid"]


def test_severity(spark):
    rules = RuleSet().add_range_rule("x", 0, 10, severity="warning").add_not_null_rule("k")
    df = spark.createDataFrame([("a", 99.0, "s"), (None, 1.0, "s"), ("a", 1.0, "s")], SCHEMA)
    assert rows(validity_counts(annotate(df, rules))) == [(1, 2)]
    assert rows(validity_counts(annotate(df, rules, ignore_warnings=True))) == [(2, 1)]


def test_registry():
    rules = rule_set().add_not_null_rule("x")
    assert [r.name for r in rules.get_all_rules()] == ["k_not_null", "x_range", "x_not_null", "absent_rule"]
    assert [r.severity for r in rules.get_rules_for_column("x")] == ["warning", "error"]
    assert rules.get_rules_for_column("zzz") == []


def test_custom_rules(spark):
    def positive(c):
        return c > 0

    def even(value):
        if value is None:
            raise ValueError("empty")
        return value % 2 == 0

    rules = RuleSet().add_custom_rule("x", positive, "not positive").add_python_rule("x", even, "odd")
    df = spark.createDataFrame([("a", 2.0, ""), ("b", -1.0, ""), ("c", None, "")], SCHEMA)
    found = {r["k"]: [v["message"] for v in r["violations"]] for r in annotate(df, rules).collect()}
    assert found == {"a": [], "b": ["not positive", "odd"], "c": ["not positive", "odd (error: empty)"]}


def test_no_rules_means_valid(spark):
    df = spark.createDataFrame([("a", 1.0, "s")], SCHEMA)
    assert annotate(df, RuleSet()).first()["is_valid"]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_split_keeps_every_row_once(spark, seed):
    r = random.Random(seed)
    data = [(r.choice(["a", "b", "", None]), r.choice([1.0, 20.0, NAN, None]), str(i)) for i in range(200)]
    parent = spark.createDataFrame([("a",)], "p STRING")
    rules = RuleSet().add_not_null_rule("k").add_range_rule("x", 0, 10).add_unique_rule("x")
    rules.add_referential_rule("k", parent, "p").add_unique_rule("s")
    annotated = annotate(spark.createDataFrame(data, SCHEMA), rules)
    valid, invalid = split(annotated)
    seen = [x["s"] for x in valid.collect()] + [x["s"] for x in invalid.collect()]
    assert sorted(seen, key=int) == [str(i) for i in range(200)]
    assert valid.columns == ["k", "x", "s"]
    per_rule = {x["rule"]: x["violations"] for x in counts_by_rule(annotated).collect()}
    assert per_rule["k_referential"] == sum(k is not None and k != "a" for k, _, _ in data)
    assert per_rule["k_not_null"] == sum(not (k or "").strip() for k, _, _ in data)
    assert "s_unique" not in per_rule
    assert violation_rows(annotated, "s").count() == sum(per_rule.values())


def test_history_score_and_report(spark, tmp_path):
    history = report.record_check(spark, "a", False, 100, 90, 10, ["x"]).unionByName(
        report.record_check(spark, "b", False, 300, 150, 150)
    )
    assert rows(report.quality_score(history)) == [(60.0,)]
    assert rows(report.quality_report(history)) == [(60.0, 2, 0, 2, 400, 240, 160)]
    empty = history.limit(0)
    assert rows(report.quality_score(empty)) == [(100.0,)]
    assert rows(report.quality_report(empty)) == [(100.0, 0, 0, 0, 0, 0, 0)]
    assert report.record_check(spark, "none", True, 0, 0, 0).first()["valid_percentage"] == 0.0
    report.export_report_csv(history, str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert tuple(back.columns) == report.CSV_COLUMNS
    assert sorted(r["valid_percentage"] for r in back.collect()) == ["50.00%", "90.00%"]
    report.export_report_json(history, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json/checks")).count() == 2
    assert spark.read.json(str(tmp_path / "json/totals")).first()["total_checks"] == 2


@pytest.mark.parametrize(
    ("pattern", "text", "match"),
    [
        (r"\w+$", "été", True),
        (r"\d+", "٣", True),
        (r"(?P<first_part>a)(?P=first_part)", "aa", True),
        (r"a\\Z", "a\\Z", True),
        (r"a\\Z", "a", False),
        (r"a\Z", "a\n", False),
        (r"a$", "a\n", True),
        (r"a$", "a\r", False),
        (r"[[a&&b]+\Z", "[a&", True),
        (r"[]x]+", "]x", True),
        (r".\Z", "\r", True),
    ],
)
def test_patterns_mean_what_python_means(spark, pattern, text, match):
    assert bool(re.match(pattern, text)) is match
    rules = RuleSet().add_pattern_rule("s", pattern)
    assert annotate(spark.createDataFrame([(text,)], "s STRING"), rules).first()["is_valid"] is match


def test_python_rules_do_not_depend_on_their_neighbours(spark):
    big = 9007199254740993
    rules = RuleSet().add_python_rule("x", lambda v: v is None or v == big, "not big")
    rules.add_python_rule("a", lambda v: v == [1, None], "other items")
    for rows_ in ([(big, [1, None])], [(big, [1, None]), (None, [1, None])]):
        checked = annotate(spark.createDataFrame(rows_, "x BIGINT, a ARRAY<INT>").coalesce(1), rules)
        assert all(r["is_valid"] for r in checked.collect())


def test_rules_of_one_kind_keep_apart(spark):
    prefix = "a" * 30
    rules = RuleSet().add_pattern_rule("s", prefix + "b").add_pattern_rule("s", prefix + "c")
    rules.add_custom_rule("s", lambda c: c != "x", "x").add_custom_rule("s", lambda c: c != "y", "y").add_unique_rule("s").add_unique_rule("s")
    names = [r.name for r in rules.get_all_rules()]
    assert len(set(names)) == 6 and names[:2] == ["s_pattern", "s_pattern_2"]
    df = spark.createDataFrame([(prefix + "b",), ("x",)], "s STRING")
    assert annotate(df, rules).columns == ["s", "violations", "is_valid"]
    assert {r["rule"]: r["violations"] for r in counts_by_rule(annotate(df, rules)).collect()} == {"s_pattern": 1, "s_pattern_2": 2, "s_custom": 1}


def test_map_reduce_sees_true_values(spark):
    df = spark.createDataFrame([(9007199254740993, [1]), (None, [2, 3])], "x BIGINT, a ARRAY<INT>").coalesce(1)
    found = map_reduce(df, lambda r: (r["x"] or 0) + len(r["a"]), lambda a, b: a + b, "BIGINT").first()[0]
    assert found == 9007199254740996
    counted = map_reduce(df, lambda b: b.num_rows, lambda a, b: a + b, "BIGINT", by_batch=True).first()[0]
    assert counted == 2

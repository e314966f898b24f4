"""Exact medians with bounded state.

The built-in exact median keeps every distinct value of a column in one task.  Here a quantile sketch proposes a
bracket around the median, one aggregate counts what lies below and inside it, and this repeats until the bracket
holds few enough distinct values to rank.  Each step is one aggregate over all columns, and each narrowing divides the
rows inside the bracket by a factor in the thousands, so even 10^12 rows need two or three.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowkit.functions.columns import present

RANKED_VALUES = 200_000
ACCURACY = 10_000


@dataclass
class _Bracket:
    """A range of values known to hold both middle ranks of a column; no bound means unbounded."""

    count: int
    inside: int
    distinct: int
    spread: float
    below: int = 0
    lo: float | None = None
    hi: float | None = None

    @property
    def ranks(self) -> tuple[int, int]:
        """0-based ranks of the two middle values, counted inside the bracket."""
        return (self.count - 1) // 2 - self.below, self.count // 2 - self.below

    def shares(self) -> Column:
        center = sum(self.ranks) / 2 / self.inside
        return F.array(F.lit(max(0.0, center - self.spread)), F.lit(min(1.0, center + self.spread)))

    def keeps(self, value: Column) -> Column:
        return value if self.lo is None else F.when(value.between(F.lit(self.lo), F.lit(self.hi)), value)


@dataclass(frozen=True)
class ColumnSize:
    """Rows of the frame, non-missing values of the column, and about how many of them differ."""

    rows: int
    count: int
    distinct: int


def _values(df: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    types = {f.name: f.dataType for f in df.schema}
    return {c: present(c, types[c]).cast("double") for c in columns}


def column_sizes(df: DataFrame, columns: Sequence[str]) -> dict[str, ColumnSize]:
    """Sizes of numeric columns, from one aggregate."""
    if not columns:
        return {}
    sizes = [F.struct(F.count(v), F.approx_count_distinct(v)) for v in _values(df, columns).values()]
    rows, *counted = df.agg(F.count(F.lit(1)), *[s.alias(str(i)) for i, s in enumerate(sizes)]).first()
    return {c: ColumnSize(rows, *size) for c, size in zip(columns, counted, strict=True)}


def exact_medians(
    df: DataFrame,
    columns: Sequence[str],
    ranked_values: int = RANKED_VALUES,
    accuracy: int = ACCURACY,
    sizes: dict[str, ColumnSize] | None = None,
) -> dict[str, float | None]:
    """The median of the non-missing values of each column, None for a column without values.

    Runs a few one-row aggregates, and one job that ranks about `ranked_values` distinct values per column or fewer.
    """
    value = _values(df, columns)
    spread = 4.0 / accuracy
    known = sizes or column_sizes(df, columns)
    brackets = {
        c: _Bracket(known[c].count, known[c].count, known[c].distinct, spread) for c in columns if known[c].count
    }
    while wide := [c for c, b in brackets.items() if b.distinct > ranked_values]:
        _narrow(df, {c: value[c] for c in wide}, brackets, accuracy, spread)
    return {**dict.fromkeys(columns), **_middle_values(df, value, brackets)}


def _narrow(
    df: DataFrame, value: dict[str, Column], brackets: dict[str, _Bracket], accuracy: int, spread: float
) -> None:
    """Propose closer bounds for each column and take those that the counts prove right."""
    proposed = df.agg(*[
        F.percentile_approx(brackets[c].keeps(v), brackets[c].shares(), accuracy).alias(str(i))
        for i, (c, v) in enumerate(value.items())
    ]).first()
    counts = []
    for i, (v, (lo, hi)) in enumerate(zip(value.values(), proposed, strict=True)):
        kept = F.when(v.between(F.lit(lo), F.lit(hi)), v)
        parts = F.struct(F.count_if(v < F.lit(lo)), F.count(kept), F.approx_count_distinct(kept))
        counts.append(parts.alias(str(i)))
    counted = df.agg(*counts).first()
    for c, (lo, hi), (below, inside, distinct) in zip(value, proposed, counted, strict=True):
        b = brackets[c]
        if below <= (b.count - 1) // 2 and b.count // 2 < below + inside:
            brackets[c] = _Bracket(b.count, inside, distinct, spread, below, lo, hi)
        else:
            b.spread *= 2


def _middle_values(
    df: DataFrame, value: dict[str, Column], brackets: dict[str, _Bracket]
) -> dict[str, float]:
    """Average of the values at the two middle ranks; ranks run over the values counted once each."""
    if not brackets:
        return {}
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), b.keeps(value[c]).alias("v")) for c, b in brackets.items()])
    counts = (
        df.select(F.inline(pairs)).where(F.col("v").isNotNull()).groupBy("name", "v").agg(F.count(F.lit(1)).alias("n"))
    )
    upto = Window.partitionBy("name").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumn("end", F.sum("n").over(upto))
    wanted = F.create_map(*[
        part for c, b in brackets.items() for part in (F.lit(c), F.array(*[F.lit(r) for r in b.ranks]))
    ])

    def value_at(which: int) -> Column:
        rank = wanted[F.col("name")][which]
        return F.max(F.when((F.col("end") > rank) & (F.col("end") - F.col("n") <= rank), F.col("v")))

    rows = ranked.groupBy("name").agg(((value_at(0) + value_at(1)) / 2).alias("median")).collect()
    return {r["name"]: r["median"] for r in rows}

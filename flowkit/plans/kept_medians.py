"""Exact medians over parts that are added one after the other, each of which is read once.

A part (a day, a batch) leaves two summaries: how often each value of a column occurs, and a mergeable quantile sketch.
The merged sketches bracket the median of all parts, the counts prove the bracket, and only the values left in it are
ranked.  Neither an old part nor most of its counts are read again when a new one comes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowkit.functions.columns import col, present
from flowkit.functions.schema import DOUBLE, LONG, TEXT, schema
from flowkit.functions.text import require_identifier
from flowkit.plans.ordered import running_sums
from flowkit.plans.staging import children, exists, remove

SKETCH_SIZE = 4_000
SPREAD = 0.002
COUNTS = schema(name=TEXT, value=DOUBLE, n=LONG)
SKETCHES = "name STRING, sketch BINARY, n BIGINT"


@dataclass(frozen=True)
class KeptMedians:
    """Where the summaries of the parts lie, and of which numeric columns they are.

    Missing values (NULL or NaN) have no part in a median.  A part is complete when its sketches are; adding it again
    changes nothing, and one that stopped half-way is made anew.
    """

    path: str
    columns: tuple[str, ...]

    def _at(self, kind: str, part: str) -> str:
        return f"{self.path}/{kind}/part={part}"

    def parts(self, spark: SparkSession) -> list[str]:
        """The names of the complete parts."""
        named = [n.removeprefix("part=") for n in children(spark, f"{self.path}/sketches")]
        return sorted(p for p in named if exists(spark, f"{self._at('sketches', p)}/_SUCCESS"))

    def add(self, rows: DataFrame, part: str) -> bool:
        """Summarize a part (two passes over its rows, two writes); False if it is there already."""
        spark = rows.sparkSession
        require_identifier(part)
        if part in self.parts(spark):
            return False
        remove(spark, self._at("sketches", part))
        types = {f.name: f.dataType for f in rows.schema}
        value = {c: present(c, types[c]).cast("double") for c in self.columns}
        each = F.array(*[F.struct(F.lit(c).alias("name"), v.alias("value")) for c, v in value.items()])
        # Minus zero is zero, or one value would have two counts.
        counted = rows.select(F.inline(each)).where("value IS NOT NULL").withColumn("value", F.col("value") + F.lit(0.0))
        counted = counted.groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
        ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
        placed = counted.repartitionByRange(ranges, "name", "value").sortWithinPartitions("name", "value")
        placed.write.mode("overwrite").parquet(self._at("counts", part))
        sketched = rows.agg(*[
            F.struct(F.lit(c).alias("name"), F.kll_sketch_agg_double(v, F.lit(SKETCH_SIZE)).alias("sketch"), F.count(v).alias("n")).alias(str(i))
            for i, (c, v) in enumerate(value.items())
        ])
        made = sketched.select(F.inline(F.array(*[F.col(str(i)) for i in range(len(self.columns))]))).where("n > 0")
        made.coalesce(1).write.mode("overwrite").parquet(self._at("sketches", part))
        return True

    def counts(self, spark: SparkSession, parts: Sequence[str]) -> DataFrame:
        """How often each value occurs in each of some parts."""
        return spark.read.schema(COUNTS).parquet(*[self._at("counts", p) for p in parts])

    def _brackets(self, spark: SparkSession, parts: Sequence[str], columns: Sequence[str], spread: float) -> dict[str, tuple]:
        """Per column `(rows, lowest, highest)`: bounds that hold the median if the sketches are right."""
        sketches = spark.read.schema(SKETCHES).parquet(*[self._at("sketches", p) for p in parts])
        merged = sketches.groupBy("name").agg(
            F.kll_merge_agg_double("sketch", F.lit(SKETCH_SIZE)).alias("sketch"), F.sum("n").alias("n")
        )
        shares = {"low": max(0.0, 0.5 - spread), "high": min(1.0, 0.5 + spread)}
        bounds = merged.where(F.col("name").isin(list(columns))).select(
            "name", "n", *[F.kll_sketch_get_quantile_double("sketch", F.lit(share)).alias(c) for c, share in shares.items()]
        )
        return {r["name"]: (r["n"], r["low"], r["high"]) for r in bounds.collect()}

    def medians(self, spark: SparkSession) -> dict[str, float | None]:
        """The median of each column over all parts, None for a column without values.

        Runs one-row aggregates over the sketches and counts, and a distributed running sum over the values within the
        brackets; what comes to the driver is a few numbers per column.
        """
        out: dict[str, float | None] = dict.fromkeys(self.columns)
        parts = self.parts(spark)
        wanted, spread = list(self.columns), SPREAD
        while parts and wanted and (brackets := self._brackets(spark, parts, wanted, spread)):
            proved = self._below(spark, parts, brackets)
            found = {
                c: (n, low, high, proved[c][0]) for c, (n, low, high) in brackets.items()
                if proved[c][0] <= (n - 1) // 2 and n // 2 < sum(proved[c])
            }
            out |= self._middle(spark, parts, found)
            wanted, spread = [c for c in brackets if c not in found], min(0.5, 4 * spread)
        return out

    def _below(self, spark: SparkSession, parts: Sequence[str], brackets: dict[str, tuple]) -> dict[str, tuple[int, int]]:
        """Per column, the rows below its bracket and inside it."""
        named, sums = F.col("name"), []
        for i, (c, (_, low, high)) in enumerate(brackets.items()):
            below, inside = (named == c) & (F.col("value") < low), (named == c) & F.col("value").between(low, high)
            sums += [F.sum(F.when(below, F.col("n"))).alias(f"b{i}"), F.sum(F.when(inside, F.col("n"))).alias(f"i{i}")]
        row = self.counts(spark, parts).where(self._any(brackets, lambda low, high: F.col("value") <= high)).agg(*sums).first()
        return {c: (row[f"b{i}"] or 0, row[f"i{i}"] or 0) for i, c in enumerate(brackets)}

    def _any(self, brackets: dict[str, tuple], holds) -> Column:
        wanted = F.lit(False)
        for c, (_, low, high, *_) in brackets.items():
            wanted = wanted | ((F.col("name") == c) & holds(F.lit(low), F.lit(high)))
        return wanted

    def _middle(self, spark: SparkSession, parts: Sequence[str], found: dict[str, tuple]) -> dict[str, float]:
        """The mean of the values at the two middle ranks, by running counts of the values in the brackets."""
        if not found:
            return {}
        inside = self.counts(spark, parts).where(self._any(found, lambda low, high: F.col("value").between(low, high)))
        inside = inside.groupBy("name", "value").agg(F.sum("n").alias("n"))
        running = running_sums(inside, {"upto": F.col("n")}, ["value"], ["name"])
        ranks = {c: ((n - 1) // 2 - below, n // 2 - below) for c, (n, _, _, below) in found.items()}
        wanted = F.create_map(*[x for c, r in ranks.items() for x in (F.lit(c), F.array(*map(F.lit, r)))])[F.col("name")]

        def value_at(which: int) -> Column:
            rank = wanted[which]
            return F.max(F.when((F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank), F.col("value")))

        rows = running.groupBy("name").agg(((value_at(0) + value_at(1)) / 2).alias("median")).collect()
        return {r["name"]: r["median"] for r in rows}


def fill_medians(df: DataFrame, medians: dict[str, float | None]) -> DataFrame:
    """Missing values of the columns replaced by the given medians; a column without one stays as it is."""
    types = {f.name: f.dataType for f in df.schema}
    known = {c: m for c, m in medians.items() if m is not None}
    return df.withColumns({c: F.coalesce(present(c, types[c]).cast("double"), F.lit(float(m))) for c, m in known.items()}) if known else df

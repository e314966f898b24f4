"""Mixing sources to target weights by capped water-filling.

Sources share the words of the corpus by weight, but a source is repeated `max_epochs` times at most.  What a clamped
source cannot take is shared by the others in proportion to their weights, until no target is above its cap.  A source
gives whole repetitions of all its documents and a seeded sample for the fraction that is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
BETWEEN = r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = 7
BUCKET_DIGITS = 3
ADDED = ("size", "source_size", "target", "whole", "part")


def words_in(text: Column) -> Column:
    """Number of words, runs without ASCII white space (NULL: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Target of each source from (source, source_size): adds `weight` and `target` (double).

    Weights repeat over the sources by code point, null last.  The table has one row per source, so its windows run in
    one task; they see no documents.  With sources in the order of cap / weight, the clamped ones come first: a source
    is clamped if its cap is not above what the words left by the clamped sources before it would give it.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    known = sizes.withColumn("weight", weight.cast("long")).withColumn("__cap", F.col("source_size") * max_epochs)
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("__cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("__cap").over(before), zero)
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), zero)
    clamped = F.col("__cap") / F.col("weight") <= left / weight_left
    known = known.withColumn("__clamped", clamped)
    free_words = F.sum("source_size").over(everything) - F.sum(F.when(F.col("__clamped"), F.col("__cap")).otherwise(0)).over(everything)
    free_weight = F.sum(F.when(F.col("__clamped"), 0).otherwise(F.col("weight"))).over(everything)
    target = F.when(F.col("__clamped"), F.col("__cap").cast("double")).otherwise(F.col("weight") * (free_words / free_weight))
    return known.withColumn("target", target).drop("__cap", "__clamped")


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED
) -> DataFrame:
    """What the mix takes of each document: adds `size`, `source_size`, `target`, `whole` and `part`.

    `docs` has `doc_id`, `text` and `source`; its other columns pass through, but for those with the added names, which
    are replaced.  All words of a document are taken `whole` times, then `part` (0 to `size`) of its words once more.
    The fraction goes to the documents of a source in the order of a seeded digest of `doc_id`, until the words of the
    source reach its target; the document that crosses it gives its first words only, so that a source takes its target
    rounded to whole words.  Running sums are taken within 4,096 digest ranges per source, so that a source of any size
    spreads over many tasks.  A null text has size 0, a null source is a source of its own, rows with one `doc_id` are
    ordered by size, and an empty table stays empty.
    """
    docs = docs.drop(*ADDED).withColumn("size", words_in(F.col("text")))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    docs = docs.withColumn("__digest", digest).withColumn("__bucket", F.substring("__digest", 1, BUCKET_DIGITS))
    ranges = docs.groupBy("source", "__bucket").agg(F.sum("size").alias("__size"))
    in_source = Window.partitionBy("source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("__before", F.coalesce(F.sum("__size").over(in_source), F.lit(0).cast("long")))
    targets = source_targets(docs.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_epochs)
    plan = ranges.alias("r").join(targets.alias("t"), F.expr("r.source <=> t.source")).selectExpr(
        "r.source AS __source", "__bucket AS __range", "__before", "source_size", "target",
        "CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS long) ELSE 0L END AS whole",
    )
    rows = docs.join(plan, F.expr("source <=> __source AND __bucket = __range")).drop("__source", "__range")
    in_range = Window.partitionBy("source", "__bucket").orderBy("__digest", F.col("doc_id"), "size").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("__before") + F.coalesce(F.sum("size").over(in_range), F.lit(0).cast("long"))
    quota = F.floor(F.col("target") + 0.5) - F.col("whole") * F.col("source_size")
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), quota - before))
    return rows.withColumn("part", part).drop("__digest", "__bucket", "__before")


def repeat(mixed: DataFrame) -> DataFrame:
    """The rows of the mix: each document `whole` times, and once more with its first `part` words if that is not 0.

    A cut text keeps its white space up to the end of the last word that is taken; `n_chars`, if there, follows it.
    """
    copies = F.col("whole").cast("int") + (F.col("part") > 0).cast("int")
    rows = mixed.withColumn("__copy", F.explode(F.when(copies > 0, F.sequence(F.lit(1), copies)).otherwise(F.array().cast("array<int>"))))
    cut = (F.col("__copy") > F.col("whole")) & (F.col("part") < F.col("size"))
    pieces = F.slice(F.split("text", BETWEEN), F.lit(1), F.col("part").cast("int"))
    rows = rows.withColumn("text", F.when(cut, F.array_join(pieces, "")).otherwise(F.col("text")))
    if "n_chars" in rows.columns:
        rows = rows.withColumn("n_chars", F.when(cut, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return rows.drop("__copy", *ADDED)

"""A corpus pipeline: each stage reads what the stage before it kept, written as Parquet.

Language identification, line deduplication, one document of each group of near copies, the mix of sources, tokens.
A stage takes (spark, docs, sf_dir) and returns rows with the columns of `docs`; the last one returns tokens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowkit.llm import bpe, jaccard, language, lines, mixing
from flowkit.llm.documents import row_keys, settled

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined; those without a text or without a letter go."""
    model = language.learn(docs.where(language.remainder(F.col("doc_id")) != 2))
    found = language.identify(docs.withColumnsRenamed({"lang_pred": "__lang_pred", "score": "__score"}), model)
    found = found.where(F.col("lang_pred") != language.UNDETERMINED).drop("lang_pred", "score")
    return found.withColumnsRenamed({"__lang_pred": "lang_pred", "__score": "score"})


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line repeats; those with no word left go, `n_chars` follows."""
    rows, key = row_keys(docs)
    found = lines.dedup_lines(rows.select(F.col(key).alias("doc_id"), "text")).select(F.col("doc_id").alias("__id"), F.col("text").alias("__text"))
    joined = rows.drop("text").join(found, F.col(key).eqNullSafe(F.col("__id"))).where(mixing.words_in(F.col("__text")) > 0)
    made = {"text": F.col("__text"), "n_chars": F.char_length("__text").cast("long")}
    return joined.withColumns({c: v for c, v in made.items() if c in docs.columns}).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of near copies; without an id or with a shared one, by row."""
    rows, key = row_keys(docs)
    found = jaccard.components(rows.select(F.col(key).alias("doc_id"), "text"))
    found = found.where("doc_id <=> component_id").select(F.col("doc_id").alias("__id"))
    return rows.join(found, F.col(key).eqNullSafe(F.col("__id")), "left_semi").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their source asks for; a cut copy holds the words that are taken."""
    aside = {c: f"__{c}" for c in mixing.ADDED if c in docs.columns}
    rows = mixing.repeat(mixing.mix(docs.withColumnsRenamed(aside)))
    return rows.withColumnsRenamed({v: k for k, v in aside.items()}).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row (little-endian unsigned 32-bit integers) with their number, instead of the text."""
    encoded = bpe.encode(docs, VOCABULARY)
    return encoded.withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))


STAGES = [
    ("language id", known_language),
    ("line dedup", fresh_lines),
    ("n-gram Jaccard join", one_of_each),
    ("mixing sources", mixed),
    ("BPE", tokens),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, with a written table between two."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

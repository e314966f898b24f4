"""Line deduplication by a deletion-neighbourhood join, in DataFrame operations only.

Lines are compared as word sequences.  Each line emits the hashes of itself and of itself without one word; equal
hashes are joined, the edit distance is verified on the words, and a line with an earlier line in its bound goes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowkit.llm.documents import LEAST_ID, by_document, settled

MIN_WORDS = 10
SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(line: Column) -> Column:
    """The words of a line, A-Z as a-z; a line of ASCII letters takes the faster way to the same."""
    lowered = F.when(F.octet_length(line) == F.char_length(line), F.lower(line)).otherwise(F.translate(line, UPPER, LOWER))
    return F.array_remove(F.split(lowered, SPACE), "")


def _lines(docs: DataFrame) -> DataFrame:
    """Every line: doc, at, its words, and their number."""
    doc = F.coalesce("doc_id", F.lit(LEAST_ID)).alias("doc")
    lines = docs.select(doc, F.posexplode(F.split("text", "\n")).alias("at", "line"))
    return lines.select("doc", "at", words_of(F.col("line")).alias("words")).withColumn("n", F.size("words"))


def _halves(words: Column, n: Column) -> Column:
    """Keys of which two lines share one if they are one word apart: of the longer one's length, 2 of n or n + 1 words,
    the first half or the last half agrees."""
    keys = []
    for longer in (n, n + 1):
        half = F.floor(longer / 2).cast("int")
        keys.append(F.xxhash64(F.lit("first"), longer, F.slice(words, F.lit(1), half)))
        keys.append(F.xxhash64(F.lit("last"), longer, F.slice(words, n - half + 1, half)))
    return F.array(*keys)


def _neighbourhoods(chosen: DataFrame) -> DataFrame:
    """Variants of the lines (id, first: doc and at, n, words): key, role, id, place, cut.

    A position hash covers a word and its place, and hashes combine by xor.  Role S: a line without the word at `cut`,
    its place left open, equal for lines that differ there only; role D: a line without a word, the rest closed up;
    role W: a whole line, equal to role D of a line with one word more.
    """
    word = chosen.select("id", "place", "n", F.posexplode("words").alias("cut", "word"))
    word = word.withColumn("here", F.xxhash64("word", "cut")).withColumn("back", F.xxhash64("word", F.col("cut") - 1))
    line = Window.partitionBy("id")
    before = line.orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
    after = line.orderBy(F.desc("cut")).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    word = word.withColumn("whole", F.bit_xor("here").over(line))
    closed = F.coalesce(F.bit_xor("here").over(before), zero).bitwiseXOR(F.coalesce(F.bit_xor("back").over(after), zero))
    word = word.withColumn("closed", closed)
    key = lambda role, *parts: F.xxhash64(F.lit(role), *parts)
    variants = F.array(
        F.struct(key("same", "n", "cut", F.col("whole").bitwiseXOR(F.col("here"))).alias("key"), F.lit("S").alias("role")),
        F.struct(key("shorter", F.col("n") - 1, "closed").alias("key"), F.lit("D").alias("role")),
        F.struct(F.when(F.col("cut") == 0, key("shorter", F.col("n"), "whole")).alias("key"), F.lit("W").alias("role")),
    )
    return word.select("id", "place", "cut", F.inline(variants)).where("key IS NOT NULL")


def _chosen(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """The words of the asked lines: id, n, place, words.  Lines are cut from their document after it is joined."""
    by_doc = asked.groupBy(F.col("place.doc").alias("doc")).agg(F.collect_list(F.struct("id", "n", "place")).alias("asked"))
    texts = docs.select(F.coalesce("doc_id", F.lit(LEAST_ID)).alias("doc"), "text").join(by_doc, "doc")
    cut = texts.select(F.split("text", "\n").alias("lines"), F.explode("asked").alias("a"))
    line = F.element_at("lines", F.col("a.place.at") + 1)
    return cut.select("a.id", "a.n", "a.place", line.alias("line")).select("id", "n", "place", words_of(F.col("line")).alias("words"))


def _near(classes: DataFrame, docs: DataFrame, min_words: int) -> DataFrame:
    """The classes of equal lines that have an earlier line within one word: id."""
    halves = classes.where(F.col("n") >= min_words).select("id", F.explode("halves").alias("half"))
    often = halves.groupBy("half").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("half")
    met = settled(halves.join(settled(often, "halves"), "half").select("id").distinct(), "met")
    chosen = settled(_chosen(docs, classes.join(met, "id").select("id", "n", "place")), "chosen")
    variants = settled(_neighbourhoods(chosen), "variants")
    firsts = {r: F.min(F.when(F.col("role") == r, F.struct("place", "id", "cut"))).alias(r) for r in "SDW"}
    shared = variants.groupBy("key").agg(F.count(F.lit(1)).alias("times"), *firsts.values()).where("times > 1")
    joined = variants.join(settled(shared.drop("times"), "shared"), "key")
    other = F.when(F.col("role") == "S", F.col("S")).when(F.col("role") == "D", F.col("W")).otherwise(F.col("D"))
    pairs = joined.withColumn("other", other).where("other.place < place")
    cut = F.when(F.col("role") == "W", F.col("other.cut")).otherwise(F.col("cut"))
    pairs = pairs.select("id", "role", F.col("other.id").alias("earlier"), cut.alias("cut")).distinct()
    own = chosen.select("id", F.col("words").alias("a"))
    first = chosen.select(F.col("id").alias("earlier"), F.col("words").alias("b"))
    return settled(pairs, "pairs").join(own, "id").join(first, "earlier").where(_one_word_apart()).select("id").distinct()


def _one_word_apart() -> Column:
    """The edit distance of `a` and `b` is at most one word, at the place `cut` (from 0)."""
    return F.expr("""
        slice(a, 1, cut) = slice(b, 1, cut) AND CASE
          WHEN role = 'S' THEN size(a) = size(b) AND slice(a, cut + 2, size(a)) = slice(b, cut + 2, size(b))
          WHEN role = 'D' THEN slice(a, cut + 2, size(a)) = slice(b, cut + 1, size(b))
          ELSE slice(a, cut + 1, size(a)) = slice(b, cut + 2, size(b)) END""")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Each document without the lines that an earlier line repeats: doc_id, text, n_lines, n_removed.

    A line goes if an earlier one (smaller `doc_id`, or the same and an earlier line) has the same words, or, for lines
    of `min_words` words or more, words at an edit distance of one (one word added, left out or changed).  Lines end at
    \\n; A-Z count as a-z, white space only separates words, and lines without words stay.  Earlier lines count whether
    they stay or not.  One row per id and text: a null text is empty (one empty line), a null id stands before all
    others, and different texts that share an id (or have none) follow each other by a hash of the text.

    Copies are gathered by hash first, so that one line stands for them.  Lines whose first and last halves are both
    found in no other line cannot be one word apart from any, and emit no variants.
    """
    return by_document(docs, lambda rows: _dedup_lines(rows, min_words))


def _dedup_lines(docs: DataFrame, min_words: int) -> DataFrame:
    lines = _lines(docs)
    words = F.col("words")
    keyed = lines.withColumn("id", F.when(F.col("n") > 0, F.xxhash64(F.lit("line"), words))).withColumn("key", F.xxhash64(words, F.lit("second")))
    keyed = settled(keyed.select("doc", "at", "n", "id", "key", F.when(F.col("n") >= min_words, _halves(words, F.col("n"))).alias("halves")), "lines")
    kept = keyed.where("n > 0").groupBy("id", "key").agg(F.min(F.struct("doc", "at")).alias("place"), F.first("n").alias("n"), F.first("halves").alias("halves"))
    classes = settled(kept, "classes")
    near = settled(_near(classes, docs, min_words), "near").withColumn("near", F.lit(True))
    judged = settled(classes.select("id", "key", "place").join(near, "id", "left").select("id", "key", "place", F.coalesce("near", F.lit(False)).alias("near")), "judged")
    flagged = keyed.select("doc", "at", "id", "key").join(judged, ["id", "key"], "left")
    flagged = flagged.select("doc", "at", F.coalesce(F.col("near") | (F.struct("doc", "at") != F.col("place")), F.lit(False)).alias("gone"))
    flags = flagged.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("at", "gone"))).alias("flags"))
    joined = docs.withColumn("doc", F.coalesce("doc_id", F.lit(LEAST_ID))).join(flags, "doc")
    rows = F.filter(F.arrays_zip(F.split("text", "\n").alias("line"), F.col("flags").alias("flag")), lambda x: ~x["flag"]["gone"])
    return joined.select(
        "doc_id",
        F.array_join(F.transform(rows, lambda x: x["line"]), "\n").alias("text"),
        F.size("flags").cast("long").alias("n_lines"),
        F.size(F.filter("flags", lambda x: x["gone"])).cast("long").alias("n_removed"),
    )

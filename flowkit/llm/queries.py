"""The queries that apply each operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowkit.llm import byte_bpe, extraction, periods, quality, spelling
from flowkit.llm.ann import nearest
from flowkit.llm.bpe import decode, encode
from flowkit.llm.fingerprints import compare_edited
from flowkit.llm.jaccard import components
from flowkit.llm.language import identify, learn, remainder
from flowkit.llm.lines import dedup_lines
from flowkit.llm.mixing import mix
from flowkit.llm.registry import QUERIES, SQL, query, table
from flowkit.llm.suffixes import deduplicate

__all__ = ["QUERIES", "SQL"]

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

WORDS_SQL = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def _crc_step(c: int) -> int:
    for _ in range(8):
        c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
    return c


# The crc32 of a text, byte by byte from the hex digits of its UTF-8.
CRC_SQL = f"""xor(list_reduce(list_transform(range(octet_length(encode({{0}}))),
    lambda i: ('0x' || substr(hex(encode({{0}})), 2 * i::INT + 1, 2))::BIGINT),
    lambda c, b: xor(c >> 8, ({[_crc_step(c) for c in range(256)]})[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"""


@query(rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len({WORDS_SQL.format("text")}), 0) AS size,
         md5('7:' || coalesce(doc_id::VARCHAR, '')) AS digest
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source),
ordered AS (
  SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS all_words, sum(weight) OVER () AS all_weight,
         coalesce(sum(3 * source_size) OVER before, 0) AS cap_before, coalesce(sum(weight) OVER before, 0) AS weight_before
  FROM sources
  WINDOW before AS (ORDER BY (3 * source_size)::DOUBLE / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
clamps AS (
  SELECT *, cap::DOUBLE / weight <= (all_words - cap_before)::DOUBLE / (all_weight - weight_before) AS clamped
  FROM ordered),
targets AS (
  SELECT source, source_size,
         CASE WHEN clamped THEN cap::DOUBLE ELSE weight * (
           (all_words - sum(CASE WHEN clamped THEN cap ELSE 0 END) OVER ())::DOUBLE
           / (sum(CASE WHEN clamped THEN 0 ELSE weight END) OVER ())) END AS target
  FROM clamps),
summed AS (
  SELECT doc_id, size, s.source_size, target,
         CASE WHEN s.source_size > 0 THEN floor(target / s.source_size)::BIGINT ELSE 0 END AS whole,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY digest, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS words_before
  FROM sized d JOIN targets s ON d.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (whole * size + greatest(0, least(size, floor(target + 0.5)::BIGINT - whole * source_size - words_before)))::BIGINT
         AS taken
FROM summed
""")
def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    taken = F.col("whole") * F.col("size") + F.col("part")
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


@query("""
WITH usable AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, q.v AS query, c.vec_id, CASE WHEN len(q.v) = len(c.v) THEN list_inner_product(q.v, c.v) END AS score
  FROM usable q JOIN usable c ON q.vec_id % 20 = 0 AND len(q.v) = len(c.v) AND (c.vec_id <> q.vec_id OR c.v <> q.v)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id, query ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
""")
def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query()
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.where(remainder(F.col("doc_id")) != 2))
    held_out = F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False))
    found = identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


@query()
def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edited(table(spark, sf_dir, "documents"))


@query()
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.learn(docs.select("doc_id", "text"), labels.where(remainder(F.col("doc_id")) != 2))
    held_out = F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False))
    found = quality.score(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "score", "predicted")


@query()
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), VOCABULARY)
    digests = encoded.select(
        "doc_id", "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256")
    )
    decoded_sha256 = F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256")
    return decode(digests, VOCABULARY).select("doc_id", "n_tokens", "ids_sha256", decoded_sha256)


@query()
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = extraction.extract(pages.select("page_id", "url", "html"), extraction.learn(pages))
    return found.select("page_id", "url", "text", "n_chars")


@query()
def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = deduplicate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query(rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, {WORDS_SQL.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - 3, 2)),
         lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM worded),
each AS (SELECT doc_id, len(s) AS n, unnest(s) AS h FROM sets),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM each x JOIN each y ON x.h = y.h AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reach AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT sets.doc_id, len(s)::BIGINT AS n_shingles, least(sets.doc_id, coalesce(min(b), sets.doc_id)) AS component_id
FROM sets LEFT JOIN reach ON reach.a = sets.doc_id GROUP BY sets.doc_id, s
""")
def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(table(spark, sf_dir, "documents"))


@query(rf"""
WITH lines AS (
  SELECT doc_id, pos, line, regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w
  FROM (SELECT doc_id, unnest(s) AS line, generate_subscripts(s, 1) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents))),
classes AS (SELECT w, len(w) AS n, min((doc_id, pos)) AS place FROM lines WHERE len(w) > 0 GROUP BY w),
cut AS (SELECT w, n, place, unnest(range(1, n + 1)) AS i FROM classes WHERE n >= 10),
variants AS (
  SELECT 'S' AS role, hash(n, i, w[:i - 1], w[i + 1:]) AS key, w, place FROM cut
  UNION ALL SELECT 'D', hash(list_concat(w[:i - 1], w[i + 1:])), w, place FROM cut
  UNION ALL SELECT 'W', hash(w), w, place FROM classes WHERE n >= 10),
firsts AS (
  SELECT key, min(place) FILTER (role = 'S') AS s, min(place) FILTER (role = 'D') AS d, min(place) FILTER (role = 'W') AS w
  FROM variants GROUP BY key),
near AS (
  SELECT DISTINCT v.w FROM variants v JOIN firsts f ON v.key = f.key
  WHERE CASE v.role WHEN 'S' THEN f.s WHEN 'D' THEN f.w ELSE f.d END < v.place),
flagged AS (
  SELECT doc_id, l.pos, line, len(l.w) > 0 AND (near.w IS NOT NULL OR c.place <> (doc_id, l.pos)) AS gone
  FROM lines l LEFT JOIN classes c ON l.w = c.w LEFT JOIN near ON l.w = near.w)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM flagged GROUP BY doc_id
""")
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query()
def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    digests = encoded.select(
        "doc_id", "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256")
    )
    decoded_sha256 = F.sha2("content", 256).alias("decoded_sha256")
    return byte_bpe.decode(digests, RANKS).select("doc_id", "n_tokens", "ids_sha256", decoded_sha256)


@query(rf"""
WITH worded AS (
  SELECT doc_id, {WORDS_SQL.format("coalesce(text, '')")} AS w, {CRC_SQL.format("doc_id::VARCHAR")} AS h FROM documents),
planted AS (
  SELECT doc_id, w, len(w) AS n, h, (h // 10) % greatest(len(w), 1) AS a, 3 + (h // 10) % 8 AS parts FROM worded),
texts AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // parts) END])
    ELSE w END AS w
  FROM planted),
-- A run of period q holds two neighbouring blocks of q words, from a multiple of q on, that are equal.
lags AS (
  SELECT doc_id, n, w, q, unnest(range(0, n - 2 * q + 1, q)) AS j FROM (SELECT *, unnest(range(1, n // 4 + 1)) AS q FROM texts)),
asked AS (
  SELECT DISTINCT doc_id, q FROM lags WHERE w[j + 1] = w[j + q + 1] AND w[j + 1:j + q] = w[j + q + 1:j + 2 * q]),
scanned AS (
  SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS stretch
  FROM (SELECT doc_id, q, w, unnest(range(n - q)) AS i FROM asked JOIN texts USING (doc_id))
  WHERE w[i + 1] = w[i + q + 1]),
stretches AS (
  SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM scanned GROUP BY doc_id, q, stretch
  HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (
  SELECT * FROM stretches s WHERE NOT EXISTS (
    SELECT 1 FROM stretches t WHERE t.doc_id = s.doc_id AND t.q < s.q AND s.q % t.q = 0
      AND t.start <= s.start AND t.start + t.length >= s.start + s.length)),
summed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS listed
  FROM runs GROUP BY doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / q DESC, start, q) AS place FROM runs),
dropped AS (SELECT DISTINCT doc_id, unnest(range(start + q, start + length)) AS i FROM runs),
gone AS (SELECT doc_id, list(i) AS gone FROM dropped GROUP BY doc_id),
kept AS (
  SELECT t.doc_id, CASE WHEN gone IS NULL THEN array_to_string(w, ' ')
    ELSE array_to_string(list_transform(list_filter(range(n), lambda i: NOT list_contains(gone, i)), lambda i: w[i + 1]), ' ') END AS text
  FROM texts t LEFT JOIN gone ON t.doc_id = gone.doc_id)
SELECT k.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start, length, q AS period, 1000 * length // q AS exponent_milli,
       sha256(coalesce(listed, '')) AS runs_sha256, sha256(k.text) AS collapsed_sha256
FROM kept k LEFT JOIN summed USING (doc_id) LEFT JOIN ranked r ON r.doc_id = k.doc_id AND r.place = 1
""")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.periodic_runs(periods.looped(table(spark, sf_dir, "documents").select("doc_id", "text")))
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    digest = F.sha2(F.concat(F.array_join(listed, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit(""))), 256)
    larger = lambda x, y: x["length"] * y["period"] - y["length"] * x["period"]
    best = F.get(F.array_sort("runs", lambda x, y: F.signum(-larger(x, y)).cast("int")), F.lit(0))
    rows = found.withColumn("best", best)
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col("best")[c].alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        digest.alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )


@query(rf"""
WITH RECURSIVE found AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[a-zÀ-ÿ]+')) AS run
  FROM documents),
hashed AS (SELECT run, {CRC_SQL.format("(coalesce(doc_id::VARCHAR, '') || ':' || run)")} AS h FROM found WHERE length(run) >= 6),
words AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
         count(*) AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 6 AND count(*) >= 5),
cut AS (SELECT word, n, unnest(range(length(word))) AS i FROM words),
skips AS (SELECT word, n, substr(word, 1, i) || chr(1) || substr(word, i + 2) AS key FROM cut),
shorter AS (SELECT DISTINCT word, n, substr(word, 1, i) || substr(word, i + 2) AS key FROM cut),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM skips a JOIN skips b ON a.key = b.key AND a.word <> b.word
  UNION ALL SELECT s.word, w.word, w.n FROM shorter s JOIN words w ON s.key = w.word
  UNION ALL SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON s.key = w.word),
best AS (
  SELECT word, count(*) AS n_near, min((-other_n, other)) AS top FROM near GROUP BY word),
formed AS (
  SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -top[1] >= 5 * n THEN top[2] END AS form,
         CASE WHEN -top[1] >= 5 * n THEN -top[1] END AS form_n
  FROM words w LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS root FROM formed
  UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON c.root = f.word AND f.form IS NOT NULL)
SELECT f.word, f.form, c.root, f.n::BIGINT AS n, f.n_near::BIGINT AS n_near, f.form_n::BIGINT AS form_n
FROM formed f JOIN chain c ON f.word = c.word JOIN formed l ON c.root = l.word AND l.form IS NULL
""")
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = spelling.word_counts(table(spark, sf_dir, "documents"), typos=True)
    return spelling.variants(counts).select("word", "form", "root", "n", "n_near", "form_n")

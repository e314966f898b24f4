"""The queries of the subpackage on whole tables, against SQL or plain Python."""

import hashlib
import json
from fractions import Fraction

import brute
import numpy as np
import oracle
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from flowkit.llm import byte_bpe, dom
from flowkit.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def documents(spark, small_dir):
    rows = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] or "" for r in rows}


def rows_of(spark, name, sf_dir):
    return QUERIES[name](spark, sf_dir).toPandas()


def test_every_operator_and_the_pipeline_are_registered():
    known = queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in known) == 1
    assert "pipeline" in known and set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, name):
    names, rows = oracle.spark_rows(QUERIES[name](spark, sf_dir))
    expected_names, expected = oracle.sql_rows(oracle.connect(sf_dir), SQL[name])
    assert names == expected_names
    assert rows and not rows - expected and not expected - rows


def test_repeated_strings_equal_brute_force(spark, small_dir, documents):
    found = rows_of(spark, "op2_suffix_array_dedup", small_dir)
    expected = brute.repeated_bytes(documents.items())
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found.itertuples()} == expected
    assert found.n_removed.sum() > 0


def test_extraction_finds_the_article(spark, small_dir):
    found = rows_of(spark, "op3_html_extraction", small_dir).set_index("page_id")
    pages = spark.read.parquet(f"{small_dir}/pages.parquet").select("page_id", "html").collect()
    right = 0
    for row in pages:
        inner = row["html"].partition("<article>")[2].partition("</article>")[0]
        right += found.text[row["page_id"]] == "\n\n".join(t for t in dom.read(inner).texts if t)
        assert found.n_chars[row["page_id"]] == len(found.text[row["page_id"]])
    assert len(found) == len(pages) and right >= 0.9 * len(pages)


def test_tokens_equal_the_library(spark, small_dir, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = rows_of(spark, "op4_bpe", small_dir)
    assert len(found) == len(documents)
    for row in found.itertuples():
        ids = tokenizer.encode(documents[row.doc_id], add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_rank_file_tokens_equal_the_library(spark, small_dir, documents):
    ranks = byte_bpe.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).whole
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = rows_of(spark, "op11_byte_bpe", small_dir)
    assert len(found) == len(documents)
    for row in found.itertuples():
        ids = library.encode_ordinary(documents[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode_bytes(ids)).hexdigest()


def test_runs_equal_brute_force(spark, small_dir, documents):
    found = rows_of(spark, "op12_periodic_runs", small_dir).set_index("doc_id")
    assert len(found) == len(documents) and found.n_runs.sum() > 0
    for doc, text in documents.items():
        words = brute.looped(doc, brute.WORD.findall(text))
        runs, row = brute.runs(words), found.loc[doc]
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        kept = " ".join(w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs))
        assert row.n_runs == len(runs) and row.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()
        if runs:
            start, length, period = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))
            assert (row.start, row.length, row.period, row.exponent_milli) == (start, length, period, 1000 * length // period)


def test_fingerprints_estimate_the_similarity(spark, small_dir, documents):
    found = rows_of(spark, "op5_fingerprints", small_dir).set_index("doc_id")
    ids, errors, by_text = sorted(documents), [], {}
    for i, doc in enumerate(ids):
        text, after = documents[doc], documents[ids[i - 1]]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = found.loc[doc]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own = brute.shingle_set(text)
        errors.append(row.near_edited - brute.jaccard(own, brute.shingle_set(edited)))
        errors.append(row.near_next - brute.jaccard(own, brute.shingle_set(after)))
        assert by_text.setdefault(text, row.fingerprint) == row.fingerprint
    assert np.abs(errors).mean() < 0.03 and np.abs(errors).max() < 0.2 and abs(np.mean(errors)) < 0.01


def test_quality_holds_out(spark, sf_dir):
    found = rows_of(spark, "op8_quality_classifier", sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas()
    both = found.merge(labels, on="doc_id")
    held = both[both.held_out]
    assert found.score.between(0, 1).all() and (found.predicted == (found.score >= 0.7)).all()
    assert (held.predicted == held.quality).mean() > 0.9


def test_language_holds_out(spark, sf_dir):
    found = rows_of(spark, "op9_language_id", sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").toPandas()
    held = found.merge(docs, on="doc_id")
    held = held[held.held_out]
    assert len(found) == len(docs) and found.score.between(0, 1).all()
    assert (held.lang_pred == held.lang).mean() > 0.98


def test_pipeline_stages_take_effect(spark, small_dir, tmp_path):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    columns = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
        stage(spark, docs, small_dir).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        if i < 4:
            assert docs.columns == columns
        rows = docs.collect()
        if i == 0:
            assert {r["doc_id"] for r in rows} == {d for d, t in before.items() if t and any(c.isalpha() for c in t)}
        if i == 1:
            expected = {d: t for d, t in brute.kept_lines(before.items()).items() if t.split()}
            assert {r["doc_id"]: r["text"] for r in rows} == expected
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
        if i == 2:
            assert {r["doc_id"] for r in rows} == {d for d, (_, c) in brute.components(before.items()).items() if c == d}
        if i == 3:
            words = sum(len(brute.WORD.findall(t)) for t in before.values())
            assert abs(sum(len(brute.WORD.findall(r["text"])) for r in rows) - words) <= 20
            assert all(before[r["doc_id"]].startswith(r["text"]) for r in rows)
            mixed = sorted((r["doc_id"], r["text"]) for r in rows)
        if i == 4:
            tokenizer = Tokenizer.from_file(corpus_pipeline.VOCABULARY)
            made = sorted((r["doc_id"], tokenizer.decode(np.frombuffer(r["ids"], "<u4").tolist())) for r in rows)
            assert made == mixed
    assert corpus_pipeline.run(spark, small_dir).count() == len(mixed)
    assert json.dumps([name for name, _ in corpus_pipeline.STAGES])

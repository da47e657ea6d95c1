"""The pipeline, held stage by stage against brute force on the smallest tables and on odd rows."""

import re
from pathlib import Path

import corpus_pipeline as cp
import pytest
from pyspark.sql import functions as F
from test_line_dedup import brute as brute_lines
from test_ngram_join import brute as brute_join

from tidewatch.llm import sentencepiece_codec

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the supplied tables")


def test_the_stages():
    assert [n for n, _ in cp.STAGES] == ["toxicity", "line_dedup", "ngram_join", "decontamination", "sentencepiece"]


def test_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    clean = cp.drop_toxic(spark, docs, SF_DIR)
    assert clean.columns == docs.columns
    toxic = spark.read.parquet(f"{SF_DIR}/labels.parquet").where("toxic = 0").join(docs, "doc_id")
    assert toxic.join(clean, "doc_id", "left_anti").count() <= 0.01 * toxic.count()
    lines = {i: t for i, t, _, _ in brute_lines([(r.doc_id, r.text) for r in clean.collect()], 10, 1)}
    kept = {i for i, group, _ in brute_join(list(lines.items())) if i == group}
    items = [" ".join(re.findall(r"\w+", r.text.lower())) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    final = {r.doc_id: r for r in cp.run(spark, SF_DIR).collect()}
    assert set(final) <= kept
    for i in kept:
        text = " ".join(re.findall(r"\w+", (lines[i] or "").lower()))
        if any(f" {x} " in f" {text} " for x in items):
            assert i not in final
        elif i not in final:
            # a passage of which a line was dropped before
            assert any(" ".join(x.split()[2:9]) in text or " ".join(x.split()[-8:-1]) in text for x in items)
    codec = sentencepiece_codec.Codec(*sentencepiece_codec.read_model())
    for i, r in final.items():
        assert codec.decode(r.ids) == lines[i] and r.n_chars == len(lines[i]) and r.n_ids == len(r.ids)


def test_odd_rows_and_other_columns(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "some words of no id here", "y"), (3, "long " * 50000, None), (4, "five words and one more", "z"), (4, "five words and one more", "z"), (5, "Five words, and one more!", "z")]
    docs = spark.createDataFrame([(*r, 7, "a", True) for r in rows], "doc_id long, text string, lang string, _ids int, class string, _toxic boolean")
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns and {(r._ids, r["class"], r._toxic) for r in out.collect()} == {(7, "a", True)}
    assert sorted(r.doc_id or 0 for r in cp.drop_near_duplicates(spark, docs, SF_DIR).collect()) == [0, 1, 2, 3, 4]
    assert cp.encode(spark, docs, SF_DIR).columns == ["doc_id", "lang", "n_ids", "ids"]
    for _, stage in cp.STAGES:
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0


def test_the_lengths_follow_the_texts(spark):
    docs = spark.createDataFrame([(i, f"same\nown {i}", 99) for i in range(10)], "doc_id long, text string, n_chars long")
    found = cp.drop_lines(spark, docs, SF_DIR)
    assert {(r.text, r.n_chars) for r in found.collect()} == {(f"own {i}", 5) for i in range(10)}
    assert found.where(F.col("n_chars") != F.length("text")).count() == 0

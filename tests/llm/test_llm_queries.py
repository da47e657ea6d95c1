"""The registered queries of the corpus operators on the smallest tables, against SQL or brute force."""

import hashlib
import re
import zlib
from pathlib import Path

import pytest
from compare import compare, connect
from pyspark.sql import functions as F

from tidewatch.llm import sentencepiece_codec
from tidewatch.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the supplied tables")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, name):
    assert compare(spark, connect(SF_DIR), QUERIES[name], ORACLES[name], SF_DIR) is None


def test_toxicity(spark):
    folder = SF_DIR.replace("sf0.001", "sf0.01")  # the smallest tables label eleven toxic documents
    found = QUERIES["op2_toxicity"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    both = labels.select("doc_id", F.col("toxic").alias("label")).join(found, "doc_id")
    assert both.where("label = 0 and toxic").count() <= 0.01 * labels.where("toxic = 0").count() + 1
    assert both.where("label = 1 and toxic").count() >= 0.7 * labels.where("toxic = 1").count()
    assert found.where("severity < 0 or severity > 2").count() == 0


def test_ngram_join(spark, docs):
    from test_ngram_join import brute

    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = sorted(((r.doc_id, r.group_id, r.n_links) for r in QUERIES["op3_ngram_join"](spark, SF_DIR).collect()), key=repr)
    assert found == brute(rows)


def test_sentencepiece(spark, docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    codec = sentencepiece_codec.Codec(*sentencepiece_codec.read_model())
    for r in QUERIES["op4_sentencepiece"](spark, SF_DIR).collect():
        assert r.decodes_exactly and r.n_ids == len(r.ids) and codec.decode(r.ids) == texts[r.doc_id]


def test_html(spark):
    import html

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    found = QUERIES["op5_html_extract"](spark, SF_DIR).collect()
    assert len(found) == len(pages)
    for r in found:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        article = re.sub(r"<br\s*/?>", " ", article)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_decontamination(spark, docs):
    items = {r.item_id: re.findall(r"\w+", r.text.lower()) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()}
    found = {r.doc_id: set(r.item_ids) for r in QUERIES["op6_decontaminate"](spark, SF_DIR).collect()}
    for r in docs.collect():
        have = f" {' '.join(re.findall(r'\w+', (r.text or '').lower()))} "
        assert found[r.doc_id] >= {i for i, words in items.items() if f" {' '.join(words)} " in have}
        assert all(f" {' '.join(items[i][2:9])} " in have for i in found[r.doc_id])


def test_language(spark, docs):
    found = QUERIES["op7_language_id"](spark, SF_DIR)
    both = docs.select("doc_id", "lang").join(found, "doc_id")
    assert both.count() == docs.count()
    for r in both.collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    assert both.where("held_out and lang = lang_pred").count() >= 0.95 * both.where("held_out").count()


def test_lm_scores(spark, docs):
    words = {r.doc_id: len(re.findall(r"\w+", (r.text or "").lower())) for r in docs.collect()}
    for r in QUERIES["op8_lm_scoring"](spark, SF_DIR).collect():
        assert r.n_tokens == words[r.doc_id] and r.log_likelihood <= 0 and (r.log_likelihood < 0) == (r.n_tokens > 0)


def test_archives(spark):
    pages = {r.page_id: (r.html or "").encode() for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    for r in QUERIES["op9_warc"](spark, SF_DIR).collect():
        assert (r.payload_bytes, r.payload_digest) == (len(pages[r.page_id]), hashlib.sha256(pages[r.page_id]).hexdigest())


def test_token_files(spark, docs):
    import numpy as np
    from tokenizers import Tokenizer

    model = Tokenizer.from_file("/opt/tokenizers/word_bpe_49k.json")
    start, wanted = 0, []
    for r in docs.orderBy("doc_id").collect():
        ids = model.encode(r.text or "", add_special_tokens=False).ids + [2]
        wanted.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert [tuple(r) for r in QUERIES["op11_token_files"](spark, SF_DIR).select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("start").collect()] == wanted


def test_periodic_runs(spark, docs):
    from test_periodic_runs import row

    found = {r.doc_id: tuple(r)[1:] for r in QUERIES["op12_periodic_runs"](spark, SF_DIR).collect()}
    some = 0
    for r in docs.collect():
        n, h = len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")), zlib.crc32(str(r.doc_id).encode())
        if n > 600:  # the search of all periods takes the square
            continue
        g = h // 10
        a = g % n if n else 0
        n_runs, best, runs, kept, _ = row(r.text, (a, 1 + (n - a) // (3 + g % 8)) if h % 10 == 0 and n else None)
        numbers = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert found[r.doc_id] == (n_runs, *numbers, runs, kept)
        some += n_runs > 0
    assert some and len(found) == docs.count()


def test_token_alignment(spark, docs):
    from test_token_alignment import brute

    rows = docs.collect()
    wanted, _ = brute([r.text for r in rows])
    found = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_token_alignment"](spark, SF_DIR).collect()}
    for r, (*numbers, groups) in zip(rows, wanted, strict=True):
        assert found[r.doc_id] == (*numbers, hashlib.sha256(groups.encode()).hexdigest() if groups else "")

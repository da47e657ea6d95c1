"""Files of token ids: round trips, order, single documents, damage."""

import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewatch.llm import token_files as tf

TEXTS = [
    None, "", " ", "Hello, World! it's 'so' ''x'' ('s) we'll x's 12ab", "ÀÉÎ Straße ΣΑΣ ﬁ İ naïve café 日本語", "<|endoftext|> x<|ENDOFTEXT|>y <|startoftext|>", "same", "same",
    "a\x1cb \x85c d é _x_ ~", "long " * 5000, "x" * 20_000, "a.b,c!? (d) [e] {f} 3.14 \t\r\n\x0b\x0c end",
]


@pytest.fixture(scope="module")
def model():
    return Tokenizer.from_file(tf.VOCABULARY)


def wanted(model, text):
    return model.encode(text or "", add_special_tokens=False).ids + [2]


def test_pieces_give_the_ids_of_whole_texts(spark, model):
    texts = TEXTS + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    found = tf.serialized(texts, tf.VOCABULARY, 2, 2)
    for text, raw in zip(texts, found, strict=True):
        assert np.frombuffer(raw, "<u2").tolist() == wanted(model, text)


@pytest.fixture(scope="module")
def written(spark):
    ids = [7, None, 3, -1, 12, 12, 5, 5, 100, 99, 98, 0]
    docs = spark.createDataFrame([(i, t, "z") for i, t in zip(ids, TEXTS, strict=True)], "doc_id long, text string, file string").repartition(3)
    folder = tf.new_folder(spark)
    return docs, folder, tf.write(docs, folder, tf.train(docs))


def test_round_trip(spark, model, written):
    docs, folder, manifest = written
    rows = tf.read(spark, folder).orderBy("start").collect()
    assert sorted([(r.doc_id, r.ids) for r in rows], key=repr) == sorted([(r.doc_id, wanted(model, r.text)) for r in docs.collect()], key=repr)
    ids = [r.doc_id for r in rows]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    start = 0
    for r in rows:
        assert (r.start, r.n_tokens) == (start, len(r.ids)) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += len(r.ids)
    assert sum(x["n_docs"] for x in manifest["files"]) == len(TEXTS) and len(manifest["files"]) > 1


def test_fetch(spark, model, written):
    docs, folder, _ = written
    asked = spark.createDataFrame([(12,), (12,), (98,), (4711,), (None,)], "doc_id long")
    found = tf.fetch(spark, folder, asked).collect()
    by_start = {r.start: r for r in tf.read(spark, folder).collect()}
    assert sorted(r.doc_id for r in found) == [12, 12, 98] and all(by_start[r.start].ids == r.ids and by_start[r.start].doc_id == r.doc_id for r in found)


def test_a_trained_dictionary_makes_short_documents_smaller(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", F.substring("text", 1, 200).alias("text"))
    sizes = {}
    for name, dictionary in (("none", b""), ("trained", tf.train(docs, size=16384))):
        folder = tf.new_folder(spark)
        manifest = tf.write(docs, folder, dictionary)
        sizes[name] = tf.index(spark, folder).agg(F.sum("length")).first()[0]
        assert tf.read(spark, folder).count() == docs.count() and Path(folder.removeprefix("file:"), f"{manifest['dictionary']}.zdict").read_bytes() == dictionary
    assert dictionary and sizes["trained"] < 0.95 * sizes["none"]


def test_other_dictionaries_are_refused(spark, written):
    _, folder, manifest = written
    root = Path(folder.removeprefix("file:"))
    other = tf.new_folder(spark)
    docs = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    own = tf.write(docs, other, b"any other bytes, taken as they are")
    (root / own["files"][0]["file"]).write_bytes(Path(other.removeprefix("file:"), own["files"][0]["file"]).read_bytes())
    store, _ = tf.file_system(folder)
    with store.open_input_file(str(root / own["files"][0]["file"])) as f, pytest.raises(ValueError, match="another dictionary"):
        tf._index(f, manifest["dictionary"])
    (root / f"{own['dictionary']}.zdict").write_bytes(b"damaged")
    with pytest.raises(ValueError, match="damaged dictionary"):
        tf.read_dictionary(folder, own["dictionary"])


def test_string_ids_and_empty_tables(spark, model):
    docs = spark.createDataFrame([("b", "x y"), ("a", "z")], "key string, body string")
    folder = tf.new_folder(spark)
    tf.write(docs, folder, tf.train(docs, id_col="key", text_col="body"), id_col="key", text_col="body")
    assert [(r.doc_id, r.ids) for r in tf.read(spark, folder).orderBy("start").collect()] == [("a", wanted(model, "z")), ("b", wanted(model, "x y"))]
    folder = tf.new_folder(spark)
    none = docs.where("key = 'q'")
    assert tf.write(none, folder, tf.train(none, id_col="key", text_col="body"), id_col="key", text_col="body")["files"] == []
    assert tf.read(spark, folder).count() == 0 and tf.fetch(spark, folder, docs, id_col="key").count() == 0

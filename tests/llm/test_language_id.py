import numpy as np
import pandas as pd
import pytest

from tidewatch.llm import language_id

SYLLABLES = {
    "de": "ung keit schaft ein ver ge ich der und lich", "en": "the ing tion and ly ed ness with of is",
    "fr": "tion eau eux ment les des oi que aire é", "es": "ción mente os as el la que ñ ado ar", "xx": "kw zq vv jj yx qw",
}


def text(lang, rng, n):
    parts = SYLLABLES[lang].split()
    return " ".join("".join(rng.choice(parts, rng.integers(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(4)
    rows = [(i, text(lang, rng, int(rng.integers(4, 60))), lang) for i, lang in enumerate(rng.choice(list(SYLLABLES), 800))]
    rows += [(900, None, "de"), (901, "", "en"), (902, "12 !? 3", "fr"), (903, text("es", rng, 20), None), (None, text("de", rng, 30), "de"), (903, text("de", rng, 20000), "de")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


@pytest.fixture(scope="module")
def model(docs):
    return language_id.fit(docs)


def test_held_out_accuracy(docs, model):
    assert model.families == ["germanic", "romance", "xx"] and model.languages["germanic"] == ["de", "en"]
    found = language_id.predict(docs, model).toPandas()
    assert len(found) == docs.count() and found.score.between(0, 1).all()
    both = found.dropna(subset="doc_id").merge(docs.toPandas().dropna(subset=["doc_id", "text"]), on="doc_id")
    test = both[both.held_out & both.lang.notna() & (both.doc_id < 800)]
    assert len(test) > 100 and (test.lang == test.lang_pred).mean() > 0.98


def test_edge_cases(docs, model):
    found = language_id.predict(docs, model).toPandas()
    odd = found[found.doc_id.isin([900, 901, 902])]
    assert set(odd.lang_pred) == {"und"} and set(odd.score) == {0.0}
    assert sorted(found[found.doc_id == 903].lang_pred) == ["de", "es"]
    assert found[found.doc_id.isna()].lang_pred.tolist() == ["de"]


def test_the_fold_is_crc32_of_the_id(spark):
    import zlib

    ids = [0, 1, 7, 123456789, -5]
    rows = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", language_id.held_out(language_id.F.col("doc_id")).alias("h")).collect()
    assert [r.h for r in rows] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in ids]


def test_a_text_is_scored_alike_alone_and_among_others(model):
    rng = np.random.default_rng(8)
    texts = [text(lang, rng, n) for lang in SYLLABLES for n in (1, 3, 400)]
    weights = model.weights.astype(np.float64)
    together = language_id.mean_weights(texts, weights)
    alone = np.concatenate([language_id.mean_weights([t], weights) for t in texts])
    assert np.abs(together - alone).max() < 1e-9
    keep, language_id.BLOCK = language_id.BLOCK, 97
    try:
        assert np.abs(language_id.mean_weights(texts, weights) - together).max() < 1e-9
    finally:
        language_id.BLOCK = keep


def test_few_languages(spark):
    one = spark.createDataFrame([(i, "ein text", "de") for i in range(20)], "doc_id long, text string, lang string")
    assert set(language_id.predict(one, language_id.fit(one)).toPandas().lang_pred) == {"de"}
    none = one.limit(0)
    assert language_id.predict(none, language_id.fit(none)).collect() == []
    assert set(language_id.predict(one, language_id.fit(none)).toPandas().lang_pred) == {"und"}
    assert isinstance(language_id.predict(one, language_id.fit(none)).toPandas(), pd.DataFrame)

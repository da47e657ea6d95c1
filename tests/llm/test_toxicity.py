import numpy as np
import pytest

from tidewatch.llm import toxicity


def corpus(n=600, seed=1):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(300)]
    bad = ["vilesome", "grimword", "hatelike"]
    rows = []
    for i in range(n):
        text = list(rng.choice(words, 40))
        toxic = int(i % 5 == 0)
        if toxic:
            for k in range(1 + (i // 5) % 4):
                text[3 * k] = bad[(i + k) % 3]
        rows.append((i, " ".join(text), toxic))
    return rows


@pytest.fixture(scope="module")
def fitted(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (5000, 1), (3, None)], "doc_id long, toxic int")
    return toxicity.fit(docs, labels)


def test_unseen_documents(spark, fitted):
    rows = corpus(400, seed=9)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    found = {r.doc_id: r for r in toxicity.score(docs, fitted).collect()}
    assert all(found[i]._toxic == bool(y) for i, _, y in rows)
    mean = [np.mean([found[i]._severity for i, _, y in rows if y and (i // 5) % 4 == k]) for k in range(4)]
    assert mean[0] < mean[1] < mean[3] and 0 <= mean[0] <= mean[3] <= 2


def test_thresholds_share_weights_and_stay_in_order():
    rng = np.random.default_rng(3)
    n, truth = 4000, np.array([2.0, -1.0, 0.5, 0.0])
    x = rng.random((n, 4)) < 0.4
    latent = x @ truth + rng.logistic(size=n)
    grades = np.searchsorted([-0.5, 0.5, 2.0], latent)
    rows, cols = np.nonzero(x)
    weights, thresholds = toxicity.fit_ordinal(rows, cols, grades, 4)
    assert np.abs(weights - truth).max() < 0.25 and np.abs(thresholds - [-0.5, 0.5, 2.0]).max() < 0.25
    assert (np.diff(thresholds) > 0).all()


def test_edge_cases(spark, fitted):
    long = "calm " * 200_000 + "grimword vilesome hatelike"
    df = spark.createDataFrame([(1, None, "a"), (2, "", "a"), (3, long, "b"), (3, long, "b"), (None, "grimword vilesome", "c")], "doc_id long, text string, _label string")
    rows = toxicity.score(df, fitted).collect()
    assert len(rows) == 5 and [r._toxic for r in rows if r.doc_id == 3] == [True, True]
    assert rows[0]._severity == rows[1]._severity < 0.5 and not rows[0]._toxic
    assert toxicity.score(df.limit(0), fitted).collect() == []


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "text"), (2, None)], "doc_id long, text string")
    for labels in ([], [(1, 0)], [(None, 1)], [(1, None)], [(2, 1)]):
        model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert {(r._severity, r._toxic) for r in toxicity.score(docs, model).collect()} == {(0.0, False)}


def test_the_sample_is_bounded(spark):
    labels = spark.range(20000).selectExpr("id AS doc_id", "cast(id % 10 = 0 AS int) AS toxic")
    sizes = {r._grade: r["count"] for r in toxicity.bounded_labels(labels, 500, "doc_id", "toxic").groupBy("_grade").count().collect()}
    assert 400 < sizes[0] < 600 and 400 < sizes[1] < 600


def test_decisions_do_not_depend_on_the_bound(spark):
    """Words that lean to one side only: where they balance, the mix of the labels decides."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(6000):
        toxic = int(i % 10 == 0)
        lean = rng.random(6) < (0.6 if toxic else 0.2)
        rows.append((i, " ".join([f"lean{k}x" for k in np.flatnonzero(lean)] + [f"w{k}" for k in rng.integers(0, 40, 5)]), toxic))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    whole, bounded = (toxicity.fit(docs, labels, max_rows=n) for n in (6000, 600))
    texts = [r[1] for r in rows]
    p, q = whole.probabilities(texts)[:, 0], bounded.probabilities(texts)[:, 0]
    assert np.mean((p >= 0.5) != (q >= 0.5)) < 0.03
    assert abs(p.mean() - 0.1) < 0.01 and abs(q.mean() - 0.1) < 0.025


def test_without_telling_words_the_mix_of_all_labels_remains(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'same words' AS text")
    labels = spark.range(4000).selectExpr("id AS doc_id", "cast(id % 10 = 0 AS int) AS toxic")
    model = toxicity.fit(docs, labels, max_rows=300)
    assert abs(model.probabilities(["same words"])[0, 0] - 0.1) < 0.03

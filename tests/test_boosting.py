"""Boosting of several classes against a search over all rows, splits and nodes in plain Python."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tidewatch.operators.boosting import SoftmaxBoostingClassifier, softmax
from tidewatch.operators.evaluation import weighted_metrics
from tidewatch.operators.training import assembled, with_score


def brute(x, y, classes, rounds, depth, step, ridge, least):
    """Scores of all rows; every value that occurs but the largest is a threshold."""
    scores = np.zeros((len(x), classes))
    for _ in range(rounds):
        chance = softmax(scores)
        added = np.zeros_like(scores)
        for c in range(classes):
            g, h = chance[:, c] - (y == c), chance[:, c] * (1 - chance[:, c])

            def grow(rows, left, c=c, g=g, h=h):
                best = None
                for f in range(x.shape[1]) if left else ():
                    for t in sorted(set(x[rows, f]))[:-1]:
                        a, b = rows[x[rows, f] <= t], rows[x[rows, f] > t]
                        if h[a].sum() < least or h[b].sum() < least:
                            continue
                        gain = 0.5 * (g[a].sum() ** 2 / (h[a].sum() + ridge) + g[b].sum() ** 2 / (h[b].sum() + ridge) - g[rows].sum() ** 2 / (h[rows].sum() + ridge))
                        if gain > 1e-12 and (best is None or gain > best[0] + 1e-9):
                            best = gain, a, b
                if best is None:
                    added[rows, c] = -step * g[rows].sum() / (h[rows].sum() + ridge)
                else:
                    grow(best[1], left - 1)
                    grow(best[2], left - 1)

            grow(np.arange(len(x)), depth)
        scores += added
    return softmax(scores)


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 12, size=(210, 3)).astype(float)
    y = ((x[:, 0] // 4 * 2 + x[:, 1] // 6 + (x[:, 2] > 9)) % 7).astype(float)
    rows = [(i, *map(float, r), float(c)) for i, (r, c) in enumerate(zip(x, y, strict=True))]
    return x, y, assembled(spark.createDataFrame(rows, "id long, a double, b double, c double, label double").repartition(3), ["a", "b", "c"])


def test_seven_classes_against_brute_force(table):
    x, y, df = table
    assert len(set(y)) == 7 or max(y) >= 5
    model = SoftmaxBoostingClassifier(maxIter=2, maxDepth=2, stepSize=0.5, minChildWeight=0.5).fit(df)
    got = {r.id: r.p for r in with_score(model.transform(df)).select("id", F.col("probability").alias("p")).collect()}
    wanted = brute(x, y, int(max(y)) + 1, 2, 2, 0.5, 1.0, 0.5)
    assert max(abs(got[i].toArray() - wanted[i]).max() for i in got) < 1e-9


def test_it_learns_and_is_saved(spark, table, tmp_path):
    _, _, df = table
    model = SoftmaxBoostingClassifier(maxIter=4, maxDepth=4, stepSize=0.8, subsamplingRate=0.9, minChildWeight=0.1).fit(df)
    scored = model.transform(df)
    assert weighted_metrics(scored, "label").first().accuracy > 0.8
    PipelineModel([model]).write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).transform(df)
    both = scored.select("id", F.col("probability").alias("p")).join(again.select("id", F.col("probability").alias("q")), "id").collect()
    assert all(r.p == r.q for r in both) and len(both) == 210


def test_missing_values_and_empty_tables(spark):
    rows = [(float(i % 5), None if i % 2 else float(i % 3), float(i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "a double, b double, label double").fillna(float("nan"), ["b"])
    df = df.withColumn("b", F.coalesce("b", F.lit(float("nan"))))
    from pyspark.ml.functions import array_to_vector

    df = df.select("label", array_to_vector(F.array("a", "b")).alias("features"))
    model = SoftmaxBoostingClassifier(maxIter=3, maxDepth=1, stepSize=0.5).fit(df)
    assert weighted_metrics(model.transform(df), "label").first().accuracy == 1.0 and model.transform(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        SoftmaxBoostingClassifier().fit(df.where("label > 5"))

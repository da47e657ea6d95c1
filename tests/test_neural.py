"""The net: gradients by differences, equal weights for any partitioning, quality next to the forest, a round trip."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from tidewatch.operators.evaluation import weighted_metrics
from tidewatch.operators.neural import Net, ReluNetClassifier
from tidewatch.operators.training import assembled, with_score


@pytest.mark.parametrize("outputs", [1, 3])
def test_gradient(outputs):
    rng = np.random.default_rng(0)
    net = Net([4, 5, 3, outputs], seed=1)
    x, y = rng.normal(size=(7, 4)), rng.integers(0, max(outputs, 2), 7)
    grad, _ = net.gradient(x, y)
    for k in range(0, len(net.theta), 3):
        step = np.zeros_like(net.theta)
        step[k] = 1e-6
        loss = [Net(net.layers, net.theta + s * step).gradient(x, y)[1] for s in (1, -1)]
        assert abs((loss[0] - loss[1]) / 2e-6 - grad[k]) < 1e-4


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 4))
    y = (x[:, 0] * x[:, 1] + 0.5 * x[:, 2] > 0).astype(float)
    rows = [(i, *map(float, r), float(c)) for i, (r, c) in enumerate(zip(x, y, strict=True))]
    return assembled(spark.createDataFrame(rows, "id long, a double, b double, c double, d double, label double"), ["a", "b", "c", "d"]).cache()


def test_weights_do_not_follow_the_partitioning(table):
    small = dict(hidden=[8], maxIter=3, batchSize=100, shards=5)
    one = ReluNetClassifier(tasks=1, **small).fit(table)
    three = ReluNetClassifier(tasks=3, **small).fit(table.repartition(5))
    assert np.allclose(one.net.theta, three.net.theta, atol=1e-9) and len(one.getOrDefault("losses")) == 3


def test_quality_and_round_trip(spark, table, tmp_path):
    train, test = table.where("id % 5 > 0"), table.where("id % 5 = 0")
    model = ReluNetClassifier(hidden=[32, 16], maxIter=25, batchSize=32, learningRate=0.01, shards=2).fit(train)
    forest = RandomForestClassifier(numTrees=50, maxDepth=10, seed=1).fit(train)
    f1 = [weighted_metrics(m.transform(test), "label").first().f1 for m in (model, forest)]
    assert f1[0] >= f1[1] - 0.01
    PipelineModel([model]).write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    pair = with_score(model.transform(test)).select("id", "score").join(with_score(again.transform(test)).select("id", F.col("score").alias("s")), "id")
    assert pair.where("score <> s").count() == 0 and pair.count() == 300


def test_several_classes_and_settings(spark, table):
    many = table.withColumn("label", F.when(F.col("a") > 0.5, 2.0).when(F.col("a") > -0.5, 1.0).otherwise(0.0))
    model = ReluNetClassifier(hidden=[16], maxIter=12, batchSize=32, learningRate=0.01, shards=2).fit(many)
    scored = model.transform(many)
    assert weighted_metrics(scored, "label").first().accuracy > 0.95 and scored.select(F.size(F.split(F.col("probability").cast("string"), ","))).first()[0] == 3
    assert scored.where("label IS NULL").count() == 0 and model.transform(many.limit(0)).count() == 0
    with pytest.raises(ValueError):
        ReluNetClassifier().fit(many.withColumn("label", F.lit(None).cast("double")))

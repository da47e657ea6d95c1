"""The saved chain in a session of its own: raw rows with text labels in, names and scores out."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from tidewatch.operators import neighbours, preparation
from tidewatch.operators.chain import fit_chain, label_names


@pytest.fixture(scope="module")
def raw(spark):
    rng = np.random.default_rng(9)
    names = ["Benign", "DoS", "PortScan"]
    rows = []
    for i in range(400):
        c = 0 if i % 10 < 7 else 1 if i % 10 < 9 else 2
        rows.append((i, None if i % 17 == 0 else float(c * 3 + rng.normal()), float(rng.normal()), float(100 * c + rng.normal(0, 5)), None if i % 50 == 49 else names[c]))
    return spark.createDataFrame(rows, "id long, near double, noise double, far double, label string")


def smoted(df, columns, label):
    return neighbours.smote(df, columns, label, ["id"]).select(*columns, label)


def test_saved_and_loaded(spark, raw, tmp_path):
    forest = RandomForestClassifier(numTrees=10, maxDepth=4, seed=1, labelCol="label_index")
    chain = fit_chain(raw.where("id % 3 > 0"), ["near", "noise", "far"], "label", forest, "DoS", k=2, balance=smoted)
    chain.write().overwrite().save(str(tmp_path / "chain"))
    other = spark.newSession()
    test = raw.where("id % 3 = 0")
    test.write.parquet(str(tmp_path / "test"))
    loaded = PipelineModel.load(str(tmp_path / "chain"))
    out = loaded.transform(other.read.parquet(str(tmp_path / "test")))
    rows = out.collect()
    here = {r.id: (r.score, r.predicted_label, r.alert) for r in chain.transform(test).collect()}
    assert {r.id: (r.score, r.predicted_label, r.alert) for r in rows} == here
    known = [r for r in rows if r.label is not None]
    assert sum(r.predicted_label == r.label for r in known) >= 0.95 * len(known) and all(r.alert == (r.score >= 0.4) for r in rows)
    assert [r.label_index for r in rows if r.label is None] == [None] * (len(rows) - len(known)) and {r.label_index for r in known} == {0.0, 1.0, 2.0}
    assert loaded.stages[1].getOrDefault("state") == chain.stages[1].getOrDefault("state") and "near" in out.columns
    # rows without the label column are scored alike
    bare = loaded.transform(test.drop("label"))
    assert {r.id: r.score for r in bare.collect()} == {i: s for i, (s, _, _) in here.items()} and "label_index" not in bare.columns


def test_labels(spark, raw):
    assert label_names(raw, "label") == ["Benign", "DoS", "PortScan"]
    with pytest.raises(ValueError):
        label_names(raw, "id", most=10)
    with pytest.raises(ValueError):
        fit_chain(raw, ["near"], "label", RandomForestClassifier(labelCol="label_index"), "Botnet")
    grouped = raw.select(preparation.binary_label(F.col("label")).alias("b")).groupBy("b").count().collect()
    assert {r.b: r["count"] for r in grouped}["Benign"] == raw.where("label = 'Benign'").count()

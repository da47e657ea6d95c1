import json

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tidewatch.operators import evaluation, explanation, neighbours, preparation, profile, sampling, training
from tidewatch.operators.neighbours import exact_neighbours, nearest_neighbours, recall, smote
from tidewatch.operators.ordering import quantiles


def brute_neighbours(ids, x, k):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    return {int(i): sorted(zip(np.round(row, 9), ids))[:k] for i, row in zip(ids, d)}


def spots(spark, width, n=400):
    rng = np.random.default_rng(width)
    x = rng.normal(size=(n, width)) * np.linspace(5, 1, width)
    # a third of the points sit almost on one spot
    x[: n // 3] = 0.01 * rng.normal(size=(n // 3, width))
    return x, spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "pid bigint, x array<double>")


@pytest.mark.parametrize("width, block", [(1, 30), (2, 400), (6, 70)])
def test_exact_neighbours(spark, width, block):
    x, df = spots(spark, width)
    got = {}
    for r in exact_neighbours(df.where("pid % 2 = 0"), df, 4, block).collect():
        got.setdefault(r.pid, []).append((round(r.dist, 9), r.nb))
    wanted = {k: v for k, v in brute_neighbours(np.arange(400), x, 4).items() if k % 2 == 0}
    assert {k: [n for _, n in sorted(v)] for k, v in got.items()} == {k: [n for _, n in v] for k, v in wanted.items()}


@pytest.mark.parametrize("width", [2, 20])
def test_recall_of_the_trees(spark, width):
    _, df = spots(spark, width, 3000)
    found = nearest_neighbours(df, 5, leaf_rows=64)
    assert found.groupBy("pid").count().where("count <> 5").isEmpty() and found.select("pid").distinct().count() == 3000
    assert recall(found, exact_neighbours(df, df, 5)).first().recall >= 0.95


def test_few_points(spark):
    x, df = spots(spark, 3, 30)
    wanted = brute_neighbours(np.arange(30), x, 4)
    for r in nearest_neighbours(df, 4).collect():
        assert wanted[r.pid][r["rank"] - 1] == (round(r.dist, 9), r.nb)
    assert nearest_neighbours(df.limit(0), 4).collect() == [] and nearest_neighbours(df.limit(1), 4).collect() == []


def shuffled(spark):
    context = spark.sparkContext._jsc.sc()
    context.listenerBus().waitUntilEmpty(30_000)
    executors = context.statusStore().executorList(False)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))


def test_vectors_do_not_go_out_with_every_pair(spark):
    joined = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rng = np.random.default_rng(11)
    x = rng.normal(size=(3000, 64)).astype("float32").astype(float)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "pid bigint, x array<double>").localCheckpoint()
    before = shuffled(spark)
    found = nearest_neighbours(df, 5).count()
    tried = shuffled(spark) - before
    # the vectors of the neighbours of each point and of those who have it as one, but not those of all pairs
    assert found == 15000 and tried < 3000 * 20_000
    exact = exact_neighbours(df, df, 5, 100).count()
    # queries and points are not dealt out again for each of 30 blocks
    assert exact == 15000 and shuffled(spark) - before - tried < 3000 * 3_000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", joined)


def test_neighbours_are_the_same_in_many_passes(spark, monkeypatch):
    _, df = spots(spark, 20, 1500)
    once = sorted(map(tuple, nearest_neighbours(df, 5, leaf_rows=64).collect()))
    monkeypatch.setattr(neighbours, "PASS_BYTES", 300_000)
    monkeypatch.setattr(neighbours, "MEET_ROWS", 300)
    monkeypatch.setattr(neighbours, "MERGE_ROWS", 300)
    assert sorted(map(tuple, nearest_neighbours(df, 5, leaf_rows=64).collect())) == once


def test_points_that_trees_do_not_find(spark):
    x = np.random.default_rng(12).normal(size=(4000, 32))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "pid bigint, x array<double>").localCheckpoint()
    found = nearest_neighbours(df, 5, leaf_rows=32, trees=2, rounds=1)
    assert recall(found, exact_neighbours(df, df, 5)).first().recall >= 0.95 and found.count() == 20000


def test_ties_and_repeated_and_missing_ids(spark):
    rows = [(i, [0.0, 0.1]) for i in range(40)] + [(7, [0.0, 0.1]), (100, [3.0, 1e300]), (None, [0.0, 0.2])]
    df = spark.createDataFrame(rows, "pid bigint, x array<double>").repartition(5)
    near = {}
    for r in sorted(nearest_neighbours(df, 4).collect()):
        near.setdefault(r.pid, []).append(r.nb)
    wanted = {i: [j for j in range(6) if j != i][:4] for i in range(40)}
    assert {k: v for k, v in near.items() if k < 100} == wanted and None not in near
    one = spark.createDataFrame([(100, [0.0, 0.3])], df.schema)
    exact = sorted(map(tuple, exact_neighbours(one, df.where("pid is null or pid > 38"), 4, 2).select("rank", "nb").collect()))
    assert exact == [(1, None), (2, 39)]


def test_smote(spark):
    rng = np.random.default_rng(0)
    rows = [(i, float(a), float(b), "rare" if i < 50 else "common") for i, (a, b) in enumerate(rng.normal(size=(230, 2)))]
    rows += [(1000 + i, 0.5, 0.5, "rare") for i in range(20)]
    df = spark.createDataFrame(rows, "id bigint, a double, b double, y string")
    out = smote(df, ["a", "b"], "y", ["id"], k=5, leaf_rows=20).collect()
    counts = {(r.y, r.synthetic): 0 for r in out}
    for r in out:
        counts[r.y, r.synthetic] += 1
    assert counts == {("rare", False): 70, ("common", False): 180, ("rare", True): 110}
    rare = np.array([[r[1], r[2]] for r in rows if r[3] == "rare"])
    for r in out:
        if r.synthetic:
            # on the line between two rows of the class
            p = np.array([r.a, r.b])
            direct = np.linalg.norm(rare[:, None] - rare[None], axis=2)
            around = np.linalg.norm(rare - p, axis=1)
            assert np.abs(around[:, None] + around[None] - direct).min() < 1e-9


def test_split_and_folds_are_exact_and_stable(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") % 10 < 7, "a").otherwise("b").alias("y"))
    results = []
    for n in (1, 17):
        split = sampling.stratified_split(df.repartition(n), "y", ["id"])
        results.append(sorted(map(tuple, split.collect())))
    assert results[0] == results[1]
    sizes = {(r.y, r.split): r["count"] for r in split.groupBy("y", "split").count().collect()}
    assert sizes == {("a", "train"): 980, ("a", "val"): 210, ("a", "test"): 210, ("b", "train"): 420, ("b", "val"): 90, ("b", "test"): 90}
    folds = sampling.stratified_folds(df, "y", ["id"], 4).groupBy("y", "fold").count().collect()
    assert len(folds) == 8 and {r["count"] for r in folds} == {350, 150}
    assert sampling.seeded_sample(df, ["id"], 50).collect() == sampling.seeded_sample(df.repartition(5), ["id"], 50).collect()


def test_quantiles_are_exact(spark):
    rng = np.random.default_rng(2)
    skewed, flat = np.exp(rng.normal(size=5000)), rng.integers(0, 3, size=5000).astype(float)
    flat[:2000] = 1.0
    df = spark.createDataFrame([(float(a), float(b), None if i % 2 else float(i)) for i, (a, b) in enumerate(zip(skewed, flat))], "a double, b double, c double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r.feature, r.prob): (r["quantile"], r.n) for r in quantiles(df, ["a", "b", "c"], probs).collect()}
    for name, x in (("a", skewed), ("b", flat), ("c", np.arange(0, 5000, 2.0))):
        for p in probs:
            assert abs(got[name, p][0] - np.quantile(x, p)) < 1e-9 and got[name, p][1] == len(x)


def test_profile(spark):
    df = spark.createDataFrame([(float(i % 7), 5.0, "x") for i in range(70)] + [(900.0, 5.0, "y")] * 2, "a double, b double, y string")
    assert {r.feature: r.n_outliers for r in profile.outlier_counts(df, ["a", "b"]).collect()} == {"a": 2}
    assert profile.duplicate_rows(df).first().n_repeats == 72 - 8
    h = profile.histogram(df, ["a", "b"], 3).orderBy("feature", "bin").collect()
    assert [r.n for r in h] == [70, 0, 2, 0, 72, 0]
    profile.check_dataset(df, "y", 72, 2, {"y"})
    for bad in (("q", 1, 1), ("y", 73, 1), ("y", 1, 3)):
        with pytest.raises(ValueError):
            profile.check_dataset(df, *bad, {"y"})


def test_scaling_and_imputation(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0), (None, 7.0), (8.0, 7.0)], "a double, b double")
    assert preparation.fill_values(df, ["a"]) == {"a": 3.0} and preparation.fill_values(df, ["a"], "mean") == {"a": 4.0}
    filled = preparation.impute(df, {"a": 3.0})
    for kind, wanted in (("standard", (np.array([1, 3, 3, 8]) - 3.75) / np.std([1, 3, 3, 8])), ("minmax", np.array([0, 2, 2, 7]) / 7)):
        scaled = preparation.scale(filled, preparation.fit_scaler(filled, ["a", "b"], kind)).collect()
        assert np.allclose(sorted(r.a for r in scaled), wanted) and {r.b for r in scaled} == {0.0}


def test_mutual_information_ranks_features(spark):
    df = spark.range(3000).select((F.col("id") % 2).alias("y"), (F.col("id") % 2 * 10 + F.col("id") % 3).alias("good"), (F.col("id") % 11).alias("bad"))
    m = {r.feature: r.mutual_info for r in preparation.mutual_information(df, ["good", "bad"], "y").collect()}
    assert abs(m["good"] - np.log(2)) < 1e-6 and m["bad"] < 0.01
    assert preparation.select_features(df, ["good", "bad"], "y", 1) == ["good"]


@pytest.fixture(scope="module")
def flows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 4))
    y = (x[:, 0] + 0.5 * x[:, 1] + 0.3 * rng.normal(size=600) > 0.5).astype(float)
    df = spark.createDataFrame([(i, *map(float, r), float(l)) for i, (r, l) in enumerate(zip(x, y))], "id bigint, a double, b double, c double, d double, y double")
    split = sampling.stratified_split(df, "y", ["id"])
    return training.assembled(split, ["a", "b", "c", "d"]).cache()


@pytest.fixture(scope="module")
def forest(flows):
    return training.base_model("random_forest", 4, 2, "y").setNumTrees(15).fit(flows.where("split = 'train'"))


def test_metrics_agree_with_the_evaluators(flows, forest):
    scored = training.with_score(forest.transform(flows.where("split <> 'train'")))
    m = evaluation.security_metrics(scored, 1.0, "y", score="score").first()
    for ours, theirs in (("accuracy", "accuracy"), ("precision", "weightedPrecision"), ("recall", "weightedRecall"), ("f1", "f1")):
        e = MulticlassClassificationEvaluator(labelCol="y", metricName=theirs)
        assert abs(m[ours] - e.evaluate(scored)) < 1e-9
    roc = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="score", numBins=0).evaluate(scored)
    assert abs(m.roc_auc - roc) < 1e-9 and m.accuracy > 0.8
    assert (m.tp + m.fp + m.fn + m.tn) == scored.count()


def test_threshold_choice(spark):
    rows = [(i % 10 / 10 + 0.05, int(i % 10 >= 4)) for i in range(100)]
    df = spark.createDataFrame(rows, "score double, label int")
    best = evaluation.recommend_threshold(evaluation.threshold_sweep(df, F.col("label") == 1, "score")).first()
    assert best.f1 == 1.0 and abs(best.threshold - 0.4) < 1e-9
    kinds = [r.kind for r in evaluation.threshold_analysis(df, F.col("label") == 1, "score").collect()]
    assert sorted(kinds) == ["detail"] * 3 + ["recommended"]


def test_search_training_and_files(spark, flows, tmp_path):
    columns = ["a", "b", "c", "d"]
    train = sampling.stratified_folds(flows.where("split = 'train'"), "y", ["id"], 2)
    spaces = {"random_forest": {"numTrees": [3, 8], "maxDepth": [3]}, "gradient_boosting": {"maxIter": [3]}}
    results = training.train_models(train, flows.where("split = 'val'"), "y", columns, spaces=spaces, folds=dict.fromkeys(spaces, 2))
    log = training.training_log(flows, results).collect()
    assert [r.model for r in log] == list(spaces) and all(r.f1 > 0.75 and r.cv_f1 > 0.7 for r in log)
    assert json.loads(log[0].best_params)["maxDepth"] == 3
    models = {n: r["model"] for n, r in results.items()}
    table = training.compare_models(models, flows.where("split = 'test'"), "y").collect()
    assert [r.model for r in table] == ["Random Forest", "Gradient Boosting"] and all(r.roc_auc > 0.8 for r in table)
    training.save_models(spark, models, columns, training.best_model(results), str(tmp_path))
    loaded, best, names = training.load_models(spark, str(tmp_path))
    assert best in loaded and names == columns
    again = training.score_batch(loaded["random_forest"], flows.drop("features"))
    assert again.where(F.col("alert") != (F.col("score") >= 0.4)).count() == 0


def test_settings_are_drawn_without_repetition():
    drawn = training.draw_settings(training.SEARCH_SPACE["random_forest"], 8)
    assert len({json.dumps(d, sort_keys=True) for d in drawn}) == 8 and drawn == training.draw_settings(training.SEARCH_SPACE["random_forest"], 8)
    assert len(training.draw_settings({"a": [1, 2]}, 8)) == 2


def test_attribution(spark, flows, forest):
    columns = ["a", "b", "c", "d"]
    rows = sampling.seeded_sample(flows.where("split = 'test'"), ["id"], 20)
    phi = explanation.attribution(forest, rows, flows.where("split = 'train'"), columns, "id", permutations=6).cache()
    assert phi.count() == 80
    top = [r.feature for r in explanation.top_features(phi, 2).collect()]
    assert top == ["a", "b"]
    scored = forest.transform(flows)
    examples = evaluation.example_rows(scored, F.col("y") == 1, F.col("prediction") == 1, "id")
    phi = explanation.attribution(forest, examples.select("id", *columns), flows.where("split = 'train'"), columns, "id", permutations=3)
    told = explanation.explain_examples(phi, examples, "id").collect()
    assert all(len(r.top_features) == 3 and "suspicion (SHAP=" in r.explanation for r in told)
    assert explanation.importance(forest, columns, spark, 1).first().feature == "a"


def test_noise(flows, forest):
    r = explanation.noise_robustness(forest, flows, ["a", "b", "c", "d"], ["id"], "y", sd=3.0).first()
    assert r.accuracy_noisy < r.accuracy_clean and r.robustness_drop_pct > 0


def test_error_advice(spark):
    df = spark.createDataFrame([(0, 1, 9.0, 1.0), (0, 0, 1.0, 1.0), (1, 1, 5.0, 2.0), (1, 0, 5.0, 2.0)], "label int, prediction int, a double, b double")
    rows = evaluation.error_analysis(df, F.col("label") == 1, F.col("prediction") == 1, ["a", "b"])
    assert [(r.feature, r.difference) for r in rows.collect()] == [("a", 8.0), ("b", 0.0)]
    assert evaluation.recommendations(rows).first().recommendation.endswith("a, b")

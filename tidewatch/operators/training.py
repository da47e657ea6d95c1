"""Training, search and comparison of detection models."""

from __future__ import annotations

import itertools
import json
import random
import time
from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, MultilayerPerceptronClassifier, OneVsRest, RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.text import title
from tidewatch.operators.boosting import SoftmaxBoostingClassifier
from tidewatch.operators.evaluation import curve_areas, curve_points, security_metrics, weighted_metrics
from tidewatch.operators.neural import ReluNetClassifier
from tidewatch.operators.preparation import Preparation
from tidewatch.session import materialize

# The searched settings of each model. An unlimited depth is the deepest Spark allows.
SEARCH_SPACE = {
    "random_forest": {"numTrees": [100, 200], "maxDepth": [10, 20, 30], "minInstancesPerNode": [2, 5]},
    "gradient_boosting": {"stepSize": [0.05, 0.1], "maxIter": [100, 200], "maxDepth": [4, 6], "subsamplingRate": [0.8, 1.0]},
    "neural_network": {"hidden": [(128, 64), (64, 32), (128,)], "maxIter": [100, 200], "tol": [1e-6, 1e-4]},
}
# The spaces of the models of this library, for ``train_models(spaces=...)``.
OWN_SPACE = {
    "relu_network": {"learningRate": [0.001, 0.0005], "batchSize": [128, 256], "alpha": [1e-4, 1e-3]},
    "softmax_boosting": {"stepSize": [0.05, 0.1], "maxIter": [100, 200], "maxDepth": [4, 6], "subsamplingRate": [0.8, 1.0]},
}
FOLDS = {"random_forest": 5, "gradient_boosting": 5, "neural_network": 3, "relu_network": 3, "softmax_boosting": 5}
DRAWS = {"random_forest": 8, "gradient_boosting": 8, "neural_network": 6, "relu_network": 6, "softmax_boosting": 8}
HIDDEN = (128, 64)


def base_model(name: str, n_features: int, n_classes: int, label: str, weight: str | None = None, seed: int = 42) -> Estimator:
    if name == "random_forest":
        model = RandomForestClassifier(labelCol=label, seed=seed)
        return model.setWeightCol(weight) if weight else model
    if name == "gradient_boosting":
        model = GBTClassifier(labelCol=label, seed=seed)
        if weight:
            model.setWeightCol(weight)
        if n_classes == 2:
            return model
        many = OneVsRest(classifier=model, labelCol=label)
        return many.setWeightCol(weight) if weight else many
    if name == "neural_network":
        layers = [n_features, *HIDDEN, n_classes]
        return MultilayerPerceptronClassifier(labelCol=label, seed=seed, layers=layers, maxIter=200)
    if name == "relu_network":
        return ReluNetClassifier(labelCol=label, seed=seed, hidden=list(HIDDEN))
    if name == "softmax_boosting":
        return SoftmaxBoostingClassifier(labelCol=label, seed=seed)
    raise ValueError(f"unknown model: {name!r}")


def draw_settings(space: dict[str, list], draws: int, seed: int = 42) -> list[dict]:
    """A seeded draw of settings without repetition."""
    names = sorted(space)
    every = [dict(zip(names, values)) for values in itertools.product(*(space[n] for n in names))]
    return random.Random(seed).sample(every, min(draws, len(every)))


def _with_settings(model: Estimator, settings: dict) -> Estimator:
    copy = model.copy()
    target = copy.getClassifier() if isinstance(copy, OneVsRest) else copy
    for name, value in settings.items():
        if name == "hidden" and target.hasParam("layers"):
            layers = target.getLayers()
            name, value = "layers", [layers[0], *value, layers[-1]]
        target.set(target.getParam(name), value)
    return copy


def assembled(df: DataFrame, columns: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol="features").transform(df)


def with_score(df: DataFrame, positive: int = 1) -> DataFrame:
    """Add ``score``, the probability of the positive class.

    A model of one classifier per class has raw scores only; their logistic values share the total.
    """
    if "probability" in df.columns:
        return df.withColumn("score", vector_to_array("probability")[positive])
    chances = F.transform(vector_to_array("rawPrediction"), lambda r: 1 / (1 + F.exp(-r)))
    total = F.aggregate("_chances", F.lit(0.0), lambda s, c: s + c)
    return df.withColumn("_chances", chances).withColumn("score", F.get("_chances", F.lit(positive)) / total).drop("_chances")


def cross_validate(
    model: Estimator, df: DataFrame, label: str, fold: str, k: int,
    balance: Callable[[DataFrame], DataFrame] | None = None,
) -> dict[str, float]:
    """Mean weighted metrics over the folds; ``balance`` is applied to each training part only."""
    parts = folds_of(df, fold, k, balance)
    rows = [weighted_metrics(model.fit(train).transform(held), label).first().asDict() for train, held in parts]
    return {name: sum(r[name] for r in rows) / k for name in rows[0]}


def folds_of(
    df: DataFrame, fold: str, k: int, balance: Callable[[DataFrame], DataFrame] | None = None
) -> list[tuple[DataFrame, DataFrame]]:
    """Training and held-out part of each fold; a balanced training part is made once and written."""
    parts = [(df.where(F.col(fold) != i), df.where(F.col(fold) == i)) for i in range(k)]
    return [(materialize(balance(train), "balanced"), held) for train, held in parts] if balance else parts


def search(
    model: Estimator, settings: list[dict], df: DataFrame, label: str, fold: str, k: int,
    balance: Callable[[DataFrame], DataFrame] | None = None, parallelism: int = 2,
) -> tuple[dict, float]:
    """The settings with the best mean F1 (the first wins on ties), and that F1."""

    parts = folds_of(df, fold, k, balance)

    def run(s):
        tried = _with_settings(model, s)
        scores = [weighted_metrics(tried.fit(train).transform(held), label).first().f1 for train, held in parts]
        return sum(scores) / k

    with ThreadPool(parallelism) as pool:
        scores = pool.map(run, settings)
    best = max(range(len(settings)), key=lambda i: (scores[i], -i))
    return settings[best], scores[best]


def validation_metrics(scored: DataFrame, label: str, n_classes: int) -> dict[str, float]:
    """Weighted metrics and ROC-AUC, for several classes one against the rest weighted by size."""
    metrics = weighted_metrics(scored, label).first().asDict()
    if n_classes == 2:
        points = curve_points(with_score(scored), F.col(label) == 1, "score")
        return {**metrics, "roc_auc": curve_areas(points).first()["roc_auc"]}
    sizes = {int(r[label]): r["n"] for r in scored.groupBy(label).agg(F.count("*").alias("n")).collect()}
    total = 0.0
    for c, n in sizes.items():
        areas = curve_areas(curve_points(with_score(scored, c), F.col(label) == c, "score")).first()
        total += areas["roc_auc"] * n
    return {**metrics, "roc_auc": total / sum(sizes.values())}


def train_models(
    train: DataFrame, val: DataFrame, label: str, columns: list[str], fold: str = "fold",
    spaces: dict[str, dict] | None = None, draws: dict[str, int] | None = None, folds: dict[str, int] | None = None,
    weight: str | None = None, balance: Callable[[DataFrame], DataFrame] | None = None, seed: int = 42,
) -> dict[str, dict]:
    """Search, fit and validate each model; ``train`` and ``val`` have ``features``, ``train`` also ``fold``."""
    spaces, draws, folds = spaces or SEARCH_SPACE, {**DRAWS, **(draws or {})}, {**FOLDS, **(folds or {})}
    # every fit and metric reads these again
    train, val = materialize(train, "train"), materialize(val, "val")
    n_classes = train.select(label).distinct().count()
    results = {}
    for name, space in spaces.items():
        k = folds[name]
        parts = train.withColumn("_fold", F.pmod(F.col(fold), F.lit(k)))
        model = base_model(name, len(columns), n_classes, label, weight, seed)
        started = time.time()
        best, _ = search(model, draw_settings(space, draws[name], seed), parts, label, "_fold", k, balance)
        fitted = _with_settings(model, best).fit(balance(train) if balance else train)
        seconds = time.time() - started
        results[name] = {
            "model": fitted,
            "best_params": best,
            "metrics": validation_metrics(fitted.transform(val), label, n_classes),
            "cv_metrics": cross_validate(model, parts, label, "_fold", k, balance),
            "training_time": seconds,
        }
    return results


def training_log(train: DataFrame, results: dict[str, dict]) -> DataFrame:
    rows = [
        (
            name, *(float(r["metrics"][m]) for m in ("accuracy", "precision", "recall", "f1", "roc_auc")),
            float(r["cv_metrics"]["accuracy"]), float(r["cv_metrics"]["f1"]), round(r["training_time"], 2),
            json.dumps(r["best_params"]),
        )
        for name, r in results.items()
    ]
    schema = (
        "model string, accuracy double, precision double, recall double, f1 double, roc_auc double, "
        "cv_accuracy double, cv_f1 double, training_time_sec double, best_params string"
    )
    return train.sparkSession.createDataFrame(rows, schema).withColumn("timestamp", F.current_timestamp())


def best_model(results: dict[str, dict]) -> str:
    """The model with the best validation F1; the first wins on ties."""
    return max(results, key=lambda n: results[n]["metrics"]["f1"])


def compare_models(models: dict[str, Model], test: DataFrame, label: str, positive: int = 1) -> DataFrame:
    """One row of rounded metrics per model."""
    parts = []
    for name, model in models.items():
        scored = model.transform(test)
        scored = with_score(scored, positive)
        row = security_metrics(scored, positive, label, "prediction", "score")
        parts.append(
            row.select(
                title(F.lit(name)).alias("model"),
                *[F.round(m, 4).alias(m) for m in ("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc")],
            )
        )
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table


def score_batch(model: Model, df: DataFrame, threshold: float = 0.4, positive: int = 1) -> DataFrame:
    """Scores and alerts at a chosen threshold."""
    return with_score(model.transform(df), positive).withColumn("alert", F.col("score") >= threshold)


def write_tables(log: DataFrame, comparison: DataFrame, folder: str) -> None:
    """The training log and the model comparison as CSV, some rows each."""
    log.coalesce(1).write.csv(f"{folder}/training_log", header=True, escape='"')
    comparison.coalesce(1).write.csv(f"{folder}/model_comparison", header=True, escape='"')


def save_models(
    spark: SparkSession, models: dict[str, Model], columns: list[str], best: str, folder: str,
    prepared: Preparation | None = None, test: DataFrame | None = None,
) -> None:
    """Every model as a pipeline with its assembler, and a one-row table of metadata.

    With ``prepared`` and ``test`` also what raw rows need before they are scored, and the held-out rows.
    """
    if prepared is not None:
        spark.createDataFrame([(prepared.to_json(),)], "value string").write.mode("overwrite").text(f"{folder}/preparation")
    if test is not None:
        test.write.mode("overwrite").parquet(f"{folder}/test")
    assembler = VectorAssembler(inputCols=columns, outputCol="features")
    for name, model in models.items():
        PipelineModel([assembler, model]).write().overwrite().save(f"{folder}/models/{name}")
    meta = spark.createDataFrame(
        [(best, list(models), columns)], "best string, models array<string>, features array<string>"
    )
    meta.write.mode("overwrite").json(f"{folder}/metadata")


def load_preparation(spark: SparkSession, folder: str) -> tuple[Preparation, DataFrame]:
    """The preparation and the held-out raw rows that were saved with the models."""
    return Preparation.from_json(spark.read.text(f"{folder}/preparation").first().value), spark.read.parquet(f"{folder}/test")


def load_models(spark: SparkSession, folder: str) -> tuple[dict[str, PipelineModel], str, list[str]]:
    meta = spark.read.json(f"{folder}/metadata").first()
    return {n: PipelineModel.load(f"{folder}/models/{n}") for n in meta["models"]}, meta["best"], list(meta["features"])

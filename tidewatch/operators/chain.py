"""From raw rows with text labels to scores with label names, as one saved pipeline.

The stages are Spark ML transformers whose parameters hold what was learned, so ``PipelineModel.load`` gives the whole chain back in any session: the label map,
fill values, shift and scale, the chosen columns, the model, and the names of what it predicts. Balancing belongs to training alone and is no stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators import preparation
from tidewatch.operators.preparation import Preparation
from tidewatch.operators.training import assembled, with_score


class LabelIndexer(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """The place of a label among the known ones, null for others; rows of a table without the label column are left as they are."""

    labels = Param(Params._dummy(), "labels", "the known labels in the order of their numbers", TypeConverters.toListString)

    def __init__(self, inputCol=None, outputCol=None, labels=None):
        super().__init__()
        if labels is not None:
            self._set(inputCol=inputCol, outputCol=outputCol, labels=list(labels))

    def _transform(self, df: DataFrame) -> DataFrame:
        if self.getInputCol() not in df.columns:
            return df
        place = F.array_position(F.array(*[F.lit(x) for x in self.getOrDefault("labels")]), F.col(self.getInputCol()).cast("string"))
        return df.withColumn(self.getOutputCol(), F.when(place > 0, (place - 1).cast("double")))


class RawFeatures(Transformer, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Raw columns filled, scaled and assembled into a vector, the raw ones left as they are."""

    state = Param(Params._dummy(), "state", "fill values, scaler and chosen columns as JSON", TypeConverters.toString)

    def __init__(self, prepared: Preparation | None = None, outputCol: str = "features"):
        super().__init__()
        if prepared is not None:
            self._set(state=prepared.to_json(), outputCol=outputCol)

    def _transform(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.functions import array_to_vector

        prepared = Preparation.from_json(self.getOrDefault("state"))
        values = []
        for c in prepared.selected:
            shift, factor = prepared.scaler[c]
            values.append((F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float(prepared.fills[c]))) - F.lit(shift)) / F.lit(factor))
        return df.withColumn(self.getOutputCol(), array_to_vector(F.array(*values)))


class NamedPrediction(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``predicted_label``, ``score`` (the chance of the positive label) and ``alert`` (the score reaches the threshold)."""

    labels = Param(Params._dummy(), "labels", "the known labels in the order of their numbers", TypeConverters.toListString)
    positive = Param(Params._dummy(), "positive", "the label whose chance is the score", TypeConverters.toString)
    threshold = Param(Params._dummy(), "threshold", "score from which a row is an alert", TypeConverters.toFloat)

    def __init__(self, labels=None, positive=None, threshold=0.4):
        super().__init__()
        if labels is not None:
            self._set(labels=list(labels), positive=positive, threshold=threshold)

    def _transform(self, df: DataFrame) -> DataFrame:
        labels = self.getOrDefault("labels")
        scored = with_score(df, labels.index(self.getOrDefault("positive")))
        name = F.get(F.array(*[F.lit(x) for x in labels]), F.col("prediction").cast("int"))
        return scored.withColumn("predicted_label", name).withColumn("alert", F.col("score") >= self.getOrDefault("threshold"))


def label_names(df: DataFrame, label: str, most: int = 1000) -> list[str]:
    """The sorted labels of a table, which must be no more than ``most``."""
    found = [r[0] for r in df.where(F.col(label).isNotNull()).select(F.col(label).cast("string")).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{label} has more than {most} values")
    return sorted(found)


def fit_chain(
    train: DataFrame, columns: list[str], label: str, model: Estimator, positive: str, k: int = 35, strategy: str = "median", kind: str = "standard",
    method: str = "neighbours", balance: Callable[[DataFrame, list[str], str], DataFrame] | None = None, threshold: float = 0.4,
) -> PipelineModel:
    """Learn the whole chain from raw rows: label map, preparation, model.

    ``model`` reads ``features`` and ``label_index``. ``balance`` gets the prepared training rows (the chosen columns and ``label_index``), the columns and the label, and
    gives rows of the same columns; it is for training only. Rows without a label are left out.
    """
    labels = label_names(train, label)
    if positive not in labels:
        raise ValueError(f"no row has the label {positive!r}")
    indexer = LabelIndexer(label, "label_index", labels)
    rows = indexer.transform(train.where(F.col(label).isNotNull()))
    prepared = preparation.prepare(rows.select(*columns, "label_index"), columns, "label_index", k, strategy, kind, method=method)
    features = RawFeatures(prepared)
    if balance is None:
        ready = features.transform(rows)
    else:
        known = {c: prepared.scaler[c] for c in prepared.selected}
        scaled = preparation.scale(preparation.impute(rows, {c: prepared.fills[c] for c in known}), known)
        ready = assembled(balance(scaled, prepared.selected, "label_index"), prepared.selected)
    return PipelineModel([indexer, features, model.copy().setLabelCol("label_index").fit(ready) if hasattr(model, "setLabelCol") else model.fit(ready), NamedPrediction(labels, positive, threshold)])

"""Boosted trees for several classes: softmax gradients, one tree a class and round, splits from histograms.

Values are binned once, at quantiles. For each level of a round every task sums the gradients of its rows by (class, node, feature, bin) with numpy, the sums are added over
the tasks, and the driver picks the best split of each node from them: what travels is classes x nodes x features x bins, whatever the number of rows.
The scores of the rows are written after each round, so a lost executor costs no more than a job.

A split sends values at or below its threshold to the left; null and NaN go to the right. The gain of a split is that of second-order boosting with a
ridge term, a leaf holds the Newton step. Ties go to the smallest feature and threshold.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasSeed, HasStepSize
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.session import materialize

# a tree is a list of nodes: (feature, bin, left, right) of a split, or (-1, value, 0, 0) of a leaf
Tree = list[tuple]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def descend(tree: Tree, binned: np.ndarray) -> np.ndarray:
    """The node that each row reaches; nodes to the left hold bins up to that of the split."""
    at = np.zeros(len(binned), np.int64)
    feature, cut, left, right = (np.array([n[k] for n in tree]) for k in range(4))
    while True:
        inner = feature[at] >= 0
        if not inner.any():
            return at
        rows = np.flatnonzero(inner)
        own = at[rows]
        at[rows] = np.where(binned[rows, feature[own]] <= cut[own], left[own], right[own]).astype(np.int64)


def best_split(grad: np.ndarray, hess: np.ndarray, ridge: float, least: float, gain_floor: float) -> tuple[float, int, int] | None:
    """(gain, feature, bin) of the best split of one node, from sums by (feature, bin); the last bin holds what is missing."""
    left_g, left_h = np.cumsum(grad, axis=1)[:, :-1], np.cumsum(hess, axis=1)[:, :-1]
    total_g, total_h = grad[0].sum(), hess[0].sum()
    right_g, right_h = total_g - left_g, total_h - left_h
    gain = 0.5 * (left_g**2 / (left_h + ridge) + right_g**2 / (right_h + ridge) - total_g**2 / (total_h + ridge))
    gain = np.where((left_h >= least) & (right_h >= least), gain, -np.inf)
    feature, cut = np.unravel_index(np.argmax(np.round(gain, 12)), gain.shape)
    return (float(gain[feature, cut]), int(feature), int(cut)) if gain[feature, cut] > gain_floor else None


class _BoostParams(HasFeaturesCol, HasLabelCol, HasMaxIter, HasSeed, HasStepSize):
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of splits", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature", TypeConverters.toInt)
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "share of rows of each round", TypeConverters.toFloat)
    ridge = Param(Params._dummy(), "ridge", "added to the sum of second derivatives", TypeConverters.toFloat)
    minChildWeight = Param(Params._dummy(), "minChildWeight", "least sum of second derivatives of a side", TypeConverters.toFloat)
    minGain = Param(Params._dummy(), "minGain", "gain that a split must exceed", TypeConverters.toFloat)


class SoftmaxBoostingClassifier(_BoostParams, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Classes are labels 0, 1, ...; rows without a label are left out."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", maxIter=100, stepSize=0.1, maxDepth=4, maxBins=64, subsamplingRate=1.0, ridge=1.0, minChildWeight=1.0, minGain=0.0, seed=42):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(maxIter=100, stepSize=0.1, maxDepth=4, maxBins=64, subsamplingRate=1.0, ridge=1.0, minChildWeight=1.0, minGain=0.0, seed=42)

    def _fit(self, df: DataFrame) -> SoftmaxBoostingModel:
        p = {x.name: self.getOrDefault(x) for x in self.params}
        x = vector_to_array(F.col(p["featuresCol"]))
        rows = df.where(F.col(p["labelCol"]).isNotNull()).select(x.alias("x"), F.col(p["labelCol"]).cast("long").alias("y"))
        about = rows.agg(F.max("y").alias("top"), F.max(F.size("x")).alias("width")).first()
        if about["top"] is None:
            raise ValueError("no rows with a label")
        width, classes = about["width"], max(about["top"] + 1, 2)
        probs = [i / p["maxBins"] for i in range(1, p["maxBins"])]
        value = [F.when(~F.isnan(F.get("x", F.lit(i))), F.get("x", F.lit(i))) for i in range(width)]
        found = rows.agg(*[F.percentile_approx(v, probs).alias(f"q{i}") for i, v in enumerate(value)]).first()
        edges = [sorted(set(q or [])) for q in found]
        data = materialize(rows.mapInArrow(_binned(edges, classes, p["seed"]), "binned binary, y long, h long, scores binary"), "boosting")
        trees: list[list[Tree]] = []
        for turn in range(p["maxIter"]):
            grown: list[Tree] = [[(-1, 0.0, 0, 0)] for _ in range(classes)]
            open_: list[list[int]] = [[0] for _ in range(classes)]
            for level in range(p["maxDepth"] + 1):
                sums = _sums(data, grown, open_, edges, classes, turn, p)
                for c in range(classes):
                    ahead = []
                    for node in open_[c]:
                        grad, hess = sums.get((c, node), (None, None))
                        if grad is None:
                            continue
                        leaf = (-1, -p["stepSize"] * float(grad[0].sum() / (hess[0].sum() + p["ridge"])), 0, 0)
                        split = best_split(grad, hess, p["ridge"], p["minChildWeight"], p["minGain"]) if level < p["maxDepth"] else None
                        grown[c][node] = leaf
                        if split:
                            left = len(grown[c])
                            grown[c][node] = (split[1], split[2], left, left + 1)
                            grown[c] += [(-1, 0.0, 0, 0), (-1, 0.0, 0, 0)]
                            ahead += [left, left + 1]
                    open_[c] = ahead
                if not any(open_):
                    break
            trees.append(grown)
            if all(len(t) == 1 and t[0][1] == 0.0 for t in grown):
                break
            data = materialize(data.mapInArrow(_stepped(grown, classes, width), "binned binary, y long, h long, scores binary"), "boosting")
        return self._copyValues(SoftmaxBoostingModel(json.dumps({"classes": classes, "edges": edges, "trees": trees})))


def _digitized(x: np.ndarray, edges: list[list[float]]) -> np.ndarray:
    """The bin of each value: the number of edges below it, and one beyond the last bin for missing ones."""
    out = np.empty(x.shape, np.int16)
    for i, e in enumerate(edges):
        out[:, i] = np.where(np.isnan(x[:, i]), len(e) + 1, np.searchsorted(np.array(e, float), x[:, i], side="left"))
    return out


def _binned(edges: list[list[float]], classes: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if n:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, len(edges))
                binned = _digitized(x, edges)
                h = pd.util.hash_array(np.array([b.tobytes().hex() for b in binned], dtype=object), categorize=False) ^ np.uint64(seed)
                zero = np.zeros(classes).tobytes()
                yield pa.RecordBatch.from_pydict({"binned": pa.array([b.tobytes() for b in binned], pa.binary()), "y": batch.column("y"), "h": pa.array(h.view(np.int64)), "scores": pa.array([zero] * n, pa.binary())})

    return run


def _arrays(batch: pa.RecordBatch, width: int, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n = batch.num_rows
    binned = np.frombuffer(b"".join(batch.column("binned").to_pylist()), np.int16).reshape(n, width)
    scores = np.frombuffer(b"".join(batch.column("scores").to_pylist())).reshape(n, classes)
    return binned, batch.column("y").to_numpy(), batch.column("h").to_numpy().view(np.uint64), scores


def _sums(data: DataFrame, grown: list[Tree], open_: list[list[int]], edges: list[list[float]], classes: int, turn: int, p: dict) -> dict:
    """Sums of gradients and second derivatives by (feature, bin) for each open (class, node)."""
    width, bins = len(edges), max(len(e) for e in edges) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {(c, node): np.zeros((2, width, bins)) for c in range(classes) for node in open_[c]}
        for batch in batches:
            if not batch.num_rows:
                continue
            binned, y, h, scores = _arrays(batch, width, classes)
            if p["subsamplingRate"] < 1:
                own = (h * np.uint64(0x9E3779B97F4A7C15) + np.uint64(turn) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(11)
                kept = own / 2.0**53 < p["subsamplingRate"]
                binned, y, scores = binned[kept], y[kept], scores[kept]
            if not len(y):
                continue
            chance = softmax(scores)
            place = np.arange(width) * bins + binned
            for c in range(classes):
                if not open_[c]:
                    continue
                grad, hess = chance[:, c] - (y == c), chance[:, c] * (1 - chance[:, c])
                at = descend(grown[c], binned)
                for node in open_[c]:
                    rows = np.flatnonzero(at == node)
                    for k, values in enumerate((grad, hess)):
                        totals[c, node][k] += np.bincount(place[rows].ravel(), weights=np.repeat(values[rows], width), minlength=width * bins).reshape(width, bins)
        keys = [k for k, t in totals.items() if t[1].any()]
        yield pa.RecordBatch.from_pydict({"c": pa.array([c for c, _ in keys], pa.int32()), "node": pa.array([n for _, n in keys], pa.int32()), "sums": pa.array([totals[k].ravel().tolist() for k in keys], pa.list_(pa.float64()))})

    parts = data.mapInArrow(run, "c int, node int, sums array<double>").select("c", "node", F.posexplode("sums").alias("i", "s")).where("s <> 0")
    added = parts.groupBy("c", "node", "i").agg(F.sum("s").alias("s")).toPandas()  # classes x nodes x features x bins rows
    out = {}
    for (c, node), rows in added.groupby(["c", "node"]):
        both = np.zeros(2 * width * bins)
        both[rows["i"].to_numpy()] = rows["s"].to_numpy()
        out[int(c), int(node)] = tuple(both.reshape(2, width, bins))
    return out


def _stepped(grown: list[Tree], classes: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                binned, _, _, scores = _arrays(batch, width, classes)
                after = scores + _raw([grown], binned, classes)
                yield batch.set_column(batch.schema.get_field_index("scores"), "scores", pa.array([s.tobytes() for s in after], pa.binary()))

    return run


def _raw(trees: list[list[Tree]], binned: np.ndarray, classes: int) -> np.ndarray:
    out = np.zeros((len(binned), classes))
    for turn in trees:
        for c, tree in enumerate(turn):
            out[:, c] += np.array([n[1] if n[0] < 0 else 0.0 for n in tree])[descend(tree, binned)]
    return out


class SoftmaxBoostingModel(_BoostParams, Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability`` and ``prediction``. Its trees are a parameter, so it is saved like any other stage."""

    state = Param(Params._dummy(), "state", "classes, edges of bins and trees as JSON", TypeConverters.toString)

    def __init__(self, state=None):
        super().__init__()
        if state is not None:
            self._set(state=state)

    def _transform(self, df: DataFrame) -> DataFrame:
        own = json.loads(self.getOrDefault("state"))

        @F.pandas_udf("array<double>")
        def chances(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            return pd.Series(list(softmax(_raw(own["trees"], _digitized(np.stack(x.to_numpy()).astype(float), own["edges"]), own["classes"]))))

        scored = df.withColumn("_chances", chances(vector_to_array(F.col(self.getOrDefault("featuresCol")))))
        best = F.array_position("_chances", F.array_max("_chances")) - 1
        return scored.withColumn("probability", array_to_vector("_chances")).withColumn("prediction", best.cast("double")).drop("_chances")

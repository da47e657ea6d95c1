"""A feed-forward net (rectified layers, logistic or softmax output) trained by Adam on mini-batches.

The rows are dealt into ``shards`` by a hash and stay in the tasks of one barrier stage. In an epoch every shard goes through its own mini-batches from the common weights; then all tasks
gather the weights of the shards and go on from their mean, so one small message a task and epoch travels. (A gathering of a barrier stage takes
about a second, so gradients are not gathered each step.) Which rows are a shard, a mini-batch, or held out to stop early follows from the hash of the row: the
weights do not depend on the partitioning or the number of tasks, but for the order of sums. If an executor is lost the stage starts anew and does the same.

A task holds its shards as numbers, so the rows must fit into the tasks that run at once; ``tasks`` sets how many.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import BarrierTaskContext, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The decay rates and the constant of Adam.
DECAY_1, DECAY_2, SMALL = 0.9, 0.999, 1e-8


def _mixed(h: np.ndarray, salt: int) -> np.ndarray:
    x = h.view(np.uint64) ^ np.uint64((salt * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Net:
    """Layers of weights in one flat vector, so that gradients and updates are of one array."""

    def __init__(self, layers: list[int], theta: np.ndarray | None = None, seed: int = 0):
        self.layers, self.shapes = layers, [(a, b) for a, b in zip(layers[:-1], layers[1:], strict=True)]
        if theta is None:
            rng = np.random.default_rng(seed)
            bounds = [np.sqrt(6 / (a + b)) for a, b in self.shapes]
            theta = np.concatenate([rng.uniform(-r, r, a * b + b) for r, (a, b) in zip(bounds, self.shapes, strict=True)])
        self.theta = theta

    def parts(self, theta: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        out, at = [], 0
        for a, b in self.shapes:
            out.append((theta[at : at + a * b].reshape(a, b), theta[at + a * b : at + a * b + b]))
            at += a * b + b
        return out

    def forward(self, x: np.ndarray) -> list[np.ndarray]:
        """The values of every layer; of the last one the probabilities of the classes, or of the second of two."""
        values = [x]
        layers = self.parts(self.theta)
        for k, (w, b) in enumerate(layers):
            z = values[-1] @ w + b
            if k + 1 < len(layers):
                z = np.maximum(z, 0)
            elif self.layers[-1] == 1:
                z = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            else:
                z = np.exp(z - z.max(axis=1, keepdims=True))
                z /= z.sum(axis=1, keepdims=True)
            values.append(z)
        return values

    def gradient(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
        """Sum of the gradients, and of the losses, over rows with the classes ``y``."""
        values = self.forward(x)
        out = values[-1]
        wanted = (y[:, None] == 1).astype(float) if self.layers[-1] == 1 else (y[:, None] == np.arange(self.layers[-1])).astype(float)
        safe = np.clip(out, 1e-10, 1 - 1e-10)
        loss = -np.sum(wanted * np.log(safe) + ((1 - wanted) * np.log(1 - safe) if self.layers[-1] == 1 else 0))
        grad, parts, layers = out - wanted, [], self.parts(self.theta)
        for k in range(len(layers) - 1, -1, -1):
            parts.append(np.concatenate(((values[k].T @ grad).ravel(), grad.sum(axis=0))))
            if k:
                grad = (grad @ layers[k][0].T) * (values[k] > 0)
        return np.concatenate(parts[::-1]), float(loss)

    def penalty(self) -> np.ndarray:
        """The weights, with zeros for the biases."""
        return np.concatenate([np.concatenate((w.ravel(), np.zeros_like(b))) for w, b in self.parts(self.theta)])

    def classes(self, x: np.ndarray) -> np.ndarray:
        out = self.forward(x)[-1]
        return (out[:, 0] > 0.5).astype(int) if self.layers[-1] == 1 else out.argmax(axis=1)


class _NetParams(HasFeaturesCol, HasLabelCol, HasMaxIter, HasSeed):
    hidden = Param(Params._dummy(), "hidden", "sizes of the hidden layers", TypeConverters.toListInt)
    learningRate = Param(Params._dummy(), "learningRate", "step size of Adam", TypeConverters.toFloat)
    batchSize = Param(Params._dummy(), "batchSize", "rows of a mini-batch", TypeConverters.toInt)
    alpha = Param(Params._dummy(), "alpha", "weight of the squared weights", TypeConverters.toFloat)
    tol = Param(Params._dummy(), "tol", "least gain in held-out accuracy that counts", TypeConverters.toFloat)
    patience = Param(Params._dummy(), "patience", "epochs without gain before the end", TypeConverters.toInt)
    heldOut = Param(Params._dummy(), "heldOut", "share of rows held out", TypeConverters.toFloat)
    shards = Param(Params._dummy(), "shards", "parts of the rows whose weights are averaged after each epoch", TypeConverters.toInt)
    tasks = Param(Params._dummy(), "tasks", "tasks of the barrier stage; 0 takes one a shard, as far as they run at once", TypeConverters.toInt)


class ReluNetClassifier(_NetParams, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Classes are labels 0, 1, ...; rows without a label are left out."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", hidden=(128, 64), maxIter=200, learningRate=0.001, batchSize=200, alpha=1e-4, tol=1e-4, patience=10, heldOut=0.1, shards=4, tasks=0, seed=42):
        super().__init__()
        self._set(**{k: list(v) if k == "hidden" else v for k, v in self._input_kwargs.items()})
        self._setDefault(hidden=[128, 64], maxIter=200, learningRate=0.001, batchSize=200, alpha=1e-4, tol=1e-4, patience=10, heldOut=0.1, shards=4, tasks=0, seed=42)

    def _fit(self, df: DataFrame) -> ReluNetModel:
        p = {x.name: self.getOrDefault(x) for x in self.params}
        x = vector_to_array(F.col(p["featuresCol"]))
        rows = df.where(F.col(p["labelCol"]).isNotNull()).select(x.alias("x"), F.col(p["labelCol"]).cast("long").alias("y")).withColumn("h", F.xxhash64(F.lit(p["seed"]), "x", "y"))
        about = rows.agg(F.count(F.lit(1)).alias("n"), F.max("y").alias("top"), F.max(F.size("x")).alias("width")).first()
        if not about["n"]:
            raise ValueError("no rows with a label")
        outputs = max(about["top"] + 1, 2)
        layers = [about["width"], *p["hidden"], 1 if outputs == 2 else outputs]
        tasks = p["tasks"] or min(p["shards"], df.sparkSession.sparkContext.defaultParallelism)
        dealt = rows.withColumn("shard", F.pmod("h", F.lit(p["shards"])).cast("int")).repartition(tasks, "shard")
        fitted = dealt.mapInArrow(_train(layers, about["n"], p), "theta array<double>, losses array<double>, scores array<double>", barrier=True).collect()[0]  # one row
        return self._copyValues(ReluNetModel(layers, fitted["theta"], fitted["losses"], fitted["scores"]))


def _train(layers: list[int], n_rows: int, p: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get()
        xs, ys, hs = [], [], []
        for batch in batches:
            if batch.num_rows:
                xs.append(batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, layers[0]))
                ys.append(batch.column("y").to_numpy())
                hs.append(batch.column("h").to_numpy())
        x, y, h = (np.concatenate(v) if v else e for v, e in ((xs, np.zeros((0, layers[0]))), (ys, np.zeros(0, np.int64)), (hs, np.zeros(0, np.int64))))

        def gathered(values: np.ndarray) -> np.ndarray:
            """The sum over all tasks, in the same order everywhere."""
            told = context.allGather(base64.b64encode(values.tobytes()).decode())
            return np.sum([np.frombuffer(base64.b64decode(t)) for t in told], axis=0)

        held = _mixed(h, 1) / 2.0**64 < p["heldOut"]
        shard = (h % p["shards"]).astype(np.int64)
        own = [np.flatnonzero(~held & (shard == k)) for k in range(p["shards"])]
        net = Net(layers, seed=p["seed"])
        own = [(r, np.zeros_like(net.theta), np.zeros_like(net.theta), [0]) for r in own if len(r)]  # rows, moments, steps
        best, best_theta, stale, losses, scores = -np.inf, net.theta, 0, [], []
        for epoch in range(p["maxIter"] + 1):
            right, start, last = float((net.classes(x[held]) == y[held]).sum()) if held.any() else 0.0, net.theta, epoch == p["maxIter"]
            total, loss = np.zeros_like(net.theta), 0.0
            for rows, m, v, steps in own if not last else ():
                net.theta = start
                n_batches = -(-len(rows) // p["batchSize"])
                place = (_mixed(h[rows], epoch + 2) % np.uint64(n_batches)).astype(np.int64)
                for k in range(n_batches):
                    some = rows[place == k]
                    if not len(some):
                        continue
                    grad, more = net.gradient(x[some], y[some])
                    grad, loss, steps[0] = (grad + p["alpha"] * net.penalty()) / len(some), loss + more, steps[0] + 1
                    m += (1 - DECAY_1) * (grad - m)
                    v += (1 - DECAY_2) * (grad**2 - v)
                    net.theta = net.theta - p["learningRate"] * np.sqrt(1 - DECAY_2 ** steps[0]) / (1 - DECAY_1 ** steps[0]) * m / (np.sqrt(v) + SMALL)
                total += len(rows) * net.theta
            sums = gathered(np.concatenate((total, [float(sum(len(r) for r, *_ in own)), loss, right, float(held.sum())])))
            n, loss, right, n_held = sums[-4:]
            # the score is that of the weights the epoch began with
            score = right / n_held if n_held else -losses[-1] if losses else -np.inf
            scores.append(score)
            stale = 0 if score > best + p["tol"] else stale + 1
            if score > best:
                best, best_theta = score, start
            if last or stale >= p["patience"] or not n:
                break
            losses.append(loss / n)
            net.theta = sums[:-4] / n
        if context.partitionId() == 0:
            yield pa.RecordBatch.from_pydict({"theta": [best_theta.tolist()], "losses": [losses], "scores": [scores]})

    return run


class ReluNetModel(_NetParams, Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability`` and ``prediction``. Its weights are parameters, so it is saved like any other stage."""

    layers = Param(Params._dummy(), "layers", "sizes of all layers", TypeConverters.toListInt)
    theta = Param(Params._dummy(), "theta", "weights and biases, layer by layer", TypeConverters.toListFloat)
    losses = Param(Params._dummy(), "losses", "mean loss of each epoch", TypeConverters.toListFloat)
    scores = Param(Params._dummy(), "scores", "held-out accuracy before each epoch and after the last", TypeConverters.toListFloat)

    def __init__(self, layers=None, theta=None, losses=None, scores=None):
        super().__init__()
        if layers is not None:
            self._set(layers=list(layers), theta=list(theta), losses=list(losses), scores=list(scores))

    @property
    def net(self) -> Net:
        return Net(self.getOrDefault("layers"), np.array(self.getOrDefault("theta")))

    def _transform(self, df: DataFrame) -> DataFrame:
        net = self.net

        @F.pandas_udf("array<double>")
        def chances(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            out = net.forward(np.stack(x.to_numpy()))[-1]
            return pd.Series(list(np.hstack((1 - out, out)) if net.layers[-1] == 1 else out))

        with_chances = df.withColumn("_chances", chances(vector_to_array(F.col(self.getOrDefault("featuresCol")))))
        best = F.array_position("_chances", F.array_max("_chances")) - 1
        return with_chances.withColumn("probability", array_to_vector("_chances")).withColumn("prediction", best.cast("double")).drop("_chances")

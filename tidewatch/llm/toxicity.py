"""Severity of toxic language by cumulative-link (proportional odds) regression on sparse text features.

One weight vector serves all thresholds: P(grade > k) = sigmoid(w.x - t_k) with t_0 < t_1 < ... The expected severity is the sum of
these probabilities. Features are the words of a text and their beginnings of 4 and 5 letters, present or not, hashed into
``2**BITS`` slots; those that tell the grades apart best are kept.

The model is fitted on at most ``max_rows`` labelled documents a grade (a share by a hash of the id, so the bound holds up to chance of a
few hundredths); a row counts as many times as its share of the grade was cut, so the model sees the mix of all labels at every size.
Scoring reads every whole text. Where labels are only clean or toxic, ``spread`` makes two grades of toxic: the
documents with more distinct telling features than the median toxic document are severe.

Defined results: null and empty texts have the severity of a text without features; rows without a label or text are not learned
from; one id with several texts or labels is learned from each; without both a clean and a toxic labelled document nothing is toxic.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import WORD, hash_strings, slices, tokens, widened

BITS = 18
PREFIXES = (4, 5)


def _slots(distinct: np.ndarray) -> np.ndarray:
    """For each distinct word the slots of the word and of its beginnings; repeated where the word is short."""
    columns = [hash_strings(np.array(["w:" + w for w in distinct], dtype=object))]
    for n in PREFIXES:
        columns.append(hash_strings(np.array([f"{n}:{w[:n]}" if len(w) > n else "w:" + w for w in distinct], dtype=object)))
    return np.stack(columns, axis=1).astype(np.uint64) & np.uint64((1 << BITS) - 1)


def _present(texts: list[str | None], known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of text and slot; only slots where ``known`` is true."""
    codes, distinct, starts = tokens([WORD.findall(t.lower()) if t else [] for t in texts])
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    slots = _slots(distinct).astype(np.int64)
    text = np.repeat(np.arange(len(texts)), np.diff(starts))
    if known is not None:
        some = known[slots].any(axis=1)[codes]
        codes, text = codes[some], text[some]
    pairs = np.unique((text[:, None] << BITS | slots[codes]).ravel())
    text, slot = pairs >> BITS, pairs & ((1 << BITS) - 1)
    if known is not None:
        text, slot = text[known[slot]], slot[known[slot]]
    return text, slot


@dataclass
class SeverityModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        """P(grade > k) of each text, one column a threshold."""
        text, slot = _present(texts, self.weights != 0)
        score = np.bincount(text, weights=self.weights[slot], minlength=len(texts))
        return 1 / (1 + np.exp(self.thresholds[None, :] - score[:, None]))


def fit_ordinal(
    rows: np.ndarray, cols: np.ndarray, grades: np.ndarray, n_cols: int, penalty: float = 0.1, steps: int = 400, counts: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and increasing thresholds of the proportional odds model, by Adam on the whole (sparse, binary) matrix.

    A row stands for ``counts`` labelled rows, by default for itself.
    """
    n, k = len(grades), int(grades.max())
    counts = np.ones(n) if counts is None else counts
    total = counts.sum()
    share = np.array([counts[grades > j].sum() / total for j in range(k)])
    free = np.log((1 - share) / share)
    free[1:] = np.log(np.maximum(np.diff(free), 1e-2))  # gaps, so that thresholds stay in order
    params = np.concatenate((np.zeros(n_cols), free))
    m, v = np.zeros_like(params), np.zeros_like(params)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    for step in range(1, steps + 1):
        weights, free = params[:n_cols], params[n_cols:]
        gaps = np.concatenate((free[:1], np.exp(free[1:])))
        bounds = np.concatenate(([-np.inf], np.cumsum(gaps), [np.inf]))
        score = np.bincount(rows, weights=weights[cols], minlength=n)
        upper, lower = sigmoid(bounds[grades + 1] - score), sigmoid(bounds[grades] - score)
        p = np.maximum(upper - lower, 1e-12)
        d_score = -(upper + lower - 1) * counts
        d_bounds = np.zeros(k)
        np.add.at(d_bounds, np.minimum(grades, k - 1), np.where(grades < k, -(upper * (1 - upper)) / p, 0) * counts)
        np.add.at(d_bounds, np.maximum(grades - 1, 0), np.where(grades > 0, lower * (1 - lower) / p, 0) * counts)
        d_free = np.cumsum(d_bounds[::-1])[::-1] * np.concatenate(([1.0], np.exp(free[1:])))
        grad = np.concatenate((np.bincount(cols, weights=d_score[rows], minlength=n_cols) + penalty * weights, d_free)) / total
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        params = params - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    free = params[n_cols:]
    return params[:n_cols], np.cumsum(np.concatenate((free[:1], np.exp(free[1:]))))


def bounded_labels(labels: DataFrame, max_rows: int, id_col: str, grade_col: str) -> DataFrame:
    """At most about ``max_rows`` labelled ids a grade, taken by a hash of the id; ``_count`` is how many rows of the grade each stands for."""
    own = labels.select(F.col(id_col).alias("_id"), F.col(grade_col).cast("int").alias("_grade")).where("_id IS NOT NULL AND _grade >= 0")
    counts = {r["_grade"]: r["count"] for r in own.groupBy("_grade").count().orderBy("_grade").limit(64).collect()}
    unit = F.pmod(F.xxhash64(F.lit(7), "_id"), F.lit(1_000_000))
    keep, stands = F.lit(False), F.lit(1.0)
    for grade, count in counts.items():
        cut = max(1, int(min(1.0, max_rows / count) * 1_000_000))
        keep = keep | ((F.col("_grade") == grade) & (unit < cut))
        stands = F.when(F.col("_grade") == grade, 1_000_000 / cut).otherwise(stands)
    return own.where(keep).withColumn("_count", stands)


def fit(
    docs: DataFrame, labels: DataFrame, grade_col: str = "toxic", spread: bool = True, max_rows: int = 8_000, max_features: int = 4_096, min_chi: float = 15.0,
    id_col: str = "doc_id", text_col: str = "text",
) -> SeverityModel:
    sample = bounded_labels(labels, max_rows, id_col, grade_col)
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text")).where("_text IS NOT NULL")
    labelled = texts.join(F.broadcast(sample), F.col("_doc") == F.col("_id")).select("_text", "_grade", "_count")  # at most max_rows a grade

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, clean, n = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64), np.zeros((2, 2))
        for batch, part in slices(batches, "_text"):
            bad = batch.column("_grade").to_numpy() > 0
            text, slot = _present(part)
            toxic += np.bincount(slot[bad[text]], minlength=1 << BITS)
            clean += np.bincount(slot[~bad[text]], minlength=1 << BITS)
            full = batch.column("_count").to_numpy()
            n += [(bad.sum(), (~bad).sum()), (full[bad].sum(), full[~bad].sum())]
        some = np.flatnonzero(toxic + clean)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, (-1, -2))), pa.array(np.append(toxic[some], n[:, 0])), pa.array(np.append(clean[some], n[:, 1]))], names=["slot", "toxic", "clean"]
        )

    counted = labelled.mapInArrow(count, "slot long, toxic double, clean double").groupBy("slot").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    table = counted.toPandas()  # at most 2**BITS + 2 rows
    total = table[table["slot"] == -1]
    n_toxic, n_clean = (int(total["toxic"].sum()), int(total["clean"].sum())) if len(total) else (0, 0)
    if not n_toxic or not n_clean:
        return SeverityModel(np.zeros(1 << BITS), np.array([np.inf]))
    full = table[table["slot"] == -2]  # of all labels
    odds = float(full["clean"].sum() / full["toxic"].sum())
    table = table[table["slot"] >= 0].sort_values("slot")
    a, b = table["toxic"].to_numpy(float), table["clean"].to_numpy(float)
    n = n_toxic + n_clean
    chance = (a + b) * n_toxic / n
    chi = (a - chance) ** 2 / np.maximum(chance, 1e-9) + (b - (a + b - chance)) ** 2 / np.maximum(a + b - chance, 1e-9)
    good = np.flatnonzero((chi > min_chi) & (a + b >= 3))  # at 15 one in ten thousand by chance
    good = good[np.argsort(-chi[good], kind="stable")[:max_features]]
    if not len(good):
        return SeverityModel(np.zeros(1 << BITS), np.array([np.log(odds)]))
    chosen = np.sort(table["slot"].to_numpy()[good])
    telling = np.zeros(1 << BITS, dtype=bool)
    telling[table["slot"].to_numpy()[good[a[good] > chance[good]]]] = True
    known = np.zeros(1 << BITS, dtype=bool)
    known[chosen] = True

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, part in slices(batches, "_text"):
            text, slot = _present(part, known)
            cuts = np.searchsorted(text, np.arange(len(part) + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_grade"), batch.column("_count"), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(slot, pa.int32()))],
                names=["_grade", "_count", "slots"],
            )

    sparse = labelled.mapInArrow(vectors, "_grade int, _count double, slots array<int>").toPandas().sort_values("_grade", kind="stable")  # chosen slots of the bounded sample
    lists = [np.asarray(x, dtype=np.int64) for x in sparse["slots"]]
    grades = sparse["_grade"].to_numpy(np.int64)
    _, grades = np.unique(grades, return_inverse=True)
    if spread and grades.max() == 1:
        dose = np.array([telling[x].sum() for x in lists])
        grades = np.where((grades == 1) & (dose > np.median(dose[grades == 1])), 2, grades)
    rows = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    cols = np.searchsorted(chosen, np.concatenate(lists) if lists else np.zeros(0, np.int64))
    weights, thresholds = fit_ordinal(rows, cols, grades, len(chosen), counts=sparse["_count"].to_numpy(float))
    full = np.zeros(1 << BITS)
    full[chosen] = weights
    return SeverityModel(full, thresholds)


def score(docs: DataFrame, model: SeverityModel, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``_severity`` (expected grade), ``_grade`` (most likely number of thresholds passed) and ``_toxic``."""
    names = docs.columns
    schema = widened(docs.schema.fields, "_severity double, _grade int, _toxic boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, text_col):
            passed = model.probabilities(texts)
            more = [pa.array(passed.sum(axis=1)), pa.array((passed >= 0.5).sum(axis=1), pa.int32()), pa.array(passed[:, 0] >= 0.5)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*names, "_severity", "_grade", "_toxic"])

    return docs.mapInArrow(run, schema)

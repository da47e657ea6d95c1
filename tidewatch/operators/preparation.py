"""Preparation of flow tables for training: derived features, labels, imputation, scaling, selection."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.information import neighbour_information
from tidewatch.operators.ordering import quantiles

# Fixed value: columns that are never features.
LABELS = {"label", "label_binary"}


def feature_columns(df: DataFrame, exclude: set[str] = LABELS) -> list[str]:
    return [c for c in df.columns if c not in exclude]


def flow_features(df: DataFrame) -> DataFrame:
    """Totals, per-packet sizes, rates and ratios of a flow; divisors are at least 1."""

    def per(top, bottom):
        return top / F.greatest(bottom, F.lit(1))

    fwd_packets, bwd_packets = F.col("total_fwd_packets"), F.col("total_bwd_packets")
    fwd_bytes, bwd_bytes = F.col("total_fwd_bytes"), F.col("total_bwd_bytes")
    packets, size, duration = fwd_packets + bwd_packets, fwd_bytes + bwd_bytes, F.col("flow_duration")
    return df.withColumns(
        {
            "total_packets": packets,
            "total_bytes": size,
            "fwd_packet_len_mean": per(fwd_bytes, fwd_packets),
            "bwd_packet_len_mean": per(bwd_bytes, bwd_packets),
            "flow_bytes_per_sec": per(size, duration) * 1e6,
            "flow_packets_per_sec": per(packets, duration) * 1e6,
            "down_up_ratio": per(bwd_bytes, fwd_bytes),
            "avg_packet_size": per(size, packets),
            "avg_fwd_segment_size": per(fwd_bytes, fwd_packets),
            "avg_bwd_segment_size": per(bwd_bytes, bwd_packets),
        }
    )


def binary_label(label: Column, benign: str = "Benign") -> Column:
    return F.when(label == benign, F.lit("Benign")).otherwise(F.lit("Attack"))


def encode_label(df: DataFrame, label: str, name: str = "label_index") -> DataFrame:
    """Add the position of the label among the sorted labels."""
    from pyspark.ml.feature import StringIndexer

    model = StringIndexer(inputCol=label, outputCol=name, stringOrderType="alphabetAsc").fit(df)
    return model.transform(df)


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def fill_values(df: DataFrame, columns: list[str], strategy: str = "median") -> dict[str, float]:
    """Median or mean of each column; a small model to keep and apply with ``impute``."""
    if strategy == "median":
        rows = quantiles(df, columns, [0.5]).select("feature", "quantile").collect()
        return {r["feature"]: r["quantile"] for r in rows}
    if strategy == "mean":
        row = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
        return {c: row[c] for c in columns if row[c] is not None}
    raise ValueError(f"unknown strategy: {strategy!r}")


def impute(df: DataFrame, values: dict[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(float(v))) for c, v in values.items()})


def fit_scaler(df: DataFrame, columns: list[str], kind: str = "standard") -> dict[str, tuple[float, float]]:
    """Shift and scale per column: mean and population deviation, or minimum and range."""
    if kind == "standard":
        pairs = [(F.avg(c), F.stddev_pop(c)) for c in columns]
    elif kind == "minmax":
        pairs = [(F.min(c), F.max(c) - F.min(c)) for c in columns]
    else:
        raise ValueError(f"unknown scaler: {kind!r}")
    row = df.agg(*[x.cast("double").alias(f"{p}{i}") for i, pair in enumerate(pairs) for p, x in zip("ab", pair)]).first()
    # a constant column is shifted only
    return {c: (row[f"a{i}"], row[f"b{i}"] or 1.0) for i, c in enumerate(columns)}


def scale(df: DataFrame, scaler: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c).cast("double") - F.lit(a)) / F.lit(b) for c, (a, b) in scaler.items()})


def bin_edges(df: DataFrame, columns: list[str], bins: int, approximate: bool = False) -> dict[str, list[float]]:
    """Inner quantile edges per column."""
    probs = [i / bins for i in range(1, bins)]
    if approximate:
        row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), probs).alias(c) for c in columns]).first()
        return {c: sorted(set(row[c] or [])) for c in columns}
    rows = quantiles(df, columns, probs).collect()
    edges: dict[str, set[float]] = {c: set() for c in columns}
    for r in rows:
        edges[r["feature"]].add(r["quantile"])
    return {c: sorted(v) for c, v in edges.items()}


def mutual_information(
    df: DataFrame, columns: list[str], label: str, bins: int = 10, approximate: bool = False
) -> DataFrame:
    """Rows of (feature, mutual_info) in nats between the binned feature and the label.

    One pass for the edges and one for the counts; what is shuffled is a row per feature, bin and
    class and task.
    """
    edges = bin_edges(df, columns, bins, approximate)

    def bin_of(c):
        return F.when(
            F.col(c).isNotNull(), sum((F.when(F.col(c) > e, 1).otherwise(0) for e in edges[c]), F.lit(0))
        ).alias(c)

    binned = df.where(F.col(label).isNotNull()).select(F.col(label).alias("_y"), *[bin_of(c) for c in columns])
    cells = (
        binned.unpivot(["_y"], columns, "feature", "bin")
        .where("bin IS NOT NULL")
        .groupBy("feature", "bin", "_y")
        .agg(F.count("*").alias("n"))
    )

    def total(*by):
        # bins times classes rows per feature
        return F.sum("n").over(Window.partitionBy(*by))

    sums = cells.select(
        "feature", "n", total("feature").alias("t"), total("feature", "bin").alias("b"), total("feature", "_y").alias("y")
    )
    term = F.col("n") / F.col("t") * F.ln(F.col("n") * F.col("t") / (F.col("b") * F.col("y")))
    return sums.groupBy("feature").agg(F.sum(term).alias("mutual_info"))


def select_features(
    df: DataFrame, columns: list[str], label: str, k: int = 35, bins: int = 10, approximate: bool = False, method: str = "bins"
) -> list[str]:
    """The k columns with the highest mutual information, in table order, by binned values or by ``neighbours``."""
    if method == "neighbours":
        scores = neighbour_information(df, columns, label)
    elif method == "bins":
        scores = mutual_information(df, columns, label, bins, approximate)
    else:
        raise ValueError(f"unknown method: {method!r}")
    best = {r["feature"] for r in scores.orderBy(F.desc("mutual_info"), "feature").limit(k).collect()}
    return [c for c in columns if c in best]


@dataclass(frozen=True)
class Preparation:
    """What was learned from the training rows: fill values, shift and scale, and the chosen columns."""

    fills: dict[str, float]
    scaler: dict[str, tuple[float, float]]
    selected: list[str]

    def to_json(self) -> str:
        return json.dumps({"fills": self.fills, "scaler": {c: list(p) for c, p in self.scaler.items()}, "selected": self.selected})

    @staticmethod
    def from_json(text: str) -> Preparation:
        d = json.loads(text)
        return Preparation(d["fills"], {c: tuple(p) for c, p in d["scaler"].items()}, d["selected"])


def prepare(
    train: DataFrame, columns: list[str], label: str, k: int = 35, strategy: str = "median", kind: str = "standard",
    bins: int = 10, approximate: bool = False, method: str = "bins",
) -> Preparation:
    """Learn from the distinct training rows: fill values, then the scaler, then the ``k`` columns that tell most."""
    rows = drop_duplicate_rows(train)
    fills = fill_values(rows, columns, strategy)
    filled = impute(rows, fills)
    scaler = fit_scaler(filled, columns, kind)
    return Preparation(fills, scaler, select_features(filled, columns, label, k, bins, approximate, method))


def apply(prepared: Preparation, df: DataFrame) -> DataFrame:
    """Raw rows filled, scaled and assembled into ``features``."""
    from pyspark.ml.feature import VectorAssembler

    known = {c: prepared.scaler[c] for c in prepared.selected}
    filled = impute(df, {c: v for c, v in prepared.fills.items() if c in known})
    return VectorAssembler(inputCols=prepared.selected, outputCol="features").transform(scale(filled, known))


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Add balanced weights: rows / (classes * rows of the class); rows without a label have none."""
    sizes = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("_n"))
    total = sizes.agg(F.struct(F.sum("_n").alias("rows"), F.count("*").alias("classes"))).scalar()
    weights = sizes.withColumn("_t", total).select(label, (F.col("_t.rows") / (F.col("_t.classes") * F.col("_n"))).alias(name))
    return df.join(weights, label, "left")

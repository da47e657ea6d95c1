"""Correlation and other moments that stay defined on constant columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def correlation_pairs(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Rows of (feature_a, feature_b, correlation) over the rows where both are present.

    Null where one side does not vary. Each task reduces its rows to one row per pair.
    """
    entries = [
        F.struct(
            F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"),
            F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y"),
        )
        for a, b in pairs
    ]
    both = df.select(F.inline(F.array(*entries)))
    present = F.col("x").isNotNull() & F.col("y").isNotNull()
    x, y = F.when(present, F.col("x")), F.when(present, F.col("y"))
    spread = F.col("_x") * F.col("_y")
    return (
        both.groupBy("feature_a", "feature_b")
        .agg(F.covar_pop(x, y).alias("_xy"), F.stddev_pop(x).alias("_x"), F.stddev_pop(y).alias("_y"))
        .select("feature_a", "feature_b", F.when(spread > 0, F.try_divide(F.col("_xy"), spread)).alias("correlation"))
    )


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """All ordered pairs; each unordered pair is computed once."""
    half = correlation_pairs(df, [(a, b) for i, a in enumerate(columns) for b in columns[i:]])
    sides = F.array(
        F.struct("feature_a", "feature_b", "correlation"),
        F.when(
            F.col("feature_a") != F.col("feature_b"),
            F.struct(F.col("feature_b").alias("feature_a"), F.col("feature_a").alias("feature_b"), "correlation"),
        ),
    )
    return half.select(F.inline(F.filter(sides, lambda s: s.isNotNull())))


def correlation_rank(df: DataFrame, target: str, columns: list[str]) -> DataFrame:
    """Features by absolute correlation with the target."""
    pairs = correlation_pairs(df, [(c, target) for c in columns if c != target])
    return pairs.select(
        F.col("feature_a").alias("feature"), F.abs("correlation").alias("abs_correlation")
    ).orderBy(F.col("abs_correlation").desc_nulls_last(), "feature")

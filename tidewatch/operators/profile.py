"""Profiles of a table: nulls, duplicates, classes, outliers, distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.ordering import quantiles, unpivot

# Outlier distance in IQRs, whisker length, histogram bins.
IQR_FACTOR = 3
WHISKER = 1.5
BINS = 12


def numeric_columns(df: DataFrame, exclude: set[str] = frozenset()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def check_dataset(df: DataFrame, label: str, min_rows: int, min_features: int, labels: set[str]) -> None:
    """Raise if the label is absent or the table is too small or too narrow."""
    if label not in df.columns:
        raise ValueError(f"label column {label!r} not found")
    n_features = len([c for c in df.columns if c not in labels])
    if n_features < min_features:
        raise ValueError(f"{n_features} features, expected at least {min_features}")
    # stops counting at the limit
    if df.limit(min_rows).count() < min_rows:
        raise ValueError(f"fewer than {min_rows} rows")


def null_counts(df: DataFrame) -> DataFrame:
    """Rows of (column, n_nulls), from one pass."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], [F.col(f"`{c}`") for c in df.columns], "column", "n_nulls")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: rows, distinct rows and repeats; nulls count as equal."""
    groups = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count("*").alias("_n"))
    return groups.agg(
        F.sum("_n").alias("n_rows"), F.count("*").alias("n_distinct"), F.sum(F.col("_n") - 1).alias("n_repeats")
    )


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows of (label, n_rows, share)."""
    total = df.agg(F.count("*")).scalar()
    return df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n_rows")).withColumn(
        "share", F.col("n_rows") / total
    )


def imbalance_ratio(df: DataFrame, label: str) -> DataFrame:
    """One row: rows of the largest and of the smallest class, and their ratio."""
    sizes = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    return sizes.agg(F.max("n").alias("largest"), F.min("n").alias("smallest"), (F.max("n") / F.min("n")).alias("ratio"))


def quartiles(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """Rows of (feature, n, q1, median, q3).

    Exact quartiles order every value; the approximate ones take a single pass.
    """
    if approximate:
        wide = df.agg(
            *[F.percentile_approx(F.col(c).cast("double"), [0.25, 0.5, 0.75]).alias(c) for c in columns],
            *[F.count(c).alias(f"_n_{c}") for c in columns],
        )
        entries = [F.struct(F.lit(c).alias("feature"), F.col(f"_n_{c}").alias("n"), F.col(c).alias("q")) for c in columns]
        rows = wide.select(F.inline(F.array(*entries)))
        return rows.select("feature", "n", *[F.col("q")[i].alias(a) for i, a in enumerate(("q1", "median", "q3"))])
    long = quantiles(df, columns, [0.25, 0.5, 0.75])
    picks = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    return long.groupBy("feature", "n").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(a) for a, p in picks.items()]
    )


def outlier_counts(df: DataFrame, columns: list[str], approximate: bool = False, box: DataFrame | None = None) -> DataFrame:
    """Rows of (feature, n_outliers): values beyond three IQRs; features without spread are left out.

    ``box`` may give the quartiles, as from merged sketches; the rows are then read once.
    """
    bounds = (quartiles(df, columns, approximate) if box is None else box).withColumn("_iqr", F.col("q3") - F.col("q1")).where("_iqr > 0")
    far = (F.col("value") < F.col("q1") - IQR_FACTOR * F.col("_iqr")) | (
        F.col("value") > F.col("q3") + IQR_FACTOR * F.col("_iqr")
    )
    # one row per feature
    return unpivot(df, columns).join(F.broadcast(bounds), "feature").groupBy("feature").agg(
        F.count_if(far).alias("n_outliers")
    )


def box_stats(df: DataFrame, columns: list[str], box: DataFrame | None = None) -> DataFrame:
    """Quartiles, whiskers (last values within 1.5 IQRs) and the number of points beyond them; ``box`` may give the quartiles."""
    box = quartiles(df, columns) if box is None else box
    reach = WHISKER * (F.col("q3") - F.col("q1"))
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    return unpivot(df, columns).where("value IS NOT NULL").join(F.broadcast(box), "feature").groupBy(
        "feature", "n", "q1", "median", "q3"
    ).agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outside"),
    )


def histogram(df: DataFrame, columns: list[str], bins: int = BINS) -> DataFrame:
    """Rows of (feature, bin, lower, upper, n); equal widths, the last bin includes its upper edge."""
    ends = df.agg(
        *[F.struct(F.min(F.col(c).cast("double")).alias("lo"), F.max(F.col(c).cast("double")).alias("hi")).alias(c) for c in columns]
    )
    ranges = ends.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"{c}.lo"), F.col(f"{c}.hi")) for c in columns]))
    ).where("lo IS NOT NULL")
    # a constant feature gets the range of one unit around it
    flat = F.col("lo") == F.col("hi")
    ranges = ranges.select(
        "feature",
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    place = F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)
    counts = (
        unpivot(df, columns)
        .where("value IS NOT NULL")
        .join(F.broadcast(ranges), "feature")
        .groupBy("feature", F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    width = (F.col("hi") - F.col("lo")) / bins
    grid = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))).select(
        "feature", "bin", (F.col("lo") + width * F.col("bin")).alias("lower"),
        (F.col("lo") + width * (F.col("bin") + 1)).alias("upper"),
    )
    return grid.join(counts, ["feature", "bin"], "left").na.fill(0, ["n"])


def variance_rank(df: DataFrame, columns: list[str], k: int = 20) -> DataFrame:
    wide = df.agg(*[F.var_samp(F.col(c).cast("double")).alias(c) for c in columns])
    return wide.unpivot([], columns, "feature", "variance").orderBy(F.col("variance").desc_nulls_last(), "feature").limit(k)


def describe(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """Rows of (feature, n, n_distinct, mean, std, min, q1, median, q3, max)."""
    long = unpivot(df, columns).where("value IS NOT NULL")
    moments = long.groupBy("feature").agg(
        F.count_distinct("value").alias("n_distinct"),
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    return quartiles(df, columns, approximate).join(moments, "feature").select(
        "feature", "n", "n_distinct", "mean", "std", "min", "q1", "median", "q3", "max"
    )

"""Distribution and relationship drift between a current and a baseline matrix."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.moments import correlation_pairs
from tidewatch.operators.ordering import running_totals, unpivot

# Compared features, related pairs and limits.
DRIFT_FEATURES = [
    "login_success_count", "login_failure_count", "unique_source_ips", "failure_ratio", "success_rate",
    "time_since_last_login_min", "dns_query_entropy", "domain_length", "bytes_transferred",
    "unique_dest_ports", "peer_deviation",
]
RELATED_PAIRS = [
    ("login_failure_count", "failure_ratio"),
    ("bytes_transferred", "unique_dest_ports"),
    ("login_success_count", "time_since_last_login_min"),
]
MEAN_SHIFT_PCT = 30
CORRELATION_SHIFT = 0.3
# a baseline mean closer to zero than this is rounding noise
NO_MEAN = 1e-9


def _exact_tail(d: float, n: int, m: int) -> float:
    """P(KS statistic >= d) for samples of n and m.

    Merging the samples walks an n x m lattice; ``inside[i]`` is the chance of having taken i steps
    of the first sample without ever reaching the distance. Only the band that is still inside is
    touched at each step.
    """
    reach = round(d * n * m)
    if reach <= 0:
        return 1.0
    inside = np.zeros(n + 2)
    inside[0] = 1.0
    low, high, lost = 0, 0, 0.0
    for step in range(n + m):
        left = n + m - step
        i = np.arange(low, high + 1)
        now = inside[low : high + 1]
        first = now * (n - i) / left
        second = now * (m - step + i) / left
        inside[low : high + 2] = 0.0
        inside[low : high + 1] += second
        inside[low + 1 : high + 2] += first
        # next i with |i*m - j*n| < reach, where i + j = step + 1
        new_low = max((((step + 1) * n - reach) // (n + m)) + 1, step + 1 - m, 0)
        new_high = min(-((-((step + 1) * n + reach)) // (n + m)) - 1, step + 1, n)
        if new_low > new_high:
            return 1.0
        for gone in (inside[low:new_low], inside[new_high + 1 : high + 2]):
            lost += gone.sum()
            gone[:] = 0.0
        low, high = new_low, new_high
    return float(min(lost, 1.0))


def ks_tail(d: float, n: int, m: int) -> float:
    """The exact tail; its work grows with n + m, so it is for small samples."""
    return float("nan") if n < 1 or m < 1 else _exact_tail(d, n, m)


@F.pandas_udf(T.DoubleType())
def _exact_p_value(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    return pd.Series([ks_tail(float(x), int(a), int(b)) for x, a, b in zip(d, n, m)])


def _limit_p_value(d: Column, n: Column, m: Column) -> Column:
    """The Kolmogorov limit of the tail with its first-order size correction."""
    n, m = n.cast("double"), m.cast("double")
    size = F.round(n * m / (n + m))
    plain = d * F.sqrt(size)
    z = plain + 1 / (6 * F.sqrt(size)) + (plain - 1) / (4 * size)

    def series(term):
        return F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0), lambda total, k: total + term(k.cast("double")))

    near = 1 - F.sqrt(2 * F.pi()) / z * series(lambda k: F.exp(-((2 * k - 1) * (2 * k - 1)) * F.pi() * F.pi() / (8 * z * z)))
    far = 2 * series(lambda k: F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2 * k * k * z * z))
    tail = F.when(plain <= 0, 1.0).when(z < 1, near).otherwise(far)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), tail))


def ks_statistics(current: DataFrame, reference: DataFrame, features: list[str]) -> DataFrame:
    """Rows of (feature, n_cur, n_ref, ks_statistic, mean_cur, mean_ref).

    Both tables are reduced to counts per value before the value order is needed.
    """
    both = unpivot(current, features).withColumn("cur", F.lit(1)).unionByName(
        unpivot(reference, features).withColumn("cur", F.lit(0))
    )
    counts = both.where("value IS NOT NULL").groupBy("feature", "value").agg(
        F.sum("cur").alias("c"), F.sum(1 - F.col("cur")).alias("r")
    )
    placed = running_totals(counts, ["feature"], ["value"], ["c", "r"])
    distance = F.abs(
        F.try_divide(F.col("cum_c"), F.col("tot_c")) - F.try_divide(F.col("cum_r"), F.col("tot_r"))
    )
    return placed.groupBy("feature").agg(
        F.sum("c").alias("n_cur"),
        F.sum("r").alias("n_ref"),
        F.max(distance).alias("ks_statistic"),
        F.try_divide(F.sum(F.col("value") * F.col("c")), F.sum("c")).alias("mean_cur"),
        F.try_divide(F.sum(F.col("value") * F.col("r")), F.sum("r")).alias("mean_ref"),
    ).where("n_cur >= 2 AND n_ref >= 2")


def drift_report(
    current: DataFrame, reference: DataFrame, features: list[str] | None = None, method: str = "limit"
) -> DataFrame:
    """Rows of (feature, ks_statistic, p_value, mean_shift_pct) and their inputs.

    The p-value is computed from three numbers per feature: by the limit law at any size, or with
    ``method="exact"`` by counting paths, which is for samples of some ten thousand rows.
    """
    if method not in ("limit", "exact"):
        raise ValueError(f"unknown method: {method!r}")
    shared = set(current.columns) & set(reference.columns)
    names = [f for f in features or DRIFT_FEATURES if f in shared]
    stats = ks_statistics(current, reference, names)
    shift = (F.col("mean_cur") - F.col("mean_ref")) / F.abs("mean_ref") * 100
    law = _exact_p_value if method == "exact" else _limit_p_value
    p_value = law(F.col("ks_statistic"), F.col("n_cur"), F.col("n_ref"))
    return stats.withColumn("p_value", p_value).withColumn(
        "mean_shift_pct", F.when(F.abs("mean_ref") >= NO_MEAN, shift)
    )


def concept_drift(
    current: DataFrame, reference: DataFrame, pairs: list[tuple[str, str]] | None = None
) -> DataFrame:
    """Rows of (feature_a, feature_b, cur_corr, ref_corr, delta) where both sides are defined."""
    shared = set(current.columns) & set(reference.columns)
    known = [p for p in pairs or RELATED_PAIRS if set(p) <= shared]
    if not known:
        schema = "feature_a string, feature_b string, cur_corr double, ref_corr double, delta double"
        return current.sparkSession.createDataFrame([], schema)
    now = correlation_pairs(current, known).withColumnRenamed("correlation", "cur_corr")
    then = correlation_pairs(reference, known).withColumnRenamed("correlation", "ref_corr")
    return (
        now.join(then, ["feature_a", "feature_b"])
        .withColumn("delta", F.col("cur_corr") - F.col("ref_corr"))
        .where("delta IS NOT NULL")
    )

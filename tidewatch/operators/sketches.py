"""Distinct counts and quantiles that add up: sketches of small parts, stored, and merged without the rows.

A distinct count is a HyperLogLog sketch of 2**bits registers: its relative standard error is at most 1.04 / sqrt(2**bits), and counts far below
the number of registers are all but exact. A quantile is a KLL sketch of size ``k``: the share of rows at or below the value it gives differs from
the wanted share by no more than ``rank_error(k)`` in 99 of 100 cases. Both are bounded in size whatever they have seen, merge in any order, and are
columns of ordinary tables, one row per key and bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.features import resolve_entity

BITS = 14
SIZE = 800


def rank_error(k: int) -> float:
    """The bound of the rank error of one quantile at 99 % confidence (a fixed law of these sketches)."""
    return 2.296 / k**0.9021


def distinct_error(bits: int) -> float:
    """The relative standard error of a distinct count."""
    return 1.04 / 2 ** (bits / 2)


def hourly_distinct(events: DataFrame, window: str, bits: int = BITS) -> DataFrame:
    """A row per (entity_label, hour_bucket) with sketches of its source addresses and destination ports."""
    ports = F.when(F.col("event_type") == "NETWORK", F.col("port"))
    return (
        events.withColumn("entity_label", resolve_entity(window)).where("entity_label IS NOT NULL").groupBy("entity_label", "hour_bucket")
        .agg(F.hll_sketch_agg("source_ip", F.lit(bits)).alias("source_ips"), F.hll_sketch_agg(ports, F.lit(bits)).alias("dest_ports"))
    )


def rolling_distinct(hourly: DataFrame, sketches: list[str], hours: int = 24, by: str = "entity_label", hour: str = "hour_bucket") -> DataFrame:
    """The hourly rows with ``<sketch>_<hours>h``: the distinct count of the hours up to and including the row's.

    The window is over the hours of one entity, which are as many as there were hours, and holds sketches only.
    """
    frame = Window.partitionBy(by).orderBy(F.unix_timestamp(hour)).rangeBetween(-(hours - 1) * 3600, 0)
    return hourly.withColumns({f"{s}_{hours}h": F.hll_sketch_estimate(F.hll_union_agg(s).over(frame)) for s in sketches})


def distinct_sketches(df: DataFrame, columns: list[str], by: list[str], bits: int = BITS) -> DataFrame:
    """A row per key with a sketch of each column, null where the column has no value."""
    return df.groupBy(*by).agg(*[F.when(F.count(c) > 0, F.hll_sketch_agg(c, F.lit(bits))).alias(c) for c in columns])


def merged_distinct(sketches: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of (feature, n_distinct) over all rows of stored sketches."""
    wide = sketches.agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in columns])
    return wide.unpivot([], columns, "feature", "n_distinct").withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0)))


def quantile_sketches(df: DataFrame, columns: list[str], by: list[str], k: int = SIZE) -> DataFrame:
    """A row per key with a sketch of the values of each column; nulls and NaN are in none."""
    def values(c: str) -> Column:
        x = F.col(f"`{c}`").cast("double")
        return F.when(~F.isnan(x), x)

    return df.groupBy(*by).agg(*[F.kll_sketch_agg_double(values(c), F.lit(k)).alias(c) for c in columns])


def merged_quantiles(sketches: DataFrame, columns: list[str], probs: list[float]) -> DataFrame:
    """Rows of (feature, n, prob, quantile) over all rows of stored sketches; a column without values has none."""
    wide = sketches.agg(*[F.kll_merge_agg_double(c).alias(c) for c in columns])
    long = wide.unpivot([], columns, "feature", "sketch").withColumn("n", F.coalesce(F.kll_sketch_get_n_double("sketch"), F.lit(0))).where("n > 0")
    found = long.withColumn("q", F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(p)) for p in probs])))
    return found.select("feature", "n", F.posexplode("q").alias("_i", "quantile")).select("feature", "n", F.get(F.array(*[F.lit(float(p)) for p in probs]), F.col("_i")).alias("prob"), "quantile")


def merged_quartiles(sketches: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of (feature, n, q1, median, q3), which the outlier counts and box plots take in place of exact ones."""
    picks = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    long = merged_quantiles(sketches, columns, list(picks.values()))
    return long.groupBy("feature", "n").agg(*[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(a) for a, p in picks.items()])


def rank_errors(df: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` with ``error``: how far the share of rows below, or at and below, each quantile is from the wanted share; 0 in between."""
    rows = found.collect()  # some quantiles a column
    x = {r["feature"]: F.col(f"`{r['feature']}`").cast("double") for r in rows}
    counts = df.agg(F.lit(0).alias("_"), *[F.count_if(x[r["feature"]] < r["quantile"]).alias(f"b{i}") for i, r in enumerate(rows)], *[F.count_if(x[r["feature"]] <= r["quantile"]).alias(f"u{i}") for i, r in enumerate(rows)]).first()
    out = [(r["feature"], r["prob"], float(r["quantile"]), max(0.0, counts[f"b{i}"] / r["n"] - r["prob"], r["prob"] - counts[f"u{i}"] / r["n"])) for i, r in enumerate(rows)]
    return df.sparkSession.createDataFrame(out, "feature string, prob double, quantile double, error double")

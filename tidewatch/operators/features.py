"""Behaviour features per entity and hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.text import pseudonymize, shannon_entropy
from tidewatch.operators.ordering import unpivot
from tidewatch.session import materialize

# Business hours 9 to 17, rolled features and window sizes.
BUSINESS_HOURS = (9, 17)
ROLLED = ["login_failure_count", "login_success_count", "bytes_transferred"]
ROLLING_ROWS = {"1h": 1, "4h": 4, "24h": 24}
KEY_COLUMNS = ["window_id", "entity_id", "entity_label", "hour"]
FEATURE_COLUMNS = [
    "window_id", "entity_id", "entity_label", "hour", "hour_of_day", "login_success_count",
    "login_failure_count", "unique_source_ips", "failure_ratio", "success_rate",
    "time_since_last_login_min", "is_business_hours", "dns_query_entropy", "domain_length",
    "bytes_transferred", "unique_dest_ports", "peer_deviation", "privacy_risk",
]


def resolve_entity(window: str) -> Column:
    if window == "user-hour":
        return F.col("user")
    if window == "host-hour":
        return F.coalesce("host", "source_ip")
    raise ValueError(f"unknown window type: {window!r}")


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def mean_entropy(domain: Column) -> Column:
    """Mean entropy at twelve digits, summed as decimals: the same in whatever order tasks finish."""
    return F.avg(F.when(domain.isNotNull(), shannon_entropy(domain)).cast("decimal(18,12)")).cast("double")


def bucket_aggregates(events: DataFrame, window: str) -> DataFrame:
    """One row per (entity, hour) with every count, sum and mean of that bucket.

    All of it merges from partial aggregates, so a bucket or entity with a third of the events is
    combined where the events are read. The time between logins needs no per-event sort: the gaps
    of a bucket add up to its last login minus the last login before it, and the latter is carried
    over the hours of an entity.
    """
    auth, network, dns = (F.col("event_type") == t for t in ("AUTH", "NETWORK", "DNS"))
    domain = F.when(dns, F.col("query_domain"))
    work = events.withColumn("entity_label", resolve_entity(window)).where("entity_label IS NOT NULL")
    login = F.when(auth, F.unix_micros("timestamp"))
    buckets = work.groupBy("entity_label", "hour_bucket").agg(
        F.count("*").alias("n_events"),
        F.count_if(auth & (F.col("status") == "SUCCESS")).alias("login_success_count"),
        F.count_if(auth & (F.col("status") == "FAILURE")).alias("login_failure_count"),
        F.count_distinct("source_ip").alias("unique_source_ips"),
        F.count_distinct(F.when(network, F.col("port"))).alias("unique_dest_ports"),
        mean_entropy(domain).alias("dns_query_entropy"),
        F.avg(F.length(domain)).alias("domain_length"),
        F.sum(F.when(network, F.col("bytes"))).alias("bytes_transferred"),
        F.count(login).alias("_logins"),
        F.min(login).alias("_first"),
        F.max(login).alias("_last"),
    )
    # hours of one entity: a bounded group
    earlier = Window.partitionBy("entity_label").orderBy("hour_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = F.max("_last").over(earlier)
    gap = F.when(
        before.isNotNull(), F.try_divide(F.col("_last") - before, F.col("_logins"))
    ).otherwise(F.try_divide(F.col("_last") - F.col("_first"), F.col("_logins") - 1))
    return buckets.withColumn("gap_min", gap / F.lit(6e7)).drop("_logins", "_first", "_last")


def peer_zscore(df: DataFrame, column: str, peers: str) -> DataFrame:
    """Add ``peer_deviation``: the population z-score of a count among rows with equal ``peers``; 0 if flat.

    The group sums are aggregated and joined back instead of windowed, so an hour in which most
    entities are active is no single sort. They are sums of whole numbers, so the result does not
    depend on the order in which tasks finish.
    """
    x = F.col(column).cast("decimal(19,0)")
    sums = df.groupBy(peers).agg(
        F.count(column).cast("decimal(19,0)").alias("_n"), F.sum(x).alias("_s"),
        F.sum((x * x).cast("decimal(38,0)")).alias("_q"),
    )
    spread = sums.select(
        peers, F.col("_n").cast("double").alias("_n"), F.col("_s").cast("double").alias("_s"),
        F.sqrt((F.col("_n") * F.col("_q") - F.col("_s") * F.col("_s")).cast("double")).alias("_d"),
    )
    z = (F.col("_n") * F.col(column) - F.col("_s")) / F.col("_d")
    return (
        df.join(spread, peers)
        .withColumn("peer_deviation", F.when(F.col("_d") > 0, z).otherwise(F.lit(0.0)))
        .drop("_n", "_s", "_d")
    )


def compute_features(
    events: DataFrame, window: str, key: bytes, include_label: bool = False
) -> DataFrame:
    """The feature matrix; ``key`` makes the pseudonyms.

    Missing login gaps take the mean of the bucket means of the whole matrix. The raw entity is
    given out only with ``include_label``.
    """
    # the matrix is far smaller than the events and is read three times below
    matrix = materialize(bucket_aggregates(events, window), "buckets")
    mean_gap = matrix.agg(F.avg("gap_min")).scalar()
    success, failure = F.col("login_success_count"), F.col("login_failure_count")
    risk = F.when(F.abs("peer_deviation") > 1e-12, F.lit("HIGH")).otherwise(
        F.lit("MEDIUM" if window == "user-hour" else "LOW")
    )
    full = (
        peer_zscore(matrix, "login_failure_count", "hour_bucket")
        .withColumns(
            {
                "hour": F.date_format("hour_bucket", "yyyy-MM-dd_HH"),
                "hour_of_day": F.hour("hour_bucket"),
                "entity_id": pseudonymize(F.col("entity_label"), key),
                "failure_ratio": _ratio(failure, success + failure),
                "success_rate": _ratio(success, F.col("n_events")),
                "time_since_last_login_min": F.coalesce("gap_min", mean_gap, F.lit(0.0)),
                "dns_query_entropy": F.coalesce("dns_query_entropy", F.lit(0.0)),
                "domain_length": F.coalesce("domain_length", F.lit(0.0)),
                "bytes_transferred": F.coalesce("bytes_transferred", F.lit(0)).cast("double"),
            }
        )
        .withColumn("is_business_hours", F.col("hour_of_day").between(*BUSINESS_HOURS))
        .withColumn("window_id", F.concat_ws("_", "hour", "entity_id"))
        .withColumn("privacy_risk", risk)
    )
    return full.select([c for c in FEATURE_COLUMNS if include_label or c != "entity_label"])


def apply_rolling(matrix: DataFrame, rolling: str, mode: str = "rows", by: str = "entity_id") -> DataFrame:
    """Trailing sums per entity over its last 1, 4 or 24 rows, or hours with ``mode='range'``."""
    if rolling not in ROLLING_ROWS:
        raise ValueError(f"unsupported rolling window: {rolling!r}")
    back = ROLLING_ROWS[rolling] - 1
    if mode == "rows":
        frame = Window.partitionBy(by).orderBy("hour").rowsBetween(-back, 0)
    elif mode == "range":
        seconds = F.unix_timestamp("hour", "yyyy-MM-dd_HH")
        frame = Window.partitionBy(by).orderBy(seconds).rangeBetween(-back * 3600, 0)
    else:
        raise ValueError(f"unknown mode: {mode!r}")
    return matrix.withColumns(
        {f"{c}_rolling_{rolling}": F.sum(F.col(c).cast("double")).over(frame) for c in ROLLED}
    )


def feature_names(matrix: DataFrame) -> list[str]:
    return [c for c in matrix.columns if c not in KEY_COLUMNS]


def feature_statistics(matrix: DataFrame) -> DataFrame:
    """Rows of (feature, n, mean, std, min, max) for the numeric features."""
    names = [f.name for f in matrix.schema if isinstance(f.dataType, T.NumericType)]
    return unpivot(matrix, names).groupBy("feature").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )


def matrix_summary(matrix: DataFrame) -> DataFrame:
    """One row: rows, entities and hours."""
    return matrix.agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("entity_id").alias("n_entities"),
        F.count_distinct("hour").alias("n_hours"),
    )

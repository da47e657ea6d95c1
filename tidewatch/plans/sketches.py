"""Queries on stored sketches, and on counts taken while a table is written."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidewatch.operators import sketches
from tidewatch.plans import inputs
from tidewatch.plans.inputs import TELEMETRY_SQL
from tidewatch.session import materialize, shared_dir
from tidewatch.sources import landing
from tidewatch.sources.telemetry import normalize_telemetry

_ITEMS = ["l_orderkey", "l_partkey", "l_suppkey"]
_PRICES = ["l_quantity", "l_extendedprice", "l_discount"]


def _folder(spark, tag):
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"


def rolling_distinct(spark, sf):
    """Distinct addresses and ports of the last 24 hours of each user, from stored hourly sketches."""
    hourly = materialize(sketches.hourly_distinct(normalize_telemetry(inputs.telemetry(spark, sf)), "user-hour"), "hourly-sketches")
    out = sketches.rolling_distinct(hourly, ["source_ips", "dest_ports"])
    return out.select("entity_label", F.date_format("hour_bucket", "yyyy-MM-dd HH:mm:ss").alias("hour"), F.col("source_ips_24h").alias("n_ips"), F.col("dest_ports_24h").alias("n_ports"))


def merged_distinct(spark, sf):
    """Distinct keys from sketches of each month, next to the exact counts; the estimate lies within four standard errors."""
    items = inputs.table(spark, sf, "lineitem")
    monthly = materialize(sketches.distinct_sketches(items.withColumn("month", F.date_trunc("month", "l_shipdate")), _ITEMS, ["month"]), "monthly-sketches")
    exact = items.agg(*[F.count_distinct(c).alias(c) for c in _ITEMS]).unpivot([], _ITEMS, "feature", "n_exact")
    near = F.abs(F.col("n_distinct") - F.col("n_exact")) <= 4 * sketches.distinct_error(sketches.BITS) * F.col("n_exact")
    return sketches.merged_distinct(monthly, _ITEMS).join(exact, "feature").select("feature", "n_exact", near.alias("near"))


def merged_quantiles(spark, sf):
    """Quantiles from sketches of each month; their rank among all rows lies within the bound."""
    items = inputs.table(spark, sf, "lineitem")
    monthly = materialize(sketches.quantile_sketches(items.withColumn("month", F.date_trunc("month", "l_shipdate")), _PRICES, ["month"]), "monthly-sketches")
    found = materialize(sketches.merged_quantiles(monthly, _PRICES, [0.01, 0.25, 0.5, 0.75, 0.99]), "quantiles")
    errors = sketches.rank_errors(items, found).withColumn("near", F.col("error") <= sketches.rank_error(sketches.SIZE))
    return found.select("feature", "prob", "n").join(errors, ["feature", "prob"]).select("feature", "prob", "n", "near")


def landed_logs(spark, sf):
    """Lines by format and outcome, counted while their events are written; what was written has as many rows."""
    folder = _folder(spark, "landed")
    counts = landing.land_logs(inputs.log_lines(spark, sf), folder, id_from=["line_id"])
    events, rejects = landing.landed_logs(spark, folder)
    written = events.groupBy("log_type").agg(F.count("*").alias("n_rows")).withColumn("outcome", F.lit("parsed")).unionByName(
        rejects.groupBy(F.col("reject_reason").alias("outcome")).agg(F.count("*").alias("n_rows")).withColumn("log_type", F.lit("unknown"))
    )
    return counts.join(written, ["log_type", "outcome"], "full").select("log_type", "outcome", "n_lines", "n_rows")


QUERIES = {f.__name__: f for f in (rolling_distinct, merged_distinct, merged_quantiles, landed_logs)}

ORACLES = {
    "rolling_distinct": f"""WITH {TELEMETRY_SQL}, hours AS (SELECT DISTINCT usr, hour_bucket FROM telemetry)
        SELECT h.usr AS entity_label, strftime(h.hour_bucket, '%Y-%m-%d %H:%M:%S') AS hour, count(DISTINCT t.source_ip) AS n_ips,
          count(DISTINCT t.port) FILTER (t.event_type = 'NETWORK') AS n_ports
        FROM hours h JOIN telemetry t ON h.usr = t.usr AND t.hour_bucket BETWEEN h.hour_bucket - INTERVAL 23 HOUR AND h.hour_bucket GROUP BY h.usr, h.hour_bucket""",
    "merged_distinct": " UNION ALL ".join(f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS n_exact, true AS near FROM lineitem" for c in _ITEMS),
    "merged_quantiles": f"""SELECT f AS feature, CAST(p AS DOUBLE) AS prob, (SELECT count(*) FROM lineitem) AS n, true AS near
        FROM (VALUES {', '.join(f"('{c}')" for c in _PRICES)}) a(f), (VALUES (0.01), (0.25), (0.5), (0.75), (0.99)) b(p)""",
    "landed_logs": f"""WITH {inputs.LOG_LINES_SQL} SELECT kind AS log_type, CASE WHEN kind = 'unknown' THEN 'unknown format' ELSE 'parsed' END AS outcome,
        count(*) AS n_lines, count(*) AS n_rows FROM lines WHERE kind <> 'comment' GROUP BY 1, 2""",
}

"""Queries that run the streaming jobs over all data that is there."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewatch.plans import inputs
from tidewatch.plans.inputs import TELEMETRY_SQL, round6, sql6
from tidewatch.plans.logs import STATUS_SQL
from tidewatch.session import materialize, shared_dir
from tidewatch.sources.telemetry import normalize_telemetry
from tidewatch.streaming import jobs


_EVENT = ["timestamp", "source_ip", "target_ip", "user", "action", "status", "log_type"]


def _event_stream(spark, sf):
    static = inputs.events(spark, sf)
    schema = inputs.table(spark, sf, "events").schema
    # a pattern of one path: it may be a file or a folder of files
    stream = spark.readStream.schema(schema).parquet(f"{sf}/events.parque[t]")
    return stream.select(*[F.col(c).cast(static.schema[c].dataType).alias(c) for c in static.columns])


def _landed(spark, sf, parts, job, tag):
    """What a job over telemetry gives when the events land in ``parts`` steps by time, with rows up to an hour out of order, and at last the ending.

    The job is started anew from its checkpoint for each step.
    """
    folder = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"
    telemetry = materialize(normalize_telemetry(inputs.telemetry(spark, sf)), "telemetry")
    arrival = F.unix_seconds("timestamp") + F.pmod(F.xxhash64("user", "timestamp"), F.lit(3600))
    low, high = telemetry.agg(F.min(arrival), F.max(arrival)).first()
    step = F.least(F.lit(parts - 1), F.floor((arrival - low) * parts / (high - low + 1)))
    out = None
    for k in range(parts + 1):
        landing = telemetry.where(step == k) if k < parts else jobs.ending(spark, telemetry.schema)
        landing.write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(telemetry.schema).parquet(f"{folder}/in")
        out = jobs.run_available(job(stream), tag, f"{folder}/job")
    return out


def stream_hourly_features(spark, sf):
    """All hours, without the approximate counts."""
    out = _landed(spark, sf, 2, lambda events: jobs.hourly_features(events, "user-hour", "2 hours"), "hourly")
    return out.select(
        F.date_format("hour_bucket", "yyyy-MM-dd HH:mm:ss").alias("hour"), "entity_label", "n_events", "login_success_count",
        "login_failure_count", "bytes_transferred", *[round6(c).alias(c) for c in ("failure_ratio", "success_rate", "domain_length")],
    )


def stream_login_gaps(spark, sf):
    """Minutes between the logins of each hour, with the state of four starts of the job."""
    out = _landed(spark, sf, 3, lambda events: jobs.login_gaps(events, "user-hour", "2 hours"), "gaps")
    return out.select(F.date_format("hour_bucket", "yyyy-MM-dd HH:mm:ss").alias("hour"), "entity_label", "logins", round6("gap_min").alias("gap_min"))


def stream_unique_events(spark, sf):
    """Events that repeat an id a moment later are dropped."""
    events = _event_stream(spark, sf).withColumn("group_id", F.floor(F.col("event_id") / 2))
    out = jobs.run_available(jobs.unique_events(events, "group_id", "ts", "60 days"), "unique")
    return out.select("group_id")


def stream_log_events(spark, sf):
    """Log lines as text files in a folder, parsed as a stream."""
    folder = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/landing-{uuid.uuid4().hex}"
    inputs.log_lines(spark, sf).select("value").write.text(folder)
    out = jobs.run_available(jobs.stream_logs(spark, folder), "logs").where("reject_reason IS NULL")
    return out.select(*_EVENT, F.count("*").over(Window.partitionBy("event_id")).alias("n_same_id"))


QUERIES = {f.__name__: f for f in (stream_hourly_features, stream_login_gaps, stream_unique_events, stream_log_events)}

ORACLES = {
    "stream_hourly_features": f"""WITH {TELEMETRY_SQL}
        SELECT strftime(hour_bucket, '%Y-%m-%d %H:%M:%S') AS hour, usr AS entity_label, count(*) AS n_events,
          count(*) FILTER (status = 'SUCCESS') AS login_success_count, count(*) FILTER (status = 'FAILURE') AS login_failure_count,
          CAST(coalesce(sum(bytes), 0) AS BIGINT) AS bytes_transferred,
          {sql6("coalesce(count(*) FILTER (status = 'FAILURE') / nullif(count(status), 0), 0)")} AS failure_ratio,
          {sql6("count(*) FILTER (status = 'SUCCESS') / count(*)")} AS success_rate,
          {sql6("coalesce(avg(length(query_domain)), 0)")} AS domain_length
        FROM telemetry GROUP BY hour_bucket, usr""",
    "stream_login_gaps": f"""WITH {TELEMETRY_SQL},
        b AS (SELECT usr, hour_bucket, count(*) AS logins, min(epoch_us(timestamp)) AS lo, max(epoch_us(timestamp)) AS hi FROM telemetry WHERE event_type = 'AUTH' GROUP BY ALL),
        g AS (SELECT *, max(hi) OVER (PARTITION BY usr ORDER BY hour_bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS past FROM b)
        SELECT strftime(hour_bucket, '%Y-%m-%d %H:%M:%S') AS hour, usr AS entity_label, logins,
          {sql6("CASE WHEN past IS NOT NULL THEN (hi - past) / logins WHEN logins > 1 THEN (hi - lo) / (logins - 1) END / 6e7::DOUBLE")} AS gap_min FROM g""",
    "stream_unique_events": "SELECT DISTINCT event_id // 2 AS group_id FROM events",
    "stream_log_events": f"WITH {inputs.LOG_LINES_SQL} SELECT * EXCLUDE (line_id), {STATUS_SQL}, 1 AS n_same_id FROM parsed",
}

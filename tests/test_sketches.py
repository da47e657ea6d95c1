"""Sketches that are stored, merged and asked, and counts that are taken while rows are written."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import profile, sketches
from tidewatch.operators.log_parsing import parse_counts, parse_lines
from tidewatch.sources import landing


def test_distinct_counts_add_up(spark, tmp_path):
    df = spark.range(60_000).select((F.col("id") % 10).alias("day"), F.pmod(F.xxhash64("id"), F.lit(20_000)).alias("a"), F.when(F.col("id") < 0, 1).alias("none"))
    for day in range(2):  # stored in two steps, as days come in
        part = df.where(F.col("day") % 2 == day)
        sketches.distinct_sketches(part, ["a", "none"], ["day"]).write.mode("append").parquet(str(tmp_path / "s"))
    found = {r.feature: r.n_distinct for r in sketches.merged_distinct(spark.read.parquet(str(tmp_path / "s")), ["a", "none"]).collect()}
    exact = df.select("a").distinct().count()
    assert abs(found["a"] - exact) <= 4 * sketches.distinct_error(sketches.BITS) * exact and found["none"] == 0


def test_rolling_counts(spark):
    def at(h, ip, port, kind="NETWORK"):
        return (f"2026-07-{20 + h // 24:02d} {h % 24:02d}:10:00", "u", ip, port, kind, "h")

    rows = [at(0, "a", 1), at(0, "b", 1), at(1, "a", 2), at(23, "c", 3), at(24, "c", 4, "AUTH"), at(30, None, 5)]
    events = spark.createDataFrame(rows, "timestamp string, user string, source_ip string, port int, event_type string, host string")
    events = events.withColumn("hour_bucket", F.date_trunc("hour", F.col("timestamp").cast("timestamp")))
    out = sketches.rolling_distinct(sketches.hourly_distinct(events, "user-hour"), ["source_ips", "dest_ports"]).orderBy("hour_bucket").collect()
    assert [(r.source_ips_24h, r.dest_ports_24h) for r in out] == [(2, 1), (2, 2), (3, 3), (2, 2), (1, 2)]


def test_quantiles_add_up(spark, tmp_path):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.exponential(10, 40_000), np.full(10_000, 3.0), rng.normal(500, 5, 300)])
    df = spark.createDataFrame([(i % 7, float(v), None) for i, v in enumerate(x)], "day int, x double, none double").repartition(5)
    sketches.quantile_sketches(df, ["x", "none"], ["day"]).write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    found = sketches.merged_quantiles(stored, ["x", "none"], [0.0, 0.1, 0.5, 0.9, 1.0])
    errors = {r.prob: r.error for r in sketches.rank_errors(df, found).collect()}
    assert len(errors) == 5 and max(errors.values()) <= sketches.rank_error(sketches.SIZE) and errors[0.0] == errors[1.0] == 0
    box = sketches.merged_quartiles(stored, ["x", "none"])
    assert [(r.feature, r.n) for r in box.collect()] == [("x", len(x))]
    q1, q3 = np.quantile(x, [0.25, 0.75])
    far = profile.outlier_counts(df, ["x"], box=box).first().n_outliers
    low, high = (int((x > q3 + f * (q3 - q1)).sum()) for f in (3.3, 2.7))
    assert low <= far <= high and profile.box_stats(df, ["x"], box=box).first().n_outside > 0


LINES = ["2026-07-15 10:23:45 u h SUCCESS 1.1.1.1", "# c", "", "garbage", "2026-07-15T10:23:45Z,1.1.1.1,2.2.2.2,443,ALLOW,1", "query_time=", "1,2"]


@pytest.mark.parametrize("fmt", [None, "auth"])
def test_lines_are_counted_while_they_are_written(spark, tmp_path, fmt):
    lines = spark.createDataFrame([(x,) for x in LINES * 3], "value string").repartition(2)
    counts = landing.land_logs(lines, str(tmp_path / "t"), fmt, id_from=["value"])
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, parse_counts(parse_lines(lines, fmt, id_from=["value"])).collect()))
    events, rejects = landing.landed_logs(spark, str(tmp_path / "t"))
    by = {o: n for _, o, n in map(tuple, counts.collect())}
    assert events.count() == sum(r.n_lines for r in counts.collect() if r.outcome == "parsed") and rejects.count() == sum(n for o, n in by.items() if o != "parsed")
    assert "reject_reason" not in events.columns and events.where("parsed_at IS NULL").count() == 0


def test_nothing_to_land(spark, tmp_path):
    lines = spark.createDataFrame([], "value string")
    assert landing.land_logs(lines, str(tmp_path / "t")).count() == 0


def test_one_scan_lands_and_counts(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([('{"timestamp": "2026-07-15T10:23:45Z", "port": "7"}',), ('{"timestamp": "soon"}',), ("{broken",)], "value string").write.text(source)
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup())
    counts = landing.land_telemetry(spark, source, str(tmp_path / "t"))
    jobs = set(tracker.getJobIdsForGroup()) - before
    assert [len(tracker.getJobInfo(j).stageIds) for j in jobs] == [1]  # the write alone, without a shuffle
    assert tuple(counts.first()) == (3, 1, 1, 1) and spark.read.parquet(str(tmp_path / "t")).first().port == 7

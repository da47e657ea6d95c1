from pyspark.sql import functions as F

from tidewatch.streaming import jobs

SCHEMA = "timestamp timestamp, event_type string, user string, source_ip string, host string, status string, port int, bytes bigint, query_domain string"


def test_logs_arrive_in_batches(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(3):
        (folder / f"{i}.log").write_text(f"2026-07-15 10:23:4{i} u{i} h SUCCESS 1.1.1.1\n# c\ngarbage\n")
    out = jobs.run_available(jobs.stream_logs(spark, str(folder), max_files=1), "t")
    assert sorted(r.user for r in out.where("reject_reason IS NULL").collect()) == ["u0", "u1", "u2"]
    assert out.where("reject_reason = 'unknown format'").count() == 3
    again = jobs.run_available(jobs.stream_logs(spark, str(folder)), "t")
    assert again.select("event_id").distinct().exceptAll(out.select("event_id").distinct()).count() == 0


def test_hours_close_with_the_watermark(spark, tmp_path):
    def at(h, m, status):
        return (f"2026-07-20 {h:02d}:{m:02d}:00", "AUTH", "u", "1.1.1.1", "h", status, None, None, None)

    rows = [at(9, 0, "SUCCESS"), at(9, 30, "FAILURE"), at(10, 5, "FAILURE"), at(12, 0, "SUCCESS")]
    df = spark.createDataFrame(rows, SCHEMA.replace("timestamp timestamp", "timestamp string"))
    source = str(tmp_path / "in")
    df.withColumn("timestamp", F.col("timestamp").cast("timestamp")).write.parquet(source)
    events = spark.readStream.schema(SCHEMA).parquet(source)
    out = jobs.run_available(jobs.hourly_features(events, "user-hour", "30 minutes"), "h").orderBy("hour_bucket").collect()
    assert [(r.hour_bucket.hour, r.n_events, r.failure_ratio) for r in out] == [(9, 2, 0.5), (10, 1, 1.0)]


def test_repeats_across_batches_are_dropped(spark, tmp_path):
    source = str(tmp_path / "in")
    for ids in (["a", "b", "a"], ["b", "c"]):
        df = spark.createDataFrame([(i,) for i in ids], "event_id string").withColumn("t", F.lit("2026-07-20 09:00:00").cast("timestamp"))
        df.coalesce(1).write.mode("append").parquet(source)
    events = spark.readStream.schema("event_id string, t timestamp").option("maxFilesPerTrigger", 1).parquet(source)
    out = jobs.run_available(jobs.unique_events(events, "event_id", "t"), "u")
    assert sorted(r.event_id for r in out.collect()) == ["a", "b", "c"]


def test_gaps_go_back_over_batches_and_restarts(spark, tmp_path):
    def login(text, user="u"):
        return (text, "AUTH", user, "1.1.1.1", "h", "SUCCESS", None, None, None)

    source, base = str(tmp_path / "in"), str(tmp_path / "job")
    # the second batch has a row that is earlier than all of the first, inside the delay; the third one that is too late
    batches = [
        [login("2026-07-20 09:30:00"), login("2026-07-20 09:50:00"), login("2026-07-20 10:10:00"), login("2026-07-20 09:00:00", "v")],
        [login("2026-07-20 09:10:00"), login("2026-07-20 11:10:00"), login("2026-07-20 18:00:00")],
        [login("2026-07-20 09:05:00"), login("2026-07-20 18:30:00"), login("2026-07-20 19:00:00", "v")],
    ]
    seen = []
    for k in range(len(batches) + 1):
        text = spark.createDataFrame(batches[k], SCHEMA.replace("timestamp timestamp", "timestamp string")).withColumn("timestamp", F.col("timestamp").cast("timestamp")) if k < 3 else None
        landing = jobs.ending(spark, spark.createDataFrame([], SCHEMA).schema) if text is None else text
        landing.select(*[F.col(c) for c in spark.createDataFrame([], SCHEMA).columns]).write.mode("append").parquet(source)
        events = spark.readStream.schema(SCHEMA).parquet(source)
        out = jobs.run_available(jobs.login_gaps(events, "user-hour", "2 hours"), "g", base)
        seen.append(out.count())
    rows = sorted((r.entity_label, r.hour_bucket.hour, r.logins, r.gap_min) for r in out.collect())
    assert rows == [("u", 9, 3, 20.0), ("u", 10, 1, 20.0), ("u", 11, 1, 60.0), ("u", 18, 2, 220.0), ("v", 9, 1, None), ("v", 19, 1, 600.0)] and seen[1] > 0 and seen[0] == 0


def test_line_places_over_batches():
    import pyarrow as pa

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(["x"] * len(rows)), pa.array([f for f, _ in rows]), pa.array([b for _, b in rows], pa.int64())], names=["value", "file", "block_start"])

    parts = [batch([("a", 0)] * 3), batch([("a", 0), ("a", 9), ("b", 9), ("b", 9)]), batch([("b", 9), ("c", 0)])]
    assert [b.column("place").to_pylist() for b in jobs._number_lines(iter(parts))] == [[0, 1, 2], [3, 0, 0, 1], [2, 0]]

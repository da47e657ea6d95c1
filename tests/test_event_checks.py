import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.operators.event_checks import CHECKS, rapid_events, run_event_checks
from tidewatch.operators.ordering import with_line_numbers
from tidewatch.operators.reports import issue_totals, issues_by_check, json_summary, top_recommendations, valid_records

AS_OF = dt.datetime(2026, 7, 24)
BASE = dict(
    event_id="e1", timestamp="2026-07-15T10:23:45Z", source_ip="203.0.113.45", target_ip=None, action="ALLOW",
    status="success", log_type="firewall", original_line="x",
)
SCHEMA = "line_number bigint, " + ", ".join(f"{c} string" for c in BASE)


def table(spark, *changes):
    rows = [tuple([i, *{**BASE, "event_id": f"e{i}", "timestamp": f"2026-07-15T10:{i:02d}:45Z", **c}.values()]) for i, c in enumerate(changes, 1)]
    return spark.createDataFrame(rows, SCHEMA)


def issues(spark, *changes):
    found = run_event_checks(table(spark, *changes), AS_OF)
    return [(r.line_number, r.check_type, r.severity, r.description) for r in found.orderBy("line_number", "check_no", "description").collect()]


@pytest.mark.parametrize(
    "change, check, severity, text",
    [
        ({"event_id": None}, "Missing Fields", "ERROR", "Missing or null critical fields: event_id"),
        ({"source_ip": None, "action": ""}, "Missing Fields", "ERROR", "Missing or null critical fields: source_ip, action"),
        ({"source_ip": "999.999.999.999"}, "IP Validation", "ERROR", "source_ip '999.999.999.999' is not a valid IPv4 or IPv6 address."),
        ({"target_ip": "invalid_ip"}, "IP Validation", "ERROR", "target_ip 'invalid_ip' is not a valid IPv4 or IPv6 address."),
        ({"source_ip": "172.20.0.1"}, "IP Validation", "WARNING", "source_ip '172.20.0.1' is a private/RFC-1918 IP address in log_type='firewall'."),
        ({"timestamp": "2099-01-01T00:00:00Z"}, "Timestamp Anomaly", "WARNING", "Timestamp '2099-01-01T00:00:00Z' is in the future (now=2026-07-24T00:00:00Z)."),
        ({"timestamp": "2020-01-01T00:00:00Z"}, "Timestamp Anomaly", "WARNING", "Timestamp '2020-01-01T00:00:00Z' is older than 1 year."),
        ({"timestamp": "not-a-date"}, "Timestamp Anomaly", "ERROR", "Timestamp 'not-a-date' cannot be parsed as ISO 8601."),
        ({"action": "DENY"}, "Suspicious Pattern", "WARNING", "Impossible combination: action='DENY', status='success'."),
        ({"status": "failure"}, "Suspicious Pattern", "WARNING", "Impossible combination: action='ALLOW', status='failure'."),
        ({"original_line": "a,-100"}, "Suspicious Pattern", "WARNING", "Negative byte count (-100) in record."),
        ({"original_line": "a,2000000000000"}, "Suspicious Pattern", "WARNING", "Extreme byte count (2,000,000,000,000) exceeds 1 TB."),
        ({"original_line": "a," + "9" * 40}, "Suspicious Pattern", "WARNING", f"Extreme byte count ({int('9' * 40):,}) exceeds 1 TB."),
    ],
)
def test_single_findings(spark, change, check, severity, text):
    assert issues(spark, change) == [(1, check, severity, text)]


def test_no_findings(spark):
    assert issues(spark, {}, {"original_line": "a,1000000000000"}, {"original_line": "a,-0"}) == []


def test_missing_time_is_reported_twice(spark):
    assert [i[1] for i in issues(spark, {"timestamp": None})] == ["Missing Fields", "Timestamp Anomaly"]


def test_duplicates_name_the_first_line(spark):
    got = issues(spark, {"event_id": "a"}, {"event_id": "b"}, {"event_id": "a"}, {"event_id": "a"}, {"event_id": ""}, {"event_id": ""})
    assert [(i[0], i[3]) for i in got if i[1] == "Duplicate Detection"] == [
        (n, "Duplicate event_id 'a' first seen at line 1.") for n in (3, 4)
    ]


def test_rapid_events_skip_bad_times_and_cross_blocks(spark):
    t = "2026-07-15T10:23:45Z"
    df = table(spark, {"timestamp": t}, {"timestamp": "bad"}, {"timestamp": None}, {"timestamp": t}, {"timestamp": t})
    for block in (1, 2, 1000):
        assert {(r.line_number, r.prev_line) for r in rapid_events(df, block).collect()} == {(4, 1), (5, 4)}
    texts = [i[3] for i in issues(spark, {"timestamp": t}, {"timestamp": t})]
    assert texts == ["Rapid sequential event: 0.000s after line 1."]


def test_reports(spark):
    df = table(spark, {}, {"event_id": "e1"}, {"source_ip": "10.0.0.1"}, {"timestamp": None})
    found = run_event_checks(df, AS_OF)
    totals = issue_totals(df, found).first()
    assert (totals.total_records, totals.valid_records, totals.error_count, totals.warning_count) == (4, 2, 3, 1)
    checks = [(n, g) for n, g, _ in CHECKS]
    verdicts = {r.check_group: r.verdict for r in issues_by_check(found, checks).collect()}
    assert verdicts["IP Validation"] == "WARNING" and verdicts["Suspicious Patterns"] == "PASS" and verdicts["Missing Fields"] == "ERROR"
    assert sorted(r.line_number for r in valid_records(df, found).collect()) == [1, 3]
    assert json_summary(df, found, checks).first().by_check["Missing Fields"].errors == 1
    assert top_recommendations(found, ["check_no", "line_number"]).count() == 4


def test_findings_do_not_depend_on_partitioning(spark):
    # a third of all rows share one id
    base = spark.range(3000).select(
        F.col("id").alias("seq"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("e"), "id")).alias("event_id"),
        F.date_format(F.timestamp_seconds(F.lit(1784000000) + F.floor(F.col("id") / 2)), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        F.lit("1.1.1.1").alias("source_ip"), F.lit(None).cast("string").alias("target_ip"), F.lit("ALLOW").alias("action"),
        F.lit("success").alias("status"), F.lit("firewall").alias("log_type"), F.lit("x").alias("original_line"),
    )
    results = []
    for n in (1, 17):
        numbered = with_line_numbers(base.repartition(n), ["seq"])
        assert numbered.where("line_number <> seq + 1").count() == 0
        results.append(sorted(map(tuple, run_event_checks(numbered, AS_OF).collect())))
    assert results[0] == results[1]
    assert sum(1 for r in results[0] if r[2] == "Duplicate Detection") == 999
    assert sum(1 for r in results[0] if r[4] == "INFO") == 1500

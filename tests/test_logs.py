import json

import pytest
from pyspark.sql import functions as F

from tidewatch.operators.log_parsing import (
    FORMATS, LogFormat, normalize_logs, parse_counts, parse_lines, register_format,
)
from tidewatch.sources.logs import read_events_jsonl, read_logs, write_jsonl

FIREWALL = "2026-07-15T10:23:45Z,192.168.1.100,10.0.0.50,443,ALLOW,15234"
AUTH = "2026-07-15 10:23:45 alice_web corporate-vpn SUCCESS 203.0.113.45"
DNS = "query_time=2026-07-15T10:23:45Z|client=192.168.1.50|domain=suspicious.example.com|type=A|response=NXDOMAIN"


def lines(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, value string")


def parse(spark, *values, fmt=None):
    return [r.asDict() for r in parse_lines(lines(spark, *values), fmt).orderBy("n").collect()]


def pick(row, *names):
    return tuple(row[n] for n in names)


def test_three_formats(spark):
    f, a, d = parse(spark, FIREWALL, AUTH, DNS)
    names = ("timestamp", "source_ip", "target_ip", "user", "action", "status", "log_type")
    time = "2026-07-15T10:23:45Z"
    assert pick(f, *names) == (time, "192.168.1.100", "10.0.0.50", None, "ALLOW", "success", "firewall")
    assert pick(a, *names) == (time, "203.0.113.45", None, "alice_web", "SUCCESS", "success", "auth")
    assert pick(d, *names) == (time, "192.168.1.50", None, "suspicious.example.com", "RESPONSE", "success", "dns")
    assert all(r["original_line"] == v for r, v in zip((f, a, d), (FIREWALL, AUTH, DNS)))


def test_edge_cases(spark):
    quoted, spaced, last, empty, plain = parse(
        spark,
        '2026-07-15T10:23:45Z,"1.2.3.4",999.1.1.1,"4,4","AL""LOW",15',
        "  2026-07-15 10:23:45 \t bob h failed 1.1.1.1 extra  ",
        "query_time=x|client=1.2.3.4|client=5.6.7.8|domain= a=b |response= |type=A",
        "2026-07-15T10:23:45Z,1.2.3.4,,,,",
        "client=1.1.1.1|domain=z",
    )
    assert pick(quoted, "source_ip", "target_ip", "action", "status") == ("1.2.3.4", None, 'AL"LOW', "unknown")
    assert pick(spaced, "log_type", "user", "action", "status") == ("auth", "bob", "FAILURE", "failure")
    assert pick(last, "timestamp", "source_ip", "user", "action") == (None, "5.6.7.8", "a=b", "UNKNOWN")
    assert pick(empty, "log_type", "target_ip", "action") == ("firewall", None, "UNKNOWN")
    assert pick(plain, "user", "action") == ("z", "QUERY")


@pytest.mark.parametrize(
    "fmt, value, reason",
    [
        ("firewall", "2026-07-15T10:23:45Z,192.168.1.100", "malformed firewall"), ("auth", "a b c", "malformed auth"),
        ("dns", "no pairs here", "malformed dns"), (None, "garbage", "unknown format"), ("syslog", FIREWALL, "unknown format"),
    ],
)
def test_rejects(spark, fmt, value, reason):
    assert parse(spark, value, fmt=fmt)[0]["reject_reason"] == reason


def test_blank_and_comment_lines_are_no_lines(spark):
    assert parse(spark, "", "   ", "# x", "  # y") == []
    events, rejects = normalize_logs(lines(spark, FIREWALL, "garbage", "# c"), id_from=["n"])
    assert events.count() == 1 and rejects.select("line").first().line == "garbage"
    counts = {(r.log_type, r.outcome): r.n_lines for r in parse_counts(parse_lines(lines(spark, FIREWALL, "garbage"))).collect()}
    assert counts == {("firewall", "parsed"): 1, ("unknown", "unknown format"): 1}


def test_registered_format(spark):
    register_format(
        "pipe", LogFormat(lambda x: x.startswith("P!"), lambda x: F.split(x, "!"), lambda p: F.size(p) < 3,
                          lambda p: {"source": F.get(p, F.lit(1)), "verb": F.get(p, F.lit(2))}),
    )
    try:
        good, bad = parse(spark, "P!1.1.1.1!drop", "P!1.1.1.1")
        assert pick(good, "log_type", "source_ip", "action") == ("pipe", "1.1.1.1", "DENY")
        assert bad["reject_reason"] == "malformed pipe"
    finally:
        del FORMATS["pipe"]


def test_event_ids(spark):
    df = lines(spark, *[FIREWALL] * 20)
    assert parse_lines(df).select("event_id").distinct().count() == 20
    ids = [parse_lines(df.repartition(n), id_from=["n"]).orderBy("n").select("event_id").collect() for n in (1, 7)]
    assert ids[0] == ids[1]


def test_line_numbers_over_splits(spark, tmp_path):
    for name, n in (("a.log", 3000), ("b.log", 500)):
        (tmp_path / name).write_text("".join(f"{name} {i + 1}\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        got = read_logs(spark, str(tmp_path), numbered=True)
        assert got.where(F.col("value") != F.concat(F.element_at(F.split("file", "/"), -1), F.lit(" "), "line_number")).count() == 0
        assert got.count() == 3500
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_invalid_bytes_and_jsonl(spark, tmp_path):
    (tmp_path / "x.log").write_bytes(b"2026-07-15 10:23:45 \xff host SUCCESS 1.1.1.1\n")
    assert parse_lines(read_logs(spark, str(tmp_path / "x.log"))).first().user == "�"
    out = str(tmp_path / "out")
    write_jsonl(parse_lines(lines(spark, DNS)).select("event_id", "target_ip"), out)
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("*.json")))
    assert json.loads(text)["target_ip"] is None
    (tmp_path / "e.jsonl").write_text('{"event_id":"a"}\n\n{bad\n{"event_id":"b"} tail\n{"event_id":"c","x":1}\n')
    good, bad = read_events_jsonl(spark, str(tmp_path / "e.jsonl"), "event_id string")
    assert {(r.line_number, r.event_id) for r in good.collect()} == {(1, "a"), (5, "c")}
    assert {r.line_number for r in bad.collect()} == {3, 4}

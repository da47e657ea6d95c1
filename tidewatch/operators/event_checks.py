"""Record-level quality checks on normalized events.

Findings are rows: ``line_number, check_no, check_group, check_type, severity, description,
recommended_action``. All checks that look at one record alone share a single projection.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.net import is_private_ip, is_valid_ip
from tidewatch.functions.text import thousands
from tidewatch.functions.times import iso_utc, parse_event_time
from tidewatch.operators.ordering import previous_row

# Names, limits and texts of the findings.
CRITICAL_FIELDS = ["event_id", "timestamp", "source_ip", "action", "log_type"]
IMPOSSIBLE = [("DENY", "success"), ("ALLOW", "failure"), ("SUCCESS", "failure"), ("FAILURE", "success")]
MAX_BYTES = "1000000000000"
MAX_AGE_DAYS = 365
RAPID_SECONDS = 1.0
CHECKS = [
    (1, "Missing Fields", "Missing Fields"),
    (2, "IP Validation", "IP Validation"),
    (3, "Timestamp Anomalies", "Timestamp Anomaly"),
    (4, "Duplicate Detection", "Duplicate Detection"),
    (5, "Suspicious Patterns", "Suspicious Pattern"),
]
ADVICE = {
    "missing": "Fix log source or parser to ensure all critical fields are populated.",
    "invalid_ip": "Verify {field} extraction logic in the parser.",
    "private_ip": "Confirm whether this is an internal-facing log; private IPs may be unexpected in "
    "external-facing records.",
    "no_time": "Ensure the parser correctly extracts and normalizes timestamps.",
    "bad_time": "Normalize all timestamps to YYYY-MM-DDTHH:MM:SSZ format.",
    "future": "Verify system clock on log source; investigate potential clock skew.",
    "old": "Confirm log retention policy; stale logs may indicate replay or ingestion delay.",
    "duplicate": "Investigate log source for double-submission or de-duplication failure.",
    "impossible": "Review parser logic for correct action/status normalization.",
    "negative": "Verify byte counter in log source; wrap-around or corruption suspected.",
    "extreme": "Confirm traffic volume; possible byte counter overflow or data exfiltration.",
    "rapid": "Verify whether this is expected high-frequency traffic or a scan/flood.",
}
ISSUE_COLUMNS = [
    "line_number", "check_no", "check_group", "check_type", "severity", "description", "recommended_action",
]


def _finding(check_no: int, severity: str, description: Column, advice: str) -> Column:
    _, group, kind = CHECKS[check_no - 1]
    return F.struct(
        F.lit(check_no).alias("check_no"),
        F.lit(group).alias("check_group"),
        F.lit(kind).alias("check_type"),
        F.lit(severity).alias("severity"),
        description.alias("description"),
        F.lit(advice).alias("recommended_action"),
    )


def _filled(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")) != ""


def _missing_fields() -> list[Column]:
    names = F.filter(
        F.array(*[F.when(~_filled(f), F.lit(f)) for f in CRITICAL_FIELDS]), lambda n: n.isNotNull()
    )
    text = F.concat(F.lit("Missing or null critical fields: "), F.array_join(names, ", "))
    return [F.when(F.size(names) > 0, _finding(1, "ERROR", text, ADVICE["missing"]))]


def _addresses() -> list[Column]:
    rules = []
    for field in ("source_ip", "target_ip"):
        ip = F.col(field)
        invalid = _finding(
            2, "ERROR",
            F.concat(F.lit(f"{field} '"), ip, F.lit("' is not a valid IPv4 or IPv6 address.")),
            ADVICE["invalid_ip"].format(field=field),
        )
        private = _finding(
            2, "WARNING",
            F.concat(
                F.lit(f"{field} '"), ip, F.lit("' is a private/RFC-1918 IP address in log_type='"),
                F.coalesce("log_type", F.lit("None")), F.lit("'."),
            ),
            ADVICE["private_ip"],
        )
        rules.append(
            F.when(_filled(field) & ~is_valid_ip(ip), invalid).when(_filled(field) & is_private_ip(ip), private)
        )
    return rules


def _times(as_of: Column) -> list[Column]:
    raw, parsed = F.col("timestamp"), F.col("_time")

    def quoted(rest):
        return F.concat(F.lit("Timestamp '"), raw, rest)

    future = F.concat(F.lit("' is in the future (now="), iso_utc(as_of), F.lit(")."))
    return [
        F.when(~_filled("timestamp"), _finding(3, "ERROR", F.lit("Timestamp field is missing or empty."), ADVICE["no_time"]))
        .when(parsed.isNull(), _finding(3, "ERROR", quoted(F.lit("' cannot be parsed as ISO 8601.")), ADVICE["bad_time"]))
        .when(parsed > as_of, _finding(3, "WARNING", quoted(future), ADVICE["future"]))
        .when(
            parsed < as_of - F.expr(f"INTERVAL {MAX_AGE_DAYS} DAYS"),
            _finding(3, "WARNING", quoted(F.lit("' is older than 1 year.")), ADVICE["old"]),
        )
    ]


def _combination() -> list[Column]:
    action = F.upper(F.coalesce("action", F.lit("")))
    status = F.lower(F.coalesce("status", F.lit("")))
    broken = F.lit(False)
    for bad_action, bad_status in IMPOSSIBLE:
        broken = broken | ((action == bad_action) & (status == bad_status))
    text = F.concat(F.lit("Impossible combination: action='"), action, F.lit("', status='"), status, F.lit("'."))
    return [F.when(broken, _finding(5, "WARNING", text, ADVICE["impossible"]))]


def _byte_count() -> list[Column]:
    # compared as digits, since a hostile count may exceed every numeric type
    raw = F.regexp_extract(F.col("original_line"), r",(-?\d+)\s*\z", 1)
    digits = F.regexp_replace(F.ltrim(raw, F.lit("-")), r"\A0+(?=\d)", "")
    negative = raw.startswith("-") & (digits != "0")
    size = F.length(digits)
    extreme = ~raw.startswith("-") & (
        (size > len(MAX_BYTES)) | ((size == len(MAX_BYTES)) & (digits > MAX_BYTES))
    )
    return [
        F.when(
            negative,
            _finding(5, "WARNING", F.concat(F.lit("Negative byte count (-"), digits, F.lit(") in record.")), ADVICE["negative"]),
        ).when(
            extreme,
            _finding(5, "WARNING", F.concat(F.lit("Extreme byte count ("), thousands(digits), F.lit(") exceeds 1 TB.")), ADVICE["extreme"]),
        )
    ]


def _local_issues(df: DataFrame, as_of: Column) -> DataFrame:
    timed = df.withColumn("_time", parse_event_time(F.col("timestamp")))
    rules = [*_missing_fields(), *_addresses(), *_times(as_of), *_combination(), *_byte_count()]
    found = F.filter(F.array(*rules), lambda r: r.isNotNull())
    return timed.select("line_number", F.explode(found).alias("i")).select("line_number", "i.*")


def duplicate_ids(df: DataFrame) -> DataFrame:
    """Records whose event id was seen on an earlier line, with ``first_line``.

    The first line of each id is a plain aggregate, so an id on a third of all lines never meets
    in one task; the join back keeps only repeated ids and its skew is left to the adaptive join.
    """
    ids = df.where(_filled("event_id")).select("event_id", "line_number")
    first = (
        ids.groupBy("event_id")
        .agg(F.min("line_number").alias("first_line"), F.count("*").alias("_n"))
        .where("_n > 1")
        .drop("_n")
    )
    return ids.join(first, "event_id").where("line_number > first_line")


def _duplicate_issues(df: DataFrame) -> DataFrame:
    text = F.format_string("Duplicate event_id '%s' first seen at line %d.", "event_id", "first_line")
    issue = _finding(4, "ERROR", text, ADVICE["duplicate"])
    return duplicate_ids(df).select("line_number", issue.alias("i")).select("line_number", "i.*")


def rapid_events(df: DataFrame, block_rows: int = 1_000_000) -> DataFrame:
    """Records less than a second from the record before that has a valid time."""
    timed = df.select("line_number", parse_event_time(F.col("timestamp")).alias("_time"))
    pairs = previous_row(timed, "line_number", F.col("_time").isNotNull(), ["_time", "line_number"], block_rows)
    delta = F.abs(F.unix_micros("_time") - F.unix_micros("prev__time")) / F.lit(1e6)
    return pairs.select(
        "line_number", F.col("prev_line_number").alias("prev_line"), delta.alias("delta_sec")
    ).where(F.col("delta_sec") < RAPID_SECONDS)


def _rapid_issues(df: DataFrame) -> DataFrame:
    text = F.format_string("Rapid sequential event: %.3fs after line %d.", "delta_sec", "prev_line")
    issue = _finding(5, "INFO", text, ADVICE["rapid"])
    return rapid_events(df).select("line_number", issue.alias("i")).select("line_number", "i.*")


def _utc(moment: dt.datetime) -> Column:
    """A moment without a zone is in UTC, whatever the zone of the machine."""
    aware = moment.replace(tzinfo=dt.timezone.utc) if moment.tzinfo is None else moment.astimezone(dt.timezone.utc)
    return F.lit(aware.isoformat()).cast("timestamp")


def run_event_checks(df: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """All findings of the five checks on events with a ``line_number``."""
    now = F.current_timestamp() if as_of is None else _utc(as_of)
    return (
        _local_issues(df, now)
        .unionByName(_duplicate_issues(df))
        .unionByName(_rapid_issues(df))
        .select(ISSUE_COLUMNS)
    )

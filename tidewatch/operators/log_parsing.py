"""Normalize raw firewall, authentication and DNS lines into one event table."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.net import normalize_ip
from tidewatch.functions.text import BLANKS, strip
from tidewatch.functions.times import iso_utc, normalize_timestamp

EVENT_COLUMNS = [
    "event_id", "timestamp", "source_ip", "target_ip", "user", "action", "status", "log_type",
    "original_line", "parsed_at",
]

# Raw verb to canonical action.
ACTIONS = {
    "allow": "ALLOW", "accept": "ALLOW", "permit": "ALLOW",
    "deny": "DENY", "drop": "DENY", "reject": "DENY", "block": "DENY",
    "success": "SUCCESS", "pass": "SUCCESS",
    "failure": "FAILURE", "fail": "FAILURE", "failed": "FAILURE", "error": "FAILURE",
    "query": "QUERY", "response": "RESPONSE", "nxdomain": "RESPONSE", "noerror": "RESPONSE", "servfail": "RESPONSE", "refused": "RESPONSE",
}
# What a canonical action says about the outcome.
STATUSES = {
    "success": ["ALLOW", "SUCCESS", "QUERY", "RESPONSE"],
    "failure": ["DENY", "FAILURE"],
}


def normalize_action(raw: Column) -> Column:
    bare = strip(raw)
    known = F.create_map(
        *[F.lit(x) for pair in ACTIONS.items() for x in pair]
    )
    mapped = F.coalesce(F.try_element_at(known, F.lower(bare)), F.upper(bare))
    return F.when(F.coalesce(raw, F.lit("")) == "", F.lit("UNKNOWN")).otherwise(mapped)


def action_to_status(action: Column) -> Column:
    status = F.lit("unknown")
    for name, actions in STATUSES.items():
        status = F.when(action.isin(actions), F.lit(name)).otherwise(status)
    return status


class LogFormat(NamedTuple):
    """How one line format is recognised, cut into parts and read.

    ``parts`` gives any column, ``rejected`` a condition on it, and ``fields`` the raw values of
    ``time``, ``source``, ``target``, ``user`` and ``verb``; missing fields are null.
    """

    matches: Callable[[Column], Column]
    parts: Callable[[Column], Column]
    rejected: Callable[[Column], Column]
    fields: Callable[[Column], dict[str, Column]]


def _csv_fields(line: Column) -> Column:
    # each field starts at a comma: a quoted body, doubled quotes inside, then the rest as it is
    pattern = F.lit(r',(?:"([^"]*(?:""[^"]*)*)(?:"|\z))?([^,]*)')
    whole = F.concat(F.lit(","), line)
    quoted = F.zip_with(
        F.regexp_extract_all(whole, pattern, F.lit(1)),
        F.regexp_extract_all(whole, pattern, F.lit(2)),
        lambda body, rest: F.concat(F.replace(body, F.lit('""'), F.lit('"')), rest),
    )
    return F.when(line.contains('"'), quoted).otherwise(F.split(line, ","))


def _is_firewall(line: Column) -> Column:
    # the first field starts like a date, and there are at least four commas
    return line.rlike(r"\A\d{4}-\d{2}-\d{2}[^,]*(?:,[^,]*){4}")


def _firewall_fields(parts: Column) -> dict[str, Column]:
    names = ["time", "source", "target", "port", "verb"]
    return {n: F.get(parts, F.lit(i)) for i, n in enumerate(names) if n != "port"}


def _is_auth(line: Column) -> Column:
    # a date, a word that starts like a time, and four words more
    word = BLANKS[:-1].replace("[", "[^") + "+"
    return line.rlike(rf"\A\d{{4}}-\d{{2}}-\d{{2}}{BLANKS}\d{{2}}:\d{{2}}:\d{{2}}(?:{word})?(?:{BLANKS}{word}){{4}}")


def _auth_fields(parts: Column) -> dict[str, Column]:
    return {
        "time": F.concat_ws(" ", F.get(parts, F.lit(0)), F.get(parts, F.lit(1))),
        "user": F.get(parts, F.lit(2)),
        "verb": F.get(parts, F.lit(4)),
        "source": F.get(parts, F.lit(5)),
    }


def _is_dns(line: Column) -> Column:
    return line.contains("query_time=") | (line.contains("client=") & line.contains("domain="))


def _dns_pairs(line: Column) -> Column:
    pattern = F.lit(r"(?U)(\w+)\s*=\s*([^|]+)")
    return F.arrays_zip(
        F.regexp_extract_all(line, pattern, F.lit(1)).alias("name"),
        F.regexp_extract_all(line, pattern, F.lit(2)).alias("text"),
    )


def _dns_fields(parts: Column) -> dict[str, Column]:
    def last(name):
        hits = F.filter(parts, lambda p: p["name"] == name)
        return strip(F.try_element_at(hits, F.lit(-1))["text"])

    return {
        "time": last("query_time"),
        "source": last("client"),
        "user": F.nullif(last("domain"), F.lit("")),
        "verb": F.coalesce(last("response"), F.lit("QUERY")),
    }


# Tested in this order when the format is not given.
FORMATS: dict[str, LogFormat] = {
    "dns": LogFormat(_is_dns, _dns_pairs, lambda p: F.size(p) == 0, _dns_fields),
    "firewall": LogFormat(_is_firewall, _csv_fields, lambda p: F.size(p) < 5, _firewall_fields),
    "auth": LogFormat(_is_auth, lambda x: F.split(x, BLANKS), lambda p: F.size(p) < 6, _auth_fields),
}


def register_format(name: str, log_format: LogFormat) -> None:
    """Add a line format; it is tested after those already known."""
    FORMATS[name] = log_format


def detect_format(line: Column) -> Column:
    detected = F.lit(None).cast("string")
    for name, fmt in reversed(FORMATS.items()):
        detected = F.when(fmt.matches(line), F.lit(name)).otherwise(detected)
    return detected


def parse_lines(df: DataFrame, fmt: str | None = None, id_from: list[str] | None = None) -> DataFrame:
    """One row per line that is neither blank nor a comment, with ``reject_reason``.

    The reason is null for parsed lines, else ``unknown format`` or ``malformed <format>``. Other
    columns of ``df`` are kept. ``id_from`` names columns that identify a line: event ids then
    are a hash of them and stay the same when a job is run again.
    """
    formats = FORMATS if fmt is None else {k: v for k, v in FORMATS.items() if k == fmt}
    line = F.col("_line")
    work = df.withColumn("_line", strip(F.col("value"))).where((line != "") & ~line.startswith("#"))
    work = work.withColumn("log_type", F.lit(fmt) if fmt else detect_format(line))
    of = {name: F.col("log_type") == name for name in formats}
    work = work.withColumns({f"_{n}": F.when(of[n], f.parts(line)) for n, f in formats.items()})
    fields = {n: f.fields(F.col(f"_{n}")) for n, f in formats.items()}
    bad = F.lit(None).cast("string")
    for name, form in formats.items():
        bad = F.when(of[name] & form.rejected(F.col(f"_{name}")), F.lit(f"malformed {name}")).otherwise(bad)

    def pick(field):
        result = F.lit(None).cast("string")
        for name in formats:
            if field in fields[name]:
                result = F.when(of[name], fields[name][field]).otherwise(result)
        return result

    work = work.withColumns({f"_f_{f}": pick(f) for f in ("time", "source", "target", "user", "verb")})
    work = work.withColumn(
        "reject_reason",
        F.when(F.col("log_type").isNull() | ~F.col("log_type").isin(list(formats)), F.lit("unknown format")).otherwise(bad),
    ).withColumn("action", normalize_action(F.col("_f_verb")))
    event_id = F.sha2(F.concat_ws("|", *id_from, line), 256) if id_from else F.uuid()
    extra = [c for c in df.columns if c not in EVENT_COLUMNS and c != "value"]
    return work.select(
        event_id.alias("event_id"),
        normalize_timestamp(F.col("_f_time")).alias("timestamp"),
        normalize_ip(F.col("_f_source")).alias("source_ip"),
        normalize_ip(F.col("_f_target")).alias("target_ip"),
        F.col("_f_user").alias("user"),
        "action",
        action_to_status(F.col("action")).alias("status"),
        "log_type",
        line.alias("original_line"),
        iso_utc(F.current_timestamp()).alias("parsed_at"),
        "reject_reason",
        *extra,
    )


def normalize_logs(
    df: DataFrame, fmt: str | None = None, id_from: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Events and rejected lines."""
    parsed = parse_lines(df, fmt, id_from)
    events = parsed.where("reject_reason IS NULL").drop("reject_reason")
    rejects = parsed.where("reject_reason IS NOT NULL").withColumnRenamed("original_line", "line")
    kept = [c for c in rejects.columns if c not in EVENT_COLUMNS]
    return events, rejects.select(*kept)


def parse_counts(parsed: DataFrame) -> DataFrame:
    """Parsed and skipped lines by format and reason."""
    return parsed.groupBy(
        F.coalesce("log_type", F.lit("unknown")).alias("log_type"),
        F.coalesce("reject_reason", F.lit("parsed")).alias("outcome"),
    ).agg(F.count("*").alias("n_lines"))

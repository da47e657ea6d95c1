"""Timestamp parsing. The session time zone must be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch.functions.text import strip

_DATE = r"\d{4}-\d{1,2}-\d{1,2}"
_TIME = r"\d{1,2}:\d{1,2}:\d{1,2}"
ISO_OUT = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# Accepted layouts. One shape test admits a value to the built-in parser, which never
# sees a value it could only reject by an exception.
_NAIVE = rf"(?:[Tt]{_TIME}[Zz]?| {_TIME})"
_EVENT = rf"\A{_DATE}{_NAIVE}\z"
_LOG = rf"\A{_DATE}(?:{_NAIVE}|[Tt]{_TIME}[+-]\d{{2}}:?\d{{2}})\z"
_TELEMETRY = rf"\A{_DATE}(?:{_NAIVE}|[Tt]{_TIME}[+-]\d{{2}}:?\d{{2}}|[Tt]{_TIME}\.\d{{1,9}}[Zz]?| {_TIME}\.\d{{1,9}})\z"
_WEB = rf"\A\d{{1,2}}/[A-Za-z]{{3}}/\d{{4}}:{_TIME} [+-]\d{{4}}\z"
_WEB_PATTERN = "d/MMM/yyyy:H:m:s XX"


def _iso(value: Column, shape: str) -> Column:
    return F.when(value.rlike(shape), F.upper(value).try_cast("timestamp"))


def _parse(value: Column, shape: str) -> Column:
    # the built-in parser wants a colon in the offset
    compact = value.rlike(r"[+-]\d{4}\z")
    zoned = F.when(compact, F.regexp_replace(value, r"(\d{2})\z", ":$1")).otherwise(value)
    web = F.when(value.rlike(_WEB), F.try_to_timestamp(value, F.lit(_WEB_PATTERN)))
    return F.when(value.contains("/"), web).otherwise(_iso(zoned, shape))


def parse_event_time(value: Column) -> Column:
    """ISO with Z, ISO naive or blank-separated; no offset, no surrounding blanks."""
    return _iso(value, _EVENT)


def parse_log_time(value: Column) -> Column:
    """The layouts of :func:`parse_event_time` plus ISO with offset and the web-server layout."""
    return _parse(strip(value), _LOG)


def parse_telemetry_time(value: Column) -> Column:
    """The layouts of :func:`parse_log_time` plus fractional seconds."""
    return _parse(strip(value), _TELEMETRY)


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, ISO_OUT)


def normalize_timestamp(value: Column) -> Column:
    return iso_utc(parse_log_time(value))

"""Validation of nested JSON security events against a contract.

A contract is a JSON Schema document with the sections whose absence is reported first. The one of security events is declared below; another
is read from a file with ``read_contract``. Each record is opened as VARIANT once, which keeps a missing field apart
from a null one, and checked by one generated expression; only findings leave the scan stage.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.functions.jsons import parse_pair, strict_value
from tidewatch.operators.json_schema import BASE, Schema, literal, members, reach, read_schema, required_of


class Contract(NamedTuple):
    """A schema document, and the members of a record whose absence is reported before all else."""

    schema: dict
    mandatory: tuple[str, ...] = ()


def _text(**more) -> dict:
    return {"type": "string", **more}


def _choice(*values: str) -> dict:
    return {"type": "string", "enum": list(values)}


def _section(required: tuple[str, ...], **fields: dict) -> dict:
    return {"type": "object", "required": list(required), "additionalProperties": False, "properties": fields}


def _list(items: dict, **more) -> dict:
    return {"type": "array", "items": items, **more}


_MAYBE = {"type": ["string", "null"]}
_TIME = {"format": "date-time"}
_SCORE = {"type": "number", "minimum": 0, "maximum": 100}

# The event contract.
EVENT_CONTRACT = Contract(
    _section(
        ("event", "enrichment", "confidence", "approval", "audit_trail"),
        event=_section(
            ("event_id", "timestamp", "source", "event_type", "severity"),
            event_id=_text(minLength=1),
            timestamp=_text(**_TIME),
            source=_text(minLength=1),
            event_type=_choice(
                "authentication", "malware_detection", "network_intrusion", "data_exfiltration",
                "privilege_escalation", "policy_violation", "insider_activity", "vulnerability", "other",
            ),
            severity=_choice("informational", "low", "medium", "high", "critical"),
            description=_text(),
        ),
        enrichment=_section(
            ("threat_intel_matches", "asset_context", "related_events"),
            threat_intel_matches=_list(
                _section(
                    ("indicator", "indicator_type", "source", "match_type"),
                    indicator=_text(),
                    indicator_type=_choice("ip", "domain", "url", "file_hash", "email", "cve", "other"),
                    source=_text(),
                    match_type=_choice("exact", "heuristic", "campaign_correlation"),
                    campaign_or_actor=_MAYBE,
                )
            ),
            asset_context=_section(
                ("asset_id", "criticality"),
                asset_id=_text(),
                asset_type=_choice("workstation", "server", "network_device", "cloud_resource", "user_account", "other"),
                criticality=_choice("low", "medium", "high", "mission_critical"),
                owner=_text(),
            ),
            related_events=_list(
                _section(
                    ("event_id", "relationship"),
                    event_id=_text(),
                    relationship=_choice("same_asset", "same_actor_indicator", "temporal_correlation", "same_campaign", "other"),
                )
            ),
        ),
        confidence=_section(
            ("scale", "overall_score", "overall_label", "applies_to"),
            scale=_text(const="0-100"),
            overall_score=_SCORE,
            overall_label=_choice("low", "medium", "high", "very_high"),
            applies_to=_list(_text(), minItems=1),
            field_scores=_list(_section(("field", "score"), field=_text(), score=_SCORE)),
        ),
        approval={
            **_section(
                ("approval_status",),
                approval_status=_choice("pending", "approved", "rejected", "auto_approved", "not_required"),
                approver_id=_MAYBE,
                approval_timestamp=_MAYBE | _TIME,
                proposed_action=_MAYBE,
            ),
            "allOf": [
                {"if": {"properties": {"approval_status": {"const": "pending"}}}, "then": {"properties": {"approver_id": {"const": None}, "approval_timestamp": {"const": None}}}},
                {
                    "if": {"properties": {"approval_status": {"enum": ["approved", "rejected"]}}},
                    "then": {"required": ["approver_id", "approval_timestamp"], "properties": {"approver_id": _text(minLength=1), "approval_timestamp": _text(**_TIME)}},
                },
            ],
        },
        audit_trail=_list(
            _section(
                ("actor", "actor_type", "action", "timestamp"),
                actor=_text(), actor_type=_choice("human", "system"), action=_text(), timestamp=_text(**_TIME), notes=_text(),
            ),
            minItems=1,
        ),
    ),
    mandatory=("confidence", "approval"),
)


def read_contract(spark: SparkSession, path: str, mandatory: tuple[str, ...] = ()) -> Contract:
    """The contract in a JSON Schema file."""
    return Contract(read_schema(spark, path), mandatory)


def _whole(schema: Schema, contract: Contract) -> list[str]:
    """Entries on the record as a whole: text that is not JSON, then the mandatory sections, the last of them first."""
    none = schema.add_rule((), "json", "text", "record is not valid JSON", whole=True)
    found = [f"CASE WHEN {BASE} IS NULL THEN {schema.entry(none)} END"]
    if contract.mandatory:
        gone = {n: f"{reach(BASE, (n,))} IS NULL" for n in contract.mandatory}
        absent = f"array_compact(array({', '.join(f'CASE WHEN {v} THEN {literal(n)} END' for n, v in gone.items())}))"
        top = schema.add_rule((), "mandatory", "plain", "Missing required top-level field(s): ", whole=True)
        found.append(f"CASE WHEN {' OR '.join(gone.values())} THEN {schema.entry(top, names=absent)} END")
        for name in reversed(contract.mandatory):
            own = ", ".join(map(literal, required_of(contract.schema, name)))
            lacking = f"array_except(CAST(array({own}) AS array<string>), map_keys({members(reach(BASE, (name,)))}))"
            rule = schema.add_rule((), "mandatory", "plain", f"Missing required {name} field(s): ", whole=True)
            found.append(f"CASE WHEN NOT ({' OR '.join(gone.values())}) AND size({lacking}) > 0 THEN {schema.entry(rule, names=lacking)} END")
    return found


def _opened(df: DataFrame, json: str, keys: list[str]) -> DataFrame:
    """The keys and the record as ``_v``, null where the text is not JSON."""
    # through generators, so that the text is parsed once whatever reads the value
    return df.select(*keys, F.inline(F.array(F.struct(parse_pair(F.col(json)).alias("_pair"))))).select(*keys, F.inline(F.array(F.struct(strict_value(F.col("_pair")).alias("_v")))))


def _broken(df: DataFrame, json: str, keys: list[str], strict: bool, contract: Contract) -> DataFrame:
    """Keys and value of the records with findings. What is mandatory is required too, so the schema decides."""
    schema = Schema(_with_mandatory(contract), strict)
    return _opened(df, json, keys).where(F.col("_v").isNull() | ~schema.valid("_v"))


def _with_mandatory(contract: Contract) -> dict:
    """The schema, with the mandatory members required where it does not do so itself."""
    further = [n for n in contract.mandatory if n not in contract.schema.get("required", ())]
    return {**{k: contract.schema[k] for k in ("definitions", "$defs") if k in contract.schema}, "allOf": [contract.schema, {"required": further}]} if further else contract.schema


def _contract_findings(df: DataFrame, json: str, keys: list[str], strict: bool, contract: Contract) -> DataFrame:
    """Unordered findings: keys, ``_order`` (path, then place in the schema), ``path``, ``keyword``, ``message``."""
    schema = Schema(contract.schema, strict)
    whole = _whole(schema, contract)
    found = schema.findings(_opened(df, json, keys), "_v", keys, whole)
    read = found.select(*keys, "_i", *schema.described(F.col("_f")))
    order = F.struct((~F.col("_whole")).alias("inside"), F.col("_steps").alias("steps"), F.col("_i").alias("i"))
    message = F.when(F.col("_whole"), F.col("message")).otherwise(F.concat(F.lit("["), F.col("path"), F.lit("] "), F.col("message")))
    return read.select(*keys, order.alias("_order"), "path", "keyword", message.alias("message"))


def validate_events(df: DataFrame, json: str, keys: list[str], strict_formats: bool = False, contract: Contract = EVENT_CONTRACT) -> DataFrame:
    """One row per finding: the key columns, ``position`` from 1, ``path``, ``keyword``, ``message``.

    ``keys`` identify a record. Findings on the mandatory sections come first, the others by path.
    Formats are not enforced unless ``strict_formats``. Text that is not JSON has one finding.
    """
    # a window over the findings of one record
    order = Window.partitionBy(*keys).orderBy("_order")
    found = _contract_findings(df, json, keys, strict_formats, contract)
    return found.withColumn("position", F.row_number().over(order)).select(*keys, "position", "path", "keyword", "message")


def broken_events(df: DataFrame, json: str, keys: list[str], strict_formats: bool = False, contract: Contract = EVENT_CONTRACT) -> DataFrame:
    """The keys of records with findings."""
    return _broken(df, json, keys, strict_formats, contract).select(*keys).distinct()


def valid_events(df: DataFrame, json: str, keys: list[str], strict_formats: bool = False, contract: Contract = EVENT_CONTRACT) -> DataFrame:
    """The records without findings."""
    return df.join(broken_events(df, json, keys, strict_formats, contract), keys, "left_anti")


def contract_summary(df: DataFrame, json: str, keys: list[str], strict_formats: bool = False, contract: Contract = EVENT_CONTRACT) -> DataFrame:
    """One row: records, valid and invalid."""
    total = df.agg(F.count("*")).scalar()
    broken = broken_events(df, json, keys, strict_formats, contract).agg(F.count("*").alias("n_invalid"))
    return broken.select(total.alias("n_records"), (total - F.col("n_invalid")).alias("n_valid"), "n_invalid")

"""Queries on nested JSON events."""

from __future__ import annotations

import json as js
import uuid

from pyspark.sql import functions as F

from tidewatch.functions.jsons import parse_strict
from tidewatch.operators import contract
from tidewatch.operators.json_schema import Schema, check_documents
from tidewatch.plans import inputs
from tidewatch.session import shared_dir


def contract_findings(spark, sf):
    docs = inputs.event_documents(spark, sf)
    found = contract.validate_events(docs, "doc", ["event_id"])
    return found.select("event_id", "position", "path", "keyword", "message")


def contract_summary(spark, sf):
    return contract.contract_summary(inputs.event_documents(spark, sf), "doc", ["event_id"])


def contract_valid_events(spark, sf):
    return contract.valid_events(inputs.event_documents(spark, sf), "doc", ["event_id"]).select("event_id")


def contract_inner_faults(spark, sf):
    """Documents that lack an inner mandatory field, or hold a number for a text and a null for a text."""
    docs = inputs.event_documents(spark, sf)
    lacking = F.replace("doc", F.lit('"scale":"0-100",'), F.lit(""))
    wrong = F.replace(F.replace("doc", F.lit('"severity":"high"'), F.lit('"severity":7')), F.lit('"criticality":"low"'), F.lit('"criticality":null'))
    part = F.col("event_id") % 3
    docs = docs.select("event_id", F.when(part == 0, lacking).when(part == 1, wrong).otherwise(F.col("doc")).alias("doc"))
    return contract.validate_events(docs, "doc", ["event_id"]).select("event_id", "path", "keyword", "message")


def contract_property_events(spark, sf):
    """The property strings of events, which are JSON but no event documents."""
    found = contract.validate_events(inputs.events(spark, sf).select("event_id", "props"), "props", ["event_id"])
    return found.groupBy("path", "keyword", "message").count().withColumnRenamed("count", "n")


def contract_schema_file(spark, sf):
    """The findings by a contract that is read from a schema file."""
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/schema-{uuid.uuid4().hex}"
    spark.createDataFrame([(js.dumps(contract.EVENT_CONTRACT.schema),)], "value string").coalesce(1).write.text(path)
    own = contract.read_contract(spark, path, mandatory=("confidence", "approval"))
    found = contract.validate_events(inputs.event_documents(spark, sf), "doc", ["event_id"], contract=own)
    return found.select("event_id", "position", "path", "keyword", "message")


def contract_strict_findings(spark, sf):
    """Documents with a wrong time, an empty text, a negative score or no status, with formats enforced."""
    docs = inputs.event_documents(spark, sf)
    part = F.col("event_id") % 4
    untimed = F.replace("doc", F.lit('"timestamp":"2026-07-15T09:41:00Z"'), F.lit('"timestamp":"2026-07-15"'))
    empty = F.regexp_replace("doc", '"source":"[a-z]*","event_type"', '"source":"","event_type"')
    negative = F.regexp_replace("doc", '"overall_score":[0-9]+', '"overall_score":-1')
    undecided = F.regexp_replace("doc", '"approval_status":"[a-z]*",?', "")
    docs = docs.select("event_id", F.when(part == 0, untimed).when(part == 1, empty).when(part == 2, negative).otherwise(undecided).alias("doc"))
    return contract.validate_events(docs, "doc", ["event_id"], strict_formats=True).select("event_id", "path", "keyword", "message")


# lists in lists, references, alternatives, names found in the value
ORDER_SCHEMA = {
    "type": "object",
    "required": ["id", "status", "lines"],
    "properties": {
        "id": {"type": "integer", "multipleOf": 1},
        "status": {"enum": ["O", "F"]},
        "priority": {"type": "string", "pattern": "^[1-4]-"},
        "lines": {"type": "array", "items": {"$ref": "#/definitions/line"}, "maxItems": 6},
    },
    "patternProperties": {"^x_": {"type": "null"}},
    "additionalProperties": False,
    "if": {"properties": {"status": {"const": "F"}}},
    "then": {"required": ["closed"]},
    "definitions": {
        "line": {
            "type": "object",
            "properties": {
                "quantity": {"type": "number", "maximum": 45},
                "flag": {"oneOf": [{"const": "N"}, {"enum": ["A", "N"]}]},
                "charges": {"type": "array", "items": {"allOf": [{"$ref": "#/definitions/charge"}, {"not": {"required": ["waived"]}}]}},
            },
        },
        "charge": {"type": "object", "properties": {"kind": {"type": "string", "maxLength": 3}, "rate": {"exclusiveMinimum": 0}}, "additionalProperties": {"type": "boolean"}},
    },
}


def order_documents(spark, sf):
    """An order with its lines, and the charges of each line, as a JSON document."""
    charge = "named_struct('kind', '{}', 'rate', {}, 'waived', CASE WHEN {} THEN 1 END)"
    line = f"""named_struct('number', l_linenumber, 'quantity', l_quantity, 'flag', l_returnflag,
        'charges', array({charge.format('tax', 'l_tax', 'l_tax = 0.08')}, {charge.format('rebate', 'l_discount', 'false')}))"""
    lines = inputs.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.expr(f"sort_array(collect_list({line}))").alias("lines"))  # a few lines an order
    whole = inputs.table(spark, sf, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    doc = """to_json(named_struct('id', o_orderkey, 'status', o_orderstatus, 'priority', o_orderpriority, 'lines', lines,
        'x_note', CASE WHEN o_orderkey % 7 = 0 THEN 'seen' END, 'open', CASE WHEN o_orderkey % 11 = 0 THEN true END))"""
    return whole.select("o_orderkey", F.expr(doc).alias("doc"))


def order_document_findings(spark, sf):
    docs = order_documents(spark, sf).select("o_orderkey", parse_strict(F.col("doc")).alias("value"))
    found = check_documents(docs, "value", Schema(ORDER_SCHEMA), ["o_orderkey"])
    # the message on too many lines would hold them all
    return found.withColumn("message", F.when(F.col("keyword") == "maxItems", F.lit("list")).otherwise(F.col("message")))


QUERIES = {
    f.__name__: f for f in (contract_findings, contract_summary, contract_valid_events, contract_inner_faults, contract_property_events, contract_schema_file, contract_strict_findings, order_document_findings)
}

_JSON = "event_id % 41 <> 0"
_FOUND = f"""
found AS (
  SELECT event_id, 0 AS o, '' AS sort, '(root)' AS path, 'json' AS keyword, 'record is not valid JSON' AS message FROM events WHERE event_id % 41 = 0
  UNION ALL SELECT event_id, 1, '', '(root)', 'mandatory', 'Missing required top-level field(s): confidence, approval' FROM events WHERE event_id % 41 = 0
  UNION ALL SELECT event_id, 1, '', '(root)', 'mandatory', 'Missing required top-level field(s): confidence' FROM events WHERE {_JSON} AND event_id % 17 = 0
  UNION ALL SELECT event_id, 2, '', '(root)', 'required', '[(root)] ''confidence'' is a required property' FROM events WHERE {_JSON} AND event_id % 17 = 0
  UNION ALL SELECT event_id, 3, '', '(root)', 'additionalProperties', '[(root)] Additional properties are not allowed (''note'' was unexpected)' FROM events WHERE {_JSON} AND event_id % 37 = 0
  UNION ALL SELECT event_id, 4, 'approval.approver_id', 'approval.approver_id', 'const', '[approval.approver_id] None was expected'
    FROM events WHERE {_JSON} AND event_id % 2 = 0 AND event_id % 29 = 0
  UNION ALL SELECT event_id, 4, 'approval', 'approval', 'required', '[approval] ''approval_timestamp'' is a required property'
    FROM events WHERE {_JSON} AND event_id % 2 = 1 AND event_id % 31 = 0
  UNION ALL SELECT event_id, 4, 'confidence.applies_to', 'confidence.applies_to', 'minItems', '[confidence.applies_to] [] should be non-empty'
    FROM events WHERE {_JSON} AND event_id % 17 <> 0 AND event_id % 23 = 0
  UNION ALL SELECT event_id, 4, 'confidence.overall_score', 'confidence.overall_score', 'maximum', '[confidence.overall_score] 101 is greater than the maximum of 100'
    FROM events WHERE {_JSON} AND event_id % 17 <> 0 AND event_id % 19 = 0
  UNION ALL SELECT event_id, 4, 'enrichment', 'enrichment.threat_intel_matches.1.match_type', 'enum',
    '[enrichment.threat_intel_matches.1.match_type] ''guess'' is not one of [''exact'', ''heuristic'', ''campaign_correlation'']'
    FROM events WHERE {_JSON} AND event_id % 13 = 0
  UNION ALL SELECT event_id, 4, 'event.event_type', 'event.event_type', 'enum',
    '[event.event_type] ''unheard'' is not one of [''authentication'', ''malware_detection'', ''network_intrusion'', ''data_exfiltration'', ''privilege_escalation'', ''policy_violation'', ''insider_activity'', ''vulnerability'', ''other'']'
    FROM events WHERE {_JSON} AND event_id % 11 = 0)"""

_POSITIONS = f"""WITH {_FOUND} SELECT event_id, CAST(row_number() OVER (PARTITION BY event_id ORDER BY o, sort) AS INTEGER) AS position,
        path, keyword, message FROM found"""
# lines with their place in the order
_LINES = """lines AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity, l_returnflag, l_tax, l_discount) - 1 AS i,
    count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
  known AS (SELECT DISTINCT o_orderkey, o_orderstatus, o_orderpriority FROM lines)"""

ORACLES = {
    "contract_findings": _POSITIONS,
    "contract_schema_file": _POSITIONS,
    "contract_strict_findings": f"""WITH {_FOUND} SELECT event_id, path, keyword, message FROM found WHERE NOT (keyword = 'maximum' AND event_id % 4 = 2)
        UNION ALL SELECT event_id, 'event.timestamp', 'format', '[event.timestamp] ''2026-07-15'' is not a ''date-time''' FROM events WHERE {_JSON} AND event_id % 4 = 0
        UNION ALL SELECT event_id, 'event.source', 'minLength', '[event.source] '''' should be non-empty' FROM events WHERE {_JSON} AND event_id % 4 = 1
        UNION ALL SELECT event_id, 'confidence.overall_score', 'minimum', '[confidence.overall_score] -1 is less than the minimum of 0' FROM events
          WHERE {_JSON} AND event_id % 4 = 2 AND event_id % 17 <> 0
        UNION ALL SELECT event_id, '(root)', 'mandatory', 'Missing required approval field(s): approval_status' FROM events WHERE {_JSON} AND event_id % 4 = 3 AND event_id % 17 <> 0
        UNION ALL SELECT event_id, 'approval', 'required', '[approval] ''approval_status'' is a required property' FROM events WHERE {_JSON} AND event_id % 4 = 3
        UNION ALL SELECT event_id, 'approval.approver_id', 'const', '[approval.approver_id] None was expected' FROM events WHERE {_JSON} AND event_id % 4 = 3
        UNION ALL SELECT event_id, 'approval.approval_timestamp', 'const', '[approval.approval_timestamp] None was expected' FROM events
          WHERE {_JSON} AND event_id % 4 = 3 AND event_id % 31 <> 0""",
    "order_document_findings": f"""WITH {_LINES}
        SELECT o_orderkey, 'status' AS path, 'enum' AS keyword, '''P'' is not one of [''O'', ''F'']' AS message FROM known WHERE o_orderstatus = 'P'
        UNION ALL SELECT o_orderkey, 'priority', 'pattern', '''' || o_orderpriority || ''' does not match ''^[1-4]-''' FROM known WHERE NOT regexp_matches(o_orderpriority, '^[1-4]-')
        UNION ALL SELECT o_orderkey, '(root)', 'required', '''closed'' is a required property' FROM known WHERE o_orderstatus = 'F'
        UNION ALL SELECT o_orderkey, '(root)', 'additionalProperties', '''open'' does not match any of the regexes: ''^x_''' FROM known WHERE o_orderkey % 11 = 0
        UNION ALL SELECT o_orderkey, 'x_note', 'type', '''seen'' is not of type ''null''' FROM known WHERE o_orderkey % 7 = 0
        UNION ALL SELECT l_orderkey, 'lines', 'maxItems', 'list' FROM lines WHERE n > 6 AND i = 0
        UNION ALL SELECT l_orderkey, 'lines.' || i || '.quantity', 'maximum', CAST(l_quantity AS INT) || ' is greater than the maximum of 45' FROM lines WHERE l_quantity > 45
        UNION ALL SELECT l_orderkey, 'lines.' || i || '.flag', 'oneOf', '''' || l_returnflag || ''' is ' || CASE l_returnflag WHEN 'N' THEN 'valid under more than one' ELSE 'not valid under any' END || ' of the given schemas'
          FROM lines WHERE l_returnflag <> 'A'
        UNION ALL SELECT l_orderkey, 'lines.' || i || '.charges.0.rate', 'exclusiveMinimum', '0 is less than or equal to the minimum of 0' FROM lines WHERE l_tax = 0
        UNION ALL SELECT l_orderkey, 'lines.' || i || '.charges.1.rate', 'exclusiveMinimum', '0 is less than or equal to the minimum of 0' FROM lines WHERE l_discount = 0
        UNION ALL SELECT l_orderkey, 'lines.' || i || '.charges.0.waived', 'type', '1 is not of type ''boolean''' FROM lines WHERE l_tax = 0.08
        UNION ALL SELECT l_orderkey, 'lines.' || i || '.charges.0', 'not', '{{"kind":"tax","rate":0.08,"waived":1}} should not be valid under the given schema' FROM lines WHERE l_tax = 0.08
        UNION ALL SELECT l_orderkey, 'lines.' || i || '.charges.1.kind', 'maxLength', '''rebate'' is too long' FROM lines""",
    "contract_summary": f"""WITH {_FOUND}, bad AS (SELECT count(DISTINCT event_id) AS n FROM found)
        SELECT (SELECT count(*) FROM events) AS n_records, (SELECT count(*) FROM events) - n AS n_valid, n AS n_invalid FROM bad""",
    "contract_valid_events": f"WITH {_FOUND} SELECT event_id FROM events WHERE event_id NOT IN (SELECT event_id FROM found)",
    "contract_inner_faults": f"WITH {_FOUND}, inner_faults AS (SELECT * FROM (VALUES "
        "(0, '(root)', 'mandatory', 'Missing required confidence field(s): scale'), "
        "(0, 'confidence', 'required', '[confidence] ''scale'' is a required property'), "
        "(1, 'event.severity', 'type', '[event.severity] 7 is not of type ''string'''), "
        "(1, 'event.severity', 'enum', '[event.severity] 7 is not one of [''informational'', ''low'', ''medium'', ''high'', ''critical'']'), "
        "(1, 'enrichment.asset_context.criticality', 'type', '[enrichment.asset_context.criticality] None is not of type ''string'''), "
        "(1, 'enrichment.asset_context.criticality', 'enum', "
        "'[enrichment.asset_context.criticality] None is not one of [''low'', ''medium'', ''high'', ''mission_critical'']')) f(part, path, keyword, message)) "
        f"SELECT event_id, path, keyword, message FROM found UNION ALL SELECT event_id, path, keyword, message FROM events "
        f"JOIN inner_faults ON event_id % 3 = part WHERE {_JSON} AND (part = 1 OR event_id % 17 <> 0)",
    "contract_property_events": " UNION ALL ".join(
        f"SELECT '(root)' AS path, '{k}' AS keyword, '{m}' AS message, count(*) AS n FROM events"
        for k, m in [("mandatory", "Missing required top-level field(s): confidence, approval")]
        + [("required", f"[(root)] ''{s}'' is a required property") for s in ("event", "enrichment", "confidence", "approval", "audit_trail")]
        + [("additionalProperties", "[(root)] Additional properties are not allowed (''k'' was unexpected)")]
    ),
}

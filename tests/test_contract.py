import copy
import json

import pytest

from tidewatch.operators.contract import contract_summary, valid_events, validate_events

VALID = {
    "event": {"event_id": "E1", "timestamp": "2026-07-15T09:41:00Z", "source": "edr", "event_type": "malware_detection", "severity": "high"},
    "enrichment": {
        "threat_intel_matches": [{"indicator": "1.1.1.1", "indicator_type": "ip", "source": "f", "match_type": "exact", "campaign_or_actor": None}],
        "asset_context": {"asset_id": "W", "criticality": "medium"}, "related_events": [{"event_id": "x", "relationship": "same_asset"}],
    },
    "confidence": {"scale": "0-100", "overall_score": 82, "overall_label": "high", "applies_to": ["event.severity"]},
    "approval": {"approval_status": "approved", "approver_id": "a", "approval_timestamp": "2026-07-15T09:55:00Z"},
    "audit_trail": [{"actor": "s", "actor_type": "system", "action": "t", "timestamp": "z"}],
}
GONE = object()


def changed(path, value):
    doc = copy.deepcopy(VALID)
    *front, last = path.split(".")
    at = doc
    for step in front:
        at = at[step]
    if value is GONE:
        del at[last]
    else:
        at[last] = value
    return json.dumps(doc)


CASES = [
    (json.dumps(VALID), []),
    (changed("confidence", GONE), ["Missing required top-level field(s): confidence", "[(root)] 'confidence' is a required property"]),
    (changed("approval", GONE), ["Missing required top-level field(s): approval", "[(root)] 'approval' is a required property"]),
    (changed("zz", 1), ["[(root)] Additional properties are not allowed ('zz' was unexpected)"]),
    (changed("event.severity", "x"), ["[event.severity] 'x' is not one of ['informational', 'low', 'medium', 'high', 'critical']"]),
    (changed("confidence.overall_score", 101.5), ["[confidence.overall_score] 101.5 is greater than the maximum of 100"]),
    (changed("confidence.overall_score", "9"), ["[confidence.overall_score] '9' is not of type 'number'"]),
    (changed("confidence.scale", "1"), ["[confidence.scale] '0-100' was expected"]),
    (changed("confidence.applies_to", []), ["[confidence.applies_to] [] should be non-empty"]),
    (changed("confidence.applies_to", ["a", 1]), ["[confidence.applies_to.1] 1 is not of type 'string'"]),
    (changed("confidence.field_scores", [{"field": "a", "score": -1}]), ["[confidence.field_scores.0.score] -1 is less than the minimum of 0"]),
    (changed("event.event_id", ""), ["[event.event_id] '' should be non-empty"]),
    (changed("event.source", True), ["[event.source] True is not of type 'string'"]),
    (changed("enrichment.asset_context", None), ["[enrichment.asset_context] None is not of type 'object'"]),
    (changed("approval.approval_status", "pending"), ["[approval.approval_timestamp] None was expected", "[approval.approver_id] None was expected"]),
    (changed("approval", {"approval_status": "pending", "approver_id": None}), []),
    (changed("approval.approver_id", None), ["[approval.approver_id] None is not of type 'string'"]),
    (changed("approval.approver_id", GONE), ["[approval] 'approver_id' is a required property"]),
    (
        changed("approval", {}),
        ["Missing required approval field(s): approval_status", "[approval] 'approval_status' is a required property",
         "[approval] 'approver_id' is a required property", "[approval] 'approval_timestamp' is a required property"],
    ),
    (changed("approval", 5), ["[approval] 5 is not of type 'object'"]),
    (
        changed("audit_trail", VALID["audit_trail"] * 11 + [{"actor": "s", "actor_type": "robot", "action": "t", "timestamp": "z"}]),
        ["[audit_trail.11.actor_type] 'robot' is not one of ['human', 'system']"],
    ),
    ("{bad", ["record is not valid JSON", "Missing required top-level field(s): confidence, approval"]),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, d) for i, (d, _) in enumerate(CASES)], "id int, doc string")


def test_findings(docs):
    rows = validate_events(docs, "doc", ["id"]).orderBy("id", "position").collect()
    for i, (_, wanted) in enumerate(CASES):
        assert [r.message for r in rows if r.id == i] == wanted


def test_summary(docs):
    good = {i for i, (_, wanted) in enumerate(CASES) if not wanted}
    assert {r.id for r in valid_events(docs, "doc", ["id"]).collect()} == good
    s = contract_summary(docs, "doc", ["id"]).first()
    assert (s.n_records, s.n_valid, s.n_invalid) == (len(CASES), len(good), len(CASES) - len(good))


def test_formats_on_request(docs):
    strict = validate_events(docs.where("id = 0"), "doc", ["id"], strict_formats=True).collect()
    assert [r.message for r in strict] == ["[audit_trail.0.timestamp] 'z' is not a 'date-time'"]

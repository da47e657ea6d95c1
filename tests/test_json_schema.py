"""Schemas as expressions, on small values."""

import json

import pytest
from pyspark.sql import functions as F

from tidewatch.functions.jsons import parse_strict
from tidewatch.operators.contract import Contract, valid_events, validate_events
from tidewatch.operators.json_schema import Schema, check_documents


def messages(spark, schema, values, strict=False):
    docs = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "id int, doc string").select("id", parse_strict(F.col("doc")).alias("v"))
    own = Schema(schema, strict)
    rows = check_documents(docs, "v", own, ["id"]).collect()
    valid = {r.id: r.ok for r in docs.select("id", own.valid("v").alias("ok")).collect()}
    assert valid == {i: i not in {r.id for r in rows} for i in range(len(values))}
    return [sorted((r.path, r.message) for r in rows if r.id == i) for i in range(len(values))]


@pytest.mark.parametrize(
    ("schema", "good", "bad"),
    [
        ({"type": "integer"}, [1, 2.0, -3], [(1.5, "1.5 is not of type 'integer'"), ("1", "'1' is not of type 'integer'"), (True, "True is not of type 'integer'")]),
        ({"type": ["string", "null"]}, ["a", None], [(3, "3 is not of type 'string', 'null'"), ([], "[] is not of type 'string', 'null'")]),
        ({"enum": ["a", 1, None, True]}, ["a", 1, 1.0, None, True], [("b", "'b' is not one of ['a', 1, None, True]"), (False, "False is not one of ['a', 1, None, True]")]),
        ({"minLength": 2, "maxLength": 3}, ["ab", "abc", 7], [("a", "'a' is too short"), ("abcd", "'abcd' is too long")]),
        ({"pattern": "^a'b"}, ["a'bc", 5], [("x'", '"x\'" does not match "^a\'b"')]),
        ({"minimum": 1, "exclusiveMaximum": 5}, [1, 4.9, "x"], [(0, "0 is less than the minimum of 1"), (5, "5 is greater than or equal to the maximum of 5")]),
        ({"exclusiveMinimum": 1, "maximum": 2.5}, [1.1, 2.5], [(1, "1 is less than or equal to the minimum of 1"), (3, "3 is greater than the maximum of 2.5")]),
        ({"multipleOf": 3}, [9, "a"], [(10, "10 is not a multiple of 3")]),
        ({"minItems": 1, "maxItems": 2}, [[1], {}], [([], "[] should be non-empty"), ([1, 2, 3], "[1,2,3] is too long")]),
        ({"minProperties": 1, "maxProperties": 1}, [{"a": 1}, 4], [({}, "{} should be non-empty"), ({"a": 1, "b": 2}, '{"a":1,"b":2} has too many properties')]),
        ({"const": "it's"}, ["it's"], [("its", '"it\'s" was expected')]),
        ({"anyOf": [{"type": "string"}, {"minimum": 3}]}, ["a", 3, None], [(2, "2 is not valid under any of the given schemas")]),
        ({"oneOf": [{"minimum": 3}, {"maximum": 5}]}, [2, 6], [(4, "4 is valid under more than one of the given schemas")]),
        ({"not": {"type": "null"}}, [1], [(None, "None should not be valid under the given schema")]),
        (False, [], [(1, "False schema does not allow 1")]),
        (True, [1, None, {}], []),
        ({"if": {"type": "string"}, "then": {"minLength": 2}, "else": {"minimum": 2}}, ["ab", 2, None], [("a", "'a' is too short"), (1, "1 is less than the minimum of 2")]),
    ],
)
def test_keywords(spark, schema, good, bad):
    found = messages(spark, schema, [*good, *(v for v, _ in bad)])
    assert found == [[]] * len(good) + [[("(root)", m)] for _, m in bad]


def test_places(spark):
    leaf = {"type": "object", "properties": {"n": {"$ref": "#/$defs/small"}}, "additionalProperties": {"type": "string"}, "patternProperties": {"^p": {"$ref": "#/$defs/small"}}}
    schema = {"items": {"type": "array", "items": leaf}, "$defs": {"small": {"maximum": 3}}}
    value = [[], [{"n": 4}, {"n": 1, "x": 2, "p1": 9, "y": "t"}], [{"p": 3}], 5]
    wanted = [("1.0.n", "4 is greater than the maximum of 3"), ("1.1.p1", "9 is greater than the maximum of 3"), ("1.1.x", "2 is not of type 'string'"), ("3", "5 is not of type 'array'")]
    assert messages(spark, schema, [value, [], 7]) == [wanted, [], []]


def test_formats_on_request(spark):
    values = ["2026-01-02T03:04:05Z", "2026-01-02T03:04:05.5+02:00", "2026-01-02T03:04:05", "2026-13-02T03:04:05Z", "x", 4]
    schema = {"format": "date-time"}
    assert messages(spark, schema, values) == [[]] * 6
    assert [len(x) for x in messages(spark, schema, values, strict=True)] == [0, 0, 1, 1, 1, 0]


@pytest.mark.parametrize("schema", [{"type": "object", "propertyNames": {}}, {"$ref": "#/definitions/a", "definitions": {"a": {"items": {"$ref": "#/definitions/a"}}}}, {"$ref": "http://x/y"}, {"items": [{}]}, {"enum": [{}]}])
def test_what_is_not_supported_is_an_error(spark, schema):
    with pytest.raises(ValueError):
        Schema(schema).valid("v")


def test_a_contract_of_its_own(spark):
    contract = Contract({"type": "object", "properties": {"a": {"type": "object", "required": ["x"]}, "b": {}}}, mandatory=("a", "b"))
    docs = spark.createDataFrame([(1, '{"a": {"x": 1}, "b": 2}'), (2, '{"a": {}, "b": 2}'), (3, '{"b": 1}'), (4, "nothing"), (5, None)], "id int, doc string")
    found = validate_events(docs, "doc", ["id"], contract=contract).orderBy("id", "position").collect()
    assert [(r.id, r.message) for r in found] == [
        (2, "Missing required a field(s): x"), (2, "[a] 'x' is a required property"), (3, "Missing required top-level field(s): a"),
        (4, "record is not valid JSON"), (4, "Missing required top-level field(s): a, b"), (5, "record is not valid JSON"), (5, "Missing required top-level field(s): a, b"),
    ]
    assert [r.id for r in valid_events(docs, "doc", ["id"], contract=contract).collect()] == [1]


def test_rules_are_flat_and_read_once(spark):
    inner = {"type": "object", "required": ["x"], "properties": {"x": {"enum": ["a"]}, "y": {"type": "number"}}}
    schema = {"required": ["o"], "properties": {"o": inner, "n": {"maximum": 3}}, "if": {"required": ["n"], "properties": {"n": {"const": 1}}}, "then": {"required": ["p"]}}
    values = [{"o": {"x": "a"}}, {"o": {"x": "b", "y": None}}, {"n": 1, "o": {}}, {"n": 4, "o": []}]
    assert messages(spark, schema, values) == [
        [], [("o.x", "'b' is not one of ['a']"), ("o.y", "None is not of type 'number'")], [("(root)", "'p' is a required property"), ("o", "'x' is a required property")],
        [("n", "4 is greater than the maximum of 3"), ("o", "[] is not of type 'object'")],
    ]
    docs = spark.createDataFrame([(1, "{}")], "id int, doc string").select("id", parse_strict(F.col("doc")).alias("v"))
    plan = check_documents(docs, "v", Schema(schema), ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter (size(" not in plan
    # nothing is opened by a function over an array but the names of a message
    assert plan.count("lambdafunction") <= 1, plan

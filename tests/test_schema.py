"""Faults of documents under a schema."""

import json

from pressmill.operators.schema import faults, schema_faults
from pressmill.sources.session import ship

SCHEMA = {
    "type": "object", "required": ["id", "items"], "additionalProperties": False, "definitions": {"side": {"type": "integer", "exclusiveMinimum": 0}},
    "properties": {
        "id": {"type": "string", "pattern": "^https?:"}, "kind": {"enum": ["a", "b"]}, "fixed": {"const": 1}, "body": {"oneOf": [{"type": "string"}, {"type": "array", "minItems": 1}]},
        "items": {"type": "array", "items": {"type": "object", "properties": {"w": {"$ref": "#/definitions/side"}}}},
    },
}


def test_faults():
    assert faults(json.dumps({"id": "http://x", "items": [{"w": 3}, {"w": 4.0}], "kind": "a", "fixed": 1, "body": ["x"]}), SCHEMA) == []
    assert faults(json.dumps({"items": [{"w": 1}, {"w": 0}, 5, {"w": True}] + [{}] * 7 + [{"w": "x"}]}), SCHEMA) == [
        "<root>: id is missing", "items/1/w: 0 is not more than 0", "items/2: 5 is not of type object", "items/3/w: true is not of type integer", 'items/11/w: "x" is not of type integer',
    ]
    assert faults(json.dumps({"id": "ftp:", "items": [], "kind": "c", "fixed": 2, "body": [], "more": 1}), SCHEMA) == [
        "body: does not fit oneOf", "fixed: 1 was expected", 'id: "ftp:" does not match ^https?:', 'kind: "c" is none of ["a", "b"]', "more: nothing is allowed here",
    ]
    assert faults("[1", SCHEMA) == faults(None, SCHEMA) == ["<root>: no JSON"] and faults("[]", SCHEMA) == ["<root>: [] is not of type object"]


def test_faults_of_a_table(spark):
    ship(spark)
    rows = spark.createDataFrame([(1, '{"id": "http://x", "items": []}'), (2, "{}"), (3, None)], "k int, d string")
    got = {r.k: r.faults for r in schema_faults(rows, "k", "d", SCHEMA).collect()}
    assert got == {1: [], 2: ["<root>: id is missing", "<root>: items is missing"], 3: ["<root>: no JSON"]}

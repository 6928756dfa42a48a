"""Documents without a fixed shape, and whole JSON schemas."""

import json

import duckdb
import pytest
from pyspark.sql import functions as F

from daybook.operators import jsonschema
from daybook.operators import variants as V

DOCS = [
    {"name": "a", "n": 1, "tags": ["x", "y"], "at": {"zip": "1", "city": None}},
    {"name": None, "n": "one", "tags": "x", "at": "nowhere"},
    {"n": {"deep": [1, {"deep": 2}]}, "tags": [], "at": {}},
    {"name": ["list"], "n": None, "at": None, "tags": [{"t": 1}, None, 3]},
    [1, 2],
    "text",
    None,
]


@pytest.fixture(scope="module")
def docs(spark):
    return V.from_json(spark.createDataFrame([(str(i), json.dumps(d)) for i, d in enumerate(DOCS)], "_id string, t string"), "t")


def plain(coll):
    rows = V.to_json(coll).orderBy("_id").collect()
    return [json.loads(r.doc) for r in rows]


def merged(doc, patch):
    return json.loads(duckdb.execute("select json_merge_patch(?::json, ?::json)", [json.dumps(doc), json.dumps(patch)]).fetchone()[0])


@pytest.mark.parametrize(
    "patch",
    [
        {"name": "b"},
        {"n": {"deep": 5}},
        {"n": {"deep": None, "new": {"x": None, "y": []}}},
        {"at": {"zip": None, "street": "7"}, "tags": {"was": "list"}},
        {"name": None, "tags": None, "missing": None},
        {"n": False, "at": 2.5, "it's": {"a.b": 1}},
        {},
    ],
)
def test_merge_patch_as_another_engine_has_it(docs, patch):
    objects = docs.filter(V.kind("n").isNotNull())
    assert plain(V.patch(objects, patch)) == [merged(d, patch) for d in DOCS[:4]]


def test_conditional_patch_changes_a_type_in_some_documents(docs):
    out = plain(V.patch(docs, {"n": {"was": V.at("n")}, "name": F.upper(V.at("name", "string"))}, V.kind("n").isin("number", "string")))
    assert [d["n"] for d in out[:4]] == [{"was": 1}, {"was": "one"}, {"deep": [1, {"deep": 2}]}, None]
    assert out[0]["name"] == "A" and out[4:] == DOCS[4:]
    with pytest.raises(ValueError, match="_id"):
        V.patch(docs, {"_id": 1})


def test_set_change_and_unset(docs):
    assert [d.get("at") for d in plain(V.set_path(docs, "at.zip", None))[:4]] == [{"zip": None, "city": None}, "nowhere", {"zip": None}, None]
    assert [d.get("at") for d in plain(V.change_path(docs, "at.city", [1]))[:4]] == [{"zip": "1", "city": [1]}, "nowhere", {}, None]
    assert ["name" in d for d in plain(V.set_path(docs, "name", "z", "_id <> '2'"))[:4]] == [True, True, False, True]
    assert [d.get("name", "-") for d in plain(V.change_path(docs, "name", 0))[:4]] == [0, 0, "-", 0]
    assert [d.get("n") for d in plain(V.change_path(docs, "n.deep[1].deep", "in"))[:4]] == [1, "one", {"deep": [1, {"deep": "in"}]}, None]
    tags = [d["tags"] for d in plain(V.set_path(docs, "tags[1]", {"k": 1}))[:4]]
    assert tags == [["x", {"k": 1}], "x", [{"k": 1}], [{"t": 1}, {"k": 1}, 3]]
    gone = plain(V.unset(docs, "tags[0]", "at.city", "name", condition="_id <> '3'"))
    assert gone[0] == {"n": 1, "tags": ["y"], "at": {"zip": "1"}} and gone[1] == {"n": "one", "tags": "x", "at": "nowhere"} and gone[3:] == DOCS[3:]
    assert plain(V.unset(docs, "nowhere", "tags[9]", "name.x")) == DOCS
    with pytest.raises(ValueError, match="_id"):
        V.set_path(docs, "_id", 1)


def test_arrays_and_null_elements(docs):
    assert [d["tags"] for d in plain(V.array_append(docs, "tags", None))[:4]] == [["x", "y", None], "x", [None], [{"t": 1}, None, 3, None]]
    assert [d["tags"] for d in plain(V.array_insert(docs, "tags[1]", "in"))[:4]] == [["x", "in", "y"], "x", ["in"], [{"t": 1}, "in", None, 3]]
    kinds = docs.select(V.kind("tags[1]").alias("k")).collect()
    assert [r.k for r in kinds[:4]] == ["string", None, None, "null"]


def test_members_at_any_depth(spark):
    deep = 1
    for level in range(50):
        deep = {"x": deep} if level % 2 else [0, deep]
    rows = [("1", json.dumps(deep)), ("2", '{"x":{"x":[{"x":null},{"y":{"x":"t"}}]}}'), ("3", '"x"'), ("4", "broken"), ("5", None)]
    coll = V.from_json(spark.createDataFrame(rows, "_id string, t string"), "t")
    found = V.anywhere(coll, "x").collect()
    mine = sorted((r._id, r.path) for r in found if r._id == "2")
    assert mine == [("2", "$.x"), ("2", "$.x.x"), ("2", "$.x.x[0].x"), ("2", "$.x.x[1].y.x")]
    assert sum(r._id == "1" for r in found) == 25 and len(found) == 29


SCHEMA = {
    "$schema": "http://json-schema.org/draft-04/schema",
    "type": "object",
    "required": ["id", "lines"],
    "definitions": {"money": {"type": "number", "minimum": 0, "exclusiveMinimum": True, "multipleOf": 0.01}},
    "properties": {
        "id": {"type": "string", "pattern": "^[A-Z]+-[0-9]+$", "minLength": 4, "maxLength": 6},
        "total": {"$ref": "#/definitions/money"},
        "lines": {
            "type": "array",
            "minItems": 1,
            "maxItems": 3,
            "uniqueItems": True,
            "items": {"type": "object", "required": ["qty"], "properties": {"qty": {"type": "integer", "maximum": 9}, "price": {"$ref": "#/definitions/money"}}},
        },
        "state": {"enum": ["open", 1, None, {"a": [1]}]},
        "pair": {"items": [{"type": "string"}, {"type": "boolean"}], "additionalItems": False},
        "choice": {"oneOf": [{"type": "integer"}, {"minimum": 10}]},
        "other": {"not": {"type": "null"}, "anyOf": [{"type": "string"}, {"maxProperties": 1, "minProperties": 1}]},
    },
    "patternProperties": {"^x-": {"type": "string"}},
    "additionalProperties": {"type": "boolean"},
    "dependencies": {"total": ["state"], "flag": {"required": ["other"]}},
}

GOOD = {"id": "AB-1", "lines": [{"qty": 1}]}
CASES = [
    (GOOD, []),
    ({**GOOD, "lines": [{"qty": 2.0, "price": 0.07}], "total": 12.34, "state": "open"}, []),
    ("text", ["type:$"]),
    ({}, ["required:$.id", "required:$.lines"]),
    ({"id": "ab", "lines": []}, ["minLength:$.id", "pattern:$.id", "minItems:$.lines"]),
    ({**GOOD, "lines": [{"qty": 1}, {"qty": 1}]}, ["uniqueItems:$.lines"]),
    ({**GOOD, "lines": [{"qty": 10}, {}, {"qty": "1"}, 5]}, ["maximum:$.lines[0].qty", "required:$.lines[1].qty", "type:$.lines[2].qty", "type:$.lines[3]", "maxItems:$.lines"]),
    ({**GOOD, "total": 0}, ["exclusiveMinimum:$.total", "dependencies:$.state"]),
    ({**GOOD, "total": 0.005, "state": 1.0}, ["multipleOf:$.total"]),
    ({**GOOD, "state": {"a": [1]}, "choice": 5}, []),
    ({**GOOD, "state": {"a": [2]}, "choice": 12}, ["enum:$.state", "oneOf:$.choice"]),
    ({**GOOD, "state": None, "choice": "t"}, []),
    ({**GOOD, "choice": 2.5}, ["oneOf:$.choice"]),
    ({**GOOD, "pair": ["a", 1, 2]}, ["type:$.pair[1]", "never:$.pair[2]"]),
    ({**GOOD, "other": None}, ["not:$.other"]),
    ({**GOOD, "other": {"a": 1, "b": 2}}, ["anyOf:$.other"]),
    ({**GOOD, "x-a": 1, "extra": "no", "flag": True}, ["required:$.other", "type:$.x-a", "type:$.extra"]),
]


def test_schema_violations_by_path(spark):
    rows = [(i, json.dumps(doc)) for i, (doc, _) in enumerate(CASES)] + [(98, "{"), (99, None)]
    judged = jsonschema.judge(spark.createDataFrame(rows, "i int, t string"), "t", SCHEMA)
    found = {r.i: r.violations for r in judged.collect()}
    assert found.pop(98) == found.pop(99) == ["malformed"]
    for i, (doc, wanted) in enumerate(CASES):
        assert sorted(found[i]) == sorted(wanted), doc
    good, bad = jsonschema.validate(spark.createDataFrame(rows, "i int, t string"), "t", SCHEMA)
    assert good.count() + bad.count() == len(rows) and good.count() == sum(not w for _, w in CASES)


def test_what_a_schema_must_not_hold(spark):
    doc = F.parse_json(F.lit("{}"))
    for schema, message in (
        ({"minimun": 1}, "unknown keywords"),
        ({"properties": {"a": {"format": "date"}}}, "unknown keywords"),
        ({"type": "int"}, "unknown types"),
        ({"$ref": "other.json"}, "out of the schema"),
        ({"$ref": "#/definitions/a"}, "leads nowhere"),
        ({"definitions": {"a": {"items": {"$ref": "#/definitions/a"}}}, "$ref": "#/definitions/a"}, "back to itself"),
    ):
        with pytest.raises(ValueError, match=message):
            jsonschema.violations(schema, doc)

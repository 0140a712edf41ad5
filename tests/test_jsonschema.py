"""Compiled JSON schemas against a plain validator."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from tributary.operators import jsonschema as js


def _type(v):
    if isinstance(v, bool):
        return {"boolean"}
    if isinstance(v, (int, float)):
        return {"number", "integer"} if float(v).is_integer() else {"number"}
    return {{str: "string", dict: "object", list: "array", type(None): "null"}[type(v)]}


def first(v, s, path="$"):
    """The violation a careful reader of the schema finds first."""
    if isinstance(s, bool):
        return None if s else f"{path}: false"
    kinds = _type(v)
    if "type" in s and not kinds & set([s["type"]] if isinstance(s["type"], str) else s["type"]):
        return f"{path}: type"
    same = lambda x: _type(x) & kinds and x == v
    if "enum" in s and not any(same(x) for x in s["enum"]):
        return f"{path}: enum"
    if "const" in s and not same(s["const"]):
        return f"{path}: const"
    tests = [("minimum", "number", lambda x: v >= x), ("maximum", "number", lambda x: v <= x),
             ("exclusiveMinimum", "number", lambda x: v > x), ("exclusiveMaximum", "number", lambda x: v < x),
             ("minLength", "string", lambda x: len(v) >= x), ("maxLength", "string", lambda x: len(v) <= x),
             ("pattern", "string", lambda x: re.search(x, v)), ("minItems", "array", lambda x: len(v) >= x),
             ("maxItems", "array", lambda x: len(v) <= x), ("minProperties", "object", lambda x: len(v) >= x),
             ("maxProperties", "object", lambda x: len(v) <= x)]
    for key, kind, ok in tests:
        if key in s and kind in kinds and not ok(s[key]):
            return f"{path}: {key}"
    if "object" in kinds:
        for name in s.get("required", []):
            if name not in v:
                return f"{path}: required {name}"
        if s.get("additionalProperties") is False and set(v) - set(s.get("properties", {})):
            return f"{path}: additionalProperties"
        for name, inner in s.get("properties", {}).items():
            if name in v and (found := first(v[name], inner, f"{path}.{name}")):
                return found
    if "array" in kinds and "items" in s:
        for i, x in enumerate(v):
            if found := first(x, s["items"], f"{path}[{i}]"):
                return found
    return None


SCHEMA = {
    "$schema": "http://json-schema.org/draft-07/schema", "title": "t", "type": "object", "required": ["metadata", "data"],
    "properties": {
        "metadata": {"type": "object", "required": ["table-name"], "additionalProperties": False, "properties": {
            "table-name": {"type": "string", "minLength": 1, "pattern": "^[a-z]+$"}, "op": {"enum": ["a", 1, None, True]},
            "n": {"type": ["integer", "null"], "minimum": 0, "exclusiveMaximum": 10}}},
        "data": {"type": "object", "maxProperties": 3, "properties": {
            "x": {"type": "number", "maximum": 2.5}, "tags": {"type": "array", "minItems": 1, "items": {
                "type": "object", "required": ["k"], "properties": {"k": {"const": 1}, "v": {"type": "array", "items": {"type": "string", "maxLength": 2}}}}}}},
        "before": {"type": "object"}, "never": False}}


def got(spark, texts, schema):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, value string")
    return [r.violation for r in js.check_schema(df, schema).orderBy("i").collect()]


def test_random_values_equal_plain_validator(spark):
    rng = random.Random(3)
    scalars = ["", "a", "abc", "A", 0, 1, 5, 9, 10, -1, 2.5, 2.6, 1.0, 1e3, None, True, False, 12345678901234567890, [], {}]

    def pick(depth=0):
        return rng.choice(scalars)

    def value():
        v = {"metadata": {"table-name": rng.choice(["orders", "orders", "", "X", 3]), "op": rng.choice(["a", "b", 1, None, True, 1.0]),
                          "n": pick(), "extra": 1},
             "data": {"x": rng.choice([1, 2.5, 2.51, "2"]), "tags": [
                 {"k": rng.choice([1, 1, 1.0, 2]), "v": [rng.choice(["a", "bb", "ccc", 1]) for _ in range(rng.randrange(3))]}
                 for _ in range(rng.randrange(3))], "y": pick(), "z": pick()},
             "before": rng.choice([{}, {"q": 1}, None, 2]), "never": 1}
        v["metadata"].pop("extra") if rng.random() < .9 else None
        for key in ("n", "op", "table-name"):
            v["metadata"].pop(key) if rng.random() < .2 else None
        v["data"].pop("z") if rng.random() < .9 else None
        for key, p in (("never", .95), ("before", .5), ("data", .05), ("metadata", .05)):
            v.pop(key) if rng.random() < p else None
        return v if rng.random() < .95 else pick()
    values = [value() for _ in range(600)]
    want = [first(v, SCHEMA) for v in values]
    assert len(set(want)) >= 15 and None in want
    assert got(spark, [json.dumps(v) for v in values], SCHEMA) == want


def test_not_json_and_text_schema(spark):
    texts = [None, "", "{", "nope", '{"metadata":{},"data":{}}', '{"metadata":null,"data":{}}', '{"metadata":{},"data":{},"before":[]}']
    schema = json.dumps({"type": "object", "required": ["metadata", "data"], "properties": {
        k: {"type": "object"} for k in ("metadata", "data", "before")}})
    assert got(spark, texts, schema) == ["$: not_json"] * 4 + [None, "$.metadata: type", "$.before: type"]


def test_odd_property_names(spark):
    schema = {"properties": {"it's": {"type": "string"}, 'a "b"': {"type": "string"}, "x.y": {"type": "string"}, "é": {"type": "string"}}}
    texts = [json.dumps({k: 1}, ensure_ascii=False) for k in schema["properties"]] + ['{"x":{"y":1}}']
    assert got(spark, texts, schema) == [f"$.{k}: type" for k in schema["properties"]] + [None]


@pytest.mark.parametrize("bad", [{"$ref": "#/x"}, {"type": "date"}, {"enum": [[1]]}, {"items": [{}]}, [], {"properties": {"a": 3}},
                                 {"additionalProperties": {"type": "string"}}, {"properties": {"'\"": {"type": "string"}}}])
def test_what_cannot_be_compiled_is_refused(spark, bad):
    with pytest.raises(js.SchemaError):
        js.violation(F.col("v"), bad)


def test_split_and_plan(spark):
    df = spark.createDataFrame([("{}", 1), ('{"a":1}', 2)], "value string, _json int")
    good, bad = js.split_conforming(df, {"required": ["a"]})
    assert [r._json for r in good.collect()] == [2] and [(r._json, r.parse_error) for r in bad.collect()] == [(1, "$: required a")]
    plan = bad._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_parse_json") + plan.count("parse_json") <= 2  # parsed once, not again in the filter

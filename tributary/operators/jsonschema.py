"""JSON Schema compiled to column expressions: the first violation of each record.

A schema (draft-07 text or dict) becomes one expression over the parsed value;
no Python runs on the rows. The first violation is named by its place and the
keyword it breaks, e.g. ``$.metadata: required table-name`` or
``$.items[2].price: minimum``; records that conform have NULL, text that is not
JSON has ``$: not_json``.

Order: a value's own keywords first (``type``, ``enum``, ``const``, limits,
``required``, ``additionalProperties``), then its properties as the schema
declares them, then its array items by position. As the standard has it, a
keyword says nothing about values of other types, and numbers without a
fraction are integers however they are written.

Annotations are ignored. A keyword that is not known is refused when the schema
is compiled, never skipped.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.variants import kind

NOT_JSON = "not_json"
# Keywords without effect on validation.
ANNOTATIONS = {"$schema", "$id", "$comment", "title", "description", "default", "examples"}
TYPES = ("object", "array", "string", "number", "integer", "boolean", "null")
DECIMAL = "decimal(38,18)"


class SchemaError(ValueError):
    """A schema that cannot be compiled."""


def _is(of: Column, value: Column, name: str) -> Column:
    """The value (of kind ``of``) has the JSON type."""
    match name:
        case "object":
            return of.startswith("OBJECT")
        case "array":
            return of.startswith("ARRAY")
        case "string":
            return of == "STRING"
        case "boolean":
            return of == "BOOLEAN"
        case "null":
            return of == "VOID"
        case "number":
            return (of == "BIGINT") | (of == "DOUBLE") | of.startswith("DECIMAL")
        case "integer":
            double = F.try_variant_get(value, "$", "double")
            return ((of == "BIGINT") | of.rlike(r"^DECIMAL\(\d+,0\)$")
                    | ((of == "DOUBLE") | of.startswith("DECIMAL")) & (double == F.floor(double)))
    raise SchemaError(f"unknown type {name!r}")


def _member(value: Column, name: str) -> Column:
    """Property of an object, as VARIANT; NULL if there is none (a JSON null is a value)."""
    for quote in "'\"":
        if quote not in name and "\\" not in name:
            return F.try_variant_get(value, f"$[{quote}{name}{quote}]", "variant")
    raise SchemaError(f"property name {name!r} has both quotes")


def _number(value: Column, limit: Any, test) -> Column:
    """Compare exactly, as doubles beyond the range of decimals."""
    exact = test(F.try_variant_get(value, "$", DECIMAL), F.lit(str(limit)).try_cast(DECIMAL))
    return F.coalesce(exact, test(F.try_variant_get(value, "$", "double"), F.lit(float(limit))))


def _equal(of: Column, value: Column, want: Any) -> Column:
    if want is None:
        return of == "VOID"
    if isinstance(want, bool):
        return (of == "BOOLEAN") & (F.try_variant_get(value, "$", "boolean") == F.lit(want))
    if isinstance(want, (int, float)):
        return _is(of, value, "number") & _number(value, want, lambda a, b: a == b)
    if isinstance(want, str):
        return (of == "STRING") & (F.try_variant_get(value, "$", "string") == F.lit(want))
    raise SchemaError("enum and const take scalars only")


def _size(value: Column, container: str) -> Column:
    if container == "array":
        return F.size(F.try_variant_get(value, "$", "array<variant>"))
    return F.size(F.try_variant_get(value, "$", "map<string,variant>"))


# keyword -> (type it applies to, test of a value against the keyword's operand)
_LIMITS = {
    "minimum": ("number", lambda v, x: _number(v, x, lambda a, b: a >= b)),
    "maximum": ("number", lambda v, x: _number(v, x, lambda a, b: a <= b)),
    "exclusiveMinimum": ("number", lambda v, x: _number(v, x, lambda a, b: a > b)),
    "exclusiveMaximum": ("number", lambda v, x: _number(v, x, lambda a, b: a < b)),
    "minLength": ("string", lambda v, x: F.length(F.try_variant_get(v, "$", "string")) >= x),
    "maxLength": ("string", lambda v, x: F.length(F.try_variant_get(v, "$", "string")) <= x),
    "pattern": ("string", lambda v, x: F.try_variant_get(v, "$", "string").rlike(x)),
    "minItems": ("array", lambda v, x: _size(v, "array") >= x),
    "maxItems": ("array", lambda v, x: _size(v, "array") <= x),
    "minProperties": ("object", lambda v, x: _size(v, "object") >= x),
    "maxProperties": ("object", lambda v, x: _size(v, "object") <= x),
}
_KEYWORDS = ANNOTATIONS | set(_LIMITS) | {"type", "enum", "const", "required", "properties", "additionalProperties", "items"}


def _violations(value: Column, schema: Any, path: Column) -> list[Column]:
    """Candidate violations of a present value, first one first; each is NULL or text."""
    if schema is True:
        return []
    if schema is False:
        return [F.concat(path, F.lit(": false"))]
    if not isinstance(schema, Mapping):
        raise SchemaError("a schema is an object or a boolean")
    unknown = sorted(set(schema) - _KEYWORDS)
    if unknown:
        raise SchemaError(f"unsupported keywords: {', '.join(unknown)}")
    of = kind(value)

    def broken(bad: Column, what: str) -> Column:
        return F.when(F.coalesce(bad, F.lit(False)), F.concat(path, F.lit(f": {what}")))
    out = []
    if "type" in schema:
        names = [schema["type"]] if isinstance(schema["type"], str) else list(schema["type"])
        right = F.lit(False)
        for n in names:
            right = right | _is(of, value, n)
        out.append(broken(~right, "type"))
    for keyword in ("enum", "const"):
        if keyword in schema:
            right = F.lit(False)
            for want in schema["enum"] if keyword == "enum" else [schema["const"]]:
                right = right | _equal(of, value, want)
            out.append(broken(~F.coalesce(right, F.lit(False)), keyword))
    for keyword, (name, test) in _LIMITS.items():
        if keyword in schema:
            out.append(broken(_is(of, value, name) & ~F.coalesce(test(value, schema[keyword]), F.lit(False)), keyword))
    is_object, properties = of.startswith("OBJECT"), schema.get("properties", {})
    out += [broken(is_object & _member(value, name).isNull(), f"required {name}") for name in schema.get("required", [])]
    if "additionalProperties" in schema:
        if schema["additionalProperties"] not in (True, False):
            raise SchemaError("additionalProperties takes a boolean only")
        if schema["additionalProperties"] is False:
            others = F.array_except(F.map_keys(F.try_variant_get(value, "$", "map<string,variant>")),
                                    F.array(*map(F.lit, properties)).cast("array<string>"))
            out.append(broken(is_object & (F.size(others) > 0), "additionalProperties"))
    for name, inner in properties.items():
        member = _member(value, name)
        found = _violations(member, inner, F.concat(path, F.lit(f".{name}")))
        out += [F.when(is_object & member.isNotNull(), v) for v in found]
    if "items" in schema:
        if isinstance(schema["items"], list):
            raise SchemaError("items takes one schema only")

        def of_item(item: Column, i: Column) -> Column:
            inner = _violations(item, schema["items"], F.concat(path, F.lit("["), i.cast("string"), F.lit("]")))
            return F.coalesce(*inner) if inner else F.lit(None).cast("string")
        items = F.when(of.startswith("ARRAY"), F.try_variant_get(value, "$", "array<variant>"))
        out.append(F.try_element_at(F.filter(F.transform(items, of_item), lambda x: x.isNotNull()), F.lit(1)))
    return out


def violation(value: Column, schema: Mapping | str | bool) -> Column:
    """First violation of a VARIANT value (NULL: the record is not JSON)."""
    schema = json.loads(schema) if isinstance(schema, str) else schema
    found = _violations(value, schema, F.lit("$"))
    return F.when(value.isNull(), F.lit(f"$: {NOT_JSON}")).otherwise(F.coalesce(*found, F.lit(None).cast("string")))


def check_schema(df: DataFrame, schema: Mapping | str | bool, value_col: str = "value", out_col: str = "violation") -> DataFrame:
    """Adds the first violation of the JSON text in ``value_col``.

    The text is parsed once, in a generator no filter is copied below.
    """
    name = "_json"
    while name in df.columns:
        name = f"_{name}"
    parsed = df.select("*", F.inline(F.array(F.struct(F.try_parse_json(F.col(value_col)).alias(name)))))
    return parsed.withColumn(out_col, violation(F.col(name), schema)).drop(name)


def split_conforming(df: DataFrame, schema: Mapping | str | bool, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: bad rows carry ``parse_error``, the violation, for the quarantine."""
    checked = check_schema(df, schema, value_col, "parse_error")
    return checked.where(F.col("parse_error").isNull()).drop("parse_error"), checked.where(F.col("parse_error").isNotNull())

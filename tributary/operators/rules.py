"""Filters of selection rules as predicates over row columns.

A rule may carry ``filters``; each names a column and conditions on it. The
conditions of one column are alternatives (or), the filters of a rule must all
hold (and). Values are text in the rule; what they look like decides how the
row's value is read:

* a number: both sides as exact decimals, as doubles beyond their range; a row's
  text that reads as a number counts as one;
* an ISO date or instant: both sides as instants (UTC unless a zone is given);
* anything else: text, compared by code points.

A row whose column is missing, JSON ``null``, or cannot be read as the value's
type meets no condition but ``null``; a value that cannot be read is not null.
Rules are job configuration, so a predicate is built once on the driver and is
evaluated in generated code.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.functions.variants import field

NUMBER = re.compile(r"[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?")
INSTANT = re.compile(r"\d{4}-\d\d-\d\d([T ]\d\d:\d\d(:\d\d(\.\d{1,9})?)?(Z|[+-]\d\d:?\d\d)?)?")
DECIMAL = "decimal(38,18)"

# The operators of rule conditions and the keys of their operands.
OPERANDS = {"eq": ("value",), "noteq": ("value",), "ste": ("value",), "gte": ("value",),
            "between": ("start-value", "end-value"), "notbetween": ("start-value", "end-value"),
            "null": (), "notnull": ()}


class RuleError(ValueError):
    """A rule that cannot be turned into a predicate."""


def value_type(values: Iterable[str]) -> str:
    """How values are compared: ``number``, ``instant`` or ``text`` (all of them must look alike)."""
    values = list(values)
    for name, pattern in (("number", NUMBER), ("instant", INSTANT)):
        if values and all(pattern.fullmatch(v.strip()) for v in values):
            return name
    return "text"


def _compare(operator: str, row: Column, operands: list[Column]) -> Column:
    match operator:
        case "eq":
            return row == operands[0]
        case "noteq":
            return row != operands[0]
        case "ste":
            return row <= operands[0]
        case "gte":
            return row >= operands[0]
        case "between":
            return (row >= operands[0]) & (row <= operands[1])
        case _:
            return (row < operands[0]) | (row > operands[1])


def condition(column: str, spec: Mapping, data: Column | None = None) -> Column:
    """One condition on a row column; never null."""
    data = F.col("data") if data is None else data
    operator = str(spec.get("filter-operator", ""))
    if operator not in OPERANDS:
        raise RuleError(f"unknown filter operator {operator!r}; one of {', '.join(OPERANDS)}")
    missing = [k for k in OPERANDS[operator] if spec.get(k) is None]
    if missing:
        raise RuleError(f"filter operator {operator!r} needs {', '.join(missing)}")
    text = field(data, column)
    if not OPERANDS[operator]:
        return text.isNull() if operator == "null" else text.isNotNull()
    values = [str(spec[k]) for k in OPERANDS[operator]]
    kind = value_type(values)
    if kind == "text":
        held = _compare(operator, text, [F.lit(v) for v in values])
    elif kind == "instant":
        held = _compare(operator, text.try_cast("timestamp"), [F.lit(v.strip()).cast("timestamp") for v in values])
    else:
        text = F.trim(text)
        row, wide = text.try_cast(DECIMAL), text.try_cast("double")
        exact = [F.lit(v.strip()).try_cast(DECIMAL) for v in values]
        # beyond 20 digits before the point the decimal is null on either side
        held = F.coalesce(_compare(operator, row, exact), _compare(operator, wide, [F.lit(float(v)) for v in values]))
        held = held & wide.isNotNull() & ~F.isnan(wide)
    return F.coalesce(held, F.lit(False))


def filters_predicate(filters: Iterable[Mapping], data: Column | None = None) -> Column:
    """All filters hold; a filter holds if any of its conditions does."""
    every = F.lit(True)
    for f in filters:
        column, conditions = f.get("column-name"), f.get("filter-conditions") or []
        if not column or not conditions:
            raise RuleError("a filter needs column-name and filter-conditions")
        if f.get("filter-type", "source") != "source":
            raise RuleError(f"unknown filter type {f['filter-type']!r}")
        some = F.lit(False)
        for c in conditions:
            some = some | condition(column, c, data)
        every = every & some
    return every

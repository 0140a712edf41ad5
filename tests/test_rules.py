"""Filters of selection rules (F4) against plain comparisons."""

import pytest
from pyspark.sql import functions as F

from tributary.operators import routing, rules


def _row(data, table="t"):
    return ('{"metadata":{"record-type":"data","schema-name":"s","table-name":"%s","operation":"load",'
            '"timestamp":"2022-01-01T00:00:00Z"},"data":%s}' % (table, data))


@pytest.fixture
def kept(spark):
    from tributary.operators import envelope

    def run(rows, *filters, action="include", extra=()):
        df = envelope.parse_dms(spark.createDataFrame([(_row(r), i) for i, r in enumerate(rows)], "value string, seq long"))
        rule = {"rule-id": "7", "rule-action": action, "object-locator": {"schema-name": "s", "table-name": "t"}, "filters": list(filters)}
        return sorted(r.seq for r in routing.select_tables(df, [rule, *extra]).collect())
    return run


def f(column, *conditions):
    return {"column-name": column, "filter-conditions": [
        {"filter-operator": c[0], **dict(zip(rules.OPERANDS.get(c[0], ()), c[1:]))} for c in conditions]}


NUMBERS = ['{"a":1}', '{"a":2.5}', '{"a":"2.50"}', '{"a":1e30}', '{"a":null}', "{}", '{"a":"x"}', '{"a":"NaN"}', '{"a":[2]}',
           '{"a":true}', '{"a":12345678901234567890}', '{"a":" 7 "}']


@pytest.mark.parametrize("condition,want", [
    (("eq", "2.5"), [1, 2]), (("noteq", "2.5"), [0, 3, 10, 11]), (("ste", "2.5"), [0, 1, 2]), (("gte", "7"), [3, 10, 11]),
    (("between", "1", "7"), [0, 1, 2, 11]), (("notbetween", "2", "1e29"), [0, 3]), (("gte", "12345678901234567890"), [3, 10]),
    (("gte", "12345678901234567891"), [3]), (("null",), [4, 5]), (("notnull",), [0, 1, 2, 3, 6, 7, 8, 9, 10, 11])])
def test_numbers(kept, condition, want):
    assert kept(NUMBERS, f("a", condition)) == want


def test_instants_and_text(kept):
    rows = ['{"d":"2022-03-01"}', '{"d":"2022-03-01T12:00:00Z"}', '{"d":"2022-03-01 13:00:00+02:00"}', '{"d":"soon"}', '{"d":20220301}']
    assert kept(rows, f("d", ("gte", "2022-03-01T11:30:00Z"))) == [1]
    assert kept(rows, f("d", ("between", "2022-03-01", "2022-03-01T11:00:00Z"))) == [0, 2]
    assert kept(rows, f("d", ("eq", "soon"))) == [3]
    text = ['{"d":"a"}', '{"d":"B"}', '{"d":"é"}', '{"d":""}', '{"d":"a%"}']
    assert kept(text, f("d", ("gte", "a"))) == [0, 2, 4] and kept(text, f("d", ("eq", "a%"))) == [4]
    assert kept(text, f("d", ("eq", ""))) == [3]


def test_and_or_exclude(kept):
    rows = [f'{{"a":{a},"b":"{b}"}}' for a in range(6) for b in "xy"]
    one = f("a", ("ste", "1"), ("gte", "5"))
    assert kept(rows, one) == [0, 1, 2, 3, 10, 11]
    assert kept(rows, one, f("b", ("eq", "y"))) == [1, 3, 11]
    everything = {"object-locator": {"schema-name": "%", "table-name": "%"}}
    assert kept(rows, one, f("b", ("eq", "y")), action="exclude", extra=[everything]) == [0, 2, 4, 5, 6, 7, 8, 9, 10]


@pytest.mark.parametrize("bad", [f("a", ("like", "1")), f("a", ("between", "1")), {"column-name": "a"}, {"filter-conditions": [{}]},
                                 {**f("a", ("null",)), "filter-type": "target"}])
def test_bad_rules_name_themselves(spark, bad):
    with pytest.raises(rules.RuleError, match="selection rule 9"):
        routing.selection_predicate([{"rule-id": "9", "filters": [bad]}])


def test_predicate_is_never_null(spark):
    df = spark.createDataFrame([(None,)], "data map<string,string>").select(F.lit(None).cast("map<string,variant>").alias("data"))
    assert [r.p for r in df.select(rules.filters_predicate([f("a", ("eq", "1"))]).alias("p")).collect()] == [False]

"""Envelope parsing and quarantine reasons (FIXTURES.md X1-X7, N1-N8)."""

import json

import pytest
from pyspark.sql import functions as F

from tributary.operators import envelope, routing


def change(row, kind="data", operation="update", table="orchard", **meta):
    """Envelope text of one record; ``None`` leaves a part out."""
    parts = {"timestamp": "2031-05-06T07:08:09Z", "record-type": kind, "operation": operation,
             "partition-key-type": "schema-table", "schema-name": "FARM", "table-name": table, **meta}
    out = {"metadata": {k: v for k, v in parts.items() if v is not None}}
    if row is not None:
        out["data"] = row
    return json.dumps(out)


SINGLE = change({"TREE": 17, "SORT": "pear"})
CONTROL = change(None, kind="control", operation="rename-table")
BATCH = f'{{"data": [{CONTROL}, {SINGLE}]}}'
ARRAY = f"[{SINGLE}]"


def test_records_and_batches(parse):
    r = parse([SINGLE, CONTROL, BATCH, ARRAY, "no json at all"])
    assert r[0]["parse_error"] is None and r[0]["record_type"] == "data"
    assert r[0]["metadata"]["table-name"] == "orchard" and set(r[0]["data"]) == {"TREE", "SORT"}
    assert r[1]["parse_error"] is None and r[1]["data"] == {} and r[1]["record_type"] == "control"
    # data array and no metadata; array root; plain text
    assert [r[k]["parse_error"] for k in (2, 3, 4)] == ["malformed_json"] * 3


def test_row_change_without_table_is_quarantined(parse):
    r = parse([change({"a": 1}, table=None), change(None, kind="control", table=None), change({"a": 1})])
    assert [r[k]["parse_error"] for k in range(3)] == ["table_missing", None, None]


def test_malformed_inputs(parse):
    bad = ["", "null", "[]", "not json", '{"metadata": {"a": "1"', "{'metadata': {}}",
           '{"metadata": {"x": NaN}}', '{"metadata": "str"}']
    r = parse(bad)
    assert [r[i]["parse_error"] for i in range(len(bad))] == ["malformed_json"] * len(bad)
    for i in range(len(bad)):
        assert r[i]["metadata"] is None and r[i]["record_type"] is None


def test_reasons(parse):
    r = parse(['{"data": {"a": 1}}', '{"metadata": null, "data": {}}',
               '{"metadata": {"record-type": "data"}, "data": [1]}',
               '{"metadata": {"record-type": "data"}, "data": 5}',
               '{"metadata": {"record-type": {"nested": 1}}, "data": {}}',
               '{"metadata": {"record-type": "data", "t": [1]}, "data": {}}'])
    assert [r[i]["parse_error"] for i in range(6)] == [
        "metadata_missing", "metadata_missing", "data_not_object", "data_not_object",
        "metadata_nested", "metadata_nested"]


def test_kept_cases(parse):
    meta = '{"metadata": {"record-type": "data", "table-name": "orchard"}'
    r = parse([meta + "}", meta + ', "data": null}', meta + ', "data": {"a": 1}} trailing text',
               meta + ', "data": {"a": 1, "a": 2}}'])
    assert all(r[i]["parse_error"] is None for i in range(4))
    assert r[0]["data"] == {} and r[1]["data"] == {}
    assert r[3]["data"]["a"].toJson() == "2"


def test_only_data_filter(spark):
    vals = [SINGLE, CONTROL, SINGLE.replace('"record-type": "data"', '"record-type": "DATA"'),
            change({"TREE": 1}, kind=None)]
    df = spark.createDataFrame([(v,) for v in vals], "value string")
    p = routing.drop_branch(envelope.parse_dms(df))
    assert [r["branch"] for r in p.collect()] == ["data", "not_data", "not_data", "no_record_type"]
    assert routing.only_data(envelope.parse_dms(df)).count() == 1


def test_unbatch(spark):
    df = spark.createDataFrame([(BATCH,), (ARRAY,), (SINGLE,)], "value string")
    u = envelope.unbatch(df)
    assert u.count() == 4
    kept = routing.only_data(envelope.parse_dms(u))
    assert kept.count() == 3


def test_unbatch_looks_at_values_not_at_text(spark):
    texts = [lead + f"[{SINGLE}, {SINGLE}]" for lead in ("", " ", "\n", "\t", "\r\n")]
    texts += [BATCH.replace('"data": [', '"d\\u0061ta" : ['), "\n" + BATCH, change({"list": "[1, 2]", "data": [1]}), "[", None]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value string, seq long")
    n = {r["seq"]: r["count"] for r in envelope.unbatch(df).groupBy("seq").count().collect()}
    assert n == {0: 2, 1: 2, 2: 2, 3: 2, 4: 2, 5: 2, 6: 2, 7: 1, 8: 1, 9: 1}
    assert routing.only_data(envelope.parse_dms(envelope.unbatch(df))).count() == 13


def test_split_quarantine(spark):
    df = spark.createDataFrame([(SINGLE,), ("x",)], "value string")
    good, bad = envelope.split_quarantine(envelope.parse_dms(df))
    assert good.count() == 1
    q = envelope.quarantine_view(bad).collect()
    assert q[0]["value"] == "x" and q[0]["parse_error"] == "malformed_json"


def test_conforms(spark):
    df = spark.createDataFrame([('{"metadata": {}, "data": {}, "before": {}}',), ('{"metadata": {}}',),
                                ('{"metadata": {}, "data": {}, "before": []}',), ("[1]",)], "value string")
    assert [r[0] for r in df.select(envelope.conforms(F.col("value"))).collect()] == [True, False, False, False]


def striim(data, **meta):
    return json.dumps({"before": {"CROP": "plum"}, "data": data, "userdata": "", "TxnID": "tx-5",
                       "__striimmetadata": {"position": "at-9"},
                       "metadata": {"TableName": "FARM.ORCHARD", "OperationName": "UPDATE", "OperationType": "DML",
                                    "TimeStamp": "2031-05-06T07:08:09.000-00:00", **meta}})


def test_striim(spark):
    texts = [striim({"CROP": "fig"}), striim({"0": "fig", "1": "7"}), "{}"]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    rows = envelope.parse_striim(df, positional_columns=["A", "B"]).collect()
    assert (rows[0]["schema_name"], rows[0]["table_name"], rows[0]["operation"]) == ("FARM", "ORCHARD", "UPDATE")
    assert rows[0]["before"]["CROP"] == "plum" and rows[0]["position"] == "at-9" and rows[0]["txn_id"] == "tx-5"
    assert rows[1]["data"] == {"A": "fig", "B": "7"}
    assert rows[2]["parse_error"] == "metadata_missing"
    assert str(rows[0]["event_time"]) == "2031-05-06 07:08:09"


def test_odd_times_are_quarantined_not_fatal(spark):
    texts = [striim({"A": "1"}, TimeStamp="2031-05-06 07:08"), striim({"A": "1"}, DBTimeStamp=1935817689000000),
             striim({"A": "1"}, TableName=None), striim({"A": "1"}, DBTimeStamp=1935817689)]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    assert [r["parse_error"] for r in envelope.parse_striim(df).collect()] == [
        "time_invalid", "time_invalid", "table_missing", None]
    trips = [json.dumps({"pickup_datetime": t, "trip_id": 1}) for t in (9223372036854775807, -9223372036854775808, 0)]
    got = envelope.parse_trip(spark.createDataFrame([(t,) for t in trips], "value string")).collect()
    assert [r["parse_error"] for r in got] == ["time_invalid", "time_invalid", None]


def test_audit_line_needs_all_parts(spark):
    df = spark.createDataFrame([(change({"a": 1}),), (change({"a": 1}, operation=None),)], "value string")
    rows = routing.audit_line(envelope.parse_dms(df)).collect()
    assert [(r["audit"], r["audit_error"]) for r in rows] == [
        ("FARM.orchard|update|data", None), (None, "audit_incomplete")]


def test_rule_filters_are_refused():
    with pytest.raises(ValueError):
        routing.selection_predicate([{"object-locator": {}, "filters": [{"column-name": "a"}]}])


def test_selection_rules_underscore_is_literal(spark):
    vals = ['{"metadata": {"record-type": "data", "schema-name": "S", "table-name": "%s"}, "data": {}}' % t
            for t in ("my_table", "myXtable", "other")]
    df = routing.only_data(envelope.parse_dms(spark.createDataFrame([(v,) for v in vals], "value string")))
    rules = [{"rule-type": "selection", "object-locator": {"schema-name": "S", "table-name": "my_table"},
              "rule-action": "include"},
             {"rule-type": "selection", "object-locator": {"schema-name": "%", "table-name": "oth%"},
              "rule-action": "include"}]
    assert sorted(r["table_name"] for r in routing.select_tables(df, rules).collect()) == ["my_table", "other"]

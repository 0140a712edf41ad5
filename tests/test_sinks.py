"""File sinks and read-backs (FIXTURES.md X14-X17, O4, O5, O11, O12)."""

import datetime as dt

from pyspark.sql import functions as F

from tributary.operators import envelope
from tributary.schemas import ADDRESS_SCHEMA
from tributary.session import scratch_path
from tributary.sources.files import open_source, read_parquet_back
from tributary.streaming import sinks


def test_address_parquet_roundtrip(spark):
    rows = [(k, f"{k} Mill Lane", f"town {k % 2}", "ZZ", f"{k:05d}") for k in range(1, 8)]
    path = scratch_path(spark, "addr")
    sinks.write_parquet(spark.createDataFrame(rows, ADDRESS_SCHEMA), path)
    back = sorted(tuple(r) for r in read_parquet_back(spark, path, ADDRESS_SCHEMA).collect())
    assert back == rows
    rows2 = [(9, "Elm Row", "Fernhill", "QX", "00042"), (10, "Oak Row", "Fernhill", "QX", "00043")]
    path2 = scratch_path(spark, "addr2")
    sinks.write_parquet(spark.createDataFrame(rows2, ADDRESS_SCHEMA), path2)
    assert sorted(tuple(r) for r in read_parquet_back(spark, path2).collect()) == rows2


def test_generic_parquet_and_text(spark):
    path = scratch_path(spark, "ab")
    sinks.write_parquet(spark.createDataFrame([("red", 4), ("green", 5), ("blue", 6)], "a string, b int"), path)
    assert sorted(tuple(r) for r in read_parquet_back(spark, path, "a string, b int").collect()) == \
        [("blue", 6), ("green", 5), ("red", 4)]
    tpath = scratch_path(spark, "txt")
    lines = ["first line", " second, after a space", "troisième"]
    sinks.write_text(spark.createDataFrame([(x,) for x in lines], "data string"), tpath, col="data")
    back = open_source(spark, "text", {"path": tpath}, streaming=False)
    assert sorted(r["value"] for r in back.collect()) == sorted(lines)


def test_hour_layout_zone_and_table(spark):
    v = ('{"metadata": {"record-type": "data", "table-name": "T", "timestamp": "2022-01-01T03:30:00Z"}, '
         '"data": {"a": 1}}')
    parsed = envelope.parse_dms(spark.createDataFrame([(v,)], "value string"))
    path = scratch_path(spark, "hours")
    sinks.write_json_lines(parsed, path, by_table=True)
    r = spark.read.option("basePath", path).text(path).first()
    assert (r["table_name"], r["year"], r["month"], r["day"], r["hour"]) == ("T", 2021, 12, 31, 22)
    assert '"metadata"' in r["value"] and '"data":{"a":1}' in r["value"]


def test_trip_layout(spark):
    df = spark.createDataFrame([(7, dt.datetime(2020, 3, 5, 1, 0)), (123, dt.datetime(2021, 11, 1))],
                               "pickup_location_id int, pickup_datetime timestamp")
    path = scratch_path(spark, "trips")
    sinks.write_trip_parquet(df, path)
    back = spark.read.schema("pickup_location string, year string, month string").parquet(path)
    got = sorted((r["pickup_location"], r["year"], r["month"]) for r in back.collect())
    assert got == [("007", "2020", "03"), ("123", "2021", "11")]


def test_start_positions(spark):
    import pytest
    from tributary.sources.files import start_at
    rows = [(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 20)), (3, dt.datetime(2030, 1, 1))]
    df = spark.createDataFrame(rows, "k long, arrival_time timestamp")
    assert start_at(df, "TRIM_HORIZON", None, "arrival_time").count() == 3
    assert sorted(r["k"] for r in start_at(df, "AT_TIMESTAMP", "2024-01-15 00:00:00", "arrival_time").collect()) == [2, 3]
    assert [r["k"] for r in start_at(df, "LATEST", None, "arrival_time").collect()] == [3]
    with pytest.raises(ValueError):
        start_at(df, "AT_TIMESTAMP", None, "arrival_time")


def test_wholetext_source(spark):
    path = scratch_path(spark, "whole")
    sinks.write_text(spark.createDataFrame([('{"metadata": {"record-type": "data", "table-name": "t"},',), ('"data": {"a": 1}}',)],
                                           "value string").coalesce(1), path)
    recs = open_source(spark, "wholetext", {"path": path}, streaming=False)
    parsed = envelope.parse_dms(recs).collect()
    assert len(parsed) == 1 and parsed[0]["parse_error"] is None and parsed[0]["record_type"] == "data"

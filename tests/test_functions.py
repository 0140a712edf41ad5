"""Geo, ids, documents and type inference (FIXTURES.md N8-N14)."""

import hashlib
import json

from pyspark.sql import functions as F

from tributary.functions import ids, inference
from tributary.operators import envelope, mapping, routing


def _routed_df(spark, datas, **opts):
    vals = ['{"metadata": {"record-type": "data", "schema-name": "S", "table-name": "T", '
            '"operation": "update", "timestamp": "2022-01-01T00:00:00Z"}, "data": ' + d + "}" for d in datas]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(vals)], "value string, seq long")
    return routing.route(routing.only_data(envelope.parse_dms(df)), **opts)


def _routed(spark, datas, **opts):
    return _routed_df(spark, datas, **opts).orderBy("seq").collect()


def test_geo_layouts(spark):
    rows = _routed(spark, [
        '{"LATITUDE": 10.5, "LONGITUDE": 20.25}', '{"LONGITUDE": 20.25, "LATITUDE": 10.5}',
        '{"latitude": 10.5, "longitude": 20.25}', '{"LATITUDE": "10.5", "LONGITUDE": "20.25"}',
        '{"LATITUDE": 91, "LONGITUDE": 20}', '{"LATITUDE": 10, "LONGITUDE": 181}',
        '{"LATITUDE": "NaN", "LONGITUDE": 20}', '{"LATITUDE": 10}', '{"PLATE_NO": 42}', '{}'])
    pts = [(r["location"]["lat"], r["location"]["lon"]) for r in rows]
    assert pts[:4] == [(10.5, 20.25)] * 4
    assert pts[4:] == [(0.0, 0.0)] * 6


def test_canonical_text_and_content_id(spark):
    rows = _routed(spark, ['{"b": "x", "a": 1, "c": null}', '{"a": 1, "b": "x", "c": null}',
                           '{"a": 2, "b": "x", "c": null}'])
    text = "{a=1, b=x, c=null}"
    got = _routed_df(spark, ['{"b": "x", "a": 1, "c": null}']).select(ids.canonical_text(F.col("data"))).first()[0]
    assert got == text
    want = hashlib.md5(hashlib.md5(text.encode()).digest()).hexdigest()
    assert rows[0]["doc_id"] == want == rows[1]["doc_id"]
    assert rows[2]["doc_id"] != want


def test_key_id(spark):
    rows = _routed(spark, ['{"id": 7, "v": 1}', '{"id": 7, "v": 2}'], id_mode="key", key_columns=["id"])
    want = hashlib.md5(hashlib.md5(b"1:S.T{id=1:7}").digest()).hexdigest()
    assert rows[0]["doc_id"] == rows[1]["doc_id"] == want


def test_key_ids_do_not_collide(spark):
    rows = _routed(spark, ['{"a": "x, b=y", "b": "z"}', '{"a": "x", "b": "y, b=z"}', '{"v": 1}', '{"a": null, "b": 1}'],
                   id_mode="key", key_columns=["a", "b"])
    assert rows[0]["doc_id"] != rows[1]["doc_id"]
    assert [(r["doc_id"], r["route_error"]) for r in rows[2:]] == [(None, "key_missing")] * 2


def test_document_envelope_wins(spark):
    rows = _routed(spark, ['{"location": "row", "metadata": "row", "x": 1}'])
    doc = json.loads(rows[0]["doc"])
    assert doc["x"] == 1 and doc["location"] == {"lat": 0.0, "lon": 0.0}
    assert doc["metadata"]["table-name"] == "T"
    assert rows[0]["index_name"] == "dms_flink_t"


def test_document_forms(spark):
    arr = json.loads(_routed(spark, ['{"LAT": 1.5, "LON": 2.5}'], location_mode="array")[0]["doc"])
    assert arr["location"] == [1.5, 2.5]
    raw = json.loads(_routed(spark, ['{"LAT": 99, "LON": 2.5}'], location_mode="raw")[0]["doc"])
    assert raw["location"] == {"lat": 99, "lon": 2.5}
    texts = [r["doc"] for r in _routed(spark, ['{"LAT": 1, "MY_LAT": "q", "X": 3}', "{}"], location_mode="raw")]
    assert '"location":{"lat":1,"lat":"q"}' in texts[0] and '"location":{}' in texts[1]
    empty = _routed(spark, ["{}"], location_mode="array")[0]["doc"]
    assert empty.startswith('{"data":null,"location":[0.0,0.0],"metadata":{')


def test_value_types(spark):
    data = ('{"big": 12345678901, "huge": 123456789012345678901234, "f": 5.0, "e": 1.5e3, "b": true, '
            '"z": null, "o": {"q": 1}, "s": "x", "d1": "2022-01-01T00:00:00Z", "d2": "2022-01-01T00:00:00.123456Z", '
            '"t1": "2022-01-01", "t2": "2022-13-01T00:00:00Z", "t3": "2022-01-01T00:00:00+00:00", '
            '"t4": "2022-01-01T00:00Z"}')
    df = _routed_df(spark, [data])
    types = {r["field"]: r["es_type"] for r in mapping.field_types(df, include_envelope=False).collect()}
    assert types == {"big": "long", "huge": "text", "f": "float", "e": "float", "b": "text", "z": "text",
                     "o": "text", "s": "text", "d1": "date", "d2": "date", "t1": "text", "t2": "text",
                     "t3": "text", "t4": "text"}


def test_nulls_do_not_change_a_type(spark):
    df = _routed_df(spark, ['{"n": null, "d": null, "z": null}', '{"n": 3, "d": "2022-01-01T00:00:00Z", "z": null}',
                            '{"n": null, "d": null}'])
    types = {r["field"]: (r["es_type"], r["n"]) for r in mapping.field_types(df, include_envelope=False).collect()}
    assert types == {"n": ("long", 3), "d": ("date", 3), "z": ("text", 2)}


def test_ignore_above(spark):
    df = _routed_df(spark, ['{"a": "' + "x" * 256 + '", "b": "' + "y" * 257 + '"}'])
    ign = {r["field"]: r["ignore_above"] for r in mapping.field_types(df).collect()}
    assert ign["a"] == 256 and ign["b"] is None and ign["metadata.table-name"] == 256


def test_widening_and_mapping_json(spark):
    df = _routed_df(spark, ['{"n": 1, "m": "2022-01-01T00:00:00Z"}', '{"n": 1.5, "m": 3}'])
    types = mapping.field_types(df)
    t = {r["field"]: r["es_type"] for r in types.collect()}
    assert t["n"] == "float" and t["m"] == "text" and t["location"] == "geo_point"
    m = json.loads(mapping.mapping_json(types).first()["mapping"])
    assert m["properties"]["n"] == {"type": "float"}
    assert m["properties"]["location"] == {"type": "geo_point"}
    assert m["properties"]["metadata"]["properties"]["timestamp"]["fields"]["keyword"]["ignore_above"] == 256
    v2 = {r["field"]: r["es_type"] for r in mapping.apply_profile(types, "v2").collect()}
    assert v2["n"] == "double" and v2["metadata.timestamp"] == "text"


def test_template_override(spark):
    types = mapping.field_types(_routed_df(spark, ['{"location": 1, "k": 2}']))
    tpl = [{"index_patterns": ["dms_flink_*"], "template": {"mappings": {"properties": {
        "location": {"type": "text", "fields": {"keyword": {"type": "keyword", "ignore_above": 256}}}}}}}]
    t = {r["field"]: r["es_type"] for r in mapping.apply_template(types, tpl).collect()}
    assert t["location"] == "text" and t["k"] == "long"


def test_iso_instant(spark):
    vals = ["2022-01-01T00:00:00Z", "2022-01-01T00:00:00.123456789Z", "2022-02-30T00:00:00Z", "2022-01-01"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    assert [r[0] for r in df.select(inference.is_iso_instant(F.col("s"))).collect()] == [True, True, False, False]

"""Mappings that grow with the stream (T3) and templates merged by precedence (T4)."""

import json
import random

from tributary.operators import envelope, mapping, routing
from tributary.session import scratch_path


def _docs(spark, rows, table="t"):
    texts = [json.dumps({"metadata": {"record-type": "data", "schema-name": "s", "table-name": table, "operation": "load"}, "data": r}) for r in rows]
    parsed = envelope.parse_dms(spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value string, seq long"))
    return routing.route(routing.only_data(parsed))


def _types(df):
    return {(r.field, r.es_type, r.ignore_above, r.n) for r in df.collect()}


def test_any_order_of_batches_gives_the_whole_tables_mapping(spark):
    rng = random.Random(1)
    values = [1, 2.5, "x", "2022-01-01T00:00:00Z", None, True, "y" * 300, 7]
    batches = [[{f"f{i}": rng.choice(values[:2 + i]) for i in range(5) if rng.random() < .8} for _ in range(6)] for _ in range(5)]
    want = _types(mapping.field_types(_docs(spark, [r for b in batches for r in b])))
    for order in ([0, 1, 2, 3, 4], [4, 2, 0, 3, 1]):
        store = mapping.MappingStore(spark, scratch_path(spark, "map"))
        for n in order:
            store.append(_docs(spark, batches[n]), n)
            store.append(_docs(spark, batches[n]), n)  # replayed
        assert _types(store.mapping()) == want


def test_versions_and_folding(spark):
    batches = [[{"a": 1, "b": None}], [{"a": 2, "b": None}], [{"a": 2.5, "c": "2022-01-01T00:00:00Z"}], [{"a": "x", "b": 1}], [{"c": 3, "b": 2}]]
    store = mapping.MappingStore(spark, scratch_path(spark, "map"))
    for n, rows in enumerate(batches):
        store.append(_docs(spark, rows), n, include_envelope=False)

    def versions():
        return sorted((r.field, r.batch_id, r.previous_type, r.es_type) for r in store.versions().collect())
    want = [("a", 0, None, "long"), ("a", 2, "long", "float"), ("a", 3, "float", "text"), ("b", 3, None, "long"),
            ("c", 2, None, "date"), ("c", 4, "date", "text")]
    assert versions() == want
    types = _types(store.mapping())
    store.fold(3)
    assert {r.batch_id for r in store.flags().select("batch_id").distinct().collect()} == {2, 3, 4}
    assert versions() == want and _types(store.mapping()) == types
    store.append(_docs(spark, [{"b": "text now"}]), 5, include_envelope=False)
    assert sorted((r.field, r.batch_id) for r in store.drift().collect()) == [("a", 2), ("a", 3), ("b", 5), ("c", 4)]


def test_templates_merge_by_order_pattern_and_place():
    t = [{"index_patterns": ["*"], "order": 1, "template": {"settings": {"x": 1, "y": {"p": 1}}, "mappings": {"dynamic_templates": [{"one": {}}]}}},
         {"index_patterns": ["log-*"], "order": 1, "template": {"settings": {"y": {"p": 2, "q": 3}}, "mappings": {"dynamic_templates": [{"two": {}}]}}},
         {"index_patterns": ["log-a", "z*"], "order": 0, "template": {"settings": {"x": 9, "z": [1]}}},
         {"index_patterns": ["*"], "order": 1, "template": {"settings": {"x": 2}}}]
    assert mapping.merged_templates(t, "log-a") == {"settings": {"x": 2, "y": {"p": 2, "q": 3}, "z": [1]},
                                                    "mappings": {"dynamic_templates": [{"two": {}}, {"one": {}}]}}
    assert mapping.merged_templates(t, "b")["settings"] == {"x": 2, "y": {"p": 1}}
    assert mapping.merged_templates(t[1:3], "b") == {}
    assert mapping.merged_templates([{"index_patterns": ["a[1]?"], "mappings": {"k": 1}}], "a[1]?") == {"index_patterns": ["a[1]?"], "mappings": {"k": 1}}


def test_ordered_templates_on_fields(spark):
    types = mapping.field_types(_docs(spark, [{"a_id": 1, "b_id": "x", "name": "y", "when": "2022-01-01T00:00:00Z"}], "Orders"))
    templates = [{"index_patterns": ["*"], "template": {"mappings": {"dynamic_templates": [
                     {"any": {"match_mapping_type": "*", "match": "*_id", "mapping": {"type": "keyword", "ignore_above": 9}}},
                     {"texts": {"match_mapping_type": "string", "unmatch": "metadata.*", "mapping": {"type": "match_only_text"}}}],
                     "properties": {"metadata": {"properties": {"operation": {"type": "keyword"}}}, "when": {"type": "date_nanos"}}}}}]
    got = {r.field: (r.es_type, r.ignore_above) for r in mapping.apply_ordered_templates(types, templates).collect()}
    assert got["a_id"] == got["b_id"] == ("keyword", 9) and got["name"] == ("match_only_text", None) and got["when"][0] == "date_nanos"
    assert got["metadata.operation"][0] == "keyword" and got["metadata.table-name"] == ("text", 256) and got["location"][0] == "geo_point"
    assert {(r.field, r.es_type) for r in mapping.apply_ordered_templates(types, []).collect()} == {(r.field, r.es_type) for r in types.collect()}

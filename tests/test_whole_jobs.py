"""Queries over rows of their own, where the driver's tables would not show what is missing."""

import datetime as dt
import pathlib

import __spark_entry__ as E
from tributary.operators import envelope as env
from tributary.operators import mapping, state
from tributary.plans.queries import routed
from tributary.session import local_path, shared_root


def test_trip_rows_keeps_every_location(spark, tmp_path):
    rows = [(k // 4, k, k % 50, k % 7 + 1, float(k % 11), 10.0, 0.05, 0.02, "N", dt.datetime(2022, 1 + k % 2, 3)) for k in range(530)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                                "l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = E.queries()["trip_rows"](spark, str(tmp_path)).collect()
    assert {r["pickup_location"] for r in got} == {f"{k:03d}" for k in range(1, 266)}
    assert len(got) == 530 and sum(r["n"] for r in got) == 530


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_whole_files_lie_in_one_folder(spark, tmp_path):
    rows = [(k, k, "FOP"[k % 3], 1.5, dt.datetime(2022, 1, 3), 'a,"b"') for k in range(300)] + [(None, 1, "F", 1.0, dt.datetime(2022, 1, 3), "x")]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                                "o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    root = pathlib.Path(local_path(shared_root(spark)))
    before = set(root.glob("whole-files-*"))
    got = E.queries()["whole_file_rows"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((r[0], r[2]) for r in rows), key=str)
    (folder,) = set(root.glob("whole-files-*")) - before
    assert not [p for p in folder.iterdir() if p.is_dir()]
    assert len(list(folder.glob("part-*"))) == 4  # three batches, and the one of no key


def test_a_batch_is_parsed_once(spark):
    df = spark.createDataFrame([('[{"a":1},{"a":2}]',), ('{"data":[]}',), ("[]",), ('{"metadata":{},"data":[1]}',), ("7",), (None,), ("x",),
                                ('{"metadata":null,"data":[1]}',), ('\n{"data":[{"a":[3]}]}',)], "value string")
    out = env.unbatch(df)
    assert _plan(out).lower().count("parsejson") == 1
    assert sorted(((r["batch_pos"], r["value"]) for r in out.collect()), key=str) == sorted([
        (0, '{"a":1}'), (1, '{"a":2}'), (0, '{"metadata":{},"data":[1]}'), (0, "7"), (0, None), (0, "x"),
        (0, '{"metadata":null,"data":[1]}'), (0, '{"a":[3]}')], key=str)


def test_a_version_is_sorted_with_one_copy_of_its_document(spark):
    at = dt.datetime(2022, 1, 1)
    rows = [("i", "a", "old", False, "update", at, 1), ("i", "a", "new", False, "update", at, 2), ("i", "b", None, True, "delete", None, 1),
            ("i", "b", "x", False, "insert", at, None)]
    df = spark.createDataFrame(rows, "index_name string, doc_id string, doc string, is_delete boolean, operation string, "
                                     "event_time timestamp, seq long")
    out = state.reduce_documents(df)
    assert out.columns == ["index_name", "doc_id", *state.DOCUMENT_COLUMNS, "commit_no", "n_versions"]
    assert _plan(out).count("doc, doc#") == 1
    got = {r["doc_id"]: (r["doc"], r["is_delete"], r["seq"], r["n_versions"]) for r in out.collect()}
    assert got == {"a": ("new", False, 2, 2), "b": ("x", False, None, 2)}


def test_field_types_read_each_value_once(spark):
    rows = ['{"metadata":{"record-type":"data","table-name":"t","timestamp":"x"},"data":{"location":1,"s":"é","d":"2022-01-01T00:00:00Z"}}',
            '{"metadata":{"table-name":"t","record-type":"data"},"data":{"s":null,"metadata.timestamp":2.5,"big":123456789012345678901}}',
            '{"metadata":{"table-name":"t","record-type":"data"}}',
            '{"metadata":{"table-name":"u","record-type":"data","extra":"1"},"data":{"d":"2022-01-01T00:00:00Z","s":"%s"}}' % ("x" * 257)]
    df = spark.createDataFrame([(r,) for r in rows], "value string")
    flags = mapping.field_flags(routed(spark, df))
    # the kind of a value in its cell, of a metadata value, and of data that is no object
    assert _plan(flags).lower().count("schemaofvariant.schemaofvariant(") == 3
    got = {(r["index_name"][-1], r["field"]): ("".join(c for c in mapping.FLAGS if r[c]), r["max_len"], r["n"]) for r in flags.collect()}
    assert got == {
        ("t", "location"): ("lg", 1, 4), ("t", "s"): ("x", 4, 2), ("t", "d"): ("d", 20, 1), ("t", "big"): ("x", 21, 1),
        ("t", "metadata.timestamp"): ("fm", 3, 2), ("t", "metadata.record-type"): ("m", 0, 3), ("t", "metadata.table-name"): ("m", 0, 3),
        ("u", "location"): ("g", 0, 1), ("u", "d"): ("d", 20, 1), ("u", "s"): ("x", 257, 1), ("u", "metadata.extra"): ("m", 0, 1),
        ("u", "metadata.record-type"): ("m", 0, 1), ("u", "metadata.table-name"): ("m", 0, 1)}
    assert mapping.field_types(routed(spark, df), include_envelope=False).where("field = 'location'").first()["es_type"] == "long"

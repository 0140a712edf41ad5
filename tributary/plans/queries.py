"""Registered queries: each reads the driver's tables, builds the change
stream from them and runs the operators over every row.

``QUERIES[name](spark, sf_dir) -> DataFrame``; ``ORACLE_SQL[name]`` repeats
the planted-case arithmetic on the base tables in plain SQL (DuckDB).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions import documents, layout
from tributary.functions.variants import field
from tributary.operators import envelope as env
from tributary.operators import mapping, routing, state, windows
from tributary.schemas import ADDRESS_SCHEMA
from tributary.session import prepare, scratch_path
from tributary.sources import fixtures as fx
from tributary.sources.files import open_source, start_at

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

SECOND_FMT = "yyyy-MM-dd HH:mm:ss"
MICRO_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def register(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLE_SQL[name] = oracle.strip()
        return run
    return deco


def routed(spark: SparkSession, envelopes: DataFrame, **route_opts) -> DataFrame:
    return routing.route(routing.only_data(env.parse_dms(envelopes)), **route_opts)


# --- SQL pieces repeating the planted-case arithmetic (fixtures.PLANT_*) ----------------

def _kept(key: str) -> str:
    return f"{key} % 100 NOT IN (0, 1, 2, 3, 4, 5, 6, 7, 11)"


def _op(key: str) -> str:
    return (f"CASE WHEN {key} % 100 = 10 THEN 'delete' WHEN {key} % 3 = 0 THEN 'load' "
            f"WHEN {key} % 3 = 1 THEN 'insert' ELSE 'update' END")


def _per_index_counts(table: str, key: str) -> str:
    return (f"SELECT 'dms_flink_{table}' AS index_name, count(*) AS n_docs, "
            f"count(*) FILTER (WHERE {key} % 100 = 10) AS n_deletes, "
            f"count(DISTINCT CASE WHEN {key} % 100 = 8 THEN -1 ELSE {key} END) AS n_ids "
            f"FROM {table} WHERE {_kept(key)}")


# --- P1 F1-F3 I1 H1: the live path ------------------------------------------------------

@register("kept_per_index", " UNION ALL ".join([
    _per_index_counts("orders", "o_orderkey"),
    _per_index_counts("customer", "c_custkey"),
    _per_index_counts("supplier", "s_suppkey")]))
def kept_per_index(spark, sf_dir):
    """Documents per index after parse, quarantine and the data-only filter.

    ``n_ids`` counts distinct content ids: all empty-row events of a table
    share one id, as in the original job."""
    docs = routed(spark, fx.three_table_envelopes(spark, sf_dir, plant=True))
    return (docs.groupBy("index_name")
                .agg(F.count("*").alias("n_docs"),
                     F.sum(F.col("is_delete").cast("long")).alias("n_deletes"),
                     F.count_distinct("doc_id").alias("n_ids")))


@register("quarantine_reasons", """
SELECT reason, count(*) AS n FROM (
  SELECT CASE WHEN event_id % 100 IN (1, 7) THEN 'malformed_json'
              WHEN event_id % 100 = 4 THEN 'data_not_object'
              WHEN event_id % 100 = 5 THEN 'metadata_missing'
              WHEN event_id % 100 = 6 THEN 'metadata_nested'
              WHEN event_id % 100 = 11 THEN 'table_missing'
              ELSE 'kept' END AS reason
  FROM events) t
GROUP BY reason""")
def quarantine_reasons(spark, sf_dir):
    """Quarantine split with a reason per bad record."""
    parsed = env.parse_dms(fx.events_envelopes(spark, sf_dir, plant=True))
    return (parsed.groupBy(F.coalesce("parse_error", F.lit("kept")).alias("reason"))
                  .agg(F.count("*").alias("n")))


@register("conformance", """
SELECT o_orderkey % 100 NOT IN (0, 1, 4, 5, 7, 8) AS conforms, count(*) AS n
FROM orders GROUP BY ALL""")
def conformance(spark, sf_dir):
    """Envelope schema check (P7): ``metadata`` and ``data`` present, both objects."""
    recs = fx.orders_envelopes(spark, sf_dir, plant=True)
    return recs.groupBy(env.conforms(F.col("value")).alias("conforms")).agg(F.count("*").alias("n"))


# Schema used by the ``schema_violations`` query.
ORDER_SCHEMA = {
    "type": "object", "required": ["metadata", "data"],
    "properties": {
        "metadata": {"type": "object", "required": ["record-type", "table-name"], "additionalProperties": False, "properties": {
            "timestamp": {"type": "string", "pattern": "^[0-9]{4}-"}, "record-type": {"enum": ["data", "control"]},
            "operation": {"type": "string"}, "partition-key-type": {"type": "string"}, "schema-name": {"const": "TPCH"},
            "table-name": {"type": "string", "minLength": 1}}},
        "data": {"type": "object", "required": ["o_orderkey"], "properties": {
            "o_orderkey": {"type": "integer", "minimum": 1}, "o_totalprice": {"type": "number", "maximum": 300000},
            "o_orderstatus": {"enum": ["O", "F"]}}}}}


@register("schema_violations", """
SELECT violation, count(*) AS n FROM (
  SELECT CASE WHEN o_orderkey % 100 IN (1, 7) THEN '$: not_json'
              WHEN o_orderkey % 100 = 5 THEN '$: required metadata'
              WHEN o_orderkey % 100 IN (0, 8) THEN '$: required data'
              WHEN o_orderkey % 100 = 3 THEN '$.metadata: required record-type'
              WHEN o_orderkey % 100 = 11 THEN '$.metadata: required table-name'
              WHEN o_orderkey % 100 = 6 THEN '$.metadata: additionalProperties'
              WHEN o_orderkey % 100 = 2 THEN '$.metadata.record-type: enum'
              WHEN o_orderkey % 100 = 4 THEN '$.data: type'
              WHEN o_totalprice > 300000 THEN '$.data.o_totalprice: maximum'
              WHEN o_orderstatus NOT IN ('O', 'F') THEN '$.data.o_orderstatus: enum'
              ELSE 'conforms' END AS violation
  FROM orders) t
GROUP BY violation""")
def schema_violations(spark, sf_dir):
    """Records by the first violation of a JSON schema, with its place."""
    from tributary.operators.jsonschema import check_schema
    checked = check_schema(fx.orders_envelopes(spark, sf_dir, plant=True), ORDER_SCHEMA)
    return checked.groupBy(F.coalesce("violation", F.lit("conforms")).alias("violation")).agg(F.count("*").alias("n"))


@register("control_dropped", """
SELECT branch, count(*) AS n FROM (
  SELECT CASE WHEN o_orderkey % 100 IN (1, 4, 5, 6, 7, 11) THEN 'quarantined'
              WHEN o_orderkey % 100 = 3 THEN 'no_record_type'
              WHEN o_orderkey % 100 IN (0, 2) THEN 'not_data'
              ELSE 'data' END AS branch
  FROM orders) t
GROUP BY branch""")
def control_dropped(spark, sf_dir):
    """Which stage keeps or drops each record (F1-F3): control and ``DATA`` are dropped."""
    parsed = env.parse_dms(fx.orders_envelopes(spark, sf_dir, plant=True))
    return routing.drop_branch(parsed).groupBy("branch").agg(F.count("*").alias("n"))


# Selection rules used by the ``selected_tables`` query.
SELECTION_RULES = [
    {"rule-type": "selection", "rule-id": "1", "rule-name": "1",
     "object-locator": {"schema-name": "TPCH", "table-name": "orders"}, "rule-action": "include", "filters": []},
    {"rule-type": "selection", "rule-id": "2", "rule-name": "2",
     "object-locator": {"schema-name": "TP%", "table-name": "%"}, "rule-action": "include", "filters": []},
    {"rule-type": "selection", "rule-id": "3", "rule-name": "3",
     "object-locator": {"schema-name": "%", "table-name": "supp%"}, "rule-action": "exclude", "filters": []},
]


@register("selected_tables", f"""
SELECT 'TPCH' AS schema_name, 'orders' AS table_name, count(*) AS n FROM orders WHERE {_kept('o_orderkey')}
UNION ALL
SELECT 'TPCH', 'customer', count(*) FROM customer WHERE {_kept('c_custkey')}""")
def selected_tables(spark, sf_dir):
    """Selection rules (include/exclude with ``%`` wildcards) then key by table."""
    kept = routing.only_data(env.parse_dms(fx.three_table_envelopes(spark, sf_dir, plant=True)))
    sel = routing.select_tables(kept, SELECTION_RULES)
    return sel.groupBy("schema_name", "table_name").agg(F.count("*").alias("n"))


# Rules with filters used by the ``filtered_rows`` query.
FILTER_RULES = [
    {"rule-type": "selection", "rule-id": "1", "rule-action": "include",
     "object-locator": {"schema-name": "TPCH", "table-name": "orders"},
     "filters": [{"filter-type": "source", "column-name": "o_totalprice", "filter-conditions": [
                     {"filter-operator": "ste", "value": "30000.5"}, {"filter-operator": "between", "start-value": "100000", "end-value": "1.5e5"}]},
                 {"filter-type": "source", "column-name": "o_orderdate", "filter-conditions": [
                     {"filter-operator": "gte", "value": "1995-06-17"}]},
                 {"filter-type": "source", "column-name": "o_orderstatus", "filter-conditions": [
                     {"filter-operator": "noteq", "value": "F"}, {"filter-operator": "null"}]}]},
    {"rule-type": "selection", "rule-id": "2", "rule-action": "include",
     "object-locator": {"schema-name": "TPCH", "table-name": "customer"},
     "filters": [{"column-name": "c_mktsegment", "filter-conditions": [
                     {"filter-operator": "eq", "value": "BUILDING"}, {"filter-operator": "between", "start-value": "F", "end-value": "I"}]}]},
    {"rule-type": "selection", "rule-id": "3", "rule-action": "exclude",
     "object-locator": {"schema-name": "TPCH", "table-name": "%"},
     "filters": [{"column-name": "c_acctbal", "filter-conditions": [{"filter-operator": "notbetween", "start-value": "-500", "end-value": "9000"}]}]},
]


@register("filtered_rows", f"""
SELECT 'orders' AS table_name, CAST(o_orderkey AS BIGINT) AS key FROM orders
WHERE {_kept('o_orderkey')} AND o_orderkey % 100 <> 8 AND (o_totalprice <= 30000.5 OR o_totalprice BETWEEN 100000 AND 150000)
  AND o_orderdate >= TIMESTAMP '1995-06-17' AND o_orderstatus <> 'F'
UNION ALL
SELECT 'customer', c_custkey FROM customer
WHERE {_kept('c_custkey')} AND c_custkey % 100 <> 8 AND (c_mktsegment = 'BUILDING' OR c_mktsegment BETWEEN 'F' AND 'I')
  AND c_acctbal BETWEEN -500 AND 9000""")
def filtered_rows(spark, sf_dir):
    """Selection rules with filters: conditions of a column are alternatives, filters of a rule all hold; numbers,
    dates and text are compared as what they are (F4)."""
    kept = routing.only_data(env.parse_dms(fx.three_table_envelopes(spark, sf_dir, plant=True)))
    sel = routing.select_tables(kept, FILTER_RULES)
    key = F.coalesce(field(F.col("data"), "o_orderkey", "bigint"), field(F.col("data"), "c_custkey", "bigint"))
    return sel.select("table_name", key.alias("key"))


@register("audit_line", f"""
SELECT CASE WHEN c_custkey % 100 = 8 THEN NULL ELSE c_custkey END AS c_custkey,
       'TPCH.customer|' || {_op('c_custkey')} || '|data' AS audit
FROM customer WHERE {_kept('c_custkey')}""")
def audit_line(spark, sf_dir):
    """``schema.table|operation|record-type`` per kept record."""
    kept = routing.only_data(env.parse_dms(fx.customer_envelopes(spark, sf_dir, plant=True)))
    return routing.audit_line(kept).select(field(F.col("data"), "c_custkey", "bigint").alias("c_custkey"),
                                           "audit")


# --- H1 H2: document ids ------------------------------------------------------------------

@register("content_doc_id", """
SELECT 'dms_flink_nation' AS index_name, CAST(n_nationkey AS BIGINT) AS row_key,
       md5(unhex(md5('{n_name=' || n_name || ', n_nationkey=' || n_nationkey
                     || ', n_regionkey=' || n_regionkey || '}'))) AS doc_id
FROM nation
UNION ALL
SELECT 'dms_flink_region', CAST(r_regionkey AS BIGINT),
       md5(unhex(md5('{r_name=' || r_name || ', r_regionkey=' || r_regionkey || '}')))
FROM region
UNION ALL
SELECT 'dms_flink_part', p_partkey,
       md5(unhex(md5('{p_brand=' || p_brand || ', p_name=' || p_name || ', p_partkey=' || p_partkey
                     || ', p_size=' || p_size || ', p_type=' || p_type || '}')))
FROM part""")
def content_doc_id(spark, sf_dir):
    """Content ids: MD5 of the MD5 digest of the sorted ``{k=v, ...}`` row text (H1)."""
    envs = fx.nation_region_envelopes(spark, sf_dir).unionByName(fx.part_envelopes(spark, sf_dir, with_price=False))
    docs = routed(spark, envs)
    key = F.coalesce(field(F.col("data"), "n_nationkey", "bigint"), field(F.col("data"), "r_regionkey", "bigint"),
                     field(F.col("data"), "p_partkey", "bigint"))
    return docs.select("index_name", key.alias("row_key"), "doc_id")


_EVENTS_KEY_ID = "md5(unhex(md5('4:TPCH.events{user_id=' || length(CAST(user_id AS VARCHAR)) || ':' || user_id || '}')))"


@register("key_doc_id", f"""
SELECT 'dms_flink_events' AS index_name, {_EVENTS_KEY_ID} AS doc_id, count(*) AS n_versions
FROM events GROUP BY user_id""")
def key_doc_id(spark, sf_dir):
    """Key ids: every version of a row maps to one document (H2)."""
    docs = routed(spark, fx.events_envelopes(spark, sf_dir), id_mode="key", key_columns=["user_id"])
    return docs.groupBy("index_name", "doc_id").agg(F.count("*").alias("n_versions"))


# --- O1: document state -----------------------------------------------------------------

_LATEST_SQL = f"""
SELECT 'dms_flink_events' AS index_name, {_EVENTS_KEY_ID} AS doc_id,
       arg_max(event_id, ts) AS latest_event_id,
       arg_max(event_type, ts) AS latest_event_type,
       arg_max(CASE WHEN event_type = 'error' THEN 'delete' ELSE 'update' END, ts) AS operation,
       count(*) AS n_versions
FROM events GROUP BY user_id"""


def _latest(spark, sf_dir, apply_deletes):
    docs = routed(spark, fx.events_envelopes(spark, sf_dir), id_mode="key", key_columns=["user_id"])
    latest = state.latest_documents(docs, apply_deletes=apply_deletes)
    return latest.select("index_name", "doc_id", F.col("seq").alias("latest_event_id"),
                         F.get_json_object("doc", "$.event_type").alias("latest_event_type"),
                         "operation", "n_versions")


@register("latest_documents", _LATEST_SQL)
def latest_documents(spark, sf_dir):
    """Latest version per document; deletes indexed like any version (O1, original behaviour)."""
    return _latest(spark, sf_dir, apply_deletes=False)


@register("latest_with_deletes", f"SELECT * FROM ({_LATEST_SQL}) t WHERE operation <> 'delete'")
def latest_with_deletes(spark, sf_dir):
    """Latest version per document; a document whose latest version is a delete is removed."""
    return _latest(spark, sf_dir, apply_deletes=True)


# --- G1-G4: geo ---------------------------------------------------------------------------

_LAT = "(((c_custkey * 37) % 720) / 4.0 - 90.0)"
_LON = "(((c_custkey * 53) % 1440) / 4.0 - 180.0)"


@register("geo_points", f"""
SELECT c_custkey,
       CAST(CAST(CASE WHEN c_custkey % 10 IN (0, 1, 2, 3, 9) THEN {_LAT} ELSE 0 END AS FLOAT) AS DOUBLE) AS lat,
       CAST(CAST(CASE WHEN c_custkey % 10 IN (0, 1, 2, 3, 9) THEN {_LON} ELSE 0 END AS FLOAT) AS DOUBLE) AS lon
FROM customer""")
def geo_points(spark, sf_dir):
    """Geo point from column names, ten layouts, (0, 0) when no valid pair."""
    docs = routed(spark, fx.geo_envelopes(spark, sf_dir))
    return docs.select(field(F.col("data"), "c_custkey", "bigint").alias("c_custkey"),
                       F.col("location.lat").cast("double").alias("lat"),
                       F.col("location.lon").cast("double").alias("lon"))


@register("geo_array_points", f"""
SELECT c_custkey,
       CAST(CAST(CASE WHEN c_custkey % 10 IN (0, 1, 2, 3, 9) THEN {_LAT} ELSE 0 END AS FLOAT) AS DOUBLE) AS lat,
       CAST(CAST(CASE WHEN c_custkey % 10 IN (0, 1, 2, 3, 9) THEN {_LON} ELSE 0 END AS FLOAT) AS DOUBLE) AS lon
FROM customer""")
def geo_array_points(spark, sf_dir):
    """Documents with ``location`` as ``[lat, lon]`` (J3), read back from the document text."""
    docs = routed(spark, fx.geo_envelopes(spark, sf_dir), location_mode="array")
    d = F.parse_json(F.col("doc"))
    return docs.select(field(F.col("data"), "c_custkey", "bigint").alias("c_custkey"),
                       F.try_variant_get(d, "$.location[0]", "double").alias("lat"),
                       F.try_variant_get(d, "$.location[1]", "double").alias("lon"))


@register("geo_raw_points", f"""
SELECT c_custkey,
       CASE c_custkey % 10 WHEN 2 THEN NULL WHEN 4 THEN 91.0 WHEN 6 THEN 'NaN'::DOUBLE WHEN 8 THEN 42.0
            ELSE {_LAT} END AS lat,
       CASE WHEN c_custkey % 10 <> 2 THEN c_custkey % 10 IN (3, 6) END AS lat_quoted,
       CASE c_custkey % 10 WHEN 2 THEN NULL WHEN 5 THEN 181.0 WHEN 7 THEN NULL WHEN 8 THEN NULL
            ELSE {_LON} END AS lon,
       CASE WHEN c_custkey % 10 NOT IN (2, 7, 8) THEN c_custkey % 10 = 3 END AS lon_quoted
FROM customer""")
def geo_raw_points(spark, sf_dir):
    """Documents whose location is copied unvalidated from ``LAT``/``LON`` columns
    (G5, J4): out-of-range and text values pass through, ``PLATE_NO`` counts as ``LAT``."""
    docs = routed(spark, fx.geo_envelopes(spark, sf_dir), location_mode="raw")
    d = F.parse_json(F.col("doc"))

    def side(name: str) -> list:
        v = F.try_variant_get(d, f"$.location.{name}", "variant")
        return [F.try_variant_get(d, f"$.location.{name}", "double").alias(name),
                F.startswith(F.to_json(v), F.lit('"')).alias(f"{name}_quoted")]

    return docs.select(field(F.col("data"), "c_custkey", "bigint").alias("c_custkey"),
                       *side("lat"), *side("lon"))


# --- J1 J2: documents ---------------------------------------------------------------------

@register("doc_fields", """
SELECT p_partkey, p_name, p_retailprice, CAST(0 AS DOUBLE) AS lat, 'part' AS table_name,
       'dms_flink_part' AS index_name
FROM part""")
def doc_fields(spark, sf_dir):
    """Search documents read back field by field (J2): row columns at top level,
    ``location`` and ``metadata`` from the envelope."""
    docs = routed(spark, fx.part_envelopes(spark, sf_dir))
    d = F.parse_json(F.col("doc"))
    return docs.select(F.try_variant_get(d, "$.p_partkey", "bigint").alias("p_partkey"),
                       F.try_variant_get(d, "$.p_name", "string").alias("p_name"),
                       F.try_variant_get(d, "$.p_retailprice", "double").alias("p_retailprice"),
                       F.try_variant_get(d, "$.location.lat", "double").alias("lat"),
                       F.try_variant_get(d, "$.metadata['table-name']", "string").alias("table_name"),
                       "index_name")


@register("envelope_roundtrip", f"""
SELECT CASE WHEN o_orderkey % 100 = 8 THEN NULL ELSE o_orderkey END AS o_orderkey,
       {_op('o_orderkey')} AS operation, 'orders' AS table_name
FROM orders WHERE {_kept('o_orderkey')}""")
def envelope_roundtrip(spark, sf_dir):
    """Envelope re-serialised (J1, the file and re-stream format) and parsed again."""
    kept = routing.only_data(env.parse_dms(fx.orders_envelopes(spark, sf_dir, plant=True)))
    again = env.parse_dms(kept.select(documents.envelope_json(F.col("metadata"), F.col("data")).alias("value")))
    return again.select(field(F.col("data"), "o_orderkey", "bigint").alias("o_orderkey"), "operation", "table_name")


# --- T1-T4: mapping -----------------------------------------------------------------------

def _text_field(index: str, col: str, table: str) -> str:
    return (f"SELECT '{index}' AS index_name, '{col}' AS field, 'text' AS es_type, "
            f"CASE WHEN max(length({col})) <= 256 THEN 256 END AS ignore_above FROM {table}")


def _fixed_fields(index: str, pairs: list[tuple[str, str]]) -> list[str]:
    return [f"SELECT '{index}', '{f}', '{t}', CAST(NULL AS INTEGER)" for f, t in pairs]


def _envelope_fields(index: str) -> list[str]:
    keys = ["timestamp", "record-type", "operation", "partition-key-type", "schema-name", "table-name"]
    return ([f"SELECT '{index}', 'metadata.{k}', 'text', 256" for k in keys]
            + [f"SELECT '{index}', 'location', 'geo_point', CAST(NULL AS INTEGER)"])


_FIELD_TYPES_SQL = " UNION ALL ".join(
    [_text_field("dms_flink_part", c, "part") for c in ("p_name", "p_brand", "p_type")]
    + _fixed_fields("dms_flink_part", [("p_partkey", "long"), ("p_size", "long"), ("p_retailprice", "float")])
    + _envelope_fields("dms_flink_part")
    + [_text_field("dms_flink_orders", c, "orders") for c in ("o_orderstatus", "o_orderpriority")]
    + _fixed_fields("dms_flink_orders", [("o_orderkey", "long"), ("o_custkey", "long"),
                                         ("o_totalprice", "float"), ("o_orderdate", "date")])
    + _envelope_fields("dms_flink_orders")
    + [_text_field("dms_flink_events", c, "events") for c in ("event_type", "props")]
    + _fixed_fields("dms_flink_events", [("event_id", "long"), ("user_id", "long"), ("value", "float"),
                                         ("parent_id", "long")])
    + ["SELECT 'dms_flink_events', 'note', 'text', 256"]
    + ["SELECT 'dms_flink_events', 'client_ts', CASE WHEN bool_or(event_id % 1000 = 999) THEN 'text' "
       "ELSE 'date' END, CASE WHEN bool_or(event_id % 1000 = 999) THEN 256 END FROM events"]
    + _envelope_fields("dms_flink_events"))


def _mapping_input(spark, sf_dir):
    envs = (fx.part_envelopes(spark, sf_dir)
            .unionByName(fx.orders_envelopes(spark, sf_dir, plant=False))
            .unionByName(fx.events_envelopes(spark, sf_dir)))
    return routed(spark, envs)


@register("field_types", _FIELD_TYPES_SQL)
def field_types(spark, sf_dir):
    """Field types per table inferred from every value (T1-T3): instants are
    ``date``, 64-bit integers ``long``, fractions ``float``, the rest ``text``;
    mixed fields widen; ``ignore_above`` when all values fit 256 characters."""
    return mapping.field_types(_mapping_input(spark, sf_dir)).drop("n")


_V1 = {"long": "long", "float": "float", "date": "date", "text": "text"}
_V2 = {"long": "integer", "float": "double", "date": "date", "text": "text"}
_ORDERS_FIELDS = [("o_orderkey", "long"), ("o_custkey", "long"), ("o_orderstatus", "text"),
                  ("o_totalprice", "float"), ("o_orderdate", "date"), ("o_orderpriority", "text"),
                  ("metadata.operation", "text"), ("metadata.partition-key-type", "text"),
                  ("metadata.record-type", "text"), ("metadata.schema-name", "text"),
                  ("metadata.table-name", "text")]


def _diff_row(f: str, a: str, b: str) -> str:
    status = "same" if a == b else "changed"
    return f"SELECT 'dms_flink_orders' AS index_name, '{f}' AS field, '{a}' AS left_type, '{b}' AS right_type, '{status}' AS status"


_MAPPING_DIFF_SQL = " UNION ALL ".join(
    [_diff_row(f, _V1[t], _V2[t]) for f, t in _ORDERS_FIELDS]
    + [_diff_row("metadata.timestamp", "date", "text"), _diff_row("location", "geo_object", "geo_point")]
) + " UNION ALL SELECT 'dms_flink_orders', 'rows_checked', CAST(count(*) AS VARCHAR), CAST(count(*) AS VARCHAR), 'same' FROM orders"


@register("mapping_diff", _MAPPING_DIFF_SQL)
def mapping_diff(spark, sf_dir):
    """Mapping inferred over all orders, rendered in the two sample styles and
    compared field by field (T4, full outer join)."""
    types = mapping.field_types(routed(spark, fx.orders_envelopes(spark, sf_dir, plant=False)))
    diff = mapping.profile_diff(types, "v1", "v2")
    # every document has a location, so its count is the number of rows checked
    n = F.col("n").cast("string")
    row = F.struct("index_name", "field", "left_type", "right_type", "status")
    checked = F.struct("index_name", F.lit("rows_checked").alias("field"), n.alias("left_type"), n.alias("right_type"),
                       F.lit("same").alias("status"))
    both = F.when(F.col("field") == mapping.LOCATION_FIELD, F.array(row, checked)).otherwise(F.array(row))
    return diff.select(F.inline(both))


# Batches of the ``mapping_versions`` query; plain dates among the instants come in batch 3 first.
_MAPPING_BATCH = "CASE WHEN event_id % 1000 = 999 THEN 3 ELSE event_id % 7 END"
_EVENT_FIELDS = [("event_id", "long"), ("user_id", "long"), ("event_type", "text"), ("value", "float"), ("props", "text"),
                 ("parent_id", "long"), ("client_ts", "date"), ("location", "geo_point"),
                 *[(f"metadata.{k}", "text") for k in ("timestamp", "record-type", "operation", "partition-key-type", "schema-name", "table-name")]]


@register("mapping_versions", "SELECT 'dms_flink_events' AS index_name, field, min(batch) AS batch_id, CAST(NULL AS VARCHAR) AS previous_type, es_type "
          f"FROM (SELECT {_MAPPING_BATCH} AS batch FROM events), (VALUES " + ", ".join(f"('{f}', '{t}')" for f, t in _EVENT_FIELDS)
          + f""") f(field, es_type) GROUP BY ALL
UNION ALL SELECT 'dms_flink_events', 'client_ts', min({_MAPPING_BATCH}), 'date', 'text' FROM events WHERE event_id % 1000 = 999
HAVING count(*) > 0""")
def mapping_versions(spark, sf_dir):
    """A mapping that grows batch by batch, the batches in no order and one of them replayed: when each field got
    its type, and the one that widened (T3)."""
    docs = routed(spark, fx.events_envelopes(spark, sf_dir)).select("index_name", "data", "metadata", "seq")
    store = mapping.MappingStore(spark, scratch_path(spark, "mapping"))
    batch = F.when(F.pmod("seq", F.lit(1000)) == 999, F.lit(3)).otherwise(F.pmod("seq", F.lit(7)))
    for n in (2, 0, 1, 6, 3, 5, 4, 3):
        store.append(docs.where(batch == n), n)
    return store.versions()


# Overlapping templates of the ``ordered_templates`` query.
ORDERED_TEMPLATES = [
    {"index_patterns": ["dms_flink_*"], "order": 0, "template": {"mappings": {
        "dynamic_templates": [{"numbers": {"match_mapping_type": "double", "mapping": {"type": "double"}}},
                              {"codes": {"match": "*_id", "match_mapping_type": "long", "mapping": {"type": "keyword"}}}],
        "properties": {"location": {"properties": {"lat": {"type": "float"}, "lon": {"type": "float"}}},
                       "props": {"type": "text", "fields": {"keyword": {"type": "keyword", "ignore_above": 64}}},
                       "event_type": {"type": "keyword"}}}}},
    {"index_patterns": ["dms_flink_e*", "other"], "order": 5, "template": {"mappings": {
        "dynamic_templates": [{"users": {"match": "user*", "unmatch": "*name", "mapping": {"type": "integer"}}}],
        "properties": {"props": {"fields": {"keyword": {"ignore_above": 32}}}, "client_ts": {"type": "date"}}}}},
    {"index_patterns": ["dms_flink_events"], "order": 5, "template": {"mappings": {"properties": {
        "event_type": {"type": "text", "fields": {"keyword": {"type": "keyword", "ignore_above": 16}}}}}}}]


@register("ordered_templates", """
SELECT 'dms_flink_events' AS index_name, field, es_type, ignore_above, count(*) AS n_rows FROM events, (VALUES
  ('event_id', 'keyword', NULL), ('user_id', 'integer', NULL), ('event_type', 'text', 16), ('value', 'double', NULL), ('props', 'text', 32),
  ('client_ts', 'date', NULL), ('parent_id', 'keyword', NULL), ('note', 'text', 256), ('location', 'geo_point', NULL),
  ('metadata.timestamp', 'text', 256), ('metadata.record-type', 'text', 256), ('metadata.operation', 'text', 256),
  ('metadata.partition-key-type', 'text', 256), ('metadata.schema-name', 'text', 256), ('metadata.table-name', 'text', 256))
  f(field, es_type, ignore_above) GROUP BY ALL""")
def ordered_templates(spark, sf_dir):
    """Three overlapping templates: merged by order and by how special their pattern is, properties merged deeply,
    dynamic rules by field and inferred type (T4)."""
    types = mapping.field_types(routed(spark, fx.events_envelopes(spark, sf_dir)))
    return mapping.apply_ordered_templates(types, ORDERED_TEMPLATES).join(types.select("index_name", "field", F.col("n").alias("n_rows")),
                                                                          ["index_name", "field"])


# An index template with the field overrides of a deployment.
TEMPLATES = [{"index_patterns": ["dms_flink_ord*", "other-*"],
              "template": {"mappings": {"properties": {
                  "o_custkey": {"type": "integer"}, "metadata.timestamp": {"type": "date"},
                  "o_orderstatus": {"type": "text", "fields": {"keyword": {"type": "keyword", "ignore_above": 16}}}}}}}]


@register("template_types", " UNION ALL ".join(
    f"SELECT 'dms_flink_orders' AS index_name, '{f}' AS field, '{t}' AS es_type, CAST({i} AS INTEGER) AS ignore_above, "
    "(SELECT count(*) FROM orders) AS n"
    for f, t, i in [("o_orderkey", "long", "NULL"), ("o_custkey", "integer", "NULL"), ("o_orderstatus", "text", "16"),
                    ("o_totalprice", "float", "NULL"), ("o_orderdate", "date", "NULL"), ("o_orderpriority", "text", "256"),
                    ("metadata.timestamp", "date", "NULL"), ("metadata.record-type", "text", "256"),
                    ("metadata.operation", "text", "256"), ("metadata.partition-key-type", "text", "256"),
                    ("metadata.schema-name", "text", "256"), ("metadata.table-name", "text", "256"),
                    ("location", "geo_point", "NULL")]))
def template_types(spark, sf_dir):
    """Index template overrides by index pattern and field on the inferred mapping (T4)."""
    types = mapping.field_types(routed(spark, fx.orders_envelopes(spark, sf_dir, plant=False)))
    return mapping.apply_template(types.drop("n"), TEMPLATES).join(types.select("index_name", "field", "n"),
                                                                   ["index_name", "field"])


# --- O4 O5 O10 O11 S5: layouts and file sinks ---------------------------------------------

@register("hour_layout", """
SELECT CAST(strftime(ts - INTERVAL 5 HOUR, '%Y') AS INTEGER) AS year,
       CAST(strftime(ts - INTERVAL 5 HOUR, '%m') AS INTEGER) AS month,
       CAST(strftime(ts - INTERVAL 5 HOUR, '%d') AS INTEGER) AS day,
       CAST(strftime(ts - INTERVAL 5 HOUR, '%H') AS INTEGER) AS hour,
       count(*) AS n
FROM events GROUP BY ALL""")
def hour_layout(spark, sf_dir):
    """JSON-lines sink in ``year=/month=/day=/hour=`` folders cut at UTC-05:00
    by event time (O4), read back with partition discovery."""
    from tributary.streaming import sinks
    kept = routing.only_data(env.parse_dms(fx.events_envelopes(spark, sf_dir)))
    path = scratch_path(spark, "hour-layout")
    sinks.write_json_lines(kept, path)
    back = spark.read.text(path)
    return (back.groupBy(*[F.col(c).cast("int").alias(c) for c in ("year", "month", "day", "hour")])
                .agg(F.count("*").alias("n")))


@register("month_layout", """
SELECT 'ORDERS' AS table_name, CAST(strftime(o_orderdate, '%Y') AS INTEGER) AS year,
       CAST(strftime(o_orderdate, '%m') AS INTEGER) AS month, count(*) AS n
FROM orders GROUP BY ALL""")
def month_layout(spark, sf_dir):
    """Striim events to Parquet in ``table_name=/year=/month=`` folders from
    ``DBTimeStamp`` epoch seconds (O10), read back."""
    from tributary.streaming import sinks
    parsed = env.parse_striim(fx.striim_envelopes(spark, sf_dir, table="orders"))
    path = scratch_path(spark, "month-layout")
    sinks.write_table_month_parquet(parsed, path)
    back = spark.read.parquet(path)
    return (back.groupBy(F.col("table_name"), F.col("year").cast("int").alias("year"),
                         F.col("month").cast("int").alias("month"))
                .agg(F.count("*").alias("n")))


@register("trip_rows", """
SELECT lpad(CAST((l_partkey % 265) + 1 AS VARCHAR), 3, '0') AS pickup_location,
       CAST(strftime(l_shipdate, '%Y') AS INTEGER) AS year, CAST(strftime(l_shipdate, '%m') AS INTEGER) AS month,
       count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS passengers, max(l_quantity) AS max_distance
FROM lineitem GROUP BY ALL""")
def trip_rows(spark, sf_dir):
    """Trip records parsed with the fixed schema (S8) and laid out by pickup
    location and month (O11)."""
    trips = env.parse_trip(fx.trip_records(spark, sf_dir))
    return (trips.where(F.col("parse_error").isNull())
                 .groupBy(layout.pickup_location_part(F.col("pickup_location_id")),
                          F.year("pickup_datetime").alias("year"), F.month("pickup_datetime").alias("month"))
                 .agg(F.count("*").alias("n"), F.sum("passenger_count").cast("long").alias("passengers"),
                      F.max("trip_distance").alias("max_distance")))


@register("parquet_roundtrip", """
SELECT CAST(c_custkey AS INTEGER) AS num, c_name AS street, c_mktsegment AS city,
       CAST(c_nationkey AS VARCHAR) AS state, lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zip
FROM customer""")
def parquet_roundtrip(spark, sf_dir):
    """Typed records to Parquet and read back with the declared schema."""
    from tributary.streaming import sinks
    path = scratch_path(spark, "address")
    sinks.write_parquet(fx.address_rows(spark, sf_dir), path)
    return spark.read.schema(ADDRESS_SCHEMA).parquet(path)


@register("comma_lines", """
SELECT p_partkey || ',' || p_name || ',null' AS line FROM part""")
def comma_lines(spark, sf_dir):
    """``id,name,description`` text lines, null printed as ``null``, written and read back."""
    from tributary.streaming import sinks
    kept = routing.only_data(env.parse_dms(fx.part_envelopes(spark, sf_dir)))
    d = F.col("data")
    path = scratch_path(spark, "comma-lines")
    sinks.write_text(kept.select(documents.comma_line(field(d, "p_partkey"), field(d, "p_name"),
                                                      field(d, "p_description")).alias("line")), path, col="line")
    return spark.read.text(path).withColumnRenamed("value", "line")


# --- P6: Striim ---------------------------------------------------------------------------

@register("striim_rows", """
SELECT 'TPCH' AS schema_name, 'SUPPLIER' AS table_name,
       CASE s_suppkey % 3 WHEN 0 THEN 'INSERT' WHEN 1 THEN 'UPDATE' ELSE 'DELETE' END AS operation,
       s_suppkey, s_name,
       CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_name || '-old' END AS before_name,
       'pos-' || s_suppkey AS position, 'U' || (s_suppkey % 7) AS txn_user_id,
       strftime(TIMESTAMP '2022-01-01 00:00:00' + to_seconds(s_suppkey), '%Y-%m-%d %H:%M:%S') AS event_time
FROM supplier WHERE s_suppkey % 50 NOT IN (47, 48, 49)""")
def striim_rows(spark, sf_dir):
    """Striim change events: ``SCHEMA.TABLE`` split, ``before`` image, position."""
    p = env.parse_striim(fx.striim_envelopes(spark, sf_dir, table="supplier"))
    return p.where(F.col("parse_error").isNull()).select(
        "schema_name", "table_name", "operation",
        F.try_element_at("data", F.lit("S_SUPPKEY")).try_cast("bigint").alias("s_suppkey"),
        F.try_element_at("data", F.lit("S_NAME")).alias("s_name"),
        F.try_element_at("before", F.lit("S_NAME")).alias("before_name"),
        "position", "txn_user_id", F.date_format("event_time", SECOND_FMT).alias("event_time"))


# --- S4: batched records ----------------------------------------------------------------------

@register("unbatched", """
SELECT 'dms_flink_orders' AS index_name, count(*) AS n_docs FROM orders""")
def unbatched(spark, sf_dir):
    """Batches (``{"data": [...]}`` and bare arrays) split into events."""
    events = env.unbatch(fx.batched_envelopes(spark, sf_dir))
    return routed(spark, events).groupBy("index_name").agg(F.count("*").alias("n_docs"))


# --- W1-W4 M1-M3: windows and health -----------------------------------------------------------

@register("table_window_counts", """
SELECT strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type AS table_name,
       count(*) AS n
FROM events GROUP BY ALL""")
def table_window_counts(spark, sf_dir):
    """Tumbling 1-second event-time counts per table."""
    kept = routing.only_data(env.parse_dms(fx.events_envelopes(spark, sf_dir, table_by_event_type=True)))
    w = windows.table_window_counts(kept, "1 second")
    return w.select(F.date_format("window_start", SECOND_FMT).alias("window_start"), "table_name", "n")


SESSION_GAP = "30 minutes"


@register("session_counts", """
WITH e AS (
  SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev_ts FROM events),
g AS (
  SELECT user_id, ts, sum(CASE WHEN prev_ts IS NULL OR ts - prev_ts > INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
         OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
  FROM e)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS session_start,
       strftime(max(ts) + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S.%f') AS session_end, count(*) AS n
FROM g GROUP BY user_id, sid""")
def session_counts(spark, sf_dir):
    """Sessions per user with a 30-minute gap (W3), exact and split for hot keys."""
    kept = routing.only_data(env.parse_dms(fx.events_envelopes(spark, sf_dir)))
    kept = kept.withColumn("user_id", field(F.col("data"), "user_id", "bigint"))
    s = windows.session_counts(kept, SESSION_GAP, "user_id")
    return s.select("user_id", F.date_format("session_start", MICRO_FMT).alias("session_start"),
                    F.date_format("session_end", MICRO_FMT).alias("session_end"), "n")


@register("stream_health", """
SELECT strftime(date_trunc('minute', ts + to_milliseconds(event_id % 5000)), '%Y-%m-%d %H:%M:%S') AS period_start,
       count(*) AS records_in,
       count(*) FILTER (WHERE event_id % 100 NOT IN (0, 1, 2, 3, 4, 5, 6, 7, 11)) AS records_kept,
       count(*) FILTER (WHERE event_id % 100 NOT IN (1, 4, 5, 6, 7, 11)) AS lag_records,
       max(CASE WHEN event_id % 100 NOT IN (1, 4, 5, 6, 7, 11) THEN event_id % 5000 END) AS max_lag_ms,
       CAST(sum(CASE WHEN event_id % 100 NOT IN (1, 4, 5, 6, 7, 11) THEN event_id % 5000 END) AS BIGINT) AS sum_lag_ms
FROM events GROUP BY ALL""")
def stream_health(spark, sf_dir):
    """Per-minute records in, records kept and delivery lag (M1-M3)."""
    parsed = env.parse_dms(fx.events_envelopes(spark, sf_dir, plant=True))
    kept = F.col("parse_error").isNull() & F.coalesce(F.col("record_type") == "data", F.lit(False))
    h = windows.stream_health(parsed.withColumn("kept", kept), kept_col="kept")
    return h.select(F.date_format("period_start", SECOND_FMT).alias("period_start"), "records_in",
                    "records_kept", "lag_records", "max_lag_ms", "sum_lag_ms")


@register("output_volume", """
SELECT strftime(date_trunc('minute', ts + to_milliseconds(event_id % 5000)), '%Y-%m-%d %H:%M:%S') AS period_start,
       'dms_flink_events' AS index_name, count(*) AS rows_out
FROM events WHERE event_id % 100 NOT IN (0, 1, 2, 3, 4, 5, 6, 7, 11) GROUP BY ALL""")
def output_volume(spark, sf_dir):
    """Documents written per minute of arrival and index (M4). ``bytes_out`` depends on
    the exact document text, so only row counts are compared here; bytes are unit-tested."""
    docs = routed(spark, fx.events_envelopes(spark, sf_dir, plant=True))
    v = windows.output_volume(docs, ts_col="arrival_time")
    return v.select(F.date_format("period_start", SECOND_FMT).alias("period_start"), "index_name", "rows_out")


# --- S1 O6 T3: start position, re-stream records, mapping text --------------------------------

START_TIMESTAMP = "2024-01-15 00:00:00"


@register("from_position", f"""
SELECT 'dms_flink_events' AS index_name, count(*) AS n
FROM events WHERE ts + to_milliseconds(event_id % 5000) >= TIMESTAMP '{START_TIMESTAMP}'""")
def from_position(spark, sf_dir):
    """Source read from an ``AT_TIMESTAMP`` start position on arrival time."""
    recs = start_at(fx.events_envelopes(spark, sf_dir), "AT_TIMESTAMP", START_TIMESTAMP, "arrival_time")
    return routed(spark, recs).groupBy("index_name").agg(F.count("*").alias("n"))


@register("restream_records", f"""
SELECT '0' AS key, 'orders' AS table_name, {_op('o_orderkey')} AS operation, count(*) AS n
FROM orders WHERE {_kept('o_orderkey')} GROUP BY ALL""")
def restream_records(spark, sf_dir):
    """Re-stream records: fixed partition key, envelope JSON value (O6), read back."""
    from tributary.streaming import sinks
    kept = routing.only_data(env.parse_dms(fx.orders_envelopes(spark, sf_dir, plant=True)))
    recs = sinks.restream_records(kept)
    again = env.parse_dms(recs)
    return again.groupBy("key", "table_name", "operation").agg(F.count("*").alias("n"))


@register("index_mappings", """
SELECT 'dms_flink_part' AS index_name, 8 AS n_properties, 6 AS n_metadata, 'geo_point' AS location_type,
       'float' AS price_type, CASE WHEN max(length(p_name)) <= 256 THEN 256 END AS name_ignore_above
FROM part""")
def index_mappings(spark, sf_dir):
    """Mapping JSON per index (T3), read back field by field."""
    types = mapping.field_types(routed(spark, fx.part_envelopes(spark, sf_dir)))
    m = mapping.mapping_json(types).select("index_name", F.parse_json("mapping").alias("m"))
    props = F.try_variant_get(F.col("m"), "$.properties", "map<string,variant>")
    meta = F.try_variant_get(F.col("m"), "$.properties.metadata.properties", "map<string,variant>")
    return m.select(
        "index_name", F.size(props).alias("n_properties"), F.size(meta).alias("n_metadata"),
        F.try_variant_get(F.col("m"), "$.properties.location.type", "string").alias("location_type"),
        F.try_variant_get(F.col("m"), "$.properties.p_retailprice.type", "string").alias("price_type"),
        F.try_variant_get(F.col("m"), "$.properties.p_name.fields.keyword.ignore_above", "int")
         .alias("name_ignore_above"))


@register("striim_documents", """
SELECT 'dms_flink_supplier' AS index_name, count(*) AS n_docs,
       count(*) FILTER (WHERE s_suppkey % 3 = 2) AS n_deletes
FROM supplier WHERE s_suppkey % 50 NOT IN (47, 48, 49)""")
def striim_documents(spark, sf_dir):
    """Striim events through the same routing as DMS rows (D2): one document per event."""
    p = env.striim_as_changes(env.parse_striim(fx.striim_envelopes(spark, sf_dir, table="supplier")))
    docs = routing.route(routing.only_data(p))
    return docs.groupBy("index_name").agg(F.count("*").alias("n_docs"),
                                          F.sum(F.col("is_delete").cast("long")).alias("n_deletes"))


# --- S3 S8 O11 K1 P6 P8 H2 M1 M3 M4: forms with their own read-back -----------------------------

@register("whole_file_rows", """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderstatus FROM orders""")
def whole_file_rows(spark, sf_dir):
    """Whole files of several lines as records, each a batch of up to 128 events of ``orders``."""
    path = scratch_path(spark, "whole-files")
    envs = fx.batched_envelopes(spark, sf_dir, batch_size=128)
    # a file for each batch, all in one folder, moved there by the tasks that wrote them: no folder to make and list per file
    (envs.select(F.replace("value", F.lit(',"'), F.lit(',\n  "')).alias("value"))
         .write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", 2).text(path))
    recs = env.unbatch(open_source(spark, "wholetext", {"path": path}, streaming=False))
    d = F.col("data")
    return routing.only_data(env.parse_dms(recs)).select(field(d, "o_orderkey", "bigint").alias("o_orderkey"),
                                                         field(d, "o_orderstatus").alias("o_orderstatus"))


@register("trip_layout", """
SELECT lpad(CAST(((l_partkey % 265) + 1) % 3 + 5 AS VARCHAR), 3, '0') AS pickup_location, strftime(l_shipdate, '%Y') AS year,
       strftime(l_shipdate, '%m') AS month, count(*) AS n
FROM lineitem GROUP BY ALL""")
def trip_layout(spark, sf_dir):
    """Trips written under ``pickup_location=NNN/year=/month=`` and read back with a declared
    schema, so folder names keep their zeros (S8, O11). Locations are merged into three zones:
    a folder for each of 265 locations and every month would be 22,000 files of a few rows."""
    from tributary.streaming import sinks
    trips = env.parse_trip(fx.trip_records(spark, sf_dir)).withColumn(
        "pickup_location_id", F.pmod("pickup_location_id", F.lit(3)) + 5)
    path = scratch_path(spark, "trips")
    sinks.write_trip_parquet(trips.where(F.col("parse_error").isNull()).drop("value"), path)
    back = spark.read.schema("trip_id bigint, pickup_location string, year string, month string").parquet(path)
    return back.groupBy("pickup_location", "year", "month").agg(F.count("*").alias("n"))


@register("keyed_rows", " UNION ALL ".join(
    f"SELECT 'dms_flink_{t}' AS index_name, count(*) AS n FROM {t} WHERE {_kept(k)}"
    for t, k in (("orders", "o_orderkey"), ("customer", "c_custkey"), ("supplier", "s_suppkey"))))
def keyed_rows(spark, sf_dir):
    """Rows brought together by index for per-table sinks (K1), a hot table split by its size."""
    docs = routed(spark, fx.three_table_envelopes(spark, sf_dir, plant=True))
    keyed = routing.key_by_table(docs.select("index_name", "doc_id"))
    return keyed.groupBy("index_name").agg(F.count("*").alias("n"))


@register("striim_quarantine", """
SELECT CASE s_suppkey % 50 WHEN 47 THEN 'table_missing' WHEN 48 THEN 'time_invalid' WHEN 49 THEN 'time_invalid'
       ELSE 'kept' END AS reason, count(*) AS n
FROM supplier GROUP BY ALL""")
def striim_quarantine(spark, sf_dir):
    """Striim events without a table or with an impossible time are quarantined, not fatal."""
    p = env.parse_striim(fx.striim_envelopes(spark, sf_dir, table="supplier"))
    return p.groupBy(F.coalesce("parse_error", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@register("route_quarantine", f"""
SELECT CASE WHEN c_custkey % 100 = 8 THEN 'key_missing' ELSE 'routed' END AS reason, count(*) AS n,
       count(DISTINCT CASE WHEN c_custkey % 100 <> 8 THEN c_custkey END) AS n_ids
FROM customer WHERE {_kept('c_custkey')} GROUP BY ALL""")
def route_quarantine(spark, sf_dir):
    """Rows without their key columns get a reason, not a shared id (H2)."""
    docs = routed(spark, fx.customer_envelopes(spark, sf_dir, plant=True), id_mode="key", key_columns=["c_custkey"])
    return (docs.groupBy(F.coalesce("route_error", F.lit("routed")).alias("reason"))
                .agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("n_ids")))


@register("audit_quarantine", """
SELECT CASE WHEN c_custkey % 100 IN (0, 2, 3, 8, 9, 10) OR c_custkey % 100 > 11 THEN
            CASE WHEN c_custkey % 100 = 3 THEN 'audit_incomplete' ELSE 'line' END END AS reason, count(*) AS n
FROM customer WHERE c_custkey % 100 NOT IN (1, 4, 5, 6, 7, 11) GROUP BY ALL""")
def audit_quarantine(spark, sf_dir):
    """Parsed records without all four audit keys have no line and a reason."""
    parsed = env.parse_dms(fx.customer_envelopes(spark, sf_dir, plant=True))
    lines = routing.audit_line(parsed.where(F.col("parse_error").isNull()))
    return lines.groupBy(F.coalesce("audit_error", F.lit("line")).alias("reason")).agg(F.count("*").alias("n"))


@register("text_volume", """
SELECT strftime(date_trunc('minute', TIMESTAMP '2022-01-01' + to_seconds(doc_id)), '%Y-%m-%d %H:%M:%S') AS period_start,
       count(*) AS records_in, CAST(sum(strlen(text)) AS BIGINT) AS bytes_in,
       count(*) FILTER (doc_id % 5 <> 0) AS records_kept,
       CAST(sum(CASE WHEN doc_id % 5 <> 0 THEN strlen(text) ELSE 0 END) AS BIGINT) AS bytes_kept,
       count(*) FILTER (doc_id % 7 <> 0) AS lag_records,
       CAST(avg(CASE WHEN doc_id % 7 <> 0 THEN doc_id % 1000 END) AS DECIMAL(18, 3)) AS avg_lag_ms
FROM documents GROUP BY ALL""")
def text_volume(spark, sf_dir):
    """Bytes in and kept, and the average lag of records with an event time, over texts in four
    languages (M1-M3)."""
    d = fx.read_table(spark, sf_dir, "documents")
    arrival = F.timestamp_seconds(F.lit(1640995200) + F.col("doc_id"))
    lag = F.pmod("doc_id", F.lit(1000))
    recs = d.select(F.col("text").alias("value"), arrival.alias("arrival_time"),
                    F.when(F.pmod("doc_id", F.lit(7)) != 0,
                           F.timestamp_millis(F.unix_millis(arrival) - lag)).alias("event_time"),
                    (F.pmod("doc_id", F.lit(5)) != 0).alias("kept"))
    h = windows.stream_health(recs, kept_col="kept")
    return h.select(F.date_format("period_start", SECOND_FMT).alias("period_start"), "records_in", "bytes_in",
                    "records_kept", "bytes_kept", "lag_records", F.col("avg_lag_ms").cast("decimal(18,3)").alias("avg_lag_ms"))


@register("output_bytes", """
SELECT strftime(date_trunc('minute', TIMESTAMP '2022-01-01' + to_seconds(doc_id)), '%Y-%m-%d %H:%M:%S') AS period_start,
       lang AS index_name, count(*) AS rows_out, CAST(sum(strlen(text)) AS BIGINT) AS bytes_out
FROM documents GROUP BY ALL""")
def output_bytes(spark, sf_dir):
    """UTF-8 bytes written per minute and index (M4)."""
    d = fx.read_table(spark, sf_dir, "documents")
    docs = d.select(F.col("lang").alias("index_name"), F.col("text").alias("doc"),
                    F.timestamp_seconds(F.lit(1640995200) + F.col("doc_id")).alias("written_at"))
    v = windows.output_volume(docs)
    return v.select(F.date_format("period_start", SECOND_FMT).alias("period_start"), "index_name", "rows_out", "bytes_out")


# --- O1 S7: the state table ---------------------------------------------------------------------

@register("state_replay", _LATEST_SQL)
def state_replay(spark, sf_dir):
    """Two batches into the state table, the second replayed, a restart that replays it again, and a
    compaction: versions are counted once and the latest wins (O1)."""
    docs = routed(spark, fx.events_envelopes(spark, sf_dir), id_mode="key", key_columns=["user_id"])
    rows = docs.select("index_name", "doc_id", "doc", "is_delete", "operation", "event_time", "arrival_time", "seq")
    path = scratch_path(spark, "state-replay")
    late = F.pmod("seq", F.lit(2)) == 0
    store = state.StateStore(spark, path)
    store.append(rows.where(late), "events", 0)
    store.append(rows.where(~late), "events", 1)
    store.append(rows.where(~late), "events", 1)
    again = state.StateStore(spark, path)
    again.append(rows.where(~late), "events", 1)
    again.compact()
    latest = again.read(apply_deletes=False)
    return latest.select("index_name", "doc_id", F.col("seq").alias("latest_event_id"),
                         F.get_json_object("doc", "$.event_type").alias("latest_event_type"), "operation", "n_versions")


@register("index_documents", f"""
SELECT DISTINCT 'dms_flink_customer' AS index_name, CASE WHEN c_custkey % 100 = 8 THEN NULL ELSE c_custkey END AS c_custkey
FROM customer WHERE {_kept('c_custkey')}""")
def index_documents(spark, sf_dir):
    """All documents of one index, read from the state of three."""
    docs = routed(spark, fx.three_table_envelopes(spark, sf_dir, plant=True))
    path = scratch_path(spark, "state-index")
    state.StateStore(spark, path).append(
        docs.select("index_name", "doc_id", "doc", "is_delete", "operation", "event_time", "seq"), "all", 0)
    back = state.read_index(spark, path, "dms_flink_customer", apply_deletes=False)
    return back.select("index_name", F.get_json_object("doc", "$.c_custkey").cast("bigint").alias("c_custkey"))


@register("state_levels", f"""
WITH latest AS ({_LATEST_SQL})
SELECT 'read' AS via, * FROM latest
UNION ALL
SELECT 'lookup', * FROM latest QUALIFY row_number() OVER (PARTITION BY substr(doc_id, 1, 1) ORDER BY doc_id) = 1""")
def state_levels(spark, sf_dir):
    """The state after 100 appended batches, merged level by level on the way: read as a whole, and the first
    document of each leading digit looked up in the few runs that can hold it (O1 S7)."""
    docs = routed(spark, fx.events_envelopes(spark, sf_dir), id_mode="key", key_columns=["user_id"])
    rows = docs.select("index_name", "doc_id", "doc", "is_delete", "operation", "event_time", "arrival_time", "seq",
                       F.pmod("seq", F.lit(100)).cast("int").alias("batch"))
    batches, path = scratch_path(spark, "state-batches"), scratch_path(spark, "state-levels")
    rows.hint("rebalance", F.col("batch")).write.partitionBy("batch").parquet(batches)
    store = state.StateStore(spark, path, buckets=4)
    for n in range(100):
        store.append(spark.read.schema(rows.drop("batch").schema).parquet(f"{batches}/batch={n}"), "events", n)
    latest = store.read(apply_deletes=False)
    wanted = [r["id"] for r in latest.groupBy(F.substring("doc_id", 1, 1)).agg(F.min("doc_id").alias("id")).collect()]
    found = state.read_index(spark, path, "dms_flink_events", apply_deletes=False, doc_ids=wanted)
    columns = ["index_name", "doc_id", F.col("seq").alias("latest_event_id"),
               F.get_json_object("doc", "$.event_type").alias("latest_event_type"), "operation", "n_versions"]
    return latest.select(F.lit("read").alias("via"), *columns).union(found.select(F.lit("lookup").alias("via"), *columns))


# Limits and shards of the ``bulk_requests`` query.
BULK_BYTES, BULK_ACTIONS, BULK_SHARDS = 6000, 40, 8


@register("bulk_requests", f"""
WITH RECURSIVE docs AS (
  SELECT CAST(user_id % {BULK_SHARDS} AS INTEGER) AS shard, event_id,
         length('{{"index":{{"_index":"events","_id":"' || event_id || '"}}}}') + 1
         + length('{{"event_id":' || event_id || ',"event_type":"' || event_type || '"}}') + 1 AS size FROM events),
lined AS (
  SELECT *, row_number() OVER w AS rn, sum(size) OVER w AS upto FROM docs WINDOW w AS (PARTITION BY shard ORDER BY event_id)),
reach AS (  -- the last document of a request that starts at each one
  SELECT d.shard, d.rn, least(greatest(max(e.rn), d.rn), d.rn + {BULK_ACTIONS - 1}) AS last
  FROM lined d JOIN lined e ON e.shard = d.shard AND e.rn BETWEEN d.rn AND d.rn + {BULK_ACTIONS - 1}
   AND (e.upto <= d.upto - d.size + {BULK_BYTES} OR e.rn = d.rn) GROUP BY d.shard, d.rn),
requests AS (
  SELECT shard, 0 AS request, rn AS first, last FROM reach WHERE rn = 1
  UNION ALL
  SELECT r.shard, q.request + 1, r.rn, r.last FROM requests q JOIN reach r ON r.shard = q.shard AND r.rn = q.last + 1)
SELECT q.shard, CAST(request AS BIGINT) AS request, count(*) AS n_actions, CAST(sum(size) AS BIGINT) AS n_bytes,
       min(event_id) AS first_id, max(event_id) AS last_id
FROM requests q JOIN lined l ON l.shard = q.shard AND l.rn BETWEEN q.first AND q.last GROUP BY q.shard, request""")
def bulk_requests(spark, sf_dir):
    """Documents packed into bulk requests by bytes and actions, shard by shard (O2)."""
    from tributary.operators import bulk
    e = fx.read_table(spark, sf_dir, "events")
    docs = e.select(F.lit("events").alias("index_name"), F.col("event_id").cast("string").alias("doc_id"),
                    F.to_json(F.struct("event_id", "event_type")).alias("doc"), F.lit(False).alias("is_delete"),
                    F.col("event_id").alias("seq"), F.pmod("user_id", F.lit(BULK_SHARDS)).cast("int").alias("_user_shard"))
    requests = bulk.bulk_requests(docs, BULK_BYTES, BULK_ACTIONS, shard=F.col("_user_shard"), order=["seq"])
    ids = F.transform(F.regexp_extract_all("body", F.lit('"_id":"([0-9]+)"')), lambda x: x.cast("bigint"))
    return requests.select("shard", "request", "n_actions", "n_bytes", F.array_min(ids).alias("first_id"), F.array_max(ids).alias("last_id"))

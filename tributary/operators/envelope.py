"""Envelope parsers and the quarantine split.

Input is any DataFrame with a ``value`` string column (plus source columns,
which are carried through). Output keeps every input row; ``parse_error`` is
NULL for good rows and names the reason otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.variants import kind, text_map
from tributary.schemas import (CORRUPT_COL, DMS_ENVELOPE_DDL, STRICT_JSON_OPTIONS,
                               STRIIM_SCHEMA, TRIP_WIRE_SCHEMA)

# Quarantine reasons, in the order they are tested.
DATA_NOT_OBJECT = "data_not_object"
MALFORMED_JSON = "malformed_json"
METADATA_MISSING = "metadata_missing"
METADATA_NESTED = "metadata_nested"
DATA_MISSING = "data_missing"
TABLE_MISSING = "table_missing"
TIME_INVALID = "time_invalid"


def _empty_data() -> Column:
    return F.create_map().cast("map<string,variant>")


def _meta(metadata: Column, key: str) -> Column:
    return F.try_element_at(metadata, F.lit(key))


def _meta_text(metadata: Column, key: str) -> Column:
    return F.try_variant_get(_meta(metadata, key), "$", "string")


def _is_object(v: Column) -> Column:
    return F.coalesce(kind(v).startswith("OBJECT"), F.lit(False))


def _is_container(v: Column) -> Column:
    return F.left(kind(v), F.lit(5)).isin("OBJEC", "ARRAY")


def _dms_reason(value: Column, metadata: Column, data: Column, corrupt: Column) -> Column:
    # The re-parse of the text appears once, behind cheap tests: an expression
    # used twice in the first branch would be hoisted and run for every row.
    data_kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(value), "$.data", "variant"))
    nested = F.exists(F.map_values(metadata), _is_container)
    return (F.when(metadata.isNotNull() & data.isNull() & corrupt.isNotNull()
                   & F.coalesce(~data_kind.startswith("OBJECT"), F.lit(False)),
                   F.lit(DATA_NOT_OBJECT))
            .when(corrupt.isNotNull() | value.isNull() | (F.trim(value) == ""), F.lit(MALFORMED_JSON))
            .when(metadata.isNull() | (F.size(metadata) == 0), F.lit(METADATA_MISSING))
            .when(F.coalesce(nested, F.lit(False)), F.lit(METADATA_NESTED))
            # a row change nobody can route; other record types are dropped later anyway
            .when(F.coalesce(_meta_text(metadata, "record-type") == F.lit("data"), F.lit(False))
                  & _meta_text(metadata, "table-name").isNull(), F.lit(TABLE_MISSING)))


def last_wins(m: Column) -> Column:
    """Map without duplicate keys, the last value kept.

    Rebuilt only when a key repeats; the earlier occurrences are filtered out
    first, so the result does not depend on the session's map-key policy.
    """
    entries = F.map_entries(m)
    later = lambda e, i: F.exists(F.slice(entries, i + 2, F.size(entries)),
                                  lambda x: x["key"] == e["key"])
    unique = F.filter(entries, lambda e, i: ~later(e, i))
    return F.when(F.size(F.array_distinct(F.map_keys(m))) < F.size(m),
                  F.map_from_entries(unique)).otherwise(m)


# Columns ``parse_dms`` adds (an input column of the same name is replaced).
DMS_OUTPUT_COLUMNS = ("parse_error", "metadata", "data", "record_type", "operation",
                      "partition_key_type", "schema_name", "table_name", "event_time")


def _once(df: DataFrame, struct: Column) -> DataFrame:
    """The fields of ``struct`` as columns that nothing above recomputes: a generator's output.

    The struct is made in a projection below the generator, in generated code; a generator interprets what it is given.
    """
    return df.select("*", struct.alias("_struct")).select(*df.columns, F.inline(F.array("_struct")))


def parse_dms(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Parse ``{metadata, data}`` change envelopes.

    Adds ``parse_error``, ``metadata`` (map<string,string>), ``data``
    (map<string,variant>, deduplicated, last value wins, empty when absent) and
    the promoted metadata columns ``record_type``, ``operation``,
    ``partition_key_type``, ``schema_name``, ``table_name``, ``event_time``.
    A quarantined row keeps only its input columns and ``parse_error``:
    everything else is NULL, even when part of the envelope could be read.

    The JSON is parsed once, inside a generator (``inline``); the reason and
    the metadata text map are computed once each in two more generators.
    Filters on the outputs cannot be pushed below a generator, so they never
    copy the parse, the reason test or the map conversion into the filter, and
    the row map is only deduplicated for rows that pass.
    """
    keep = [c for c in df.columns if c not in DMS_OUTPUT_COLUMNS + ("_raw_meta", "_raw_data", CORRUPT_COL)]
    value = F.col(value_col)
    env = F.from_json(value, DMS_ENVELOPE_DDL, STRICT_JSON_OPTIONS)
    parsed = _once(df.select(*keep), env).withColumnsRenamed({"metadata": "_raw_meta", "data": "_raw_data"})
    raw_meta, raw_data, corrupt = F.col("_raw_meta"), F.col("_raw_data"), F.col(CORRUPT_COL)
    reason = _dms_reason(value, raw_meta, raw_data, corrupt)
    checked = _once(parsed, F.struct(reason.alias("parse_error")))
    ok = F.col("parse_error").isNull()
    # third generator: the metadata text map, so filters on it or on the
    # promoted columns read a generator output instead of rebuilding the map
    texted = _once(checked, F.struct(F.when(ok, text_map(last_wins(raw_meta))).alias("metadata")))
    maps = texted.select(
        *keep, "parse_error", "metadata",
        F.when(ok, F.coalesce(last_wins(raw_data), _empty_data())).alias("data"))
    return promote_metadata(maps)


def promote_metadata(df: DataFrame) -> DataFrame:
    """Promoted columns read from the ``metadata`` text map."""
    m = F.col("metadata")
    return df.withColumns({
        "record_type": _meta(m, "record-type"),
        "operation": _meta(m, "operation"),
        "partition_key_type": _meta(m, "partition-key-type"),
        "schema_name": _meta(m, "schema-name"),
        "table_name": _meta(m, "table-name"),
        "event_time": _meta(m, "timestamp").try_cast("timestamp"),
    })


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: complementary filters on ``parse_error``."""
    return df.where(F.col("parse_error").isNull()), df.where(F.col("parse_error").isNotNull())


def quarantine_view(bad: DataFrame, value_col: str = "value") -> DataFrame:
    """What a quarantine sink keeps: the raw text and the reason."""
    extra = [c for c in ("seq", "arrival_time") if c in bad.columns]
    return bad.select(F.col(value_col).alias("value"), "parse_error", *extra)


def conforms(value: Column, required: Sequence[str] = ("metadata", "data"),
             objects: Sequence[str] = ("metadata", "data", "before")) -> Column:
    """JSON-Schema style check: root is an object, ``required`` keys present,
    and each key of ``objects`` that is present holds an object."""
    whole = F.try_parse_json(value)
    ok = _is_object(whole)
    for key in required:
        ok = ok & F.try_variant_get(whole, f"$.{key}", "variant").isNotNull()
    for key in objects:
        node = F.try_variant_get(whole, f"$.{key}", "variant")
        ok = ok & (node.isNull() | _is_object(node))
    return F.coalesce(ok, F.lit(False))


def unbatch(df: DataFrame, value_col: str = "value") -> DataFrame:
    """One row per event for batched records (opt-in).

    A JSON array root ``[e1, e2]`` or an object ``{"data": [e1, e2]}`` without
    ``metadata`` is split into its elements; ``batch_pos`` is the position.
    Every other record passes through unchanged with ``batch_pos`` 0.

    The test is on the parsed value, never on the text, so leading white space
    and escaped key names make no difference.
    """
    value = F.col(value_col)
    others = [c for c in df.columns if c != value_col]
    # parsed once, inside a generator; a read as an array is null for anything else
    parsed = _once(df.select(*others, value_col), F.struct(F.try_parse_json(value).alias("_batch")))
    v = F.col("_batch")
    elems = F.coalesce(F.try_variant_get(v, "$", "array<variant>"),
                       F.when(F.try_variant_get(v, "$.metadata", "variant").isNull(),
                              F.try_variant_get(v, "$.data", "array<variant>")))
    texts = F.coalesce(F.transform(elems, lambda e: F.to_json(e)), F.array(value))
    # the outer form: for the other one Spark adds a filter on the size of the array, which reads the batch once more
    return (parsed.select(*others, texts.alias("_texts")).select(*others, F.posexplode_outer("_texts").alias("batch_pos", value_col))
                  .where(F.col("batch_pos").isNotNull()))


def parse_striim(df: DataFrame, value_col: str = "value",
                 positional_columns: Sequence[str] | None = None) -> DataFrame:
    """Parse Striim change events.

    ``TableName`` ``SCHEMA.TABLE`` is split into ``schema_name``/``table_name``;
    ``event_time`` comes from ``DBTimeStamp`` (epoch seconds), else ``TimeStamp``.
    Positional rows (keys ``"0"``, ``"1"``…) are renamed when
    ``positional_columns`` is given.
    """
    value = F.col(value_col)
    e = F.col("_st")
    # parsed inside a generator so filters on the outputs are not pushed below the parse
    parsed = df.select("*", F.inline(F.array(F.struct(
        F.from_json(value, STRIIM_SCHEMA, STRICT_JSON_OPTIONS).alias("_st")))))
    meta = e["metadata"]
    db_time = seconds_time(meta["DBTimeStamp"])
    text_time = F.try_to_timestamp(meta["TimeStamp"], F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSXXX"))
    reason = (F.when(e[CORRUPT_COL].isNotNull() | value.isNull() | (F.trim(value) == ""), F.lit(MALFORMED_JSON))
              .when(meta.isNull(), F.lit(METADATA_MISSING))
              .when(e["data"].isNull(), F.lit(DATA_MISSING))
              .when(F.coalesce(meta["TableName"], F.lit("")) == "", F.lit(TABLE_MISSING))
              .when((meta["DBTimeStamp"].isNotNull() & db_time.isNull())
                    | (meta["TimeStamp"].isNotNull() & text_time.isNull()), F.lit(TIME_INVALID)))
    table = meta["TableName"]
    data = e["data"]
    if positional_columns:
        names = F.array(*[F.lit(c) for c in positional_columns])
        data = F.transform_keys(
            data, lambda k, _v: F.coalesce(F.try_element_at(names, k.try_cast("int") + F.lit(1)), k))
    event_time = F.coalesce(db_time, text_time, F.col("_st.dateTime").try_cast("timestamp"))
    out = parsed.select(
        *[c for c in df.columns],
        reason.alias("parse_error"),
        meta.alias("metadata"),
        data.alias("data"),
        e["before"].alias("before"),
        F.when(F.locate(".", table) > 0, F.substring_index(table, ".", 1)).alias("schema_name"),
        F.substring_index(table, ".", -1).alias("table_name"),
        meta["OperationName"].alias("operation"),
        meta["OperationType"].alias("operation_type"),
        meta["TxnUserID"].alias("txn_user_id"),
        e["__striimmetadata"]["position"].alias("position"),
        e["userdata"].alias("userdata"),
        F.coalesce(e["TxnID"], meta["TxnID"]).alias("txn_id"),
        event_time.alias("event_time"),
    )
    return out


# Fixed value: seconds of the first instant after year 9999.
_END_OF_TIME = 253402300800


def seconds_time(seconds: Column) -> Column:
    """Epoch seconds as a timestamp; null outside the years 1 to 9999, where no error may end the job."""
    ok = (seconds >= F.lit(-62135596800)) & (seconds < F.lit(_END_OF_TIME))
    return F.timestamp_seconds(F.when(ok, seconds))


def millis_time(millis: Column) -> Column:
    ok = (millis >= F.lit(-62135596800000)) & (millis < F.lit(_END_OF_TIME * 1000))
    return F.timestamp_millis(F.when(ok, millis))


# Striim operation type of row changes.
STRIIM_ROW_CHANGE = "DML"


def striim_as_changes(parsed: DataFrame) -> DataFrame:
    """Parsed Striim events in the shape routing expects.

    ``metadata`` becomes a text map of the fields present, ``data`` a VARIANT
    map (values stay text, as Striim sends them), ``record_type`` is ``data``
    for DML events and ``control`` otherwise, ``operation`` is lower case (so
    ``DELETE`` is a delete).
    """
    ok = F.col("parse_error").isNull()
    meta = F.from_json(F.to_json(F.col("metadata")), "map<string,string>")
    kind_col = F.when(F.upper(F.col("operation_type")) == F.lit(STRIIM_ROW_CHANGE), F.lit("data")) \
                .otherwise(F.lit("control"))
    return parsed.withColumns({
        "metadata": F.when(ok, meta),
        "data": F.when(ok, F.coalesce(F.col("data"), F.create_map().cast("map<string,string>"))
                       .cast("map<string,variant>")),
        "record_type": F.when(ok, kind_col),
        "operation": F.lower(F.col("operation")),
        "partition_key_type": F.lit(None).cast("string"),
    })


def parse_trip(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Typed trip records; epoch-millisecond times become timestamps, impossible ones a quarantine reason."""
    t = F.from_json(F.col(value_col), TRIP_WIRE_SCHEMA, STRICT_JSON_OPTIONS)
    cols = [f.name for f in TRIP_WIRE_SCHEMA.fields if f.name != CORRUPT_COL]
    # parsed inside a generator so filters on the outputs are not pushed below the parse
    parsed = df.select("*", F.inline(F.array(F.struct(t.alias("_t")))))
    sel = []
    for c in cols:
        if c in ("pickup_datetime", "dropoff_datetime"):
            sel.append(millis_time(F.col(f"_t.{c}")).alias(c))
        else:
            sel.append(F.col(f"_t.{c}").alias(c))
    bad_time = F.lit(False)
    for c in ("pickup_datetime", "dropoff_datetime"):
        bad_time = bad_time | (F.col(f"_t.{c}").isNotNull() & millis_time(F.col(f"_t.{c}")).isNull())
    reason = (F.when(F.col(f"_t.{CORRUPT_COL}").isNotNull() | F.col(value_col).isNull(), F.lit(MALFORMED_JSON))
              .when(bad_time, F.lit(TIME_INVALID)))
    return parsed.select(*[c for c in df.columns], reason.alias("parse_error"), *sel)

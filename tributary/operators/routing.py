"""Filters, table selection, keying and per-row routing (index, id, document)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions import documents, geo, ids
from tributary.operators import rules as rules_of

# Index name prefix and the record type that becomes documents.
INDEX_PREFIX = "dms_flink_"
DATA_RECORD_TYPE = "data"
DELETE_OPERATION = "delete"


def only_data(df: DataFrame) -> DataFrame:
    """Parsed, has a record type, and the record type is exactly ``data``.

    Case-sensitive: ``DATA`` is dropped, as are control records
    (``create-table``, ``drop-table``...).
    """
    return df.where(F.col("parse_error").isNull()
                    & F.col("metadata").isNotNull()
                    & F.col("record_type").isNotNull()
                    & (F.col("record_type") == F.lit(DATA_RECORD_TYPE)))


def drop_branch(df: DataFrame) -> DataFrame:
    """Adds ``branch``: which stage keeps or drops each record."""
    return df.withColumn(
        "branch",
        F.when(F.col("parse_error").isNotNull(), F.lit("quarantined"))
         .when(F.col("record_type").isNull(), F.lit("no_record_type"))
         .when(F.col("record_type") != F.lit(DATA_RECORD_TYPE), F.lit("not_data"))
         .otherwise(F.lit("data")))


def rule_pattern(pattern: str) -> str:
    """A selection-rule pattern as a LIKE pattern: only ``%`` is a wildcard,
    so ``_`` (a LIKE wildcard) and the escape character are escaped."""
    return pattern.replace("\\", "\\\\").replace("_", "\\_")


def selection_predicate(rules: Iterable[Mapping]) -> Column:
    """Predicate from selection rules (``object-locator`` with ``%`` wildcards).

    A record is kept when an ``include`` rule matches and no ``exclude`` rule
    does; a rule with ``filters`` matches the rows that meet them (see :mod:`rules`). Rules are job configuration, so the predicate is built once on the
    driver and evaluated in generated code: no join is needed.
    """
    include, exclude = F.lit(False), F.lit(False)
    for rule in rules:
        if rule.get("rule-type", "selection") != "selection":
            continue
        loc = rule.get("object-locator", {})
        match = (F.coalesce(F.col("schema_name"), F.lit("")).like(rule_pattern(loc.get("schema-name", "%")))
                 & F.coalesce(F.col("table_name"), F.lit("")).like(rule_pattern(loc.get("table-name", "%"))))
        try:
            match = match & rules_of.filters_predicate(rule.get("filters") or ())
        except rules_of.RuleError as e:
            raise rules_of.RuleError(f"selection rule {rule.get('rule-id', '')}: {e}") from e
        if rule.get("rule-action", "include") == "exclude":
            exclude = exclude | match
        else:
            include = include | match
    return include & ~exclude


def select_tables(df: DataFrame, rules: Iterable[Mapping]) -> DataFrame:
    return df.where(selection_predicate(rules))


# Quarantine reasons of routing.
AUDIT_INCOMPLETE = "audit_incomplete"
KEY_MISSING = "key_missing"


def audit_line(df: DataFrame) -> DataFrame:
    """Adds ``audit``, ``schema.table|operation|record-type``, and ``audit_error``: a record that lacks
    one of the four has no line (the original job failed on it) and a reason to quarantine it."""
    line = F.concat(F.col("schema_name"), F.lit("."), F.col("table_name"), F.lit("|"), F.col("operation"),
                    F.lit("|"), F.col("record_type"))
    return df.withColumn("audit", line).withColumn("audit_error", F.when(line.isNull(), F.lit(AUDIT_INCOMPLETE)))


def index_name(table_name: Column, prefix: str = INDEX_PREFIX) -> Column:
    return F.concat(F.lit(prefix), F.lower(table_name))


def route(df: DataFrame, prefix: str = INDEX_PREFIX, id_mode: str = "content",
          key_columns: Mapping[str, Sequence[str]] | Sequence[str] | None = None,
          location_mode: str = "object") -> DataFrame:
    """Adds ``location``, ``index_name``, ``doc_id``, ``route_error``, ``is_delete`` and ``doc``.

    ``id_mode="content"`` hashes the whole row (any change gives a new
    document); ``id_mode="key"`` hashes ``key_columns`` (one list for all
    tables, or a mapping table name -> list), so every version of a row maps to
    one document. A row without its key has no id and ``route_error`` says so;
    split such rows off with :func:`split_routed`. ``location_mode`` is ``object`` (validated point), ``array``
    or ``raw`` (unvalidated upper-case columns).
    """
    data, meta = F.col("data"), F.col("metadata")
    out = (df.withColumn("location", geo.location(data))
             .withColumn("index_name", index_name(F.col("table_name"), prefix)))
    if id_mode == "content":
        doc_id = ids.content_id(data)
    elif id_mode == "key":
        if not key_columns:
            raise ValueError("id_mode='key' needs key_columns")
        if isinstance(key_columns, Mapping):
            doc_id = F.lit(None).cast("string")
            for table, cols in key_columns.items():
                doc_id = F.when(F.col("table_name") == F.lit(table),
                                ids.key_id(F.col("schema_name"), F.col("table_name"), data, cols)
                                ).otherwise(doc_id)
            # tables without a configured key use the content id
            doc_id = F.when(F.col("table_name").isin(*key_columns), doc_id).otherwise(ids.content_id(data))
        else:
            doc_id = ids.key_id(F.col("schema_name"), F.col("table_name"), data, list(key_columns))
    else:
        raise ValueError(f"unknown id_mode {id_mode!r}")
    if location_mode == "object":
        doc = documents.search_document(data, F.col("location"), meta)
    elif location_mode == "array":
        doc = documents.search_document_array(data, F.col("location"), meta)
    elif location_mode == "raw":
        doc = documents.search_document_raw(data, geo.raw_location(data), meta)
    else:
        raise ValueError(f"unknown location_mode {location_mode!r}")
    return (out.withColumn("doc_id", doc_id)
               .withColumn("route_error", F.when(F.col("doc_id").isNull(), F.lit(KEY_MISSING)))
               .withColumn("is_delete", F.coalesce(F.lower(F.col("operation")) == F.lit(DELETE_OPERATION),
                                                   F.lit(False)))
               .withColumn("doc", doc))


def split_routed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)`` by ``route_error``."""
    return df.where(F.col("route_error").isNull()), df.where(F.col("route_error").isNotNull())


def key_by_table(df: DataFrame) -> DataFrame:
    """Rows of an index together for per-table sinks. Adaptive execution splits a hot table by its size."""
    return df.hint("rebalance", F.col("index_name"))

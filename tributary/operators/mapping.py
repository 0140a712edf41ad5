"""Index mapping inference per table, mapping text, profiles and diffs.

The original helper inferred a mapping from one event. Here the mapping is
inferred from all events of a table: per ``(index, field)`` the value types
are combined, widening ``long -> float -> text`` and ``date -> text``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from fnmatch import fnmatchcase

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.functions.inference import KEYWORD_IGNORE_ABOVE, type_of
from tributary.functions.variants import as_text, kind

# Field names of the envelope parts in a document.
LOCATION_FIELD = "location"
METADATA_PREFIX = "metadata."


def _cells(routed: DataFrame, include_envelope: bool) -> DataFrame:
    """One row per (document, row field) with the value's type and the length of its text, plus, optionally, one per
    document with its metadata keys (``keys``, null in the others), all from a single pass.

    A value's kind and text are read once. The cells are made below the generator and typed above it, so that both
    run in generated code."""
    def cell(field, k, text, keys):
        return F.struct(field.alias("field"), k.alias("k"), text.alias("text"), keys.alias("keys"))

    no_text, no_keys = F.lit(None).cast("string"), F.lit(None).cast("array<string>")
    cells = F.transform(F.map_entries("data"), lambda e: cell(e["key"], kind(e["value"]), as_text(e["value"]), no_keys))
    if include_envelope:
        keys = F.map_keys("metadata")
        cells = F.when(keys.isNotNull(), F.concat(cells, F.array(cell(no_text, no_text, no_text, keys))))
    k, text = F.col("k"), F.col("text")
    # the outer form: for the other one Spark adds a filter on the size of the array, which makes the cells once more
    return (routed.select("index_name", cells.alias("_cells")).select("index_name", F.inline_outer("_cells"))
                  .where("k is not null or keys is not null")
                  .select("index_name", "field", "keys", F.when(k.isNotNull(), type_of(k, text)).alias("t"),
                          F.when(k.isNull(), F.lit(0)).otherwise(F.length(F.coalesce(text, F.lit("null")))).alias("len")))


def field_types(routed: DataFrame, include_envelope: bool = True) -> DataFrame:
    """``(index_name, field, es_type, ignore_above)`` per table field.

    Row values are typed one by one (T1) and combined per field with widening;
    JSON nulls are left out, so a nullable column keeps its type, and a field
    with nulls only is ``text``. Metadata keys are ``text`` with a 256 keyword
    limit and ``location`` is a ``geo_point``. ``n`` is the number of documents
    with the field. ``ignore_above`` (256) is set on ``text`` fields whose
    values are all at most 256 characters long. One pass over the input, map-side
    partial aggregation, and a second aggregation of what is left, a few rows per field.
    """
    return types_of(field_flags(routed, include_envelope))


# What has been seen of a field. Two such rows merge into one (or, or, ..., max, sum), in any order.
FLAGS = ("d", "l", "f", "x", "m", "g")


def field_flags(routed: DataFrame, include_envelope: bool = True) -> DataFrame:
    """``(index_name, field, d, l, f, x, m, g, max_len, n)``: whether a date, long, float, text, metadata or location
    value has been seen, the longest text and the number of documents with the field."""
    t = F.col("t")
    kinds = list(zip(FLAGS, ("date", "long", "float", "text")))
    # the metadata keys of a document are counted as one, and told apart when a row per set of keys is left
    seen = (_cells(routed, include_envelope).groupBy("index_name", "field", "keys")
            .agg(*[F.bool_or(t == k).alias(c) for c, k in kinds], F.max("len").alias("max_len"), F.count("*").alias("n")))

    def named(field, m=False, g=False):
        return F.struct(field.alias("field"), F.lit(m).alias("m"), F.lit(g).alias("g"))

    envelope = F.concat(F.transform("keys", lambda k: named(F.concat(F.lit(METADATA_PREFIX), k), m=True)),
                        F.array(named(F.lit(LOCATION_FIELD), g=True)))
    fields = F.when(F.col("keys").isNull(), F.array(named(F.col("field")))).otherwise(envelope)
    return (seen.select("index_name", *[F.coalesce(c, F.lit(False)).alias(c) for c, _ in kinds], "max_len", "n", F.inline(fields))
                .groupBy("index_name", "field")
                .agg(*[F.bool_or(c).alias(c) for c in FLAGS], F.max("max_len").alias("max_len"), F.sum("n").alias("n")))


def _type_of(unknown: str) -> Column:
    return (F.when(F.col("g"), F.lit("geo_point"))
            .when(F.col("m"), F.lit("text"))
            .when(F.col("x"), F.lit("text"))
            .when(F.col("d") & (F.col("l") | F.col("f")), F.lit("text"))
            .when(F.col("d"), F.lit("date"))
            .when(F.col("f"), F.lit("float"))
            .when(F.col("l"), F.lit("long"))
            .otherwise(F.lit(unknown)))


def types_of(flags: DataFrame) -> DataFrame:
    """The mapping that what has been seen asks for."""
    typ = _type_of("text")
    ignore = (F.when(F.col("m"), F.lit(KEYWORD_IGNORE_ABOVE))
              .when((typ == "text") & (F.col("max_len") <= KEYWORD_IGNORE_ABOVE), F.lit(KEYWORD_IGNORE_ABOVE)))
    return flags.select("index_name", "field", typ.alias("es_type"), ignore.cast("int").alias("ignore_above"), "n")


class MappingStore:
    """A mapping that grows with the batches of a stream.

    Each batch leaves what it has seen per field, a few rows under
    ``<path>/batch_id=<id>``; a replayed batch replaces its own. The mapping is the
    merge of all of them: types only widen, and any order of batches gives the
    mapping of the whole table. :meth:`versions` says in which batch a field
    first had a type and when it changed, i.e. where an index would have to be
    rebuilt. Rows grow with fields and batches, not with documents;
    :meth:`fold` merges old batches into the oldest.
    """

    SCHEMA = ("index_name string, field string, " + ", ".join(f"{c} boolean" for c in FLAGS)
              + ", max_len int, n bigint, since bigint, batch_id bigint")

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def append(self, routed: DataFrame, batch_id: int, include_envelope: bool = True) -> None:
        flags = field_flags(routed, include_envelope).withColumn("since", F.lit(batch_id).cast("bigint"))
        flags.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")  # a row per field

    def flags(self) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(self.path)

    def mapping(self) -> DataFrame:
        """``(index_name, field, es_type, ignore_above, n)`` after all batches."""
        return types_of(self.flags().groupBy("index_name", "field").agg(
            *[F.bool_or(c).alias(c) for c in FLAGS], F.max("max_len").alias("max_len"), F.sum("n").alias("n")))

    def versions(self) -> DataFrame:
        """``(index_name, field, batch_id, previous_type, es_type)``: the batches in which a field got a type or a wider
        one. Fields that have had nulls only have none yet."""
        upto = Window.partitionBy("index_name", "field").orderBy("since").rowsBetween(Window.unboundedPreceding, 0)
        seen = self.flags().select("index_name", "field", "since", *[F.bool_or(c).over(upto).alias(c) for c in FLAGS])
        typed = seen.select("index_name", "field", F.col("since").alias("batch_id"), _type_of("unknown").alias("es_type")) \
                    .where("es_type <> 'unknown'")
        before = F.lag("es_type").over(Window.partitionBy("index_name", "field").orderBy("batch_id"))
        return (typed.withColumn("previous_type", before).where("previous_type is null or previous_type <> es_type")
                     .select("index_name", "field", "batch_id", "previous_type", "es_type"))

    def drift(self) -> DataFrame:
        """The versions that changed a type."""
        return self.versions().where("previous_type is not null")

    def fold(self, before: int) -> None:
        """Merge the batches below ``before`` into one whose rows keep the batches in which something new was seen."""
        upto = Window.partitionBy("index_name", "field").orderBy("since").rowsBetween(Window.unboundedPreceding, 0)
        last = Window.partitionBy("index_name", "field").orderBy("since")
        old = self.flags().where(F.col("batch_id") < before)
        ids = [r.batch_id for r in old.select("batch_id").distinct().collect()]  # folders, not rows
        if len(ids) < 2:
            return
        seen = old.select("index_name", "field", "since", "max_len", "n", *[F.bool_or(c).over(upto).alias(c) for c in FLAGS])
        now = F.struct(*FLAGS)
        marked = seen.withColumn("new", ~now.eqNullSafe(F.lag(now).over(last)))
        kept = (marked.withColumn("step", F.sum(F.col("new").cast("int")).over(upto))
                      .groupBy("index_name", "field", "step", *FLAGS)
                      .agg(F.max("max_len").alias("max_len"), F.sum("n").alias("n"), F.min("since").alias("since")).drop("step"))
        rows = kept.collect()  # a row per field and type it has had
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        # the merged rows replace the newest of the old batches in one overwrite; until the others are gone their
        # flags are there twice, which changes no type, only counts
        schema = ", ".join(f for f in self.SCHEMA.split(", ") if not f.startswith("batch_id"))
        names = [f.split()[0] for f in schema.split(", ")]
        (self.spark.createDataFrame([tuple(r[c] for c in names) for r in rows], schema).coalesce(1)
             .write.mode("overwrite").parquet(f"{self.path}/batch_id={max(ids)}"))
        for i in sorted(ids)[:-1]:
            folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/batch_id={i}")
            folder.getFileSystem(conf).delete(folder, True)


def _spec_json(es_type_col, ignore_above_col):
    keyword = F.when(ignore_above_col.isNotNull(),
                     F.to_json(F.struct(F.lit("keyword").alias("type"), ignore_above_col.alias("ignore_above"))))\
               .otherwise(F.to_json(F.struct(F.lit("keyword").alias("type"))))
    text_spec = F.concat(F.lit('{"type":"text","fields":{"keyword":'), keyword, F.lit("}}"))
    geo_obj = F.lit('{"properties":{"lat":{"type":"float"},"lon":{"type":"float"}}}')
    return (F.when(es_type_col == "text", text_spec)
             .when(es_type_col == "geo_object", geo_obj)
             .otherwise(F.to_json(F.struct(es_type_col.alias("type")))))


def mapping_json(types: DataFrame) -> DataFrame:
    """``(index_name, mapping)`` with ``{"properties": {...}}`` per index.

    Grouping is per index and the collected list holds one entry per field,
    so its size is bounded by the schema width, not by the data.
    """
    spec = F.parse_json(_spec_json(F.col("es_type"), F.col("ignore_above")))
    is_meta = F.col("field").startswith(METADATA_PREFIX)
    top = F.map_from_entries(F.collect_list(F.when(~is_meta, F.struct(F.col("field"), spec))))
    meta = F.map_from_entries(F.collect_list(F.when(
        is_meta, F.struct(F.expr(f"substring(field, {len(METADATA_PREFIX) + 1})"), spec))))
    return (types.groupBy("index_name")
                 .agg(top.alias("_top"), meta.alias("_meta"))
                 .select("index_name", F.to_json(F.struct(F.map_concat(
                     "_top",
                     F.create_map(F.lit("metadata"),
                                  F.to_variant_object(F.struct(F.col("_meta").alias("properties"))))
                 ).alias("properties"))).alias("mapping")))


# The two sample mapping styles. v1 keeps long/float, a
# lat/lon object and a date timestamp; v2 uses integer/double, geo_point and a
# text timestamp.
PROFILES: dict[str, dict[str, str]] = {
    "v1": {"long": "long", "float": "float", "location": "geo_object", "metadata.timestamp": "date"},
    "v2": {"long": "integer", "float": "double", "location": "geo_point", "metadata.timestamp": "text"},
}


_TYPE_NAMES = ("long", "float", "text", "date", "geo_point")


def _profile_type(profile: str | Mapping[str, str]) -> Column:
    rules = PROFILES[profile] if isinstance(profile, str) else dict(profile)
    by_field = {k: v for k, v in rules.items() if k not in _TYPE_NAMES}
    by_type = {k: v for k, v in rules.items() if k in _TYPE_NAMES}
    typ = F.col("es_type")
    for name, target in by_type.items():
        typ = F.when(F.col("es_type") == F.lit(name), F.lit(target)).otherwise(typ)
    for name, target in by_field.items():
        typ = F.when(F.col("field") == F.lit(name), F.lit(target)).otherwise(typ)
    return typ


def apply_profile(types: DataFrame, profile: str | Mapping[str, str]) -> DataFrame:
    """Rewrite inferred types to a mapping style; field rules win over type rules."""
    typ = _profile_type(profile)
    ignore = F.when(typ == "text", F.coalesce(F.col("ignore_above"), F.lit(KEYWORD_IGNORE_ABOVE)))
    return types.select("index_name", "field", typ.alias("es_type"), ignore.cast("int").alias("ignore_above"))


def profile_diff(types: DataFrame, left: str | Mapping[str, str], right: str | Mapping[str, str]) -> DataFrame:
    """One mapping in two styles, field by field: a projection, no join."""
    lft, rgt = _profile_type(left), _profile_type(right)
    return types.select("index_name", "field", lft.alias("left_type"), rgt.alias("right_type"),
                        F.when(lft == rgt, F.lit("same")).otherwise(F.lit("changed")).alias("status"), "n")


def apply_template(types: DataFrame, templates: list[Mapping]) -> DataFrame:
    """Field overrides from index templates (``index_patterns`` with ``*``).

    Templates are job configuration, so they become one ``CASE`` expression
    built on the driver; the first matching template wins.
    """
    typ, ign = F.col("es_type"), F.col("ignore_above")
    rules = []
    for t in templates:
        props = t.get("template", {}).get("mappings", {}).get("properties", {})
        for pattern in t.get("index_patterns", []):
            for fld, spec in props.items():
                like = pattern.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_").replace("*", "%")
                rules.append((like, fld, spec.get("type", "object"),
                              spec.get("fields", {}).get("keyword", {}).get("ignore_above")))
    for pattern, fld, o_type, o_ign in reversed(rules):
        hit = F.col("index_name").like(pattern) & (F.col("field") == F.lit(fld))
        typ = F.when(hit, F.lit(o_type)).otherwise(typ)
        ign = F.when(hit, F.lit(o_ign).cast("int")).otherwise(ign)
    return types.select("index_name", "field", typ.alias("es_type"), ign.alias("ignore_above"))


def merged_templates(templates: Iterable[Mapping], index_name: str) -> dict:
    """The template an index gets from several, as plain data.

    Templates whose patterns match are merged deeply, in rising order of their
    ``order`` (``priority``), then of the length of the longest matching pattern
    (a more special one wins), then as given; a later value replaces an earlier one
    but for objects, which are merged key by key. ``dynamic_templates`` are lists:
    those of a later template come first.
    """
    found = []
    for place, t in enumerate(templates):
        sizes = [len(p) for p in t.get("index_patterns", []) if fnmatchcase(index_name, _glob(p))]
        if sizes:
            found.append((t.get("order", t.get("priority", 0)), max(sizes), place, t.get("template", t)))

    def merge(low, high):
        if isinstance(low, Mapping) and isinstance(high, Mapping):
            return {k: merge(low[k], high[k]) if k in low and k in high else high.get(k, low.get(k)) for k in {**low, **high}}
        return high
    out: dict = {}
    for _, _, _, body in sorted(found, key=lambda x: x[:3]):
        rules = body.get("mappings", {}).get("dynamic_templates", []) + out.get("mappings", {}).get("dynamic_templates", [])
        out = merge(out, body)
        if rules:
            out = merge(out, {"mappings": {"dynamic_templates": rules}})
    return out


def _glob(pattern: str) -> str:
    """An index pattern, in which only ``*`` is a wildcard, for the standard matcher."""
    return "".join(f"[{c}]" if c in "?[" else c for c in pattern)


def _flat(properties: Mapping, prefix: str = "") -> dict[str, Mapping]:
    """Leaf fields of nested ``properties`` by their dotted names."""
    out: dict[str, Mapping] = {}
    for name, spec in properties.items():
        if "properties" in spec and "type" not in spec:
            out |= _flat(spec["properties"], f"{prefix}{name}.")
        else:
            out[prefix + name] = spec
    return out


# The value type a dynamic rule names, by inferred type.
DYNAMIC_TYPES = {"string": "text", "long": "long", "double": "float", "date": "date"}


def apply_ordered_templates(types: DataFrame, templates: Iterable[Mapping]) -> DataFrame:
    """Inferred types under templates merged by precedence (see :func:`merged_templates`).

    A field the merged template names has its type; another one has that of the first dynamic rule whose
    ``match`` pattern (on the field), ``unmatch`` and ``match_mapping_type`` (on the inferred type) fit, else its
    inferred type. Templates are configuration: which of them meet in an index depends on the set of those
    whose patterns match, so there is one merged template per such set, and the rows pick theirs in one
    expression.
    """
    templates = list(templates)
    sets = {r.index_name: merged_templates(templates, r.index_name)
            for r in types.select("index_name").distinct().collect()}  # a row per table
    typ, ign = F.col("es_type"), F.col("ignore_above")
    for index, body in sets.items():
        here = F.col("index_name") == F.lit(index)
        mappings = body.get("mappings", {})
        for rule in reversed([r for t in mappings.get("dynamic_templates", []) for r in t.values()]):
            hit = here
            if "match_mapping_type" in rule and rule["match_mapping_type"] != "*":
                hit = hit & (F.col("es_type") == F.lit(DYNAMIC_TYPES.get(rule["match_mapping_type"], rule["match_mapping_type"])))
            for key, wanted in (("match", True), ("unmatch", False)):
                if key in rule:
                    like = F.col("field").like(_like(rule[key]))
                    hit = hit & (like if wanted else ~like)
            typ, ign = _override(typ, ign, hit, rule.get("mapping", {}))
        for field, spec in _flat(mappings.get("properties", {})).items():
            typ, ign = _override(typ, ign, here & (F.col("field") == F.lit(field)), spec)
    return types.select("index_name", "field", typ.alias("es_type"), ign.cast("int").alias("ignore_above"))


def _override(typ: Column, ign: Column, hit: Column, spec: Mapping) -> tuple[Column, Column]:
    keyword = spec.get("fields", {}).get("keyword", {}).get("ignore_above", spec.get("ignore_above"))
    return (F.when(hit, F.lit(spec.get("type", "object"))).otherwise(typ), F.when(hit, F.lit(keyword).cast("int")).otherwise(ign))


def _like(pattern: str) -> str:
    return pattern.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_").replace("*", "%")


def mapping_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Full outer join of two mappings on ``(index_name, field)``."""
    lft = left.select("index_name", "field", F.col("es_type").alias("left_type"))
    rgt = right.select("index_name", "field", F.col("es_type").alias("right_type"))
    j = lft.join(rgt, ["index_name", "field"], "full_outer")
    status = (F.when(F.col("left_type").isNull(), F.lit("only_right"))
              .when(F.col("right_type").isNull(), F.lit("only_left"))
              .when(F.col("left_type") == F.col("right_type"), F.lit("same"))
              .otherwise(F.lit("changed")))
    return j.select("index_name", "field", "left_type", "right_type", status.alias("status"))

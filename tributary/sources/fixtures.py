"""Change envelopes made from the driver's base tables.

The base tables hold no CDC text, so these builders stand in for the change
stream: every base row becomes one envelope (``value``) plus source columns
``seq`` (a per-source offset) and ``arrival_time``. Faults are planted by key
arithmetic only, so an SQL oracle can repeat the arithmetic on the base table
without reading any JSON. Every row of the base table flows through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.sources.files import spread

# Schema name used for every generated table.
SOURCE_SCHEMA = "TPCH"

# Planted cases by ``key % 100`` (see FIXTURES.md section 3).
#   0 control record (create-table, no data)      -> dropped, not data
#   1 object cut off                              -> quarantined malformed_json
#   2 record-type "DATA"                          -> dropped, case-sensitive
#   3 no record-type                              -> dropped, no record type
#   4 data is an array                            -> quarantined data_not_object
#   5 no metadata                                 -> quarantined metadata_missing
#   6 nested object inside metadata               -> quarantined metadata_nested
#   7 empty text                                  -> quarantined malformed_json
#   8 no data                                     -> kept, empty row
#   9 object followed by text                     -> kept
#  10 operation "delete"                          -> kept
#  11 no table name                               -> quarantined table_missing
PLANT_MODULUS = 100

INSTANT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def instant_text(ts: Column) -> Column:
    return F.date_format(ts.cast("timestamp"), INSTANT_FORMAT)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # a base table may be one file with one row group: local runs can ask for more tasks
    partitions = spark.conf.get("spark.tributary.inputPartitions", None)
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"), int(partitions) if partitions else None)


def default_operation(key: Column) -> Column:
    k = F.pmod(key, F.lit(3))
    return F.when(k == 0, F.lit("load")).when(k == 1, F.lit("insert")).otherwise(F.lit("update"))


def dms_envelopes(df: DataFrame, *, table: Column | str, key: Column | str,
                  columns: Sequence[Column], event_time: Column,
                  operation: Column | None = None, plant: bool = False,
                  schema: str = SOURCE_SCHEMA, seq: Column | None = None,
                  arrival_time: Column | None = None,
                  passthrough: Sequence[str] = ()) -> DataFrame:
    """One ``{metadata, data}`` envelope per row of ``df``."""
    key = F.col(key) if isinstance(key, str) else key
    table = F.lit(table) if isinstance(table, str) else table
    operation = operation if operation is not None else default_operation(key)
    p = F.pmod(key, F.lit(PLANT_MODULUS)) if plant else F.lit(-1)
    record_type = F.when(p == 2, F.lit("DATA")).when(p == 3, F.lit(None)).otherwise(F.lit("data"))
    op = F.when(p == 10, F.lit("delete")).otherwise(operation)
    ts_text = instant_text(event_time)
    meta = F.to_json(F.struct(
        ts_text.alias("timestamp"), record_type.alias("record-type"), op.alias("operation"),
        F.lit("primary-key").alias("partition-key-type"), F.lit(schema).alias("schema-name"),
        F.when(p == 11, F.lit(None)).otherwise(table).alias("table-name")))
    control = F.to_json(F.struct(
        ts_text.alias("timestamp"), F.lit("control").alias("record-type"),
        F.lit("create-table").alias("operation"), F.lit("task-id").alias("partition-key-type"),
        F.lit(schema).alias("schema-name"), table.alias("table-name")))
    data = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    seq = seq if seq is not None else key.cast("long")
    arrival_time = arrival_time if arrival_time is not None else event_time.cast("timestamp")
    staged = df.select(*passthrough, meta.alias("_meta"), control.alias("_ctrl"), data.alias("_data"),
                       p.alias("_p"), key.cast("string").alias("_key"), seq.alias("seq"),
                       arrival_time.alias("arrival_time"))
    m, d, pc = F.col("_meta"), F.col("_data"), F.col("_p")
    full = F.concat(F.lit('{"metadata":'), m, F.lit(',"data":'), d, F.lit("}"))
    nested_meta = F.concat(F.expr("substring(_meta, 1, length(_meta) - 1)"),
                           F.lit(',"transaction":{"id":'), F.col("_key"), F.lit("}}"))
    value = (F.when(pc == 0, F.concat(F.lit('{"metadata":'), F.col("_ctrl"), F.lit("}")))
             .when(pc == 1, F.expr("substring(_full, 1, length(_full) - 7)"))
             .when(pc == 4, F.concat(F.lit('{"metadata":'), m, F.lit(',"data":['), d, F.lit("]}")))
             .when(pc == 5, F.concat(F.lit('{"data":'), d, F.lit("}")))
             .when(pc == 6, F.concat(F.lit('{"metadata":'), nested_meta, F.lit(',"data":'), d, F.lit("}")))
             .when(pc == 7, F.lit(""))
             .when(pc == 8, F.concat(F.lit('{"metadata":'), m, F.lit("}")))
             .when(pc == 9, F.concat(F.col("_full"), F.lit(" trailing")))
             .otherwise(F.col("_full")))
    return (staged.withColumn("_full", full)
                  .select(*passthrough, value.alias("value"), "seq", "arrival_time"))


def epoch_time(key: Column) -> Column:
    """A stand-in event time for tables without one: 2022-01-01 plus key seconds."""
    return F.timestamp_seconds(F.lit(1640995200) + key.cast("long"))


def orders_envelopes(spark: SparkSession, sf_dir: str, plant: bool = True) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    cols = [F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus"), F.col("o_totalprice"),
            instant_text(F.col("o_orderdate")).alias("o_orderdate"), F.col("o_orderpriority")]
    return dms_envelopes(o, table="orders", key="o_orderkey", columns=cols,
                         event_time=F.col("o_orderdate"), plant=plant)


def customer_envelopes(spark: SparkSession, sf_dir: str, plant: bool = True) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    cols = [F.col("c_custkey"), F.col("c_name"), F.col("c_nationkey"), F.col("c_acctbal"),
            F.col("c_mktsegment")]
    return dms_envelopes(c, table="customer", key="c_custkey", columns=cols,
                         event_time=epoch_time(F.col("c_custkey")), plant=plant)


def supplier_envelopes(spark: SparkSession, sf_dir: str, plant: bool = True) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    cols = [F.col("s_suppkey"), F.col("s_name"), F.col("s_nationkey"), F.col("s_acctbal")]
    return dms_envelopes(s, table="supplier", key="s_suppkey", columns=cols,
                         event_time=epoch_time(F.col("s_suppkey")), plant=plant)


def three_table_envelopes(spark: SparkSession, sf_dir: str, plant: bool = True) -> DataFrame:
    return (orders_envelopes(spark, sf_dir, plant)
            .unionByName(customer_envelopes(spark, sf_dir, plant))
            .unionByName(supplier_envelopes(spark, sf_dir, plant)))


# Events whose client time is planted as a plain date.
CLIENT_TS_BAD_MODULUS = 1000
CLIENT_TS_BAD_REMAINDER = 999
# Simulated delivery delay, in milliseconds, is event_id mod this.
ARRIVAL_DELAY_MODULUS = 5000


def events_envelopes(spark: SparkSession, sf_dir: str, plant: bool = False,
                     table_by_event_type: bool = False) -> DataFrame:
    """Events as row changes of table ``events`` keyed by ``user_id``.

    ``error`` events are deletes. ``client_ts`` is an ISO instant except for
    planted plain dates. ``parent_id`` is a JSON null in every other row and
    ``note`` in all rows. ``arrival_time`` trails the event time by
    ``event_id % 5000`` ms.
    """
    e = read_table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    client_ts = F.when(F.pmod(F.col("event_id"), F.lit(CLIENT_TS_BAD_MODULUS)) == CLIENT_TS_BAD_REMAINDER,
                       F.date_format(ts, "yyyy-MM-dd")).otherwise(instant_text(ts))
    cols = [F.col("event_id"), F.col("user_id"), F.col("event_type"), F.col("value"), F.col("props"),
            client_ts.alias("client_ts"),
            F.when(F.pmod("event_id", F.lit(2)) == 0, F.col("event_id")).alias("parent_id"),
            F.lit(None).cast("string").alias("note")]
    op = F.when(F.col("event_type") == "error", F.lit("delete")).otherwise(F.lit("update"))
    table = F.col("event_type") if table_by_event_type else F.lit("events")
    arrival = F.timestamp_millis(F.unix_millis(ts) + F.pmod(F.col("event_id"), F.lit(ARRIVAL_DELAY_MODULUS)))
    return dms_envelopes(e, table=table, key="event_id", columns=cols, event_time=ts, operation=op,
                         plant=plant, arrival_time=arrival)


def part_envelopes(spark: SparkSession, sf_dir: str, with_price: bool = True) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    cols = [F.col("p_partkey"), F.col("p_name"), F.col("p_brand"), F.col("p_type"), F.col("p_size")]
    if with_price:
        cols.append(F.col("p_retailprice"))
    return dms_envelopes(p, table="part", key="p_partkey", columns=cols,
                         event_time=epoch_time(F.col("p_partkey")))


def nation_region_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    ne = dms_envelopes(n, table="nation", key="n_nationkey",
                       columns=[F.col("n_nationkey"), F.col("n_name"), F.col("n_regionkey")],
                       event_time=epoch_time(F.col("n_nationkey")))
    re = dms_envelopes(r, table="region", key="r_regionkey",
                       columns=[F.col("r_regionkey"), F.col("r_name")],
                       event_time=epoch_time(F.col("r_regionkey")))
    return ne.unionByName(re)


# Geo layouts planted by ``c_custkey % 10``.
#   0 LATITUDE, LONGITUDE numbers       5 longitude 181
#   1 LONGITUDE before LATITUDE         6 latitude "NaN" text
#   2 lower-case latitude, longitude    7 latitude only
#   3 numbers as text                   8 PLATE_NO number only
#   4 latitude 91                       9 HOME_LAT, HOME_LON
GEO_MODULUS = 10


def geo_lat(key: Column) -> Column:
    """Exactly representable latitude in [-90, 89.75]."""
    return F.pmod(key * F.lit(37), F.lit(720)) / F.lit(4.0) - F.lit(90.0)


def geo_lon(key: Column) -> Column:
    return F.pmod(key * F.lit(53), F.lit(1440)) / F.lit(4.0) - F.lit(180.0)


def geo_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer rows with coordinate columns in ten layouts."""
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    g = F.pmod(k, F.lit(GEO_MODULUS))
    lat, lon = geo_lat(k), geo_lon(k)
    base = F.to_json(F.struct(F.col("c_custkey"), F.col("c_name")))

    def obj(*pairs: tuple[str, Column]) -> Column:
        # {"c_custkey":..,"c_name":..,<pairs>} in exactly this document order
        parts = [F.expr("substring(_base, 1, length(_base) - 1)")]
        for name, v in pairs:
            parts += [F.lit(f',"{name}":'), v]
        parts.append(F.lit("}"))
        return F.concat(*parts)

    num = lambda v: v.cast("string")
    txt = lambda v: F.concat(F.lit('"'), v.cast("string"), F.lit('"'))
    data = (F.when(g == 0, obj(("LATITUDE", num(lat)), ("LONGITUDE", num(lon))))
            .when(g == 1, obj(("LONGITUDE", num(lon)), ("LATITUDE", num(lat))))
            .when(g == 2, obj(("latitude", num(lat)), ("longitude", num(lon))))
            .when(g == 3, obj(("LATITUDE", txt(lat)), ("LONGITUDE", txt(lon))))
            .when(g == 4, obj(("LATITUDE", F.lit("91")), ("LONGITUDE", num(lon))))
            .when(g == 5, obj(("LATITUDE", num(lat)), ("LONGITUDE", F.lit("181"))))
            .when(g == 6, obj(("LATITUDE", F.lit('"NaN"')), ("LONGITUDE", num(lon))))
            .when(g == 7, obj(("LATITUDE", num(lat))))
            .when(g == 8, obj(("PLATE_NO", F.lit("42"))))
            .otherwise(obj(("HOME_LAT", num(lat)), ("HOME_LON", num(lon)))))
    meta = F.to_json(F.struct(
        instant_text(epoch_time(k)).alias("timestamp"), F.lit("data").alias("record-type"),
        F.lit("load").alias("operation"), F.lit("primary-key").alias("partition-key-type"),
        F.lit(SOURCE_SCHEMA).alias("schema-name"), F.lit("customer").alias("table-name")))
    return (c.select(k, base.alias("_base"), meta.alias("_meta"))
             .select(F.concat(F.lit('{"metadata":'), F.col("_meta"), F.lit(',"data":'), data, F.lit("}"))
                     .alias("value"),
                     k.cast("long").alias("seq"), epoch_time(k).alias("arrival_time")))


# Striim operations by ``key % 3``.
STRIIM_OPERATIONS = ("INSERT", "UPDATE", "DELETE")


def striim_envelopes(spark: SparkSession, sf_dir: str, table: str = "supplier") -> DataFrame:
    """Striim change events; ``DBTimeStamp`` is epoch seconds.

    ``supplier``: event time from the key; ``orders``: from ``o_orderdate``.
    """
    if table == "supplier":
        df = read_table(spark, sf_dir, "supplier")
        key, ts = F.col("s_suppkey"), epoch_time(F.col("s_suppkey"))
        data = F.struct(F.col("s_suppkey").cast("string").alias("S_SUPPKEY"),
                        F.col("s_name").alias("S_NAME"),
                        F.col("s_nationkey").cast("string").alias("S_NATIONKEY"))
        before = F.struct(F.col("s_suppkey").cast("string").alias("S_SUPPKEY"),
                          F.concat(F.col("s_name"), F.lit("-old")).alias("S_NAME"))
    elif table == "orders":
        df = read_table(spark, sf_dir, "orders")
        key, ts = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
        data = F.struct(F.col("o_orderkey").cast("string").alias("O_ORDERKEY"),
                        F.col("o_orderstatus").alias("O_ORDERSTATUS"))
        before = F.struct(F.col("o_orderkey").cast("string").alias("O_ORDERKEY"))
    else:
        raise ValueError(table)
    op_i = F.pmod(key, F.lit(3))
    op = F.element_at(F.array(*[F.lit(o) for o in STRIIM_OPERATIONS]), (op_i + 1).cast("int"))
    # planted in supplier rows by key % 50: 47 no table, 48 a time without its shape, 49 microseconds
    bad = F.pmod(key, F.lit(50)) if table == "supplier" else F.lit(-1)
    meta = F.struct(
        F.when(bad != 47, F.lit(f"{SOURCE_SCHEMA}.{table.upper()}")).alias("TableName"),
        F.lit("USERS").alias("TableSpace"),
        F.concat(F.lit("U"), F.pmod(key, F.lit(7)).cast("string")).alias("TxnUserID"),
        op.alias("OperationName"), F.lit("DML").alias("OperationType"),
        F.when(bad == 48, F.lit("yesterday")).otherwise(
            F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'-00:00'")).alias("TimeStamp"),
        F.when(bad == 49, F.unix_micros(ts)).otherwise(F.unix_seconds(ts)).alias("DBTimeStamp"),
        F.concat(F.lit("txn-"), (key / 10).cast("long").cast("string")).alias("TxnID"))
    before_col = F.when(op_i == 0, F.to_json(F.struct())).otherwise(F.to_json(before))
    value = F.concat(
        F.lit('{"before":'), before_col, F.lit(',"data":'), F.to_json(data),
        F.lit(',"metadata":'), F.to_json(meta),
        F.lit(',"__striimmetadata":{"position":"pos-'), key.cast("string"), F.lit('"},"userdata":null}'))
    return df.select(value.alias("value"), key.cast("long").alias("seq"), ts.alias("arrival_time"))


def trip_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items shaped as trip records (times as epoch milliseconds)."""
    li = read_table(spark, sf_dir, "lineitem")
    pickup = F.unix_millis(F.col("l_shipdate").cast("timestamp"))
    rec = F.struct(
        F.pmod(F.col("l_suppkey"), F.lit(3)).cast("int").alias("vendor_id"),
        pickup.alias("pickup_datetime"),
        (pickup + F.col("l_linenumber").cast("long") * F.lit(600000)).alias("dropoff_datetime"),
        F.col("l_linenumber").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.lit(1).alias("ratecode_id"),
        F.col("l_returnflag").alias("store_and_fwd_flag"),
        (F.pmod(F.col("l_partkey"), F.lit(265)) + 1).cast("int").alias("pickup_location_id"),
        (F.pmod(F.col("l_suppkey"), F.lit(265)) + 1).cast("int").alias("dropoff_location_id"),
        F.pmod(F.col("l_orderkey"), F.lit(4)).cast("int").alias("payment_type"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_discount").alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        F.col("l_tax").alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(0.3).alias("improvement_surcharge"),
        F.col("l_extendedprice").alias("total_amount"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("trip_id"),
        F.lit("trip").alias("type"),
        F.lit("").alias("padding"))
    return li.select(F.to_json(rec).alias("value"),
                     (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"))


def address_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers shaped as address records ``(num, street, city, state, zip)``."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("int").alias("num"), F.col("c_name").alias("street"),
                    F.col("c_mktsegment").alias("city"), F.col("c_nationkey").cast("string").alias("state"),
                    F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("zip"))


def batched_envelopes(spark: SparkSession, sf_dir: str, batch_size: int = 16) -> DataFrame:
    """Orders envelopes packed as ``{"data": [e1, e2, ...]}`` batches.

    Batches hold at most ``batch_size`` events (consecutive keys), so each
    group is bounded; batches with an odd id use the bare JSON-array form.
    """
    env = orders_envelopes(spark, sf_dir, plant=False)
    batch = (F.col("seq") / F.lit(batch_size)).cast("long")
    grouped = (env.withColumn("batch_id", batch)
                  .groupBy("batch_id")
                  .agg(F.array_join(F.sort_array(F.collect_list(F.struct("seq", "value")))["value"], ",")
                       .alias("items")))
    value = F.when(F.pmod(F.col("batch_id"), F.lit(2)) == 0,
                   F.concat(F.lit('{"data":['), F.col("items"), F.lit("]}"))
                   ).otherwise(F.concat(F.lit("["), F.col("items"), F.lit("]")))
    # leading white space and an escaped key name are legal JSON
    lead = F.element_at(F.array(*[F.lit(x) for x in ("", " ", "\n", "\t", "\r\n")]),
                        (F.pmod("batch_id", F.lit(5)) + 1).cast("int"))
    value = F.concat(lead, F.when(F.pmod("batch_id", F.lit(6)) == 0, F.regexp_replace(value, '^."data"', '{"d\\\\u0061ta"'))
                     .otherwise(value))
    return grouped.select(value.alias("value"), F.col("batch_id").alias("seq"))

"""Envelope and record schemas (fixed envelope frame, dynamic row columns)."""

from __future__ import annotations

from pyspark.sql import types as T

# Column holding the raw text of a record that did not parse.
CORRUPT_COL = "_corrupt"

# Envelope read contract: row values stay VARIANT so every JSON type survives,
# metadata values are VARIANT too so nested values can be detected and refused.
DMS_ENVELOPE_DDL = (
    f"metadata map<string,variant>, data map<string,variant>, {CORRUPT_COL} string"
)

# Strict JSON, as a standard JSON parser reads it.
STRICT_JSON_OPTIONS = {
    "columnNameOfCorruptRecord": CORRUPT_COL,
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}

# Striim change-event metadata fields with their types.
_STRIIM_METADATA_FIELDS = [
    ("RbaSqn", T.StringType()), ("AuditSessionId", T.StringType()),
    ("TableSpace", T.StringType()), ("CURRENTSCN", T.StringType()),
    ("SQLRedoLength", T.IntegerType()), ("ParentTxnID", T.StringType()),
    ("SRC_CON_NAME", T.StringType()), ("Status", T.StringType()),
    ("SegmentName", T.StringType()), ("TimeStamp", T.StringType()),
    ("TableName", T.StringType()), ("TxnID", T.StringType()),
    ("COMMIT_TIMESTAMP", T.StringType()), ("OperationType", T.StringType()),
    ("DBTimeStamp", T.LongType()), ("TransactionName", T.StringType()),
    ("BytesProcessed", T.StringType()), ("OperationCode", T.IntegerType()),
    ("SessionInfo", T.StringType()), ("RecordSetID", T.StringType()),
    ("DBCommitTimestamp", T.LongType()), ("COMMITSCN", T.StringType()),
    ("SEQUENCE", T.StringType()), ("Rollback", T.StringType()),
    ("STARTSCN", T.StringType()), ("OperationName", T.StringType()),
    ("RbaBlk", T.IntegerType()), ("SSN", T.StringType()),
    ("TxnUserID", T.StringType()), ("SegmentType", T.StringType()),
    ("Serial", T.StringType()), ("ThreadID", T.StringType()),
    ("ROWID", T.StringType()), ("SCN", T.StringType()), ("Session", T.StringType()),
]

STRIIM_METADATA = T.StructType([T.StructField(n, t, True) for n, t in _STRIIM_METADATA_FIELDS])

STRIIM_SCHEMA = T.StructType([
    T.StructField("dateTime", T.StringType()),
    T.StructField("metadata", STRIIM_METADATA),
    T.StructField("data", T.MapType(T.StringType(), T.StringType())),
    T.StructField("before", T.MapType(T.StringType(), T.StringType())),
    T.StructField("dataPresenceBitMap", T.MapType(T.StringType(), T.LongType())),
    T.StructField("beforePresenceBitMap", T.MapType(T.StringType(), T.LongType())),
    T.StructField("__striimmetadata", T.StructType([T.StructField("position", T.StringType())])),
    T.StructField("typeUUID", T.StringType()),
    T.StructField("userdata", T.StringType()),
    T.StructField("TxnID", T.StringType()),
    T.StructField(CORRUPT_COL, T.StringType()),
])

# Trip record fields as they travel; timestamps are epoch milliseconds.
TRIP_WIRE_SCHEMA = T.StructType([
    T.StructField("vendor_id", T.IntegerType()),
    T.StructField("pickup_datetime", T.LongType()),
    T.StructField("dropoff_datetime", T.LongType()),
    T.StructField("passenger_count", T.IntegerType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("ratecode_id", T.IntegerType()),
    T.StructField("store_and_fwd_flag", T.StringType()),
    T.StructField("pickup_location_id", T.IntegerType()),
    T.StructField("dropoff_location_id", T.IntegerType()),
    T.StructField("payment_type", T.IntegerType()),
    T.StructField("fare_amount", T.DoubleType()),
    T.StructField("extra", T.DoubleType()),
    T.StructField("mta_tax", T.DoubleType()),
    T.StructField("tip_amount", T.DoubleType()),
    T.StructField("tolls_amount", T.DoubleType()),
    T.StructField("improvement_surcharge", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("trip_id", T.LongType()),
    T.StructField("type", T.StringType()),
    T.StructField("padding", T.StringType()),
    T.StructField(CORRUPT_COL, T.StringType()),
])

ADDRESS_SCHEMA = T.StructType([
    T.StructField("num", T.IntegerType()),
    T.StructField("street", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("zip", T.StringType()),
])

LOCATION_TYPE = T.StructType([
    T.StructField("lat", T.FloatType()),
    T.StructField("lon", T.FloatType()),
])

"""Column layouts shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

# A record of the log, column for column what Spark's Kafka source delivers with `includeHeaders`.
HEADERS = T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())]))

ENVELOPE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("headers", HEADERS),
    ]
)

# JSON name -> (column, JSON type), as the wire format has them. The order is the order in which problems are listed.
REQUIRED_FIELDS = {
    "schemaVersion": ("schema_version", "number"),
    "eventId": ("event_id", "string"),
    "sensorId": ("sensor_id", "string"),
    "sequence": ("sequence", "number"),
    "ts": ("ts", "string"),
    "temperatureC": ("temperature_c", "number"),
}

OPTIONAL_FIELDS = {
    "rackId": ("rack_id", "string"),
    "humidityPct": ("humidity_pct", "number"),
    "vibrationMmS": ("vibration_mm_s", "number"),
}

FIELDS = {**REQUIRED_FIELDS, **OPTIONAL_FIELDS}

FIELD_COLUMNS = {name: column for name, (column, _) in FIELDS.items()}

# The audit table: a record's place in the log, its reading, and what became of it.
AUDIT = T.StructType(
    [
        *[f for f in ENVELOPE.fields if f.name not in ("key", "value", "headers")],
        *[
            T.StructField(column, T.DoubleType() if kind == "number" else T.StringType())
            for column, kind in FIELDS.values()
        ],
        T.StructField("event_time", T.TimestampType()),
        T.StructField("reason", T.StringType()),
        T.StructField("errors", T.ArrayType(T.StringType())),
        T.StructField("raw", T.StringType()),
        T.StructField("dead_lettered_at", T.TimestampType()),
        T.StructField("payload", T.StringType()),
        T.StructField("is_duplicate", T.BooleanType()),
        T.StructField("previous_sequence", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("missing", T.DoubleType()),
        T.StructField("is_anomaly", T.BooleanType()),
        T.StructField("anomaly", T.StringType()),
    ]
)

# Arrival order of a log whose records carry their sensor as key.
LOG_ORDER = ("partition", "offset")

# Statuses of a record.
ACCEPTED, DUPLICATE, GAP, OUT_OF_ORDER = "accepted", "duplicate", "gap", "out_of_order"
INVALID_JSON, SCHEMA_INVALID = "invalid-json", "schema-invalid"

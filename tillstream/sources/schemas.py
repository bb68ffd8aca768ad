"""Explicit schemas. Nothing in this package infers a schema from data."""

from __future__ import annotations

import json

from pyspark.sql import types as T

# Field names, types and order of the event on the wire.
AVRO_SCHEMA = {
    "type": "record",
    "name": "Sale",
    "fields": [
        {"name": "transaction_id", "type": "string"},
        {"name": "store_id", "type": "string"},
        {"name": "product_id", "type": "string"},
        {"name": "quantity", "type": "int"},
        {"name": "price", "type": "float"},
        {"name": "payment_type", "type": ["null", "string"], "default": None},
        {"name": "transaction_ts", "type": "string"},
    ],
}

# Accepted payment types, default table names.
PAYMENT_TYPES = ["credit_card", "debit_card", "cash", "online"]
RAW_TABLE = "raw_retail_sales"
AGG_TABLE = "agg_store_sales_5min"
FACT_TABLE = "fact_sales"

# Event time, and the day partition column of tables written by this package.
TIME = "transaction_ts"
DAY = "event_day"
# Below the day, raw tables have a folder for each micro-batch; the notes of the batches begun are in a folder of their own.
BATCH = "batch"
BEGUN = "_batches"
# The window table is read by store and time: inside a day its files are cut by both.
AGG_WITHIN = ("store_id",)

SALE_COLUMNS = [field["name"] for field in AVRO_SCHEMA["fields"]]
REQUIRED = [c for c in SALE_COLUMNS if c != "payment_type"]

_SPARK_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "float": T.FloatType()}


def avro_schema_json() -> str:
    return json.dumps(AVRO_SCHEMA)


def wire_schema() -> T.StructType:
    """The event as decoded, before its time is parsed."""
    return T.StructType(
        [
            T.StructField(f["name"], _SPARK_TYPES[f["type"][-1] if isinstance(f["type"], list) else f["type"]])
            for f in AVRO_SCHEMA["fields"]
        ]
    )


RAW_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("payment_type", T.StringType()),
        T.StructField("transaction_ts", T.TimestampType()),
    ]
)

FACT_SCHEMA = T.StructType([*RAW_SCHEMA.fields, T.StructField("revenue", T.DoubleType())])

AGG_SCHEMA = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("total_revenue", T.DoubleType()),
        T.StructField("total_quantity", T.LongType()),
    ]
)

# Zoned timestamps: event time must be TIMESTAMP for watermarks, and declaring it
# at the scan (in place of a cast above it) lets time filters reach Parquet.
EVENTS_SCHEMA = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"

import json
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.operators import decode
from tillstream.operators.aggregates import store_windows
from tillstream.sources.schemas import AVRO_SCHEMA, REQUIRED, SALE_COLUMNS, avro_schema_json, wire_schema

GOOD = {
    "transaction_id": "a",
    "store_id": "store_1",
    "product_id": "product_1",
    "quantity": 3,
    "price": 19.99,
    "payment_type": None,
    "transaction_ts": "2026-03-08T22:00:00Z",
}


def framed(body: str, header: bytes = b"\x00\x00\x00\x00\x07") -> bytes:
    return header + body.encode()


@pytest.fixture()
def messages(spark):
    def build(*values):
        return spark.createDataFrame([(i, bytearray(v)) for i, v in enumerate(values)], "n int, value binary")

    return build


def test_schema_is_one_definition():
    assert [f["name"] for f in AVRO_SCHEMA["fields"]] == SALE_COLUMNS == wire_schema().names
    assert json.loads(avro_schema_json()) == AVRO_SCHEMA
    assert "payment_type" not in REQUIRED and len(REQUIRED) == 6
    assert [f.dataType.simpleString() for f in wire_schema()] == [
        "string", "string", "string", "int", "float", "string", "string",
    ]


def test_envelope_and_header(messages):
    frame = messages(framed("xyz"), b"\x00\x01", b"", framed("q", b"\x01\x00\x00\x01\x00"), b"\x00\xff\xff\xff\xff")
    found = frame.select(
        decode.payload().alias("payload"), decode.is_framed().alias("framed"), decode.schema_id().alias("id")
    ).collect()
    assert [bytes(r["payload"]) for r in found] == [b"xyz", b"", b"", b"q", b""]
    assert [r["framed"] for r in found] == [True, False, False, False, True]
    assert [r["id"] for r in found] == [7, None, None, 256, None]


def test_parse_and_cast_keeps_good_rows_and_types(messages):
    frame = messages(framed(json.dumps(GOOD)), framed("{not json"), framed(""), b"\x00\x00", framed("{}"))
    parsed = decode.parse_and_cast(frame)
    assert parsed.columns == SALE_COLUMNS
    assert dict(parsed.dtypes)["price"] == "float" and dict(parsed.dtypes)["transaction_ts"] == "timestamp"
    (row,) = parsed.collect()
    assert row["transaction_id"] == "a" and row["payment_type"] is None
    assert row["transaction_ts"] == datetime(2026, 3, 8, 22)


def test_unreadable_time_is_null_not_an_error(messages):
    frame = messages(framed(json.dumps(GOOD | {"transaction_ts": "garbage"})))
    assert decode.parse_and_cast(frame).first()["transaction_ts"] is None


def test_reject_reasons(messages):
    frame = messages(
        framed(json.dumps(GOOD)),
        framed("junk"),
        b"\x00",
        framed(json.dumps(GOOD | {"store_id": None})),
        framed(json.dumps(GOOD | {"transaction_ts": "?"})),
        b"\x07" + framed(json.dumps(GOOD))[1:],
    )
    classified = decode.with_reject_reason(frame, keep=("n", "value"))
    reasons = {r["n"]: r["reject_reason"] for r in decode.rejected(classified).collect()}
    assert reasons == {
        1: "undecodable", 2: "not_framed", 3: "missing_required", 4: "missing_required", 5: "not_framed",
    }
    kept = {r["n"]: (r["value"], r["transaction_ts_text"]) for r in decode.rejected(classified).collect()}
    assert kept[2] == (b"\x00", None) and kept[4][1] == "?" and kept[1][0] == framed("junk")
    assert [r["n"] for r in decode.accepted(classified).collect()] == [0]


def test_price_is_widened_before_the_product(messages):
    frame = decode.parse_and_cast(messages(framed(json.dumps(GOOD))))
    assert store_windows(frame).first()["total_revenue"] == 59.96999931335449


def test_avro_is_used_when_its_package_is_there(messages):
    try:
        decode.parse_and_cast(messages(framed("x")), "avro").collect()
    except AnalysisException as error:
        assert "AVRO" in str(error).upper()


def test_unknown_format(messages):
    with pytest.raises(ValueError):
        decode.parse_and_cast(messages(b""), "xml")


def test_decoding_needs_no_shuffle_and_reads_only_the_value(messages):
    plan = decode.parse_and_cast(messages(framed("x")))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert plan.count("from_json") == 1  # each message is decoded once


def test_another_event_schema(messages):
    """Unit price, total and epoch milliseconds in place of price and ISO time."""
    body = {"transaction_id": "t", "quantity": 3, "unit_price": 9.99, "total_amount": 29.97, "transaction_ts": 1704067200123}
    schema = "transaction_id string, quantity int, unit_price double, total_amount double, transaction_ts bigint"
    rows = decode.unpack(messages(framed(json.dumps(body)), framed("junk")), schema=T.StructType.fromDDL(schema))
    good, bad = rows.withColumn("transaction_ts", F.timestamp_millis("transaction_ts")).collect()
    assert good["transaction_ts"] == datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert round(good["quantity"] * good["unit_price"], 2) == good["total_amount"]
    assert list(bad) == [None] * 5

"""Sales views over the generic `events` table.

Each takes the events frame (batch or streaming) and is a single scan with
projections only: the duplicate copies come from `explode`, not from a union of
two reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.sources.readers import stream_files
from tillstream.sources.schemas import EVENTS_SCHEMA, SALE_COLUMNS

# Event type -> payment type; any other event type has none.
PAYMENT_OF_EVENT = {"click": "credit_card", "view": "debit_card", "purchase": "cash", "signup": "online"}

TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss'Z'"
EMPTY_MESSAGE = "000000"
ENVELOPE = "0000000001"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_files(spark, f"{sf_dir}/events.parquet", EVENTS_SCHEMA)


def sales(events: DataFrame) -> DataFrame:
    """Events as sales; `event_id` stays as the arrival order."""
    k = F.get_json_object("props", "$.k").cast("int")
    payment = None
    for event_type, payment_type in PAYMENT_OF_EVENT.items():
        matches = F.col("event_type") == event_type
        payment = F.when(matches, payment_type) if payment is None else payment.when(matches, payment_type)
    return events.select(
        "event_id",
        F.concat(F.lit("tx_"), "event_id").alias("transaction_id"),
        F.concat(F.lit("store_"), F.col("user_id") % 20 + 1).alias("store_id"),
        F.concat(F.lit("product_"), k % 100 + 1).alias("product_id"),
        (k % 5 + 1).cast("int").alias("quantity"),
        F.col("value").alias("price"),
        payment.alias("payment_type"),
        F.col("ts").alias("transaction_ts"),
    )


def _nth(n: int):
    return F.col("event_id") % n == 0


def _with_copies(frame: DataFrame, has_copy) -> DataFrame:
    copies = F.when(has_copy, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return frame.select("*", F.explode(copies).alias("copy"))


def sales_dirty(events: DataFrame) -> DataFrame:
    """Sales with planted faults: missing stores, unknown payment types, early
    times, and repeats of some ids three minutes later."""
    first = F.col("copy") == 0
    return (
        _with_copies(sales(events), _nth(50))
        .withColumn("store_id", F.when(~(first & _nth(97)), F.col("store_id")))
        .withColumn("payment_type", F.when(first & _nth(89), "MOBILE_PAY").otherwise(F.col("payment_type")))
        .withColumn(
            "transaction_ts",
            F.when(~first, F.col("transaction_ts") + F.expr("interval 3 minutes"))
            .when(_nth(61), F.col("transaction_ts") - F.expr("interval 2 hours"))
            .otherwise(F.col("transaction_ts")),
        )
        .drop("copy")
    )


def sales_repeated(events: DataFrame) -> DataFrame:
    """Sales in which one row of fifty comes twice, copies identical."""
    return _with_copies(sales(events), _nth(50)).drop("copy")


def sales_resent(events: DataFrame) -> DataFrame:
    """Sales in which one row of fifty is sent again eight days later."""
    return (
        _with_copies(sales(events), _nth(50))
        .withColumn(
            "transaction_ts",
            F.when(F.col("copy") == 0, F.col("transaction_ts")).otherwise(
                F.col("transaction_ts") + F.expr("interval 8 days")
            ),
        )
        .withColumn("arrived_at", F.col("transaction_ts"))
        .drop("copy")
    )


def sales_delayed(events: DataFrame) -> DataFrame:
    """Sales in which one row of seven arrives three days after its time."""
    return (
        sales(events)
        .withColumn("arrived_at", F.col("transaction_ts"))
        .withColumn(
            "transaction_ts",
            F.when(_nth(7), F.col("transaction_ts") - F.expr("interval 3 days")).otherwise(F.col("transaction_ts")),
        )
    )


def wire(events: DataFrame) -> DataFrame:
    """Sales as framed messages (`event_id`, `value`) with a JSON payload.

    Damaged messages: too short, not JSON, no store, unreadable time.
    """
    return _framed(sales(events), F.col("transaction_ts")).select("event_id", "value")


def _framed(source: DataFrame, sent: Column) -> DataFrame:
    body = F.to_json(
        F.struct(
            *[
                F.when(~_nth(47), F.col(c)).alias(c) if c == "store_id" else F.col(c)
                for c in SALE_COLUMNS
                if c != "transaction_ts"
            ],
            F.when(_nth(53), "garbage").otherwise(F.date_format(sent, TIME_PATTERN)).alias("transaction_ts"),
        )
    )
    frame = F.unhex(F.lit(ENVELOPE))
    value = (
        F.when(_nth(41), F.unhex(F.lit(EMPTY_MESSAGE)))
        .when(_nth(43), F.concat(frame, F.encode(F.lit("not json"), "utf-8")))
        .otherwise(F.concat(frame, F.encode(body, "utf-8")))
    )
    return source.withColumn("value", value)


def wire_timed(events: DataFrame) -> DataFrame:
    """The messages with the time each came."""
    return _framed(sales(events), F.col("transaction_ts")).select("event_id", "value", F.col("transaction_ts").alias("timestamp"))


def wire_misdated(events: DataFrame) -> DataFrame:
    """The messages with their arrival; some clocks are 75 years ahead, some 75 years behind."""
    far = F.expr("interval 75 years")
    sent = F.when(_nth(59), F.col("transaction_ts") + far).when(_nth(61), F.col("transaction_ts") - far).otherwise(F.col("transaction_ts"))
    return _framed(sales(events), sent).select("event_id", "value", F.col("transaction_ts").alias("arrived_at"))


def wire_versions(events: DataFrame) -> DataFrame:
    """Messages of two schemas, told apart by the id in their header, and some of a third that nobody knows.

    The second writer calls the price `unit_price`, sends it as text, and knows no payment type.
    """
    source = sales(events)
    when = F.date_format("transaction_ts", TIME_PATTERN).alias("transaction_ts")
    plain = [F.col(c) for c in SALE_COLUMNS if c not in ("transaction_ts", "price", "payment_type")]
    first = F.to_json(F.struct(*plain, "price", "payment_type", when))
    second = F.to_json(F.struct(*plain, F.col("price").cast("string").alias("unit_price"), when))
    number = F.when(_nth(67), "0000000003").when(_nth(3), "0000000002").otherwise("0000000001")
    body = F.when(_nth(71), "not json").when(_nth(3), second).otherwise(first)
    return source.select("event_id", F.concat(F.unhex(number), F.encode(body, "utf-8")).alias("value"))

"""Serving queries over the sales tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.functions.columns import AsOf, line_revenue, moment
from tillstream.operators.aggregates import hourly_revenue


def hourly_revenue_by_store(frame: DataFrame) -> DataFrame:
    return hourly_revenue(frame, "store_id")


def top_products(frame: DataFrame, n: int = 10) -> DataFrame:
    """Best sellers by revenue, ties by product id."""
    return (
        frame.groupBy("product_id")
        .agg(F.sum(line_revenue()).alias("revenue"), F.sum("quantity").alias("quantity"))
        .orderBy(F.desc("revenue"), "product_id")
        .limit(n)
    )


def payment_split(frame: DataFrame) -> DataFrame:
    """Count, revenue and shares per payment type.

    The totals are a scalar subquery over the same grouped rows; it asks for
    the same columns, so Spark reuses the exchange and scans the table once.
    """
    split = frame.groupBy("payment_type").agg(
        F.count("*").alias("transactions"), F.sum(line_revenue()).alias("revenue")
    )
    totals = split.select(
        F.struct(F.sum("transactions").alias("transactions"), F.sum("revenue").alias("revenue"))
    ).scalar()
    return split.select(
        "payment_type",
        "transactions",
        "revenue",
        (F.col("transactions") / totals["transactions"]).alias("transaction_share"),
        (F.col("revenue") / totals["revenue"]).alias("revenue_share"),
    )


def table_status(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows and newest time of each table, one row per table."""
    rows = [
        frame.agg(F.count("*").alias("row_count"), F.max(time).alias("newest")).select(
            F.lit(name).alias("table_name"), "row_count", "newest"
        )
        for name, (frame, time) in tables.items()
    ]
    status = rows[0]
    for row in rows[1:]:
        status = status.unionByName(row)
    return status


def with_revenue_band(fact: DataFrame, cuts: Sequence[tuple[str, float]], top: str) -> DataFrame:
    """Add `revenue_band`: the first (name, upper bound) the revenue stays below."""
    band = None
    for name, below in cuts:
        fits = F.col("revenue") < below
        band = F.when(fits, name) if band is None else band.when(fits, name)
    known = F.col("revenue").isNotNull()
    return fact.withColumn("revenue_band", F.when(known, band.otherwise(top)))


def with_ingested_at(fact: DataFrame, as_of: AsOf = None) -> DataFrame:
    return fact.withColumn("ingested_at", moment(as_of))


def staging(raw: DataFrame) -> DataFrame:
    """Trimmed ids, lower-case payment types, table types; unreadable values are NULL."""
    return raw.select(
        *[F.trim(c).alias(c) for c in ("transaction_id", "store_id", "product_id")],
        F.col("quantity").try_cast("int").alias("quantity"),
        F.col("price").try_cast("double").alias("price"),
        F.lower(F.trim("payment_type")).alias("payment_type"),
        F.col("transaction_ts").try_cast("timestamp").alias("transaction_ts"),
    )

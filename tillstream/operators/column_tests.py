"""Declarative column tests. A test passes when it finds no failures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.functions.columns import pass_fail
from tillstream.operators.keys import duplicate_keys
from tillstream.operators.quality import union_all
from tillstream.sources.schemas import PAYMENT_TYPES

# The tests of the fact table.
FACT_TESTS: dict[str, list] = {
    "transaction_id": ["unique", "not_null"],
    "store_id": ["not_null"],
    "product_id": ["not_null"],
    "quantity": ["not_null"],
    "price": ["not_null"],
    "payment_type": [{"accepted_values": PAYMENT_TYPES}],
    "transaction_ts": ["not_null"],
    "revenue": ["not_null"],
}

AGG_TESTS: dict[str, list] = {
    name: ["not_null"] for name in ("window_start", "window_end", "store_id", "total_revenue", "total_quantity")
}


def repeated_values(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Failures of `unique`: repeated values with their counts; NULLs do not count."""
    return duplicate_keys(frame.dropna(subset=list(columns)), columns)


def null_counts(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Failures of `not_null`, one row per column, all columns in one pass."""
    counts = frame.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in columns]
    return counts.select(F.inline(F.array(*rows)))


def unexpected_values(frame: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Failures of `accepted_values`: values outside the list with their counts.

    Case matters; NULL passes.
    """
    outside = frame.where(~F.col(column).isin(list(values)))
    return outside.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("row_count"))


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Failures of `relationships`: child rows whose key the parent lacks.

    The parent is reduced to distinct keys first, so a key repeated in it does
    not reach the join; the join then uses that shuffle again.
    """
    return child.dropna(subset=[key]).join(parent.select(key).distinct(), key, "left_anti")


def run_suite(frame: DataFrame, tests: Mapping[str, Sequence]) -> DataFrame:
    """All tests of a table: one row each, with the failures found.

    `unique` counts repeated values, `not_null` rows, `accepted_values`
    distinct values. All not_null tests share one pass; each of the others
    reads its own column only.
    """
    def result(found: DataFrame, column: str, test: str) -> DataFrame:
        return found.agg(F.count("*").alias("failures")).select(
            F.lit(column).alias("column_name"), F.lit(test).alias("test_name"), "failures"
        )

    results = []
    required = [column for column, wanted in tests.items() if "not_null" in wanted]
    if required:
        results.append(
            null_counts(frame, required).select("column_name", F.lit("not_null").alias("test_name"), "failures")
        )
    for column, wanted in tests.items():
        for test in wanted:
            if test == "unique":
                results.append(result(repeated_values(frame, [column]), column, "unique"))
            elif isinstance(test, Mapping) and "accepted_values" in test:
                found = unexpected_values(frame, column, test["accepted_values"])
                results.append(result(found, column, "accepted_values"))
            elif test != "not_null":
                raise ValueError(f"unknown test {test!r} on {column}")
    return union_all(results).withColumn("status", pass_fail(F.col("failures") == 0))

"""Small column expressions; everything here stays inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = datetime | str | Column | None


def line_revenue(quantity: str = "quantity", price: str = "price") -> Column:
    """Quantity times price in double.

    The wire carries a 32-bit price; widening it first keeps the product the
    same under ANSI and non-ANSI arithmetic and in stream and batch.
    """
    return F.col(quantity) * F.col(price).cast("double")


def any_null(columns: Iterable[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns])


def all_null(columns: Iterable[str]) -> Column:
    return reduce(and_, [F.col(c).isNull() for c in columns])


def moment(as_of: AsOf = None) -> Column:
    """The reference time of a query; the current time unless one is given."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


def ago(as_of: AsOf, duration: str) -> Column:
    return moment(as_of) - F.expr(f"interval {duration}")


def pass_fail(passes: Column) -> Column:
    return F.when(passes, "PASS").otherwise("FAIL")


def utc_day(time: Column) -> Column:
    """The day of a moment in UTC, whatever the session's zone: tables and bounds agree on it."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(time) / 86400).cast("int"))


def day_of(column: str) -> Column:
    return utc_day(F.col(column).cast("timestamp"))


def plain_number(column: Column, scale: int) -> Column:
    """Decimal text without exponent or padding zeros: 26819.6, 13.9, 4.0."""
    text = column.cast(f"decimal(38,{scale})").cast("string")
    return F.regexp_replace(text, r"(\.\d+?)0+$", "$1")

"""The incremental fact table: one row per transaction, with its revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from tillstream.functions.columns import AsOf, line_revenue, moment
from tillstream.operators.decode import AHEAD
from tillstream.operators.keys import KEY, first_occurrence
from tillstream.operators.merge import finish_upsert, merged, replace_table, upsert_days
from tillstream.operators.selection import newer_than, up_to
from tillstream.sources.readers import read_days, table_exists
from tillstream.sources.schemas import FACT_SCHEMA, SALE_COLUMNS


def with_revenue(raw: DataFrame) -> DataFrame:
    return raw.select(*SALE_COLUMNS, line_revenue().alias("revenue"))


def build_fact(
    raw: DataFrame, target: DataFrame | None = None, lookback: str | None = None, full_refresh: bool = False
) -> DataFrame:
    """The fact table after this run, as a plan.

    Without a target, or on a full refresh, all of `raw` is used; otherwise only
    rows newer than the target (less `lookback`) are merged into it by key.
    """
    if target is None or full_refresh:
        return first_occurrence(with_revenue(raw), (KEY,))
    return merged(target, with_revenue(newer_than(raw, target, lookback)), (KEY,))


def refresh_fact(
    spark: SparkSession,
    raw: DataFrame,
    path: str,
    lookback: str | None = None,
    full_refresh: bool = False,
    as_of: AsOf = None,
    ahead: str = AHEAD,
) -> None:
    """Run one fact build against a day-partitioned Parquet table.

    The newest loaded time comes from the newest partition, the scan of `raw`
    is limited by it, and only the days concerned are changed. A run that was cut
    short is completed before that time is taken, so its other days are not skipped;
    full builds are staged and swapped in the same way. Rows more than `ahead` later than
    `as_of` are left in `raw`, and such rows of an older table don't set the bound.
    """
    finish_upsert(spark, path)
    ceiling = moment(as_of) + F.expr(f"interval {ahead}")
    if full_refresh or not table_exists(spark, path):
        replace_table(spark, path, build_fact(up_to(raw, ceiling)), FACT_SCHEMA)
        return
    target = read_days(spark, path, FACT_SCHEMA)
    updates = with_revenue(newer_than(raw, target, lookback, ceiling))
    upsert_days(spark, path, updates, FACT_SCHEMA)

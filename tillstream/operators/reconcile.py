"""Source against sink counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.functions.columns import pass_fail
from tillstream.sources.schemas import TIME


def reconcile_hourly(source: DataFrame, sink: DataFrame, at_least: float = 0.999) -> DataFrame:
    """Rows per hour on both sides and the share that arrived.

    Hours of either side appear: both are tagged, stacked and counted by one
    group-by, which needs one shuffle of hourly partial counts and no join.
    """
    def tagged(frame: DataFrame, is_sink: bool) -> DataFrame:
        return frame.select(F.date_trunc("hour", TIME).alias("hr"), F.lit(is_sink).alias("is_sink"))

    counts = (
        tagged(source, False)
        .unionByName(tagged(sink, True))
        .groupBy("hr")
        .agg(F.count_if(~F.col("is_sink")).alias("source_rows"), F.count_if("is_sink").alias("sink_rows"))
    )
    return with_completeness(counts, at_least)


def with_completeness(counts: DataFrame, at_least: float = 0.999) -> DataFrame:
    """Add the share of the source's rows that arrived, and whether it is enough."""
    share = F.when(F.col("source_rows") > 0, F.col("sink_rows") / F.col("source_rows")).otherwise(F.lit(0.0))
    return counts.withColumn("completeness", share).withColumn(
        "status", pass_fail(F.col("completeness") >= at_least)
    )

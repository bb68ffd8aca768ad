"""Group-bys. All aggregates combine before the shuffle, so a hot store, hour or
product costs one partial row per task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.functions.columns import AsOf, line_revenue
from tillstream.operators.selection import recent
from tillstream.sources.schemas import TIME


def store_windows(frame: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Revenue and quantity per store and tumbling window, batch or stream.

    A stream must bring its watermark along; none is added here, because a
    second one would replace it.
    """
    return (
        frame.groupBy(F.window(TIME, width), "store_id")
        .agg(F.sum(line_revenue()).alias("total_revenue"), F.sum("quantity").alias("total_quantity"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "store_id",
            "total_revenue",
            "total_quantity",
        )
    )


def _by_hour(frame: DataFrame, *by: str):
    return frame.groupBy(F.date_trunc("hour", TIME).alias("hr"), *by)


def hourly_volume(frame: DataFrame) -> DataFrame:
    return _by_hour(frame).agg(F.count("*").alias("volume"))


def hourly_revenue(frame: DataFrame, *by: str) -> DataFrame:
    return _by_hour(frame, *by).agg(F.sum(line_revenue()).alias("revenue"))


def hourly_stats(frame: DataFrame) -> DataFrame:
    """Mean and sample deviation of the hourly volume and revenue, one scan."""
    hours = _by_hour(frame).agg(F.count("*").alias("volume"), F.sum(line_revenue()).alias("revenue"))
    return hours.agg(
        F.count("*").alias("hours"),
        F.avg("volume").alias("mean_volume"),
        F.stddev_samp("volume").alias("stddev_volume"),
        F.avg("revenue").alias("mean_revenue"),
        F.stddev_samp("revenue").alias("stddev_revenue"),
    )


def recent_hourly_volume(frame: DataFrame, as_of: AsOf = None, duration: str = "1 day") -> DataFrame:
    return hourly_volume(recent(frame, as_of, duration)).orderBy(F.desc("hr"))

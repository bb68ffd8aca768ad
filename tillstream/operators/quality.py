"""Data-quality checks: nulls, duplicates, three-sigma anomalies, freshness.

The null and both anomaly checks share one scan: a group-by on the hour carries
conditional aggregates for all of them, and a second aggregate over the few
hourly rows finishes the statistics. Nothing is joined.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.functions.columns import AsOf, ago, any_null, line_revenue, moment, pass_fail, plain_number
from tillstream.operators.decode import REASONS
from tillstream.operators.keys import KEY, duplicate_keys
from tillstream.operators.selection import recent
from tillstream.sources.schemas import REQUIRED, TIME

# History span, current span, freshness span and sigma bound.
HISTORY = "7 days"
CURRENT = "1 hour"
FRESH = "15 minutes"
SIGMAS = 3


class QualityError(RuntimeError):
    """Raised for failing checks when the caller asks for it."""


def hour_profile(frame: DataFrame, as_of: AsOf = None, bounded: bool = False) -> DataFrame:
    """Per hour: rows with nulls, and volume and revenue split into history and current.

    `bounded` ends the current hour at `as_of`; by default all later rows count.
    """
    time = F.col(TIME)
    old = (time >= ago(as_of, HISTORY)) & (time < ago(as_of, CURRENT))
    now = time >= ago(as_of, CURRENT)
    if bounded:
        now = now & (time < moment(as_of))
    return frame.groupBy(F.date_trunc("hour", TIME).alias("hr")).agg(
        F.count_if(any_null(REQUIRED)).alias("null_count"),
        F.nullif(F.count_if(old), F.lit(0)).alias("old_volume"),
        F.sum(F.when(old, line_revenue())).alias("old_revenue"),
        F.count_if(now).alias("volume"),
        F.sum(F.when(now, line_revenue())).alias("revenue"),
    )


def with_empty_hours(profile: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Add hours of the history without rows, so that they count as zero."""
    hours = F.sequence(
        F.date_trunc("hour", ago(as_of, HISTORY)),
        ago(as_of, CURRENT) - F.expr("interval 1 microsecond"),
        F.expr("interval 1 hour"),
    )
    empty = profile.sparkSession.range(1).select(
        F.explode(hours).alias("hr"),
        F.lit(0).cast("long").alias("old_volume"),
        F.lit(0.0).alias("old_revenue"),
    )
    joined = profile.unionByName(empty, allowMissingColumns=True)
    return joined.groupBy("hr").agg(
        *[F.sum(c).alias(c) for c in ("null_count", "old_volume", "old_revenue", "volume", "revenue")]
    )


def _statistics(profile: DataFrame) -> DataFrame:
    """One row: current values, and mean and sample deviation of the history."""
    return profile.agg(
        F.coalesce(F.sum("null_count"), F.lit(0)).alias("null_count"),
        F.coalesce(F.sum("volume"), F.lit(0)).alias("volume"),
        F.avg("old_volume").alias("volume_mu"),
        F.stddev_samp("old_volume").alias("volume_sigma"),
        F.coalesce(F.sum("revenue"), F.lit(0.0)).alias("revenue"),
        F.avg("old_revenue").alias("revenue_mu"),
        F.stddev_samp("old_revenue").alias("revenue_sigma"),
    )


def _anomaly(value: str) -> tuple[Column, Column]:
    """Status and z score from unrounded statistics.

    Passes without a deviation to compare with (no history, one hour, flat
    history) and up to exactly three deviations.
    """
    current, mu, sigma = F.col(value), F.col(f"{value}_mu"), F.col(f"{value}_sigma")
    distance = current - mu
    within = sigma.isNull() | (sigma == 0) | (F.abs(distance) <= SIGMAS * sigma)
    z = F.when(sigma > 0, F.round(distance / sigma, 2)).otherwise(F.lit(0.0))
    return pass_fail(within), z


def null_check(frame: DataFrame) -> DataFrame:
    nulls = frame.agg(F.count_if(any_null(REQUIRED)).alias("null_count"))
    return nulls.select(pass_fail(F.col("null_count") == 0).alias("null_check_status"), "null_count")


def duplicate_check(frame: DataFrame) -> DataFrame:
    """Counts keys, not rows."""
    keys = duplicate_keys(frame, [KEY]).agg(F.count("*").alias("duplicate_count"))
    return keys.select(
        pass_fail(F.col("duplicate_count") == 0).alias("duplicate_check_status"), "duplicate_count"
    )


def _hours_since_history(frame: DataFrame, as_of: AsOf, bounded: bool, zero_fill: bool) -> DataFrame:
    profile = hour_profile(recent(frame, as_of, HISTORY), as_of, bounded)
    return with_empty_hours(profile, as_of) if zero_fill else profile


def volume_check(
    frame: DataFrame, as_of: AsOf = None, bounded: bool = False, zero_fill: bool = False
) -> DataFrame:
    status, z = _anomaly("volume")
    return _statistics(_hours_since_history(frame, as_of, bounded, zero_fill)).select(
        status.alias("volume_anomaly_status"),
        F.col("volume").alias("current_hour_volume"),
        F.round("volume_mu", 1).alias("mean_volume"),
        F.round("volume_sigma", 1).alias("stddev_volume"),
        z.alias("z_score"),
    )


def revenue_check(
    frame: DataFrame, as_of: AsOf = None, bounded: bool = False, zero_fill: bool = False
) -> DataFrame:
    status, z = _anomaly("revenue")
    return _statistics(_hours_since_history(frame, as_of, bounded, zero_fill)).select(
        status.alias("revenue_anomaly_status"),
        F.round("revenue", 2).alias("current_hour_revenue"),
        F.round("revenue_mu", 2).alias("mean_revenue"),
        F.round("revenue_sigma", 2).alias("stddev_revenue"),
        z.alias("z_score"),
    )


def freshness(frame: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Rows of the last quarter hour; WARN when there are none."""
    rows = recent(frame, as_of, FRESH).agg(F.count("*").alias("recent_rows"))
    return rows.select(
        F.when(F.col("recent_rows") > 0, "PASS").otherwise("WARN").alias("freshness_status"), "recent_rows"
    )


def source_freshness(
    frame: DataFrame, as_of: AsOf = None, warn_after: str = "15 minutes", error_after: str = "30 minutes"
) -> DataFrame:
    """Age of the newest row against two bounds; an empty table is an error."""
    newest = frame.agg(F.max(TIME).alias("newest"))
    status = (
        F.when(F.col("newest").isNull() | (F.col("newest") < ago(as_of, error_after)), "error")
        .when(F.col("newest") < ago(as_of, warn_after), "warn")
        .otherwise("pass")
    )
    return newest.select("newest", status.alias("freshness_status"))


def _message(value: str, scale: int) -> Column:
    """Fixed format of the anomaly messages."""
    z = _anomaly(value)[1]
    current = plain_number(F.col(value), 2) if scale == 2 else F.col(value).cast("string")
    return F.concat(
        F.lit(f"{value}_anomaly FAIL: current="),
        current,
        F.lit(", mean="),
        plain_number(F.round(f"{value}_mu", scale), scale),
        F.lit(", sigma="),
        plain_number(F.round(f"{value}_sigma", scale), scale),
        F.lit(", z_score="),
        plain_number(z, 2),
    )


def check_report(
    frame: DataFrame, as_of: AsOf = None, bounded: bool = False, zero_fill: bool = False
) -> DataFrame:
    """One row per check: position, name, status, and a message when it fails.

    Two scans in all: one for nulls and anomalies, one of the key column.
    """
    profile = hour_profile(frame, as_of, bounded)
    if zero_fill:
        profile = with_empty_hours(profile, as_of)
    return report_of(profile, duplicate_keys(frame, [KEY]).agg(F.count("*").alias("duplicate_count")))


def report_of(profile: DataFrame, repeats: DataFrame) -> DataFrame:
    """The report from an hour profile and one row with the number of repeated keys."""

    def row(position: int, name: str, status: Column, message: Column) -> Column:
        return F.struct(
            F.lit(position).alias("position"),
            F.lit(name).alias("check_name"),
            status.alias("status"),
            F.when(status == "FAIL", message).alias("message"),
        )

    # Fixed texts: the messages of both counts.
    nulls = F.concat(F.lit("null_check FAIL: "), F.col("null_count"), F.lit(" null rows"))
    rows = [
        row(1, "null_check", pass_fail(F.col("null_count") == 0), nulls),
        row(3, "volume_anomaly", _anomaly("volume")[0], _message("volume", 1)),
        row(4, "revenue_anomaly", _anomaly("revenue")[0], _message("revenue", 2)),
    ]
    one_scan = _statistics(profile).select(F.inline(F.array(*rows)))
    count = F.concat(
        F.lit("duplicate_check FAIL: "), F.col("duplicate_count"), F.lit(" duplicate transaction_ids")
    )
    duplicates = row(2, "duplicate_check", pass_fail(F.col("duplicate_count") == 0), count)
    return one_scan.unionByName(repeats.select(F.inline(F.array(duplicates))))


def summary(report: DataFrame) -> DataFrame:
    """The whole report as one text: PASS, or FAIL and the messages in order."""
    failing = F.when(F.col("status") == "FAIL", F.struct("position", "message"))
    messages = F.transform(F.array_sort(F.collect_list(failing)), lambda m: m["message"])
    return report.agg(messages.alias("messages")).select(
        F.when(F.size("messages") == 0, "PASS")
        .otherwise(F.concat(F.lit("FAIL: "), F.concat_ws(" | ", "messages")))
        .alias("summary")
    )


def alerts(report: DataFrame) -> DataFrame:
    """What a notifier has to send: the outcome, and the summary behind it."""
    fails = F.col("summary").contains("FAIL")
    return summary(report).select(
        F.when(fails, "ALERT_SENT").otherwise("NO_ALERT").alias("outcome"),
        F.when(fails, F.col("summary")).alias("alert"),
    )


def run_checks(
    frame: DataFrame, as_of: AsOf = None, raise_on_fail: bool = False, **options: bool
) -> str:
    """Run all checks now and return the summary text."""
    text = summary(check_report(frame, as_of, **options)).first()["summary"]
    if raise_on_fail and text != "PASS":
        raise QualityError(text)
    return text


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def reject_check(rejects: DataFrame) -> DataFrame:
    """One row: whether any message was rejected, how many, and for which reason."""
    reason = F.col("reject_reason")
    counts = [F.count_if(reason == r).alias(r) for r in REASONS]
    return rejects.agg(F.count(F.lit(1)).alias("reject_count"), *counts).select(
        pass_fail(F.col("reject_count") == 0).alias("reject_check_status"), "reject_count", *REASONS
    )

"""Checks from stored partial results, in place of a scan of the whole table.

Next to a table that is written in batches stand, by day and batch as the rows are:

* `hours`: rows, rows with nulls, and revenue of every hour;
* `keys`: 128 bits of hash of every key, and how many rows hold it;
* `repeated`: by batch only, the keys of the batch that the table now holds more than once.

A batch that is written again replaces its own partials. All are additive, so that late
rows need no care. Only the hours cut by a bound of the checks are read from the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.functions.columns import AsOf, ago, any_null, line_revenue, moment, utc_day
from tillstream.operators.key_index import LITERALS
from tillstream.operators.keys import KEY
from tillstream.operators.quality import CURRENT, HISTORY, hour_profile, report_of, with_empty_hours
from tillstream.sources.folders import Folders
from tillstream.sources.schemas import BATCH, BEGUN, DAY, REQUIRED, TIME

HOURS, KEYS, REPEATED = "hours", "keys", "repeated"
HASHES = ["h1", "h2"]
HOUR_SCHEMA = "hr timestamp, row_count long, null_count long, revenue double"
KEY_SCHEMA = "h1 long, h2 long, n long"


def hour_partials(batch: DataFrame) -> DataFrame:
    """One row for each day and hour of a batch; rows without a time have a row of their own."""
    return batch.groupBy(DAY, F.date_trunc("hour", TIME).alias("hr")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(any_null(REQUIRED)).alias("null_count"), F.sum(line_revenue()).alias("revenue")
    )


def key_partials(batch: DataFrame, key: str = KEY) -> DataFrame:
    """One row for each day and key of a batch. A NULL key is a key."""
    return batch.groupBy(DAY, F.xxhash64(key).alias("h1"), F.xxhash64(key, F.lit(1)).alias("h2")).agg(F.count(F.lit(1)).alias("n"))


def read_partials(spark: SparkSession, folder: str, kind: str, schema: str) -> DataFrame:
    dated = T.StructType([*T.StructType.fromDDL(schema).fields, T.StructField(DAY, T.DateType()), T.StructField(BATCH, T.StringType())])
    return spark.read.schema(dated).parquet(f"{folder}/{kind}")


def of_keys(keys: DataFrame, wanted: DataFrame) -> DataFrame:
    """The partials of some keys. A few are literals, so that the bloom filters of the files skip the rest."""
    few = wanted.limit(LITERALS + 1).collect()
    if len(few) <= LITERALS:
        return keys.where(reduce(or_, [reduce(and_, [F.col(h) == r[h] for h in HASHES]) for r in few], F.lit(False)))
    return keys.join(wanted, HASHES, "left_semi")


def begin_batch(spark: SparkSession, path: str, name: str, query: str) -> None:
    """Note the batch about to be written; if it was the last one begun, drop what it left.

    Batches of a query come in order, so that no other one can come again.
    """
    folders, note = Folders(spark, path), f"{path}/{BEGUN}/{query}"
    if folders.exists(note) and folders.read_lines(note) == [name]:
        for old in [*folders.matching(f"{path}/{DAY}=*/{BATCH}={name}"), *folders.matching(f"{path}/{BATCH}={name}")]:
            folders.drop(old)
    folders.write_lines(note, [name])


def add_partials(batch: DataFrame, folder: str, name: str, query: str, key: str = KEY) -> None:
    """Store the partials of a batch, whose rows have their day. Writing a batch again replaces them.

    To tell which keys are repeated, the hashes of earlier batches are searched for those
    of this one, which for a small batch skips most of them.
    """
    spark = batch.sparkSession

    def write(frame: DataFrame, kind: str, *by: str) -> None:
        writer = frame.withColumn(BATCH, F.lit(name)).write.mode("append").partitionBy(*by, BATCH)
        writer.option("parquet.bloom.filter.enabled#h1", "true").option("parquet.bloom.filter.adaptive.enabled", "true").parquet(f"{folder}/{kind}")

    for kind in (HOURS, KEYS, REPEATED):
        begin_batch(spark, f"{folder}/{kind}", name, query)
    write(hour_partials(batch).hint("rebalance", DAY), HOURS, DAY)
    write(key_partials(batch, key).hint("rebalance", DAY).sortWithinPartitions(DAY, *HASHES), KEYS, DAY)
    keys = read_partials(spark, folder, KEYS, KEY_SCHEMA)
    mine = keys.where(F.col(BATCH) == name).select(*HASHES).distinct()
    repeated = of_keys(keys, mine).groupBy(*HASHES).agg(F.sum("n").alias("n")).where("n > 1")
    write(repeated.select(*HASHES), REPEATED)


def expire_partials(spark: SparkSession, folder: str, days: Sequence[str]) -> None:
    """Drop the partials of days that were dropped from the table, named as `expire_days` does."""
    folders = Folders(spark, folder)
    for day in days:
        for kind in (HOURS, KEYS):
            folders.drop(f"{folder}/{kind}/{day}")


def repeated_keys(spark: SparkSession, folder: str) -> DataFrame:
    """One row: how many keys the table holds more than once.

    Only keys that some batch found repeated can be; their rows are counted again, since
    retention may have dropped some.
    """
    keys = read_partials(spark, folder, KEYS, KEY_SCHEMA)
    known = spark.read.schema("h1 long, h2 long").parquet(f"{folder}/{REPEATED}").distinct()
    counts = of_keys(keys, known).groupBy(*HASHES).agg(F.sum("n").alias("n")).where("n > 1")
    return counts.agg(F.count(F.lit(1)).alias("duplicate_count"))


def _hour(time: Column) -> Column:
    return F.date_trunc("hour", time)


def _cut(time: Column) -> Column:
    """Whether a moment lies inside an hour, so that the hour's partials can't be split there."""
    return time != _hour(time)


def profile(spark: SparkSession, table: DataFrame, folder: str, as_of: AsOf = None, bounded: bool = False) -> DataFrame:
    """`hour_profile` from partials, and from the table's rows for the hours that a bound cuts."""
    old, now, end = ago(as_of, HISTORY), ago(as_of, CURRENT), moment(as_of)
    hour, next_hour = F.col("hr"), F.col("hr") + F.expr("interval 1 hour")
    hours = read_partials(spark, folder, HOURS, HOUR_SCHEMA)
    in_old = (hour >= old) & (next_hour <= now)
    in_now = (hour >= now) & (next_hour <= end) if bounded else hour >= now
    whole = hours.groupBy("hr").agg(
        F.sum("null_count").alias("null_count"),
        F.sum(F.when(in_old, F.col("row_count"))).alias("old_volume"),
        F.sum(F.when(in_old, F.col("revenue"))).alias("old_revenue"),
        F.sum(F.when(in_now, F.col("row_count"))).alias("volume"),
        F.sum(F.when(in_now, F.col("revenue"))).alias("revenue"),
    )
    bounds = [old, now, *([end] if bounded else [])]
    in_cut = [_cut(b) & (F.col(TIME) >= _hour(b)) & (F.col(TIME) < _hour(b) + F.expr("interval 1 hour")) for b in bounds]
    if DAY in table.columns:
        in_cut = [(F.col(DAY) == utc_day(_hour(b))) & c for b, c in zip(bounds, in_cut)]
    split = hour_profile(table.where(reduce(or_, in_cut)), as_of, bounded).withColumn("null_count", F.lit(0).cast("long"))
    names = ("null_count", "old_volume", "old_revenue", "volume", "revenue")
    return whole.unionByName(split).groupBy("hr").agg(*[F.sum(c).alias(c) for c in names])


def stored_report(
    spark: SparkSession, table: DataFrame, folder: str, as_of: AsOf = None, bounded: bool = False, zero_fill: bool = False
) -> DataFrame:
    """`check_report` of a table whose partials stand in `folder`."""
    hours = profile(spark, table, folder, as_of, bounded)
    return report_of(with_empty_hours(hours, as_of) if zero_fill else hours, repeated_keys(spark, folder))

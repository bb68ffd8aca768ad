"""Completeness from what each batch counts on its way, without a second scan of source or sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.operators.decode import rejected
from tillstream.operators.partials import HOUR_SCHEMA, HOURS, begin_batch, read_partials
from tillstream.operators.reconcile import with_completeness
from tillstream.sources.schemas import BATCH
from tillstream.streaming.sinks import BatchWriter, batch_name

# Distinct hours in one batch that are counted on the way; a batch with more is counted by a pass of its own.
SOME_HOURS = 4096
COUNTS = "hr timestamp, row_count long"


def hour_number(time: Column) -> Column:
    return F.unix_seconds(F.date_trunc("hour", time))


def counted(write: BatchWriter, folder: str, arrival: str = "timestamp") -> BatchWriter:
    """A sink for classified messages: counts all by the hour they came in, and hands the rejected ones on.

    The counts are observed while the rejects are written and stored under the batch, which
    replaces them if it is written again. A batch whose hours are too many for that is
    counted by a group-by.
    """

    def write_and_count(batch: DataFrame, batch_id: int) -> None:
        spark, seen = batch.sparkSession, Observation()
        hours = F.call_function("approx_top_k", hour_number(F.col(arrival)), F.lit(SOME_HOURS), F.lit(2 * SOME_HOURS))
        # Counts of a sketch that saw fewer values than it has places are exact.
        values = F.approx_count_distinct(hour_number(F.col(arrival)), 0.02)
        write(rejected(batch.observe(seen, F.count(F.lit(1)).alias("n"), hours.alias("hours"), values.alias("distinct"))), batch_id)
        told = seen.get
        name, query = batch_name(batch, batch_id)
        begin_batch(spark, folder, name, query)
        if told["distinct"] < SOME_HOURS // 2 and sum(r["count"] for r in told["hours"]) == told["n"]:
            counts = spark.createDataFrame([(r["item"], r["count"]) for r in told["hours"]], "s long, row_count long")
            counts = counts.select(F.timestamp_seconds("s").alias("hr"), "row_count")
        else:
            counts = batch.groupBy(F.date_trunc("hour", arrival).alias("hr")).agg(F.count(F.lit(1)).alias("row_count"))
        counts.withColumn(BATCH, F.lit(name)).coalesce(1).write.mode("append").partitionBy(BATCH).parquet(folder)

    return write_and_count


def reconcile_batches(spark: SparkSession, source_counts: str, partials: str, at_least: float = 0.999) -> DataFrame:
    """`reconcile_hourly` from the counts of messages and the hours of the stored rows. Messages without a time have no hour."""
    schema = T.StructType.fromDDL(COUNTS)
    source = spark.read.schema(schema).parquet(source_counts).select("hr", F.col("row_count").alias("source_rows"), F.lit(0).cast("long").alias("sink_rows"))
    sink = read_partials(spark, partials, HOURS, HOUR_SCHEMA).select("hr", F.lit(0).cast("long").alias("source_rows"), F.col("row_count").alias("sink_rows"))
    counts = source.unionByName(sink).groupBy("hr").agg(F.sum("source_rows").alias("source_rows"), F.sum("sink_rows").alias("sink_rows"))
    return with_completeness(counts, at_least)

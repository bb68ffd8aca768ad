"""foreachBatch sinks. None of them catches an exception: a failed write fails
the query, and the batch is run again from the checkpoint."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.operators.key_index import drop_index
from tillstream.operators.merge import merge_into, upsert_days, with_day
from tillstream.operators.partials import add_partials, begin_batch
from tillstream.sources.schemas import BATCH, DAY, TIME
from tillstream.sources.session import time_statistics

BatchWriter = Callable[[DataFrame, int], None]

QUERY_ID = "sql.streaming.queryId"


def append_to(
    target: str, fmt: str = "parquet", options: Mapping[str, str] | None = None, kind: str = "path"
) -> BatchWriter:
    """Plain append to a `path`, a connector's `table` (its `dbtable` option) or a `catalog` table.

    A batch that is run again after a crash is written again.
    """
    if kind not in ("path", "table", "catalog"):
        raise ValueError(f"unknown kind of target {kind!r}")

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = batch.write.format(fmt).options(**(options or {})).mode("append")
        if kind == "path":
            writer.save(target)
        elif kind == "table":
            writer.option("dbtable", target).save()
        else:
            writer.saveAsTable(target)

    return write


def batch_name(batch: DataFrame, batch_id: int) -> tuple[str, str]:
    """Name of a batch and of its query, which is kept in the checkpoint."""
    query = str(batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID))
    return f"{query}-{batch_id}", query


def replace_batch(path: str, time: str = TIME) -> BatchWriter:
    """Append that survives a repeated batch: each batch owns a folder in every day it has rows for.

    The folders are named after the query (kept in the checkpoint) and the batch,
    below the day, so that a read of one day lists that day only. The last batch
    begun is noted in a small file: if it begins again, its folders of all days are
    dropped first, because another copy of a key may now land on another day.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name, query = batch_name(batch, batch_id)
        begin_batch(spark, path, name, query)
        drop_index(spark, path)
        dated = with_day(batch, time).withColumn(BATCH, F.lit(name)).hint("rebalance", DAY)
        with time_statistics(spark):
            dated.write.mode("append").partitionBy(DAY, BATCH).parquet(path)

    return write


def with_partials(write: BatchWriter, folder: str) -> BatchWriter:
    """A sink that also stores the partial results its table is checked by. If either fails, the batch repeats both."""

    def write_both(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            write(batch, batch_id)
            add_partials(with_day(batch), folder, *batch_name(batch, batch_id))
        finally:
            batch.unpersist()

    return write_both


def upsert_to(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    time: str,
    keys_fix_day: bool = False,
    within: Sequence[str] = (),
) -> BatchWriter:
    """Upsert by key into a day-partitioned Parquet table, harmless to repeat.

    Unless `keys_fix_day`, each batch looks its keys up in the table's index, of which a
    small batch skips most: meant for low rates. For all raw rows use `replace_batch` and
    the fact merge, or `merge_to`. The batch is written out once by the streaming session;
    the merge then runs in the outer session, where adaptive execution sizes its joins and
    files.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_days(spark, path, batch, schema, keys, time, keys_fix_day, within)

    return write


def merge_to(table: str, keys: Sequence[str], order_by: Sequence[str]) -> BatchWriter:
    """MERGE each batch into a table with row-level operations."""
    def write(batch: DataFrame, batch_id: int) -> None:
        merge_into(batch, table, keys, order_by)

    return write

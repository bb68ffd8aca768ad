"""Key work: duplicates, first occurrences, new keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY = "transaction_id"


def duplicate_keys(frame: DataFrame, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Keys held by more than one row, with their counts."""
    return frame.groupBy(*keys).agg(F.count("*").alias("cnt")).where(F.col("cnt") > 1)


def duplicate_sample(frame: DataFrame, keys: Sequence[str] = (KEY,), n: int = 10) -> DataFrame:
    return duplicate_keys(frame, keys).orderBy(*keys).limit(n)


def first_occurrence(
    frame: DataFrame, keys: Sequence[str] = (KEY,), order_by: Sequence[str] = ("transaction_ts",)
) -> DataFrame:
    """One row per key: the first by `order_by`, ties settled by all other columns.

    Spark turns the rank filter into a per-task group limit ahead of the
    shuffle, so each task sends at most one row per key, however hot the key.
    """
    ties = [c for c in frame.columns if c not in {*keys, *order_by}]
    ordered = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in (*order_by, *ties)])
    return frame.withColumn("_rank", F.row_number().over(ordered)).where("_rank = 1").drop("_rank")


def new_keys(frame: DataFrame, target: DataFrame, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Rows whose key is not in `target`."""
    return frame.join(target.select(*keys), list(keys), "left_anti")

"""Intermediate tables in the shared folder, and column hygiene."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.sources.settings import fresh_folder


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame to a new folder under spark.checkpoint.dir and read it back.

    Cuts the lineage: what follows no longer depends on shuffle files of lost executors.
    """
    spark = frame.sparkSession
    path = fresh_folder(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def own_names(frame: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop the columns whose names an operator is about to add, in any case."""
    taken = {n.lower() for n in names}
    return frame.drop(*[c for c in frame.columns if c.lower() in taken])


def whole_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))

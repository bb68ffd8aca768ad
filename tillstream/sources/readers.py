"""Batch and streaming readers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.sources.schemas import (
    AGG_SCHEMA,
    AGG_TABLE,
    DAY,
    FACT_SCHEMA,
    FACT_TABLE,
    RAW_SCHEMA,
    RAW_TABLE,
    TIME,
)
from tillstream.sources.settings import TopicSettings


def read_table(spark: SparkSession, name_or_path: str, schema: T.StructType | None = None) -> DataFrame:
    """A catalog table by name, or a Parquet folder by path."""
    if "/" not in name_or_path:
        return spark.table(name_or_path)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(name_or_path)


def read_days(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table partitioned by day, with its day column."""
    dated = T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])
    return spark.read.schema(dated).parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema(f"{DAY} date").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def register_tables(
    spark: SparkSession, raw: str | None = None, agg: str | None = None, fact: str | None = None
) -> None:
    """Name the stored tables for `spark.sql`; each argument is the folder of one."""
    for name, path, schema in ((RAW_TABLE, raw, RAW_SCHEMA), (AGG_TABLE, agg, AGG_SCHEMA), (FACT_TABLE, fact, FACT_SCHEMA)):
        if path:
            read_days(spark, path, schema).createOrReplaceTempView(name)


def stream_topic(spark: SparkSession, settings: TopicSettings) -> DataFrame:
    """The Kafka topic; needs the Kafka package on the session's class path."""
    return spark.readStream.format("kafka").options(**settings.reader_options()).load()


def stream_files(
    spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet", arrival: str | None = None, **options: str
) -> DataFrame:
    """Files that arrive in a folder.

    A table may be one file or a folder of that name; the file source only
    accepts a lone file through a pattern, so the last letter becomes one.
    `maxFilesPerTrigger` or `maxBytesPerTrigger` bound a micro-batch. `arrival` names a
    column to add with the time each row's file was written.
    """
    pattern = f"{path[:-1]}[{path[-1]}]" if path.endswith(f".{fmt}") else path
    rows = spark.readStream.schema(schema).format(fmt).options(**options).load(pattern)
    return rows.select("*", F.col("_metadata.file_modification_time").alias(arrival)) if arrival else rows


def read_events(spark: SparkSession, source: str, **options) -> DataFrame:
    """One entry for all stream sources: 'kafka', 'parquet' or 'json'."""
    if source == "kafka":
        return stream_topic(spark, options.get("settings") or TopicSettings.from_env())
    return stream_files(spark, fmt=source, **options)


def high_water(target: DataFrame, time: str = TIME, day: str | None = None) -> DataFrame:
    """One row: the newest time in a table (NULL when it is empty).

    With a day partition column the newest day is found from file footers and
    only that partition's time column is read.
    """
    if day is not None:
        newest_day = target.select(F.max(day)).scalar()
        target = target.where(F.col(day) == newest_day)
    return target.select(F.max(time).alias(time))

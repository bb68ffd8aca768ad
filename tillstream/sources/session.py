"""Session settings that hold for a while, and a local session for tests, the benchmark and the comparison tool."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession


@contextmanager
def settings(spark: SparkSession, wanted: Mapping[str, str]) -> Iterator[None]:
    """Session settings, restored afterwards."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def time_statistics(spark: SparkSession):
    """For writes: times as plain 64-bit numbers. The default form of times has no minimum
    and maximum in a file's footer, so that no time filter could skip anything."""
    return settings(spark, {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"})


def local_session(cpus: int | str = 8, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tillstream")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

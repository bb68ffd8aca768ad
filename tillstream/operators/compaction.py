"""Fewer files for closed days: what many small batches left is packed by bytes.

Small files of a day are written again, together and in the order of the layout, next to
the table; then a mark is set, the new files are added and the old ones dropped. A run cut
short behind the mark is completed by the next one, as an upsert is. Readers can meanwhile
see rows twice. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.functions.columns import AsOf, moment, utc_day
from tillstream.operators.merge import MORE_ROWS, READY, day_folders, day_number, finish_upsert, layout_of, staging_of
from tillstream.sources.folders import Folders
from tillstream.sources.schemas import BATCH, BEGUN, DAY, TIME
from tillstream.sources.session import time_statistics

TARGET_BYTES = 256 << 20


def small_files(folders: Folders, day: str, target: int, open_batches: set[str]) -> list[tuple[str, int]]:
    """Path and bytes of a day's files below half the target, but for batches that may yet be written again."""
    found = []
    for path, size in folders.files(day):
        batch = path.rpartition("/")[0].rpartition("/")[2]
        if size < target // 2 and batch.removeprefix(f"{BATCH}=") not in open_batches:
            found.append((path, size))
    return found


def begun_batches(folders: Folders, path: str) -> set[str]:
    """The last batch that each query began."""
    return {name for note in folders.names(f"{path}/{BEGUN}") if "." not in note for name in folders.read_lines(f"{path}/{BEGUN}/{note}")}


def compact_days(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    as_of: AsOf = None,
    target: int = TARGET_BYTES,
    time: str = TIME,
    within: Sequence[str] = (),
) -> list[str]:
    """Pack the small files of all days before that of `as_of`, and name the days packed.

    A packed day has at most one file more than twice its bytes over `target`. Days
    whose number of files would not fall are left alone; rows, and what reads of the table
    return, stay the same. The driver lists one day's files at a time and keeps the names
    of those that are packed.
    """
    finish_upsert(spark, path)
    folders, staging = Folders(spark, path), staging_of(path)
    folders.drop(staging)
    today = day_number(f"={spark.range(1).select(utc_day(moment(as_of))).first()[0]}")
    still_open = begun_batches(folders, path)
    packed: dict[str, list[str]] = {}
    parts = 0
    for day in day_folders(folders, path):
        number = day_number(day)
        if number is None or number >= today:
            continue
        small = small_files(folders, f"{path}/{day}", target, still_open)
        wanted = -(-sum(size for _, size in small) // target)
        if len(small) > wanted:
            packed[day] = [file for file, _ in small]
            parts += wanted
    if not packed:
        return []
    batched = any(f"/{BATCH}=" in file for files in packed.values() for file in files)
    rows = read_files(spark, path, schema, packed, batched)
    layout = layout_of(time, within)
    ordered = rows.repartitionByRange(parts, *layout, F.xxhash64(*schema.names)).sortWithinPartitions(*layout)
    if batched:
        ordered = ordered.withColumn(BATCH, F.lit(f"packed-{uuid.uuid4().hex}"))
    with time_statistics(spark):
        ordered.write.partitionBy(DAY, *([BATCH] if batched else [])).parquet(f"{staging}/{MORE_ROWS}")
    steps = [f"add {day}" for day in day_folders(folders, f"{staging}/{MORE_ROWS}")]
    for day, files in packed.items():
        steps += [f"drop {day}/{file.partition(f'/{day}/')[2]}" for file in files]
    folders.write_lines(f"{staging}/{READY}", steps)
    finish_upsert(spark, path)
    drop_empty(folders, path, packed)
    return list(packed)


def read_files(spark: SparkSession, path: str, schema: T.StructType, packed: dict[str, list[str]], batched: bool) -> DataFrame:
    dated = T.StructType([*schema.fields, T.StructField(DAY, T.DateType()), *([T.StructField(BATCH, T.StringType())] if batched else [])])
    files = [file for files in packed.values() for file in files]
    return spark.read.schema(dated).option("basePath", path).parquet(*files).select(*schema.names, DAY)


def drop_empty(folders: Folders, path: str, packed: dict[str, list[str]]) -> None:
    """Batch folders of which nothing is left. Harmless if missed."""
    left: dict[str, set[str]] = defaultdict(set)
    for day, files in packed.items():
        left[day] = {file.rpartition("/")[0] for file in files if f"/{BATCH}=" in file}
    for batches in left.values():
        for batch in batches:
            if not folders.files(batch):
                folders.drop(batch)

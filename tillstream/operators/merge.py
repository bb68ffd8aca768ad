"""Upserts by key.

`merged` is the relational form: a plan from target and updates to the new
table. `upsert_days` applies it to a Parquet folder partitioned by day: days that
hold an old row of an updated key are rewritten, others only get files added.
`merge_into` hands the work to a table format with row-level operations.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.functions.columns import AsOf, ago, day_of, utc_day
from tillstream.operators.key_index import COMPLETE, build_index, days_of_keys, has_index, index_of, write_hashes
from tillstream.operators.keys import KEY, first_occurrence, new_keys
from tillstream.sources.folders import Folders
from tillstream.sources.readers import read_days, table_exists
from tillstream.sources.schemas import DAY, TIME
from tillstream.sources.session import time_statistics

# Fixed value: Spark's partition folder for a missing partition value.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def merged(
    target: DataFrame, updates: DataFrame, keys: Sequence[str] = (KEY,), order_by: Sequence[str] = (TIME,)
) -> DataFrame:
    """Target rows without an update, plus the first update of each key.

    The anti-join needs the distinct keys only, combined before their shuffle.
    While these are few Spark broadcasts them and leaves the target unshuffled.
    """
    changed = updates.select(*keys).distinct()
    return new_keys(target, changed, keys).unionByName(first_occurrence(updates, keys, order_by))


def with_day(frame: DataFrame, time: str = TIME) -> DataFrame:
    return frame.withColumn(DAY, day_of(time))


SLOT_HOURS = 6


def layout_of(time: str = TIME, within: Sequence[str] = ()) -> list[Column]:
    """What a day's files are cut and sorted by: the time, or, with columns to search by as
    well, a quarter of the day, these columns, and the time behind them.

    Then the statistics of a file are narrow in both, and a read of one store and hour
    concerns the few files of one store in one quarter.
    """
    slot = F.floor(F.unix_seconds(F.col(time).cast("timestamp")) / (SLOT_HOURS * 3600))
    return [F.col(DAY), *([slot, *[F.col(c) for c in within]] if within else []), F.col(time)]


def write_days(
    frame: DataFrame, path: str, time: str = TIME, mode: str = "overwrite", within: Sequence[str] = (), **options: str
) -> None:
    """Write a table partitioned by day, its files sorted by `layout_of`.

    The rebalance hint lets Spark cut a busy day into several files of the
    advised size and join small days into one task. With `within` files are ranges of
    the layout instead, of which Spark joins the small ones.
    """
    dated = frame if DAY in frame.columns else with_day(frame, time)
    layout = layout_of(time, within)
    spread = dated.repartitionByRange(*layout) if within else dated.hint("rebalance", DAY)
    with time_statistics(frame.sparkSession):
        spread.sortWithinPartitions(*layout).write.mode(mode).options(**options).partitionBy(DAY).parquet(path)


def _days(frame: DataFrame) -> set:
    """Distinct days; the calendar bounds their number."""
    return {row[DAY] for row in frame.select(DAY).distinct().collect()}


def _on_days(frame: DataFrame, days: set) -> DataFrame:
    """Rows of these days; None stands for rows without a time."""
    condition = F.col(DAY).isin(days - {None})
    return frame.where(condition | F.col(DAY).isNull() if None in days else condition)


# Fixed names of the folders and the mark inside a table's staging folder.
UPDATES, WHOLE_DAYS, MORE_ROWS, READY = "updates", "days", "more", "ready"
WHOLE_HASHES, MORE_HASHES = "day_hashes", "more_hashes"


def staging_of(path: str) -> str:
    return f"{path.rstrip('/')}_staged"


def finish_upsert(spark: SparkSession, path: str) -> None:
    """Complete an upsert that was cut short after its staging was ready.

    The mark says what every staged day is for, and each step can be repeated, so
    it does not matter where the earlier run stopped. Staging without a mark was
    never begun to be used.
    """
    staging = staging_of(path)
    folders = Folders(spark, path)
    if not folders.exists(f"{staging}/{READY}"):
        return
    index = index_of(path)
    for line in folders.read_lines(f"{staging}/{READY}"):
        action, _, day = line.partition(" ")
        if action == "replace":
            folders.replace(f"{staging}/{WHOLE_HASHES}/{day}", f"{index}/{day}")
            folders.replace(f"{staging}/{WHOLE_DAYS}/{day}", f"{path}/{day}")
        elif action == "add":
            folders.add_files(f"{staging}/{MORE_HASHES}/{day}", f"{index}/{day}")
            folders.add_files(f"{staging}/{MORE_ROWS}/{day}", f"{path}/{day}")
        elif action == "drop":
            folders.drop(f"{index}/{day}")
            folders.drop(f"{path}/{day}")
        elif action == "indexed":
            folders.write_lines(f"{index}/{COMPLETE}", ["1"])
    folders.drop(f"{staging}/{READY}")
    folders.drop(staging)


def day_folder(day) -> str:
    return f"{DAY}={day or NO_DAY}"


def day_folders(folders: Folders, path: str) -> list[str]:
    return [n for n in folders.names(path) if n.startswith(f"{DAY}=")]


def upsert_days(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    schema: T.StructType,
    keys: Sequence[str] = (KEY,),
    time: str = TIME,
    keys_fix_day: bool = False,
    within: Sequence[str] = (),
) -> None:
    """Upsert into a day-partitioned Parquet table; applying it twice changes nothing.

    The first update of each key is written next to the table, so the updates are
    evaluated once. Days that hold an old row of an updated key are staged whole,
    for other days only the new rows; then a mark is set and the table is changed
    day by day. A run that is cut short before the mark has changed nothing; after
    it, the next run (or `finish_upsert`) completes it first. Readers can meanwhile
    see some days changed and others not. One writer at a time.

    Old rows are looked for in the table's key index, which is staged and swapped along
    with the days, or, when the key fixes the day (`keys_fix_day`), on the days of the
    updates. No other day's files are opened. `within` is that of `write_days`.
    """
    finish_upsert(spark, path)
    staging, folders = staging_of(path), Folders(spark, path)
    folders.drop(staging)
    dated = first_occurrence(updates.select(*schema.names), keys, (time,)).transform(with_day, time)
    dated.write.parquet(f"{staging}/{UPDATES}")
    first = read_days(spark, f"{staging}/{UPDATES}", schema)
    landing = _days(first)
    if not landing:
        folders.drop(staging)
        return
    leaving, kept, indexed = set(), None, not keys_fix_day
    if table_exists(spark, path):
        target = read_days(spark, path, schema)
        changed = first.select(*keys)
        if keys_fix_day:
            leaving = _days(_on_days(target, landing).join(changed, list(keys), "left_semi"))
        else:
            if not has_index(spark, path):
                build_index(spark, path, keys, schema)
            leaving = _days(days_of_keys(spark, path, changed, keys))
        kept = new_keys(_on_days(target, leaving), changed, keys).select(*schema.names, DAY) if leaving else None
    steps = ["indexed"] if indexed else []
    if leaving:
        write_days(kept.unionByName(_on_days(first, leaving)), f"{staging}/{WHOLE_DAYS}", time, within=within)
        if indexed:
            write_hashes(read_days(spark, f"{staging}/{WHOLE_DAYS}", schema), keys, f"{staging}/{WHOLE_HASHES}")
        staged = set(day_folders(folders, f"{staging}/{WHOLE_DAYS}"))
        wanted = {day_folder(d) for d in leaving}
        steps += [f"replace {d}" for d in sorted(staged)] + [f"drop {d}" for d in sorted(wanted - staged)]
    if landing - leaving:
        more = _on_days(first, landing - leaving)
        write_days(more, f"{staging}/{MORE_ROWS}", time, within=within)
        if indexed:
            write_hashes(more, keys, f"{staging}/{MORE_HASHES}")
        steps += [f"add {d}" for d in day_folders(folders, f"{staging}/{MORE_ROWS}")]
    folders.write_lines(f"{staging}/{READY}", steps)
    finish_upsert(spark, path)


def replace_table(
    spark: SparkSession,
    path: str,
    frame: DataFrame,
    schema: T.StructType,
    keys: Sequence[str] = (KEY,),
    time: str = TIME,
    within: Sequence[str] = (),
) -> None:
    """Build a table anew: all days and their key index are staged, then a mark is set and days are swapped.

    The old table stays as it is until all of the new one is written; a run cut short
    behind the mark is completed by the next one, as an upsert is. The frame may read the
    table it replaces.
    """
    finish_upsert(spark, path)
    staging, folders = staging_of(path), Folders(spark, path)
    folders.drop(staging)
    write_days(frame, f"{staging}/{WHOLE_DAYS}", time, within=within)
    write_hashes(read_days(spark, f"{staging}/{WHOLE_DAYS}", schema), keys, f"{staging}/{WHOLE_HASHES}")
    staged = day_folders(folders, f"{staging}/{WHOLE_DAYS}")
    gone = sorted({*day_folders(folders, path)} - {*staged})
    folders.make(path)
    folders.write_lines(f"{staging}/{READY}", ["indexed", *[f"replace {d}" for d in staged], *[f"drop {d}" for d in gone]])
    finish_upsert(spark, path)


def day_number(folder: str) -> tuple[int, ...] | None:
    """Year, month and day that a folder names; years of any length compare as numbers."""
    try:
        year, month, day = folder.partition("=")[2].rsplit("-", 2)
        return int(year), int(month), int(day)
    except ValueError:
        return None


def expire_days(spark: SparkSession, path: str, as_of: AsOf = None, keep: int = 90) -> list[str]:
    """Retention: drop the folders of days before the last `keep`, and name them.

    Holds for every layout whose first level is the day. Only that level is listed;
    no file is read or rewritten, and rows without a time stay.
    """
    bound = str(spark.range(1).select(utc_day(ago(as_of, f"{keep} days"))).first()[0])
    folders = Folders(spark, path)
    numbers = {d: day_number(d) for d in day_folders(folders, path)}
    gone = [d for d, number in numbers.items() if number is not None and number < day_number(f"={bound}")]
    for day in gone:
        folders.drop(f"{path}/{day}")
        folders.drop(f"{index_of(path)}/{day}")
    return gone


def merge_into(updates: DataFrame, table: str, keys: Sequence[str] = (KEY,), order_by: Sequence[str] = (TIME,)) -> None:
    """MERGE into a catalog table whose format supports row-level operations."""
    first = first_occurrence(updates, keys, order_by).alias("updates")
    name = table.split(".")[-1]
    on = reduce(and_, [F.col(f"{name}.{k}") == F.col(f"updates.{k}") for k in keys])
    first.mergeInto(table, on).whenMatched().updateAll().whenNotMatched().insertAll().merge()

"""Which days of a table may hold a key, without reading the table.

Beside its days a table keeps, in a folder that readers of the table don't see, the 64-bit
hashes of its keys, again by day: eight bytes a row, sorted, with a Parquet bloom filter in
every row group. A key's days come from a semi-join with these; for a few keys the hashes
are literals, so that the bloom filters skip all other row groups. Equal hashes of
different keys only name a day too many.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.sources.folders import Folders
from tillstream.sources.readers import read_days
from tillstream.sources.schemas import DAY

# Folders whose names begin so are not listed by readers.
FOLDER, COMPLETE = "_keys", "_complete"
HASH = "key_hash"
SCHEMA = T.StructType([T.StructField(HASH, T.LongType())])
LITERALS = 200


def index_of(path: str) -> str:
    return f"{path.rstrip('/')}/{FOLDER}"


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def has_index(spark: SparkSession, path: str) -> bool:
    return Folders(spark, path).exists(f"{index_of(path)}/{COMPLETE}")


def write_hashes(dated: DataFrame, keys: Sequence[str], folder: str) -> None:
    """The hashes of the keys of rows that have their day."""
    (
        dated.select(DAY, key_hash(keys).alias(HASH))
        .hint("rebalance", DAY)
        .sortWithinPartitions(DAY, HASH)
        .write.mode("overwrite")
        .option(f"parquet.bloom.filter.enabled#{HASH}", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .partitionBy(DAY)
        .parquet(folder)
    )


def build_index(spark: SparkSession, path: str, keys: Sequence[str], schema: T.StructType) -> None:
    """Once, for a table that has none: reads the key column. The mark is written last."""
    write_hashes(read_days(spark, path, schema).select(*keys, DAY), keys, index_of(path))
    Folders(spark, path).write_lines(f"{index_of(path)}/{COMPLETE}", ["1"])


def drop_index(spark: SparkSession, path: str) -> None:
    """For writers that add rows and don't keep the index: the next upsert builds it anew."""
    folders = Folders(spark, path)
    if folders.exists(index_of(path)):
        folders.drop(index_of(path))


def days_of_keys(spark: SparkSession, path: str, changed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The days that may hold one of the keys; None stands for rows without a time."""
    hashes = changed.select(key_hash(keys).alias(HASH)).distinct()
    index = read_days(spark, index_of(path), SCHEMA)
    few = [r[HASH] for r in hashes.limit(LITERALS + 1).collect()]
    if len(few) <= LITERALS:
        # Equalities, since longer lists are only pushed down as a range.
        found = index.where(reduce(or_, [F.col(HASH) == h for h in few], F.lit(False)))
    else:
        found = index.join(hashes, HASH, "left_semi")
    return found.select(DAY).distinct()

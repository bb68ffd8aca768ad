"""Streaming deduplication by key under an event-time watermark."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tillstream.operators.keys import KEY
from tillstream.sources.schemas import TIME

DELAY = "10 minutes"


def newest_copies(
    keys: Sequence[str], time: str
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Keep the newest copy of each key within an Arrow batch.

    The newest copy is behind the watermark only if all copies are, and the
    batch keeps its newest time, so neither late rows nor the watermark change.
    A copy without a time is never late and is kept as well.
    """
    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [f"k{i}" for i in range(len(keys))]
            columns = [batch.column(k) for k in keys]
            times = batch.column(time)
            order = pc.sort_indices(times)
            groups = pa.table(
                [*[c.take(order) for c in columns], pc.is_null(times).take(order), order],
                names=[*names, "untimed", "row"],
            )
            kept = groups.group_by([*names, "untimed"], use_threads=False).aggregate([("row", "last")])
            yield batch if len(kept) == len(batch) else batch.take(kept["row_last"].combine_chunks())

    return combine


def deduplicate(
    frame: DataFrame,
    keys: Sequence[str] = (KEY,),
    time: str = TIME,
    delay: str = DELAY,
    mode: str = "global",
    combine: bool = True,
) -> DataFrame:
    """Set the watermark, drop late rows and repeated keys.

    `global` remembers every key for the life of the query. `within_watermark`
    forgets a key once the watermark passes its time plus `delay`, which bounds
    the state; the key is then accepted again.

    Streaming deduplication has no map-side step of its own: all copies of a
    hot key would travel to one task. `combine` removes copies ahead of that
    shuffle, within each Arrow batch, so a key that holds a third of the stream
    costs one row per ten thousand.
    """
    if combine:
        frame = frame.mapInArrow(newest_copies(keys, time), frame.schema)
    watermarked = frame.withWatermark(time, delay)
    if mode == "global":
        return watermarked.dropDuplicates(list(keys))
    if mode == "within_watermark":
        return watermarked.dropDuplicatesWithinWatermark(list(keys))
    raise ValueError(f"unknown deduplication mode {mode!r}")

"""Deduplication that sets late rows apart instead of losing them.

Spark's own operators drop rows behind the watermark. Here the watermark is still set and
moves as ever, but the processor gets the time as a plain number, which the late-row
filter of stateful operators doesn't know, and compares it with the watermark itself.

A call of the processor is dear, a row within it cheap. Where keys are remembered for ever
the processor is called for a bucket of keys and keeps nothing; Spark's own deduplication
behind it, which knows no time either, remembers the keys.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tillstream.operators.keys import KEY
from tillstream.sources.schemas import TIME
from tillstream.streaming.dedup import DELAY, newest_copies

LATE = "is_late"
BUCKET = "_bucket"
# Calls of the processor in a batch at most; a task holds a batch's rows of one bucket.
BUCKETS = 2048

# The processor travels with its code: the workers of stateful operators need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def newer(row: Row, held: Row | None, time: str) -> bool:
    """Whether a copy takes the place of the one held; a copy without a time never does."""
    return held is None or (row[time] is not None and (held[time] is None or row[time] > held[time]))


def marked(row: Row, time: str, watermark: int) -> Row:
    """The row with its mark; its time is in microseconds, the watermark in milliseconds."""
    return Row(*row.__fields__, LATE)(*row, row[time] is not None and row[time] <= watermark * 1000)


class NewestOfBatch(StatefulProcessor):
    """Of a batch's copies of a key, all in one bucket, the newest, marked as late if it came behind the watermark."""

    def __init__(self, keys: Sequence[str], time: str):
        self.keys, self.time = tuple(keys), time

    def init(self, handle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        newest = {}
        for row in rows:
            copy_of = tuple(hashable(row[k]) for k in self.keys)
            if newer(row, newest.get(copy_of), self.time):
                newest[copy_of] = row
        watermark = timerValues.getCurrentWatermarkInMs()
        for row in newest.values():
            yield marked(row, self.time, watermark)

    def close(self) -> None:
        pass


def hashable(value):
    if isinstance(value, list | tuple):
        return tuple(map(hashable, value))
    if isinstance(value, float) and value != value:
        return "NaN"  # Spark takes all of them for one key, Python for none
    return bytes(value) if isinstance(value, bytearray) else value


class FirstCopy(StatefulProcessor):
    """Lets the first copy of a key through, marked as late if it came behind the watermark.

    Of copies that come in one batch the newest counts: it is late only if all are. A key
    is forgotten once the watermark is `forget_after` milliseconds past its time, or past
    its arrival if it came late.
    """

    def __init__(self, time: str, forget_after: int):
        self.time, self.forget_after = time, forget_after

    def init(self, handle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        newest = None
        for row in rows:
            if newer(row, newest, self.time):
                newest = row
        if newest is None or self.seen.exists():
            return
        at, watermark = newest[self.time], timerValues.getCurrentWatermarkInMs()
        self.seen.update((at,))
        self.handle.registerTimer(max(watermark, (at or 0) // 1000) + self.forget_after)
        yield marked(newest, self.time, watermark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def milliseconds(frame: DataFrame, delay: str) -> int:
    return frame.sparkSession.range(1).select(F.unix_millis(F.timestamp_seconds(F.lit(0)) + F.expr(f"interval {delay}"))).first()[0]


def with_lateness(
    frame: DataFrame,
    keys: Sequence[str] = (KEY,),
    time: str = TIME,
    delay: str = DELAY,
    mode: str = "global",
    combine: bool = True,
) -> DataFrame:
    """A stream without repeated keys, with `is_late`: whether a row came behind the watermark its batch began with.

    `mode` and `combine` are those of `deduplicate`. Where that drops a late row, here it
    comes out with the mark; rows without a time are never late. Needs the RocksDB state
    store, which `start` sets. Rows pass through Python one by one, so the job takes this
    form only if late rows are asked for. With `within_watermark` each key costs a call of
    the processor, some twenty times the time of `global`.
    """
    if mode not in ("global", "within_watermark"):
        raise ValueError(f"unknown deduplication mode {mode!r}")
    if combine:
        frame = frame.mapInArrow(newest_copies(keys, time), frame.schema)
    # An expression instead of the column: its result is no event time to the operators behind it.
    plain = frame.withWatermark(time, delay).withColumn(time, F.unix_micros(time))
    out = T.StructType([*plain.schema.fields, T.StructField(LATE, T.BooleanType())])
    if mode == "global":
        dealt = plain.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)))
        out = T.StructType([*dealt.schema.fields, *out.fields[-1:]])
        once = dealt.groupBy(BUCKET).transformWithState(NewestOfBatch(keys, time), out, "append", "eventTime").dropDuplicates(list(keys))
    else:
        once = plain.groupBy(*keys).transformWithState(FirstCopy(time, milliseconds(frame, delay)), out, "append", "eventTime")
    return once.withColumn(time, F.timestamp_micros(time)).select(*frame.columns, LATE)


def split_late(on_time: Callable[[DataFrame, int], None], late: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A writer for marked rows: those on time to one sink, late ones to another.

    The batch is kept for the second write, since computing it again would run the state
    operator again. If the second write fails, both are repeated with the batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            on_time(batch.where(~F.col(LATE)).drop(LATE), batch_id)
            late(batch.where(LATE).drop(LATE), batch_id)
        finally:
            batch.unpersist()

    return write

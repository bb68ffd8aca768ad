"""Late rows of a batch, as a stream would have judged them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.sources.schemas import TIME


def running_max(slots: DataFrame, slot: str, value: str, block: int = 4096) -> DataFrame:
    """For each slot the largest value of all slots before it (`before`).

    Two levels, so that no task sees more than `block` slots, or one row per
    block: the largest value of the blocks before, and of the slots before
    inside the block.
    """
    # Asked for here, the filter is the same below both branches, which then share one exchange.
    blocked = slots.withColumn("_block", F.floor(F.col(slot) / block)).where(F.col("_block").isNotNull())
    earlier_blocks = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    earlier_slots = Window.partitionBy("_block").orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        blocked.groupBy("_block")
        .agg(F.max(value).alias("_top"))
        .select("_block", F.max("_top").over(earlier_blocks).alias("_blocks_before"))
    )
    inside = blocked.select("_block", slot, F.max(value).over(earlier_slots).alias("_slots_before"))
    return inside.join(blocks, "_block").select(
        slot, F.greatest("_blocks_before", "_slots_before").alias("before")
    )


def late_rows(frame: DataFrame, slot: Column, delay: str = "10 minutes") -> DataFrame:
    """Rows at or behind the watermark their arrival slot started with.

    `slot` numbers the micro-batch in which a row arrived. The watermark of a
    slot is the newest time of all earlier slots, to the millisecond, less
    `delay`; rows of the first slot are never late.
    """
    slotted = frame.withColumn("_slot", slot)
    newest = slotted.where(F.col("_slot").isNotNull()).groupBy("_slot").agg(F.max(TIME).alias("_newest"))
    before = running_max(newest, "_slot", "_newest").where("before is not null")
    watermark = F.date_trunc("millisecond", "before") - F.expr(f"interval {delay}")
    return (
        slotted.join(before.select("_slot", watermark.alias("watermark")), "_slot")
        .where(F.col(TIME) <= F.col("watermark"))
        .drop("_slot")
    )

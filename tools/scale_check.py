"""Time the main operators on the sf0.1 events repeated N times, a third of the
rows under one transaction id and one store.

    python tools/scale_check.py [copies] [folder]

The folder is filled on first use and kept.
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillstream.operators import aggregates, keys, quality, reports  # noqa: E402
from tillstream.plans.fact import build_fact, refresh_fact  # noqa: E402
from tillstream.sources import views  # noqa: E402
from tillstream.sources.readers import stream_files  # noqa: E402
from tillstream.sources.schemas import SALE_COLUMNS  # noqa: E402
from tillstream.sources.session import local_session  # noqa: E402
from tillstream.sources.settings import fresh_folder  # noqa: E402
from tillstream.streaming.dedup import deduplicate  # noqa: E402
from tillstream.streaming.jobs import start  # noqa: E402

SOURCE = "/root/testdata/sf0.1"


def fill(spark, copies: int, path: str) -> None:
    sales = views.sales(views.events(spark, SOURCE))
    many = sales.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    hot = F.col("event_id") % 3 == 0
    many.select(
        F.when(hot, "tx_hot").otherwise(F.concat_ws("_", "transaction_id", "copy")).alias("transaction_id"),
        F.when(hot, "store_1").otherwise(F.col("store_id")).alias("store_id"),
        *[c for c in SALE_COLUMNS if c not in ("transaction_id", "store_id", "transaction_ts")],
        (F.col("transaction_ts") + F.make_dt_interval(secs=F.col("copy") / 1000)).alias("transaction_ts"),
    ).write.parquet(path)


def timed(name: str, run) -> None:
    started = time.time()
    run()
    print(f"{name}: {time.time() - started:.1f} s", flush=True)


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 100
    folder = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="run-")
    spark = local_session(8)
    path = f"{folder}/sales-{copies}"
    if not os.path.exists(path):
        fill(spark, copies, path)
    sales = spark.read.parquet(path)
    as_of = "2024-01-31 00:00:00"
    print(path, sales.count(), "rows")

    def noop(frame):
        return lambda: frame.write.format("noop").mode("overwrite").save()

    timed("agg_store_5min", noop(aggregates.store_windows(sales)))
    timed("hourly_volume", noop(aggregates.hourly_volume(sales)))
    timed("payment_split", noop(reports.payment_split(sales)))
    timed("duplicate_ids", noop(keys.duplicate_keys(sales)))
    timed("check_report", noop(quality.check_report(sales, as_of)))
    timed("build_fact", noop(build_fact(sales)))

    table = f"{fresh_folder(spark, 'fact')}/table"
    early = F.col("transaction_ts") < F.lit("2024-01-29").cast("timestamp")
    timed("refresh_fact full", lambda: refresh_fact(spark, sales.where(early), table))
    timed("refresh_fact incremental", lambda: refresh_fact(spark, sales, table, "1 hour"))

    for mode in ("global", "within_watermark"):
        for combine in (False, True):
            out = fresh_folder(spark, "stream")
            stream = deduplicate(stream_files(spark, path, sales.schema), mode=mode, combine=combine)

            def run(frame=stream, out=out):
                counted = lambda batch, number: batch.write.format("noop").mode("overwrite").save()
                start(frame, counted, f"{out}/checkpoint", {"availableNow": True}, partitions=16).awaitTermination()

            timed(f"stream dedup {mode} combine={combine}", run)
    out = fresh_folder(spark, "stream")
    windows = aggregates.store_windows(deduplicate(stream_files(spark, path, sales.schema)))
    noop_batch = lambda batch, number: batch.write.format("noop").mode("overwrite").save()
    timed(
        "stream windows",
        lambda: start(
            windows, noop_batch, f"{out}/checkpoint", {"availableNow": True}, partitions=16
        ).awaitTermination(),
    )


if __name__ == "__main__":
    main()

"""Starting the streaming queries.

Raw rows, window aggregates and rejected messages are three independent queries
over one source, each with its own checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream.operators.aggregates import store_windows
from tillstream.operators.decode import AHEAD, BEHIND, Versions, accepted, rejected, with_reject_reason
from tillstream.sources.schemas import SALE_COLUMNS
from tillstream.sources.session import settings
from tillstream.streaming.dedup import DELAY, deduplicate
from tillstream.streaming.late import split_late, with_lateness
from tillstream.streaming.progress import BatchMetrics, listening
from tillstream.streaming.reconcile import counted
from tillstream.streaming.sinks import BatchWriter

MESSAGE_COLUMNS = ("value", "topic", "partition", "offset", "timestamp")

PARTITIONS = "spark.sql.shuffle.partitions"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Session settings a query copies when it starts; restored afterwards.

    State of lifetime deduplication outgrows executor memory, so RocksDB is used
    unless the session names a provider. The number of state partitions is
    frozen by the first start.
    """
    wanted = {}
    if spark.conf.get(PROVIDER, None) is None:
        wanted = {PROVIDER: ROCKSDB, CHANGELOG: "true"}
    if partitions:
        wanted[PARTITIONS] = str(partitions)
    with settings(spark, wanted):
        yield


def start(
    frame: DataFrame,
    writer: BatchWriter,
    checkpoint: str,
    trigger: dict | None = None,
    name: str | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """Start one append-mode query into a foreachBatch sink.

    `trigger` holds the arguments of DataStreamWriter.trigger, for example
    {"processingTime": "30 seconds"} or {"availableNow": True}.
    """
    stream = frame.writeStream.foreachBatch(writer).outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        stream = stream.queryName(name)
    if trigger:
        stream = stream.trigger(**trigger)
    with state_settings(frame.sparkSession, partitions):
        return stream.start()


@dataclass
class SalesJob:
    """The three queries over one stream of framed messages.

    Rejects keep the message and, where the source has them, its topic, partition,
    offset and time. `metrics` listens while `run` is at work.

    A row whose time is more than `ahead` later, or `behind` earlier, than its message came
    is a reject, so that one damaged clock can't move the watermark past all other rows. A
    message came when its `timestamp` column says (the broker's or the file's time), or
    without that column at the time of the micro-batch. `versions` are the writer schemas
    by the id in the header. With `write_late` the raw query hands late rows to that sink
    instead of dropping them. With the folder `source_counts` the rejects query counts all
    messages by the hour they came in, for `reconcile_batches`.
    """

    messages: DataFrame
    checkpoint: str
    write_raw: BatchWriter
    write_agg: BatchWriter
    write_rejects: BatchWriter | None = None
    write_late: BatchWriter | None = None
    source_counts: str | None = None
    fmt: str = "json"
    versions: Versions | None = None
    ahead: str = AHEAD
    behind: str = BEHIND
    delay: str = DELAY
    width: str = "5 minutes"
    dedup_mode: str = "global"
    combine: bool = True
    trigger: dict | None = None
    partitions: int | None = None
    metrics: BatchMetrics | None = None
    queries: list[StreamingQuery] = field(default_factory=list)

    def classified(self) -> DataFrame:
        keep = [c for c in MESSAGE_COLUMNS if c in self.messages.columns]
        arrival = F.col("timestamp") if "timestamp" in keep else F.current_timestamp()
        return with_reject_reason(
            self.messages, self.fmt, keep, arrival=arrival, ahead=self.ahead, behind=self.behind, versions=self.versions
        )

    def storable(self) -> DataFrame:
        """Rows with the types of the raw table. Rejects leave before the deduplication,
        so a damaged message cannot shadow a good one with its key."""
        return accepted(self.classified()).select(*SALE_COLUMNS).withColumn("price", F.col("price").cast("double"))

    def raw(self) -> DataFrame:
        """Storable rows on time, once each."""
        return deduplicate(self.storable(), delay=self.delay, mode=self.dedup_mode, combine=self.combine)

    def raw_and_late(self) -> DataFrame:
        """Storable rows, once each, those behind the watermark marked."""
        return with_lateness(self.storable(), delay=self.delay, mode=self.dedup_mode, combine=self.combine)

    def windows(self) -> DataFrame:
        return store_windows(self.raw(), self.width)

    def rejects(self) -> DataFrame:
        return rejected(self.classified())

    def start(self) -> list[StreamingQuery]:
        raw = (self.raw_and_late(), split_late(self.write_raw, self.write_late)) if self.write_late else (self.raw(), self.write_raw)
        parts = [("raw", *raw), ("agg", self.windows(), self.write_agg)]
        if self.write_rejects and self.source_counts:
            came = self.classified()
            came = came if "timestamp" in came.columns else came.withColumn("timestamp", F.current_timestamp())
            parts.append(("rejects", came, counted(self.write_rejects, self.source_counts)))
        elif self.write_rejects:
            parts.append(("rejects", self.rejects(), self.write_rejects))
        for name, frame, writer in parts:
            self.queries.append(
                start(frame, writer, f"{self.checkpoint}/{name}", self.trigger, partitions=self.partitions)
            )
        return self.queries

    def run(self) -> None:
        """Start, then block until a query ends; with availableNow, until all do."""
        spark: SparkSession = self.messages.sparkSession
        with listening(spark, self.metrics) if self.metrics else nullcontext():
            self.start()
            if self.trigger and self.trigger.get("availableNow"):
                for query in self.queries:
                    query.awaitTermination()
            else:
                spark.streams.awaitAnyTermination()

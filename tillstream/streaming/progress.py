"""Per-batch metrics of running queries as a DataFrame."""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tillstream.sources.folders import Folders
from tillstream.sources.schemas import DAY

METRICS_SCHEMA = (
    "query_id string, name string, batch_id bigint, started string, input_rows bigint, "
    "rows_per_second double, duration_ms bigint, late_rows bigint, state_rows bigint, error string"
)
METRIC_NAMES = ("query_id", "name", "batch_id", "started", "input_rows", "rows_per_second", "duration_ms", "late_rows", "state_rows", "error")


def progress_row(progress) -> tuple:
    operators = progress.stateOperators or []
    return (
        str(progress.id),
        progress.name,
        progress.batchId,
        progress.timestamp,
        progress.numInputRows,
        float(progress.processedRowsPerSecond or 0.0),
        progress.durationMs.get("triggerExecution"),
        sum(o.numRowsDroppedByWatermark for o in operators),
        sum(o.numRowsTotal for o in operators),
        None,
    )


KEEP = 1000


@contextmanager
def listening(spark: SparkSession, listener: StreamingQueryListener) -> Iterator[None]:
    """Listen for a while; at the end all events so far have been heard."""
    spark.streams.addListener(listener)
    try:
        yield
    finally:
        spark._jsc.sc().listenerBus().waitUntilEmpty()
        spark.streams.removeListener(listener)


class BatchMetrics(StreamingQueryListener):
    """Records of all batches; add with `spark.streams.addListener` or give it to a job.

    Counts come from the engine's own progress events, so no batch is counted by an
    extra action. Totals per query run from the listener's start and are never cut. Of the
    records the newest KEEP wait in memory for `frame` or `take`; each is handed to `log`,
    if there is one, as it comes. `StoredMetrics` keeps them all.
    """

    def __init__(self, log: Callable[[tuple], None] | None = None) -> None:
        self.rows: deque[tuple] = deque(maxlen=KEEP)
        self.late: dict[str, int] = {}
        self.log = log

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._add(progress_row(event.progress))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self._add((str(event.id), None, None, None, None, None, None, None, None, event.exception))

    def _add(self, row: tuple) -> None:
        self.late[row[0]] = self.late.get(row[0], 0) + (row[7] or 0)
        if self.log:
            self.log(row)
        else:
            self.rows.append(row)

    def late_rows_dropped(self, query_id: str) -> int:
        """Rows the query's stateful operators dropped behind the watermark since the listener was added."""
        return self.late.get(str(query_id), 0)

    def take(self, spark: SparkSession) -> DataFrame:
        """The records so far, which the listener then forgets; totals stay."""
        rows = [self.rows.popleft() for _ in range(len(self.rows))]
        return spark.createDataFrame(rows, METRICS_SCHEMA)

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.rows), METRICS_SCHEMA)


class StoredMetrics(BatchMetrics):
    """Records kept as a table: a JSON file for each query and day, one line for each batch.

    A batch that is reported again replaces its line, and the table outlives the listener:
    totals are those of the table, over all restarts from one checkpoint. A file is written
    anew with every record; a day of half-minute batches is about a megabyte. The listener
    itself remembers nothing. A record is lost if the driver dies between the end of a batch
    and its event; `missing_batches` tells which.
    """

    def __init__(self, spark: SparkSession, path: str, log: Callable[[tuple], None] | None = None) -> None:
        super().__init__(log)
        self.spark, self.path = spark, path.rstrip("/")

    def _add(self, row: tuple) -> None:
        if self.log:
            self.log(row)
        record = dict(zip(METRIC_NAMES, row))
        day = (record["started"] or datetime.now(UTC).isoformat())[:10]
        file = f"{self.path}/{DAY}={day}/{record['query_id']}.json"
        folders = Folders(self.spark, self.path)
        lines = [json.loads(line) for line in folders.read_lines(file)] if folders.exists(file) else []
        lines = [line for line in lines if (line["batch_id"], line["error"]) != (record["batch_id"], record["error"])]
        folders.write_lines(file, [json.dumps(line) for line in (*lines, record)])

    def frame(self, spark: SparkSession) -> DataFrame:
        return stored_metrics(spark, self.path)

    def take(self, spark: SparkSession) -> DataFrame:
        raise TypeError("stored records are not taken away; read the table")

    def late_rows_dropped(self, query_id: str) -> int:
        """Rows the query's stateful operators dropped behind the watermark since its checkpoint began."""
        mine = stored_metrics(self.spark, self.path).where(F.col("query_id") == str(query_id))
        return mine.agg(F.coalesce(F.sum("late_rows"), F.lit(0))).first()[0]


def stored_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The records of a folder, one for each query and batch.

    A batch that ended on another day than it was first reported on has a line on both; the newest counts.
    """
    read = spark.read.schema(f"{METRICS_SCHEMA}, {DAY} date").json(path)
    newest = Window.partitionBy("query_id", "batch_id", "error").orderBy(F.desc("started"))
    return read.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank", DAY)


def totals(metrics: DataFrame) -> DataFrame:
    """Batches, rows and late rows of each query so far, and how many errors ended it."""
    return metrics.groupBy("query_id").agg(
        F.max("name").alias("name"),
        F.count("batch_id").alias("batches"),
        F.coalesce(F.sum("input_rows"), F.lit(0)).alias("input_rows"),
        F.coalesce(F.sum("late_rows"), F.lit(0)).alias("late_rows"),
        F.count("error").alias("errors"),
    )


def missing_batches(metrics: DataFrame) -> DataFrame:
    """query_id, batch_id: gaps in the numbers of the batches, whose records were lost."""
    ahead = Window.partitionBy("query_id").orderBy("batch_id")
    gaps = metrics.where("batch_id is not null").withColumn("next", F.lead("batch_id").over(ahead)).where("next > batch_id + 1")
    return gaps.select("query_id", F.explode(F.sequence(F.col("batch_id") + 1, F.col("next") - 1)).alias("batch_id"))


def log_line(row: tuple) -> str:
    """One line for each batch: query, number, rows, milliseconds, late rows, error."""
    names = ("query", "name", "batch", "started", "rows", "rows_per_second", "ms", "late", "state", "error")
    return " ".join(f"{n}={v}" for n, v in zip(names, row) if v is not None)

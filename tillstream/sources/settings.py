"""Settings of the source topic and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession

from tillstream.sources.folders import Folders


@dataclass(frozen=True)
class TopicSettings:
    """Where events come from; `from_env` reads the usual variables.

    `max_offsets_per_trigger` bounds a micro-batch; `min_partitions` reads a
    topic of few partitions with more tasks than it has partitions. Without
    `fail_on_data_loss` a stream goes on where offsets are gone from the topic.
    """

    # The first four variables, the topic and the first two defaults.

    brokers: str | None = None
    topic: str = "retail_sales"
    starting_offsets: str = "latest"
    checkpoint_dir: str | None = None
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    fail_on_data_loss: bool = False

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> TopicSettings:
        return cls(
            brokers=env.get("KAFKA_BROKERS"),
            topic=env.get("KAFKA_TOPIC", cls.topic),
            starting_offsets=env.get("KAFKA_STARTING_OFFSETS", cls.starting_offsets),
            checkpoint_dir=env.get("CHECKPOINT_DIR"),
            max_offsets_per_trigger=int(env["KAFKA_MAX_OFFSETS_PER_TRIGGER"]) if env.get("KAFKA_MAX_OFFSETS_PER_TRIGGER") else None,
            min_partitions=int(env["KAFKA_MIN_PARTITIONS"]) if env.get("KAFKA_MIN_PARTITIONS") else None,
            fail_on_data_loss=env.get("KAFKA_FAIL_ON_DATA_LOSS", "false").lower() == "true",
        )

    def reader_options(self) -> dict[str, str]:
        if not self.brokers:
            raise ValueError("no brokers configured: set KAFKA_BROKERS or pass brokers=")
        options = {
            "kafka.bootstrap.servers": self.brokers,
            "subscribe": self.topic,
            "startingOffsets": self.starting_offsets,
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
        }
        if self.max_offsets_per_trigger:
            options["maxOffsetsPerTrigger"] = str(self.max_offsets_per_trigger)
        if self.min_partitions:
            options["minPartitions"] = str(self.min_partitions)
        return options


_local_folder: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by spark.checkpoint.dir.

    Only a local master (tests) may fall back to a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folder:
        _local_folder[app] = tempfile.mkdtemp(prefix="run-")
    return _local_folder[app]


_fresh: dict[str, list[str]] = {}


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new folder for intermediate tables, which stay until `drop_fresh_folders`: a result that
    is still to be computed reads them, also again after executors were lost."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _fresh.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def drop_fresh_folders(spark: SparkSession) -> int:
    """Drop the intermediate tables of this application so far, once its results are written. Returns how many."""
    paths = _fresh.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        Folders(spark, path).drop(path)
    return len(paths)

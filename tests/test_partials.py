"""Checks from partial results, counts of each batch, and stored records of batches."""

import json
import os
import random
from types import SimpleNamespace

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tests.conftest import at, rows, sale
from tests.test_event_time import Messages, sold
from tests.test_layout import spoil
from tests.test_streams import Feed
from tillstream.operators import key_index, partials
from tillstream.operators.merge import expire_days
from tillstream.operators.partials import expire_partials, stored_report
from tillstream.operators.quality import check_report
from tillstream.operators.reconcile import reconcile_hourly
from tillstream.sources.readers import read_days
from tillstream.sources.schemas import DAY, RAW_SCHEMA
from tillstream.streaming import reconcile
from tillstream.streaming.dedup import deduplicate
from tillstream.streaming.progress import BatchMetrics, StoredMetrics, listening, missing_batches, stored_metrics, totals
from tillstream.streaming.reconcile import reconcile_batches
from tillstream.streaming.sinks import replace_batch, with_partials


class Checked:
    def __init__(self, spark, sales, root):
        self.spark, self.sales, self.raw, self.folder = spark, sales, f"{root}/raw", f"{root}/partials"
        self.write = with_partials(replace_batch(self.raw), self.folder)

    def add(self, number, *batch):
        self.write(self.sales(*batch), number)

    def table(self):
        return read_days(self.spark, self.raw, RAW_SCHEMA)

    def same(self, as_of, **options):
        stored = rows(stored_report(self.spark, self.table(), self.folder, as_of, **options))
        assert stored == rows(check_report(self.table(), as_of, **options))
        return {r[1]: r[2:] for r in stored}


@pytest.fixture()
def checked(spark, sales, tmp_path):
    return Checked(spark, sales, tmp_path)


def history(seed, n=60):
    chosen = random.Random(seed)
    stores = ["s1", "s2", None] if seed % 2 else ["s1"]
    return [
        sale(chosen.choice(["again", f"{seed}-{i}"]) if i % 9 == 0 else f"{seed}-{i}", f"2024-01-0{chosen.randrange(1, 9)} {chosen.randrange(24):02d}:{chosen.randrange(60):02d}:30",
             chosen.choice(stores), chosen.randrange(1, 6), chosen.randrange(500) / 4)
        for i in range(n)
    ]


@pytest.mark.parametrize("as_of", ["2024-01-08 12:00", "2024-01-08 12:30", "2024-01-08 12:30:30", "2024-01-20 00:00"])
def test_report_equals_that_of_the_whole_table(checked, as_of):
    for number in range(3):
        checked.add(number, *history(number))
    checked.add(3, sale(None, "2024-01-02 00:00"), sale(None, "2024-01-03 00:00"), sale("timeless", None))
    for options in ({}, {"bounded": True}, {"zero_fill": True, "bounded": True}):
        checked.same(as_of, **options)


def test_replays_late_rows_and_retention(spark, checked):
    checked.add(0, sale("a", "2024-01-05 10:00"), sale("b", "2024-01-05 11:00"))
    assert checked.same("2024-01-05 12:00")["duplicate_check"][0] == "PASS"
    checked.add(1, sale("c", "2024-01-05 11:10"), sale("a", "2024-01-06 00:00", None), sale("x", "2024-01-05 00:00"))
    told = checked.same("2024-01-06 00:30")
    assert told["duplicate_check"] == ("FAIL", "duplicate_check FAIL: 1 duplicate transaction_ids") and told["null_check"][0] == "FAIL"
    # The batch comes again, with other rows and days.
    checked.add(1, sale("c", "2024-01-04 11:10"), sale("b", "2024-01-06 00:00"))
    assert checked.same("2024-01-06 00:30")["duplicate_check"][1] == "duplicate_check FAIL: 1 duplicate transaction_ids"
    checked.add(2, sale("late", "2023-12-30 00:00"), sale("b", "2023-12-30 00:00"), sale("late2", "2024-01-05 10:30"))
    checked.same("2024-01-06 00:30")
    gone = expire_days(spark, checked.raw, "2024-01-07 00:00", keep=1)
    expire_partials(spark, checked.folder, gone)
    assert checked.same("2024-01-06 00:30")["duplicate_check"][0] == "PASS"


@pytest.mark.parametrize("literals", [0, 200])
def test_only_cut_hours_are_read_from_the_table(spark, checked, monkeypatch, literals):
    """All days but those of the cut hours are unreadable."""
    monkeypatch.setattr(partials, "LITERALS", literals)
    for number in range(2):
        checked.add(number, *history(number))
    as_of = "2024-01-08 12:30"
    wanted = rows(check_report(checked.table(), as_of))
    spoil(checked.raw, [f"2024-01-0{d}" for d in range(2, 8)])
    assert rows(stored_report(spark, checked.table(), checked.folder, as_of)) == wanted


def test_a_batch_that_fails_between_its_writes_is_whole_in_the_end(spark, sales, tmp_path, monkeypatch):
    feed = Feed(spark, sales, tmp_path)
    for number in range(3):
        feed.add(*history(number, 20))
    write = with_partials(replace_batch(f"{tmp_path}/raw"), f"{tmp_path}/partials")
    crash = [True]

    def failing(*args):
        if args[2].endswith("-1") and crash.pop():
            raise RuntimeError("down between the writes")
        plain(*args)

    from tillstream.streaming import sinks

    plain = sinks.add_partials
    monkeypatch.setattr(sinks, "add_partials", failing)
    with pytest.raises(StreamingQueryException):
        feed.run(feed.stream(), write)
    crash.append(False)
    monkeypatch.setattr(sinks, "add_partials", plain)
    feed.run(feed.stream(), write)
    table = read_days(spark, f"{tmp_path}/raw", RAW_SCHEMA)
    assert table.count() == 60
    stored = stored_report(spark, table, f"{tmp_path}/partials", "2024-01-08 12:30")
    assert rows(stored) == rows(check_report(table, "2024-01-08 12:30"))


@pytest.mark.parametrize("some_hours", [4096, 2])
def test_counts_of_the_job_equal_those_of_both_tables(spark, tmp_path, monkeypatch, some_hours):
    monkeypatch.setattr(reconcile, "SOME_HOURS", some_hours)
    feed = Messages(spark, tmp_path)

    def run():
        job = feed.job(source_counts=f"{tmp_path}/source")
        job.write_raw = with_partials(job.write_raw, f"{tmp_path}/partials")
        job.run()

    feed.add((sold("a", "2024-01-01T10:00:00"), "10:00"), (bytearray(b"x"), "10:01"), (sold("b", "2024-01-01T11:00:00"), "11:00"))
    run()
    feed.add((sold("c", "2024-01-01T12:00:00"), "12:00"), (sold("n", "2024-01-01T12:10:00", store_id=None), "12:10"), (sold("d", "2024-01-01T13:00:00"), "13:00"))
    run()
    source = spark.read.schema("timestamp timestamp").parquet(f"{tmp_path}/in").withColumnRenamed("timestamp", "transaction_ts")
    wanted = rows(reconcile_hourly(source, feed.table()))
    assert rows(reconcile_batches(spark, f"{tmp_path}/source", f"{tmp_path}/partials")) == wanted
    assert [(r[0], r[1], r[2]) for r in wanted] == [(at("10:00"), 2, 1), (at("11:00"), 1, 1), (at("12:00"), 2, 1), (at("13:00"), 1, 1)]
    assert feed.rejects().count() == 2


def fill(feed):
    feed.add(sale("a", "00:00"), sale("b", "02:00"))
    feed.add(sale("late", "00:01"), sale("c", "02:10"))


def test_records_outlive_the_listener(spark, sales, tmp_path):
    feed, path = Feed(spark, sales, tmp_path / "feed"), f"{tmp_path}/metrics"
    fill(feed)
    for _ in range(2):
        listener = StoredMetrics(spark, path)
        with listening(spark, listener):
            query = feed.run(deduplicate(feed.stream()))
        assert not listener.rows and not listener.late
        feed.add(sale("later", "01:00"), sale("late again", "00:05"), sale("d", "03:00"))
    # The row in the batch right after the watermark's is still taken, as ever.
    assert listener.late_rows_dropped(query.id) == 2
    (told,) = totals(stored_metrics(spark, path)).collect()
    assert (told["query_id"], told["input_rows"], told["late_rows"], told["errors"]) == (str(query.id), 7, 2, 0)
    assert told["batches"] == listener.frame(spark).count() and missing_batches(listener.frame(spark)).count() == 0
    with pytest.raises(TypeError):
        listener.take(spark)


def progress(batch, started, rows_read=5, late=1):
    operators = [SimpleNamespace(numRowsDroppedByWatermark=late, numRowsTotal=9)]
    return SimpleNamespace(
        id="q", name=None, batchId=batch, timestamp=started, numInputRows=rows_read, processedRowsPerSecond=1.0,
        durationMs={"triggerExecution": 7}, stateOperators=operators,
    )


def test_a_batch_reported_again_replaces_its_record(spark, tmp_path):
    lines = []
    listener = StoredMetrics(spark, f"{tmp_path}/m", log=lines.append)
    for batch, started, n in ((0, "2024-01-01T23:59:00Z", 5), (1, "2024-01-01T23:59:59Z", 6), (1, "2024-01-02T00:01:00Z", 7), (0, "2024-01-01T23:59:30Z", 8), (4, "2024-01-02T00:02:00Z", 1)):
        listener.onQueryProgress(SimpleNamespace(progress=progress(batch, started, n)))
    for error in ("broke", "broke", "broke otherwise"):
        listener.onQueryTerminated(SimpleNamespace(id="q", exception=error))
    assert len(lines) == 8
    table = stored_metrics(spark, f"{tmp_path}/m")
    assert rows(table.where("error is null"), "batch_id", "input_rows") == [(0, 8), (1, 7), (4, 1)]
    assert rows(missing_batches(table)) == [("q", 2), ("q", 3)]
    assert rows(totals(table)) == [("q", None, 3, 16, 3, 2)]
    assert listener.late_rows_dropped("q") == 3
    assert sorted(os.listdir(f"{tmp_path}/m"))[:2] == [f"{DAY}=2024-01-01", f"{DAY}=2024-01-02"]
    with open(f"{tmp_path}/m/{DAY}=2024-01-01/q.json") as file:
        assert len([json.loads(line) for line in file]) == 2


def test_records_in_memory_are_bounded(spark):
    metrics = BatchMetrics()
    for batch in range(1500):
        metrics.onQueryProgress(SimpleNamespace(progress=progress(batch, "2024-01-01T00:00:00Z")))
    assert len(metrics.rows) == 1000 and metrics.late_rows_dropped("q") == 1500
    assert metrics.take(spark).agg(F.min("batch_id")).first()[0] == 500 and not metrics.rows


def test_index_literals_are_shared(monkeypatch):
    assert partials.LITERALS == key_index.LITERALS

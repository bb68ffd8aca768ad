"""Damaged clocks, late rows set apart, several writers in one stream."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import at, rows, sale
from tests.test_streams import NOW, Feed, framed
from tillstream.operators.decode import Writer, accepted, rejected, with_reject_reason
from tillstream.operators.merge import expire_days, finish_upsert, staging_of, write_days
from tillstream.plans.fact import refresh_fact, with_revenue
from tillstream.sources.folders import Folders
from tillstream.sources.readers import read_days, stream_files
from tillstream.sources.schemas import DAY, FACT_SCHEMA, RAW_SCHEMA, wire_schema
from tillstream.streaming.jobs import SalesJob, start
from tillstream.streaming.late import LATE, with_lateness
from tillstream.streaming.sinks import append_to, replace_batch


@pytest.fixture()
def feed(spark, sales, tmp_path):
    return Feed(spark, sales, tmp_path)


class Messages:
    """A stream of framed messages, one file a batch, with the time each came."""

    def __init__(self, spark, root):
        self.spark, self.root, self.count = spark, str(root), 0

    def add(self, *messages):
        frame = self.spark.createDataFrame([(m, at(came)) for m, came in messages], "value binary, timestamp timestamp")
        self.count += 1
        frame.coalesce(1).write.mode("append").parquet(f"{self.root}/in")
        for entry in os.scandir(f"{self.root}/in"):
            if entry.name.endswith(".parquet") and entry.stat().st_mtime > 1_800_000_000 - 10**8:
                os.utime(entry.path, (1_600_000_000 + self.count,) * 2)

    def job(self, **options):
        stream = stream_files(self.spark, f"{self.root}/in", "value binary, timestamp timestamp", maxFilesPerTrigger="1")
        if options.pop("untimed", False):
            stream = stream.drop("timestamp")
        return SalesJob(
            stream, f"{self.root}/cp", replace_batch(f"{self.root}/raw"), append_to(f"{self.root}/agg"), replace_batch(f"{self.root}/rejects"),
            trigger=NOW, partitions=2, **options,
        )

    def table(self, name="raw"):
        return read_days(self.spark, f"{self.root}/{name}", RAW_SCHEMA)

    def rejects(self):
        return self.spark.read.schema("transaction_id string, transaction_ts_text string, reject_reason string").parquet(f"{self.root}/rejects")


def sold(id, time, **fields):
    return framed(transaction_id=id, transaction_ts=f"{time}Z", **fields)


@pytest.mark.parametrize("untimed", [False, True])
def test_a_far_future_time_does_not_end_the_stream(spark, tmp_path, untimed):
    """Two runs: the second one starts with the watermark that the first one left."""
    feed = Messages(spark, tmp_path)
    feed.add((sold("a", "2024-01-01T10:00:00"), "10:00"), (sold("far", "2099-01-01T00:00:00"), "10:01"))
    feed.job(untimed=untimed).run()
    feed.add((sold("b", "2024-01-01T10:05:00"), "10:05"), (sold("c", "2024-01-01T10:06:00"), "10:06"), (sold("old", "1970-01-01T00:00:00"), "10:06"))
    feed.job(untimed=untimed).run()
    assert [r[0] for r in rows(feed.table(), "transaction_id")] == ["a", "b", "c"]
    assert rows(feed.rejects(), "transaction_id", "transaction_ts_text", "reject_reason") == [
        ("far", "2099-01-01T00:00:00Z", "implausible_time"), ("old", "1970-01-01T00:00:00Z", "implausible_time"),
    ]


def test_bounds_are_inclusive_and_open_without_an_arrival(spark):
    times = ["2024-01-02T10:00:00", "2024-01-02T10:00:01", "2023-12-31T10:00:00", "2023-12-31T09:59:59"]
    data = [(sold(str(i), t), at("10:00")) for i, t in enumerate(times)] + [(sold("n", times[1]), None)]
    frame = spark.createDataFrame(data, "value binary, came timestamp")
    judged = with_reject_reason(frame, arrival=F.col("came"), ahead="1 day", behind="1 day")
    assert [r[0] for r in rows(accepted(judged), "transaction_id")] == ["0", "2", "n"]
    assert rows(rejected(judged), "transaction_id", "reject_reason") == [("1", "implausible_time"), ("3", "implausible_time")]


def test_a_far_future_row_in_the_fact_does_not_stop_it(spark, sales, tmp_path):
    path = f"{tmp_path}/fact"
    old = sales(sale("a", "10:00"), sale("far", "2099-01-01 00:00"))
    write_days(with_revenue(old), path)
    raw = old.union(sales(sale("b", "10:05"), sale("c", "10:06"), sale("far2", "2098-01-01 00:00")))
    for lookback in (None, "1 hour"):
        refresh_fact(spark, raw, path, lookback)
        assert [r[0] for r in rows(read_days(spark, path, FACT_SCHEMA), "transaction_id")] == ["a", "b", "c", "far"]
    refresh_fact(spark, raw, path, full_refresh=True)
    assert [r[0] for r in rows(read_days(spark, path, FACT_SCHEMA), "transaction_id")] == ["a", "b", "c"]
    refresh_fact(spark, raw, path, as_of="2098-01-01 00:00")
    assert [r[0] for r in rows(read_days(spark, path, FACT_SCHEMA), "transaction_id")] == ["a", "b", "c", "far2"]


class Stop(Exception):
    pass


def dying(monkeypatch, step):
    """Folders whose n-th change raises."""
    left = [step]
    for name in ("drop", "_move"):
        plain = getattr(Folders, name)

        def wrapped(self, *args, plain=plain):
            if left[0] == 0:
                raise Stop
            left[0] -= 1
            return plain(self, *args)

        monkeypatch.setattr(Folders, name, wrapped)


@pytest.mark.parametrize("first_build", [True, False])
@pytest.mark.parametrize("step", [0, 1, 3, 4, 5, 6, 7, 8, 9])
def test_a_full_build_cut_short_anywhere_is_completed(spark, sales, tmp_path, monkeypatch, step, first_build):
    path = f"{tmp_path}/fact"
    wanted = [sale("a", "2024-01-01 00:00"), sale("b", "2024-01-02 00:00"), sale("c", "2024-01-03 00:00")]
    if not first_build:
        refresh_fact(spark, sales(sale("x", "2023-12-01 00:00"), sale("a", "2024-01-01 09:00")), path)
    with monkeypatch.context() as patch:
        dying(patch, step)
        try:
            refresh_fact(spark, sales(*wanted), path, full_refresh=True)
        except Stop:
            pass
    marked = os.path.exists(f"{staging_of(path)}/ready")
    if not first_build and not marked and os.path.exists(staging_of(path)):
        assert {"a", "x"} <= {r[0] for r in rows(read_days(spark, path, FACT_SCHEMA), "transaction_id")}
    finish_upsert(spark, path)
    refresh_fact(spark, sales(*wanted), path, lookback="1 hour", full_refresh=not marked)
    assert [r[0] for r in rows(read_days(spark, path, FACT_SCHEMA), "transaction_id")] == ["a", "b", "c"]


def test_a_full_build_of_nothing_leaves_an_empty_table(spark, sales, tmp_path):
    path = f"{tmp_path}/fact"
    refresh_fact(spark, sales(sale("a", "00:00")), path)
    refresh_fact(spark, sales(), path, full_refresh=True)
    assert read_days(spark, path, FACT_SCHEMA).count() == 0
    refresh_fact(spark, sales(sale("b", "00:00")), path)
    assert read_days(spark, path, FACT_SCHEMA).count() == 1


def test_days_of_odd_years_expire_by_number(spark, tmp_path):
    for day in ("0999-12-31", "2024-01-01", "2024-02-01", "+12024-01-01", "10000-01-01", "__HIVE_DEFAULT_PARTITION__"):
        os.makedirs(f"{tmp_path}/t/{DAY}={day}")
    assert expire_days(spark, f"{tmp_path}/t", "2024-02-02", keep=10) == [f"{DAY}=0999-12-31", f"{DAY}=2024-01-01"]


def marked(table):
    return rows(table, "transaction_id", "transaction_ts", LATE)


LATE_SCHEMA = T.StructType([*RAW_SCHEMA.fields, T.StructField(LATE, T.BooleanType())])


def test_late_rows_come_out_marked_across_a_restart(feed):
    feed.add(sale("a", "00:00"), sale("b", "01:00"), sale("b", "01:00"))
    feed.run(with_lateness(feed.stream()))
    feed.add(sale("late", "00:50"), sale("edge", "00:50:00.001"), sale("a", "02:00"), sale("none", None))
    feed.add(sale("both", "00:10"), sale("both", "03:00"), sale("late", "00:20"))
    feed.run(with_lateness(feed.stream()))
    wanted = [
        ("a", at("00:00"), False), ("b", at("01:00"), False), ("late", at("00:50"), True), ("edge", at("00:50:00.001"), False),
        ("none", None, False), ("both", at("03:00"), False),
    ]
    assert marked(feed.table(schema=LATE_SCHEMA)) == sorted(wanted, key=repr)


def test_keys_of_late_output_are_remembered_without_python(feed):
    feed.add(*[sale(f"k{i}", "00:00") for i in range(50)])
    query = feed.run(with_lateness(feed.stream(), combine=False))
    held = {op["operatorName"]: op["numRowsTotal"] for op in json.loads(query.recentProgress[0].json)["stateOperators"]}
    assert held.pop("dedupe") == 50 and set(held.values()) == {0}


def test_copies_of_a_batch_with_odd_keys(spark, tmp_path):
    shape = "id bigint, x double, raw binary, transaction_ts timestamp, n bigint"
    big = 2**53 + 1
    data = [(big, float("nan"), b"a", at("01:00"), 1), (big, float("nan"), b"a", at("02:00"), big), (big, float("nan"), b"b", None, None), (None, 0.5, None, None, 3), (None, 0.5, None, at("00:10"), 4)]
    spark.createDataFrame(data, shape).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = with_lateness(stream_files(spark, f"{tmp_path}/in", shape), keys=("id", "x", "raw"), combine=False)
    start(stream, append_to(f"{tmp_path}/out"), f"{tmp_path}/cp", {"availableNow": True}, partitions=2).awaitTermination()
    found = spark.read.schema(stream.schema).parquet(f"{tmp_path}/out")
    assert rows(found, "id", "transaction_ts", "n", LATE) == sorted([(big, at("02:00"), big, False), (big, None, None, False), (None, at("00:10"), 4, False)], key=repr)


@pytest.mark.parametrize("combine", [True, False])
def test_a_key_is_forgotten_with_its_window(feed, combine):
    for batch in (["a 00:00"], ["b 01:00"], ["x 01:00"], ["a 00:05", "c 01:01"], ["d 05:00"], ["y 05:00"], ["a 05:01", "c 04:59", "c 01:02"]):
        feed.add(*[sale(*b.split(" ")) for b in batch])
    feed.run(with_lateness(feed.stream(), mode="within_watermark", combine=combine))
    found = [(i, t, late) for i, t, late in marked(feed.table(schema=LATE_SCHEMA)) if i in "ac"]
    # As in Spark's own operator a key goes at the end of the batch that passes it: hence x and y.
    assert found == [("a", at("00:00"), False), ("a", at("00:05"), True), ("a", at("05:01"), False), ("c", at("01:01"), False), ("c", at("04:59"), False)]


def test_the_job_stores_late_rows_apart(spark, tmp_path):
    feed = Messages(spark, tmp_path)
    feed.add((sold("a", "2024-01-01T10:00:00"), "10:00"))
    feed.job(write_late=replace_batch(f"{tmp_path}/late")).run()
    feed.add((sold("late", "2024-01-01T09:00:00"), "10:05"), (sold("b", "2024-01-01T10:06:00"), "10:06"), (sold("a", "2024-01-01T10:00:00"), "10:06"))
    feed.job(write_late=replace_batch(f"{tmp_path}/late")).run()
    assert [r[0] for r in rows(feed.table(), "transaction_id")] == ["a", "b"]
    assert rows(feed.table("late"), "transaction_id", "transaction_ts", DAY) == [("late", at("09:00"), at("00:00").date())]


def test_unknown_mode_is_refused(feed):
    feed.add(sale("a", "00:00"))
    with pytest.raises(ValueError):
        with_lateness(feed.stream(), mode="sometimes")


def message(number, **fields):
    good = {"transaction_id": "a", "store_id": "s", "product_id": "p", "quantity": 1, "price": 2.0, "transaction_ts": "2024-01-01T00:00:00Z"}
    return bytearray(b"\x00" + number.to_bytes(4, "big") + json.dumps({k: v for k, v in (good | fields).items() if v != "drop"}).encode())


def test_each_writer_is_read_by_its_own_schema(spark):
    narrow = T.StructType([f for f in wire_schema().fields if f.name not in ("payment_type", "price")] + [T.StructField("cost", T.StringType())])
    versions = {1: Writer(wire_schema()), 300: Writer(narrow, {"price": "cost"}, {"payment_type": "cash"})}
    messages = {
        "known": message(1, payment_type="card"),
        "null stays": message(1, payment_type=None),
        "renamed": message(300, price="drop", cost="3.5"),
        "unreadable": message(300, price="drop", cost="much"),
        "not of this writer": message(300),
        "unknown": message(2),
        "short": bytearray(b"\x00\x00"),
        "bad": bytearray(b"\x00" + (300).to_bytes(4, "big") + b"not json"),
        "empty": bytearray(b"\x00" + (300).to_bytes(4, "big")),
    }
    frame = spark.createDataFrame(list(messages.items()), "name string, value binary")
    judged = with_reject_reason(frame, keep=["name"], versions=versions)
    found = {r["name"]: (r["reject_reason"], r["price"], r["payment_type"]) for r in judged.collect()}
    assert found == {
        "known": (None, 2.0, "card"),
        "null stays": (None, 2.0, None),
        "renamed": (None, 3.5, "cash"),
        "unreadable": ("missing_required", None, "cash"),
        "not of this writer": ("missing_required", None, "cash"),
        "unknown": ("unknown_schema", None, None),
        "short": ("not_framed", None, None),
        "bad": ("undecodable", None, None),
        "empty": ("undecodable", None, None),
    }


def test_a_message_is_decoded_once(spark):
    frame = spark.createDataFrame([(message(1),)], "value binary")
    plan = with_reject_reason(frame, versions={1: Writer(wire_schema()), 2: Writer(wire_schema())})
    assert accepted(plan)._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 2

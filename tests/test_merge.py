import glob
import os
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import at, rows, sale
from tillstream.operators import merge
from tillstream.operators.merge import expire_days, finish_upsert, merge_into, merged, staging_of, upsert_days, write_days
from tillstream.operators.selection import history, newer_than, recent
from tillstream.plans.fact import refresh_fact
from tillstream.sources import views
from tillstream.sources.folders import Folders
from tillstream.sources.readers import read_days, table_exists
from tillstream.sources.schemas import DAY, FACT_SCHEMA, RAW_SCHEMA


def contents(spark, path):
    return rows(read_days(spark, path, RAW_SCHEMA), "transaction_id", "price", "transaction_ts")


@pytest.fixture()
def table(spark, sales, tmp_path):
    path = f"{tmp_path}/table"
    upsert_days(
        spark, path, sales(sale("a", "2024-01-01 01:00"), sale("b", "2024-01-02 01:00"), sale("c", "2024-01-02 02:00")), RAW_SCHEMA
    )
    return path


def test_merged_takes_the_first_update_and_is_repeatable(sales):
    target = sales(sale("a", "00:00"), sale("b", "00:00"))
    updates = sales(sale("b", "02:00", price=9.0), sale("b", "01:00", price=8.0), sale("c", "03:00"))
    once = merged(target, updates)
    wanted = [("a", 1.0), ("b", 8.0), ("c", 1.0)]
    assert rows(once, "transaction_id", "price") == wanted
    assert rows(merged(once, updates), "transaction_id", "price") == wanted


def test_first_upsert_creates_the_table_without_duplicates(spark, sales, tmp_path):
    path = f"{tmp_path}/new"
    assert not table_exists(spark, path)
    upsert_days(spark, path, sales(sale("a", "02:00", price=2.0), sale("a", "01:00")), RAW_SCHEMA)
    assert table_exists(spark, path)
    assert contents(spark, path) == [("a", 1.0, at("01:00"))]


def test_upsert_rewrites_only_touched_days(spark, sales, table):
    files = {day: set(glob.glob(f"{table}/{DAY}={day}/*.parquet")) for day in ("2024-01-01", "2024-01-02")}
    updates = sales(sale("b", "2024-01-02 01:00", price=5.0), sale("d", "2024-01-03 00:00"))
    for _ in range(2):
        upsert_days(spark, table, updates, RAW_SCHEMA)
        assert contents(spark, table) == [
            ("a", 1.0, at("2024-01-01 01:00")), ("b", 5.0, at("2024-01-02 01:00")), ("c", 1.0, at("2024-01-02 02:00")),
            ("d", 1.0, at("2024-01-03 00:00")),
        ]
    assert set(glob.glob(f"{table}/{DAY}=2024-01-01/*.parquet")) == files["2024-01-01"]
    assert not set(glob.glob(f"{table}/{DAY}=2024-01-02/*.parquet")) & files["2024-01-02"]


def test_row_that_moves_to_another_day_leaves_the_old_one(spark, sales, table):
    upsert_days(spark, table, sales(sale("b", "2024-01-05 00:00", price=7.0)), RAW_SCHEMA)
    assert contents(spark, table) == [
        ("a", 1.0, at("2024-01-01 01:00")), ("b", 7.0, at("2024-01-05 00:00")), ("c", 1.0, at("2024-01-02 02:00")),
    ]


def test_day_that_loses_its_last_row_is_emptied(spark, sales, table):
    upsert_days(spark, table, sales(sale("a", "2024-01-02 03:00")), RAW_SCHEMA)
    assert [r[0] for r in contents(spark, table)] == ["a", "b", "c"]
    assert read_days(spark, table, RAW_SCHEMA).where(F.col(DAY) == "2024-01-01").count() == 0


def test_rows_without_a_time_are_kept_and_found(spark, sales, table):
    upsert_days(spark, table, sales(sale("n", None), sale("m", None)), RAW_SCHEMA)
    upsert_days(spark, table, sales(sale("o", None)), RAW_SCHEMA)
    assert [r[0] for r in contents(spark, table)] == ["a", "b", "c", "m", "n", "o"]
    upsert_days(spark, table, sales(*[sale(i, "2024-01-02 05:00") for i in "mno"]), RAW_SCHEMA)
    assert [r[0] for r in contents(spark, table)] == ["a", "b", "c", "m", "n", "o"]
    assert read_days(spark, table, RAW_SCHEMA).where(F.col(DAY).isNull()).count() == 0


def test_random_upserts_against_a_dictionary(spark, sales, tmp_path):
    random.seed(11)
    path, wanted = f"{tmp_path}/random", {}
    for _ in range(5):
        updates = [
            sale(f"k{random.randrange(12)}", f"2024-01-0{random.randrange(1, 6)} 0{random.randrange(5)}:00", price=float(random.randrange(9)))
            for _ in range(random.randrange(1, 9))
        ]
        first = {}
        for row in sorted(updates, key=lambda r: (r[6], r[4])):
            first.setdefault(row[0], row)
        wanted |= first
        upsert_days(spark, path, sales(*updates), RAW_SCHEMA)
        assert contents(spark, path) == sorted(((r[0], r[4], r[6]) for r in wanted.values()), key=repr)


def test_no_updates_change_nothing(spark, sales, table):
    before = contents(spark, table)
    upsert_days(spark, table, sales(), RAW_SCHEMA)
    assert contents(spark, table) == before


def test_day_filter_prunes_partitions(spark, table):
    frame = read_days(spark, table, RAW_SCHEMA).where(F.col(DAY) == "2024-01-02")
    assert frame.count() == 2
    assert f"PartitionFilters: [isnotnull({DAY}" in frame._jdf.queryExecution().executedPlan().toString()


def test_time_filters_prune_days(spark, sales, table):
    frame = read_days(spark, table, RAW_SCHEMA)
    for found, ids in (
        (recent(frame, "2024-01-02 02:00", "1 hour"), ["b", "c"]),
        (history(frame, "2024-01-02 02:00", "2 days", "1 hour"), ["a"]),
        (newer_than(frame, sales(sale("x", "2024-01-02 01:30"))), ["c"]),
        (newer_than(frame, frame, "1 hour"), ["c"]),
    ):
        assert [r[0] for r in rows(found, "transaction_id")] == ids
        plan = found._jdf.queryExecution().executedPlan().toString()
        filters = plan[plan.index("PartitionFilters: [") :].split("]")[0]
        assert f"{DAY}#" in filters


def test_expired_days_are_emptied_and_others_left_alone(spark, table):
    kept = set(glob.glob(f"{table}/{DAY}=2024-01-02/*.parquet"))
    assert expire_days(spark, table, "2024-01-12 12:00", keep=10) == [f"{DAY}=2024-01-01"]
    assert [r[0] for r in contents(spark, table)] == ["b", "c"]
    assert set(glob.glob(f"{table}/{DAY}=2024-01-02/*.parquet")) == kept


def test_files_are_sorted_by_time(spark, sales, tmp_path):
    write_days(sales(*[sale(str(i), f"0{9 - i % 10}:00") for i in range(10)]), f"{tmp_path}/t")
    (file,) = glob.glob(f"{tmp_path}/t/*/*.parquet")
    times = [r[0] for r in spark.read.parquet(file).select("transaction_ts").collect()]
    assert times == sorted(times)


def test_busy_day_is_cut_into_several_files(spark, tmp_path):
    busy = views.sales(views.events(spark, "/root/testdata/sf0.001")).select(*RAW_SCHEMA.names)
    busy = busy.withColumn("transaction_ts", F.lit("2024-01-01").cast("timestamp")).repartition(4)
    advised = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(advised, "8k")
    try:
        write_days(busy, f"{tmp_path}/busy")
    finally:
        spark.conf.unset(advised)
    assert len(glob.glob(f"{tmp_path}/busy/*/*.parquet")) > 1
    write_days(busy, f"{tmp_path}/small")
    assert len(glob.glob(f"{tmp_path}/small/*/*.parquet")) == 1


def test_refresh_fact_runs(spark, sales, tmp_path):
    path = f"{tmp_path}/fact"
    raw = [sale("a", "2024-01-01 00:00", quantity=2, price=3.0), sale("b", "2024-01-02 00:00")]

    def fact():
        return rows(read_days(spark, path, FACT_SCHEMA), "transaction_id", "revenue")

    refresh_fact(spark, sales(*raw), path)
    assert fact() == [("a", 6.0), ("b", 1.0)]
    raw += [sale("late", "2024-01-01 23:30", price=4.0), sale("tie", "2024-01-02 00:00"), sale("c", "2024-01-02 00:00:01")]
    refresh_fact(spark, sales(*raw), path)
    assert fact() == [("a", 6.0), ("b", 1.0), ("c", 1.0)]
    refresh_fact(spark, sales(*raw), path, lookback="1 hour")
    assert fact() == [("a", 6.0), ("b", 1.0), ("c", 1.0), ("late", 4.0), ("tie", 1.0)]
    refresh_fact(spark, sales(*raw[:1]), path, full_refresh=True)
    assert fact() == [("a", 6.0)]
    assert os.path.exists(path)


def test_merge_statement_needs_a_row_level_format(spark, sales, tmp_path):
    spark.sql(f"CREATE TABLE plain_fact (transaction_id string, transaction_ts timestamp) USING parquet LOCATION '{tmp_path}/p'")
    try:
        with pytest.raises(PySparkException, match="MERGE"):
            merge_into(sales(sale("a", "00:00")).select("transaction_id", "transaction_ts"), "plain_fact")
    finally:
        spark.sql("DROP TABLE plain_fact")


def test_days_without_a_match_only_get_files_added(spark, sales, table):
    before = {d: set(glob.glob(f"{table}/{DAY}={d}/*.parquet")) for d in ("2024-01-01", "2024-01-02")}
    upsert_days(spark, table, sales(sale("x", "2024-01-01 05:00"), sale("y", "2024-01-02 05:00"), sale("y", "2024-01-02 06:00")), RAW_SCHEMA)
    assert [r[0] for r in contents(spark, table)] == ["a", "b", "c", "x", "y"]
    for day, files in before.items():
        assert files < set(glob.glob(f"{table}/{DAY}={day}/*.parquet"))
    assert not os.path.exists(staging_of(table))


class Stop(Exception):
    pass


UPDATES = (
    sale("a", "2024-01-01 09:00", price=7.0), sale("b", "2024-01-04 00:00", price=8.0), sale("c", "2024-01-04 00:00"),
    sale("d", "2024-01-03 00:00"), sale("e", "2024-01-01 03:00"), sale("f", "2024-01-05 00:00"),
)


@pytest.mark.parametrize("step", range(9))
def test_an_upsert_cut_short_anywhere_is_completed(spark, sales, table, monkeypatch, step):
    """The run dies before its n-th change to a folder, in mid-swap too; then it is repeated."""
    left = [step]

    def dying(name):
        plain = getattr(Folders, name)

        def wrapped(self, *args):
            if "_staged" in str(args[0]) and name == "drop" and left[0] > 99:
                return plain(self, *args)
            if left[0] == 0:
                raise Stop
            left[0] -= 1
            return plain(self, *args)

        return wrapped

    with monkeypatch.context() as patch:
        for name in ("drop", "_move"):
            patch.setattr(Folders, name, dying(name))
        try:
            upsert_days(spark, table, sales(*UPDATES), RAW_SCHEMA)
        except Stop:
            pass
    upsert_days(spark, table, sales(*UPDATES), RAW_SCHEMA)
    wanted = [(r[0], r[4], r[6]) for r in UPDATES]
    assert contents(spark, table) == sorted(wanted)
    assert read_days(spark, table, RAW_SCHEMA).where(F.col(DAY) == "2024-01-02").count() == 0


def test_a_fact_run_cut_short_loses_no_day(spark, sales, tmp_path, monkeypatch):
    path = f"{tmp_path}/fact"
    raw = sales(sale("a", "2024-01-01 00:00"), sale("b", "2024-01-01 01:00"))
    refresh_fact(spark, raw, path)
    more = raw.union(sales(sale("c", "2024-01-02 00:00"), sale("d", "2024-01-03 00:00"), sale("e", "2024-01-04 00:00")))

    def only_the_newest(self, source, target):
        if source.endswith("2024-01-04"):
            plain(self, source, target)
        else:
            seen.append(source)

    plain, seen = Folders.add_files, []
    with monkeypatch.context() as patch:
        patch.setattr(Folders, "add_files", only_the_newest)
        drop = Folders.drop
        patch.setattr(Folders, "drop", lambda self, p: drop(self, p) if "ready" not in p and not (seen and p.endswith("_staged")) else None)
        refresh_fact(spark, more, path)
    assert len([s for s in seen if "/more/" in s]) == 2
    refresh_fact(spark, more, path)
    assert rows(read_days(spark, path, FACT_SCHEMA), "transaction_id") == [("a",), ("b",), ("c",), ("d",), ("e",)]


@pytest.mark.parametrize("zone", ["Asia/Tokyo", "America/New_York"])
def test_days_do_not_depend_on_the_session_zone(spark, sales, tmp_path, zone):
    path = f"{tmp_path}/zoned"
    frame = sales(sale("a", "2024-01-01 21:00"), sale("b", "2024-01-02 03:00"))
    upsert_days(spark, path, frame, RAW_SCHEMA, keys_fix_day=True)
    moment = lambda text: F.to_timestamp(F.lit(f"{text}Z"))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        upsert_days(spark, path, read_days(spark, path, RAW_SCHEMA).select(*RAW_SCHEMA.names), RAW_SCHEMA, keys_fix_day=True)
        table = read_days(spark, path, RAW_SCHEMA)
        assert table.count() == 2
        assert [r[0] for r in rows(recent(table, moment("2024-01-01 22:00:00"), "2 hours"), "transaction_id")] == ["a", "b"]
        assert [r[0] for r in rows(history(table, moment("2024-01-02 00:00:00"), "1 day", "1 hour"), "transaction_id")] == ["a"]
        old = table.where(F.col("transaction_id") == "a")
        assert [r[0] for r in rows(newer_than(table, old, "1 hour"), "transaction_id")] == ["a", "b"]
        assert [r[0] for r in rows(newer_than(table, old), "transaction_id")] == ["b"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_nothing_staged_is_nothing_to_finish(spark, table):
    before = contents(spark, table)
    finish_upsert(spark, table)
    os.makedirs(f"{staging_of(table)}/{merge.WHOLE_DAYS}/{DAY}=2024-01-01")
    finish_upsert(spark, table)
    assert contents(spark, table) == before

import contextlib
import io
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import at, rows, sale
from tillstream.functions.columns import plain_number
from tillstream.operators import aggregates, keys, lateness, reconcile, reports, selection
from tillstream.plans.fact import build_fact, with_revenue
from tillstream.sources import views
from tillstream.sources.readers import high_water, read_table

SF = "/root/testdata/sf0.001"


def plan_of(frame) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain("formatted")
    return out.getvalue()


# --- selection ---------------------------------------------------------------


def test_history_is_closed_open_and_recent_is_open_ended(sales):
    frame = sales(
        sale("a", "2024-01-01 12:00"), sale("b", "2024-01-08 10:59:59"), sale("c", "2024-01-08 11:00"),
        sale("d", "2024-01-09 00:00"), sale("n", None),
    )
    as_of = at("2024-01-08 12:00")
    assert rows(selection.history(frame, as_of), "transaction_id") == [("a",), ("b",)]
    assert rows(selection.recent(frame, as_of), "transaction_id") == [("c",), ("d",)]
    assert rows(selection.recent(frame, F.lit(as_of)), "transaction_id") == [("c",), ("d",)]
    assert selection.recent(frame).count() == 0  # now


def test_rows_with_nulls_ignores_payment(sales):
    frame = sales(sale("a", "00:00", payment=None), sale("b", "00:00", store=None), sale(None, "00:00"))
    assert rows(selection.rows_with_nulls(frame), "transaction_id") == [("b",), (None,)]


def test_newer_than_ties_lookback_and_empty_target(sales):
    target = sales(sale("a", "01:00"))
    frame = sales(sale("b", "01:00"), sale("c", "01:00:01"), sale("d", "00:30"))
    assert rows(selection.newer_than(frame, target), "transaction_id") == [("c",)]
    assert rows(selection.newer_than(frame, target, "1 hour"), "transaction_id") == [("b",), ("c",), ("d",)]
    assert selection.newer_than(frame, sales()).count() == 3


def test_time_filters_reach_the_scan(spark):
    sales = views.sales(views.events(spark, SF))
    recent = plan_of(selection.recent(sales, "2024-01-30").select("price"))
    assert "GreaterThanOrEqual(ts" in recent and "ReadSchema: struct<ts:timestamp,value:double>" in recent
    newer = selection.newer_than(sales, sales.where("transaction_ts < '2024-01-20'")).select("price")
    newer.collect()
    assert "(ts#" in plan_of(newer) and "Join" not in plan_of(newer)


def test_high_water_reads_one_partition(spark, sales, tmp_path):
    frame = sales(sale("a", "2024-01-01 01:00"), sale("b", "2024-01-03 02:00"), sale("c", "2024-01-03 01:00"))
    frame.withColumn("day", F.to_date("transaction_ts")).write.partitionBy("day").parquet(f"{tmp_path}/t")
    table = read_table(spark, f"{tmp_path}/t")
    newest = high_water(table, day="day")
    assert newest.first()[0] == datetime(2024, 1, 3, 2)
    assert "PartitionFilters: [isnotnull(day" in newest._jdf.queryExecution().executedPlan().toString()
    assert high_water(sales()).first()[0] is None


# --- aggregates --------------------------------------------------------------


def test_window_edge_belongs_to_the_next_window(sales):
    found = aggregates.store_windows(sales(sale("a", "00:04:59"), sale("b", "00:05:00"), sale("c", "00:09:59", price=2.5)))
    assert rows(found) == [
        (at("00:00"), at("00:05"), "store_1", 1.0, 1),
        (at("00:05"), at("00:10"), "store_1", 3.5, 2),
    ]
    assert found.columns == ["window_start", "window_end", "store_id", "total_revenue", "total_quantity"]


def test_sums_of_nulls_stay_null(sales):
    found = aggregates.store_windows(sales(sale("a", "00:00", price=None), sale("b", "00:00", store=None, quantity=None)))
    assert rows(found, "store_id", "total_revenue", "total_quantity") == [("store_1", None, 1), (None, None, None)]


def test_hourly_stats_of_one_hour_has_no_deviation(sales):
    row = aggregates.hourly_stats(sales(sale("a", "00:00"), sale("b", "00:30"))).first()
    assert (row["hours"], row["mean_volume"], row["stddev_volume"]) == (1, 2.0, None)


def test_recent_hourly_volume_is_newest_first(sales):
    frame = sales(sale("a", "2024-01-01 00:00"), sale("b", "2024-01-02 01:10"), sale("c", "2024-01-02 03:00"))
    found = aggregates.recent_hourly_volume(frame, "2024-01-02 12:00").collect()
    assert [r["hr"].hour for r in found] == [3, 1]


def test_aggregates_combine_before_the_shuffle(spark):
    plan = plan_of(aggregates.store_windows(views.sales(views.events(spark, SF))))
    assert plan.count("partial_sum") > 0 and plan.count("- Exchange (") == 1


# --- keys --------------------------------------------------------------------


def test_duplicates_count_keys(sales):
    frame = sales(*[sale("a", "00:00")] * 3, sale("b", "00:00"), sale(None, "00:00"), sale(None, "00:01"))
    assert rows(keys.duplicate_keys(frame)) == [("a", 3), (None, 2)]
    assert len(keys.duplicate_sample(sales(*[sale(str(i % 20), "00:00") for i in range(40)])).collect()) == 10


def test_first_occurrence_against_brute_force(sales):
    random.seed(3)
    data = [
        sale("hot" if random.random() < 0.4 else f"k{random.randrange(40)}", f"0{random.randrange(3)}:{random.randrange(60):02d}",
             price=float(random.randrange(5)))
        for _ in range(600)
    ]
    best = {}
    for row in data:
        rank = (row[6], *[str(v) for v in row[1:6]])
        if row[0] not in best or rank < best[row[0]][0]:
            best[row[0]] = (rank, row)
    found = keys.first_occurrence(sales(*data))
    assert rows(found) == sorted((row for _, row in best.values()), key=repr)
    plan = plan_of(found)
    assert plan.count("WindowGroupLimit") >= 2  # one of them ahead of the exchange


def test_first_occurrence_prefers_rows_with_a_time(sales):
    assert keys.first_occurrence(sales(sale("a", None), sale("a", "05:00"))).first()["transaction_ts"] == at("05:00")


def test_new_keys(sales):
    found = keys.new_keys(sales(sale("a", "00:00"), sale("b", "00:00"), sale("b", "00:01")), sales(sale("a", "09:00")))
    assert rows(found, "transaction_id") == [("b",), ("b",)]


# --- fact --------------------------------------------------------------------


def test_fact_runs(sales):
    first = build_fact(sales(sale("a", "00:00", quantity=2, price=3.0), sale("a", "00:05", price=9.0)))
    assert rows(first, "transaction_id", "revenue") == [("a", 6.0)]
    raw = sales(sale("a", "00:00"), sale("b", "00:30", price=5.0), sale("b", "00:40", price=7.0), sale("late", "23:59"))
    later = build_fact(raw.where("transaction_id <> 'late'"), first)
    assert rows(later, "transaction_id", "revenue") == [("a", 6.0), ("b", 5.0)]
    assert build_fact(raw, first, full_refresh=True).count() == 3
    assert build_fact(raw, with_revenue(sales())).count() == 3  # empty target: full build


def test_merge_keeps_unmatched_null_keys(sales):
    target = with_revenue(sales(sale(None, "00:00"), sale("a", "00:00")))
    found = build_fact(sales(sale("b", "01:00")), target)
    assert rows(found, "transaction_id") == [("a",), ("b",), (None,)]


# --- lateness ----------------------------------------------------------------


@pytest.mark.parametrize("block", [2, 3, 100])
def test_running_max_in_blocks(spark, block):
    random.seed(block)
    slots = sorted(random.sample(range(60), 25))
    data = [(s, random.randrange(1000)) for s in slots]
    found = lateness.running_max(spark.createDataFrame(data, "slot int, value int"), "slot", "value", block)
    wanted = [(s, max((v for t, v in data if t < s), default=None)) for s in slots]
    assert sorted(tuple(r) for r in found.collect()) == wanted


def test_late_rows_against_brute_force(spark):
    random.seed(1)
    start = at("00:00")
    data = [(i, start + timedelta(minutes=i + random.choice([0, 0, 0, -25]), microseconds=random.randrange(999))) for i in range(300)]
    frame = spark.createDataFrame(data, "n int, transaction_ts timestamp")
    found = lateness.late_rows(frame, F.floor(F.col("n") / 10))
    wanted = []
    for n, ts in data:
        before = [t for m, t in data if m // 10 < n // 10]
        if before:
            top = max(before)
            mark = top.replace(microsecond=top.microsecond // 1000 * 1000) - timedelta(minutes=10)
            if ts <= mark:
                wanted.append(n)
    assert wanted and sorted(r["n"] for r in found.collect()) == wanted


# --- reports and reconciliation ------------------------------------------------


def test_top_products_breaks_ties_by_id(sales):
    frame = sales(*[sale(str(i), "00:00", product=f"product_{i}", price=5.0) for i in (3, 1, 2)])
    assert [r["product_id"] for r in reports.top_products(frame, 2).collect()] == ["product_1", "product_2"]


def test_payment_split_scans_once(spark, sales):
    found = reports.payment_split(sales(sale("a", "00:00", price=3.0), sale("b", "00:00", payment=None)))
    assert rows(found) == [("cash", 1, 3.0, 0.5, 0.75), (None, 1, 1.0, 0.5, 0.25)]
    split = reports.payment_split(views.sales(views.events(spark, SF)))
    split.collect()
    assert "ReusedExchange" in split._jdf.queryExecution().executedPlan().toString()


def test_bands_staging_retention_status(sales):
    fact = with_revenue(sales(sale("a", "00:00", price=5.0), sale("b", "00:00", price=50.0), sale("c", "00:00", price=None)))
    banded = reports.with_revenue_band(fact, [("low", 50.0)], "high")
    assert rows(banded, "transaction_id", "revenue_band") == [("a", "low"), ("b", "high"), ("c", None)]
    clean = reports.staging(sales(sale(" a ", "00:00", payment=" Cash"))).first()
    assert (clean["transaction_id"], clean["payment_type"]) == ("a", "cash")
    kept = selection.keep_last(sales(sale("a", "2024-01-01 00:00"), sale("b", "2024-04-01 00:00")), "2024-05-01", 90)
    assert rows(kept, "transaction_id") == [("b",)]
    status = reports.table_status({"x": (fact, "transaction_ts"), "y": (sales(), "transaction_ts")})
    assert rows(status) == [("x", 3, at("00:00")), ("y", 0, None)]


def test_reconcile_reports_hours_of_either_side(sales):
    source = sales(*[sale(str(i), "00:10") for i in range(4)], sale("x", "01:00"))
    sink = sales(*[sale(str(i), "00:10") for i in range(3)], sale("y", "02:00"))
    found = reconcile.reconcile_hourly(source, sink)
    assert rows(found) == [
        (at("00:00"), 4, 3, 0.75, "FAIL"), (at("01:00"), 1, 0, 0.0, "FAIL"), (at("02:00"), 0, 1, 0.0, "FAIL"),
    ]


def test_plain_number(spark):
    frame = spark.createDataFrame([(12345678.9,), (4.0,), (0.05,), (-3.1,)], "x double")
    assert [r[0] for r in frame.select(plain_number(F.col("x"), 2)).collect()] == ["12345678.9", "4.0", "0.05", "-3.1"]


def test_late_rows_scan_their_input_twice(spark):
    frame = views.sales(views.events(spark, SF)).withColumn("arrived", F.col("transaction_ts"))
    found = lateness.late_rows(frame, F.floor(F.unix_seconds("arrived") / 3600))
    found.collect()
    final = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 2 and final.count("ReusedExchange") == 1

from datetime import timedelta
from statistics import mean, stdev

import pytest

from tests.conftest import at, rows, sale
from tillstream.operators import column_tests, quality
from tillstream.plans.fact import with_revenue
from tillstream.sources.schemas import PAYMENT_TYPES

AS_OF = at("2024-01-08 12:00")


def hours(counts, start="2024-01-08 00:00", price=1.0):
    """`counts[i]` sales in the i-th hour."""
    first = at(start)
    return [
        sale(f"h{i}_{n}", str(first + timedelta(hours=i, seconds=n)), price=price)
        for i, count in enumerate(counts)
        for n in range(count)
    ]


def current(count, price=1.0):
    return [sale(f"c{n}", str(AS_OF - timedelta(minutes=30) + timedelta(seconds=n)), price=price) for n in range(count)]


def volume(frame, **options):
    return tuple(quality.volume_check(frame, AS_OF, **options).first())


def test_no_history_passes(sales):
    assert volume(sales(*current(5))) == ("PASS", 5, None, None, 0.0)
    assert volume(sales()) == ("PASS", 0, None, None, 0.0)


def test_one_history_hour_has_no_deviation(sales):
    assert volume(sales(*hours([4]), *current(90))) == ("PASS", 90, 4.0, None, 0.0)


def test_flat_history_passes(sales):
    assert volume(sales(*hours([4, 4, 4]), *current(90))) == ("PASS", 90, 4.0, 0.0, 0.0)


def test_three_deviations_exactly_pass_and_more_fails(sales):
    history = hours([1, 2, 3])  # mean 2, deviation 1
    assert volume(sales(*history, *current(5))) == ("PASS", 5, 2.0, 1.0, 3.0)
    assert volume(sales(*history, *current(6))) == ("FAIL", 6, 2.0, 1.0, 4.0)


def test_quiet_current_hour(sales):
    frame = sales(*hours([1, 2, 3], price=10.0))
    assert volume(frame) == ("PASS", 0, 2.0, 1.0, -2.0)
    assert tuple(quality.revenue_check(frame, AS_OF).first()) == ("PASS", 0.0, 20.0, 10.0, -2.0)


def test_later_rows_count_as_current_unless_bounded(sales):
    later = [sale(f"x{n}", "2024-01-09 00:00") for n in range(9)]
    frame = sales(*hours([1, 2, 3]), *current(2), *later)
    assert volume(frame)[:2] == ("FAIL", 11)
    assert volume(frame, bounded=True)[:2] == ("PASS", 2)


def test_history_skips_empty_hours_unless_filled(sales):
    frame = sales(*hours([9, 0, 9]), *current(4))
    assert volume(frame)[:4] == ("PASS", 4, 9.0, 0.0)
    counts = [9, 9] + [0] * 165
    mu, sigma = mean(counts), stdev(counts)
    wanted = ("FAIL", 4, round(mu, 1), round(sigma, 1), round((4 - mu) / sigma, 2))
    assert volume(frame, zero_fill=True) == wanted


def test_history_ends_an_hour_before(sales):
    edge = sale("e", str(AS_OF - timedelta(hours=1)))
    start = sale("s", str(AS_OF - timedelta(days=7)))
    before = sale("b", str(AS_OF - timedelta(days=7, seconds=1)))
    assert volume(sales(edge, start, before))[1:3] == (1, 1.0)


def test_null_and_duplicate_checks(sales):
    clean = sales(sale("a", "00:00", payment=None), sale("b", "00:00"))
    assert rows(quality.null_check(clean)) == [("PASS", 0)]
    assert rows(quality.duplicate_check(clean)) == [("PASS", 0)]
    dirty = sales(*[sale("a", "00:00")] * 3, sale("b", None), sale("c", "00:00", quantity=None))
    assert rows(quality.null_check(dirty)) == [("FAIL", 2)]
    assert rows(quality.duplicate_check(dirty)) == [("FAIL", 1)]


def test_summary_lists_failures_in_order(sales):
    frame = sales(
        *hours([1, 2, 3], price=10.0), *current(9, price=20.5), sale("c0", "2024-01-08 11:59"), sale(None, "2024-01-08 11:59")
    )
    report = quality.check_report(frame, AS_OF)
    assert [r["status"] for r in report.orderBy("position").collect()] == ["FAIL"] * 4
    wanted = (
        "FAIL: null_check FAIL: 1 null rows | duplicate_check FAIL: 1 duplicate transaction_ids"
        " | volume_anomaly FAIL: current=11, mean=2.0, sigma=1.0, z_score=9.0"
        " | revenue_anomaly FAIL: current=186.5, mean=20.0, sigma=10.0, z_score=16.65"
    )
    assert quality.summary(report).first()["summary"] == wanted
    assert rows(quality.alerts(report)) == [("ALERT_SENT", wanted)]
    assert quality.run_checks(frame, AS_OF) == wanted
    with pytest.raises(quality.QualityError):
        quality.run_checks(frame, AS_OF, raise_on_fail=True)


def test_summary_of_clean_and_empty_tables(sales):
    for frame in (sales(*hours([1, 2, 3]), *current(2)), sales()):
        report = quality.check_report(frame, AS_OF)
        assert report.count() == 4
        assert rows(quality.summary(report)) == [("PASS",)]
        assert rows(quality.alerts(report)) == [("NO_ALERT", None)]
    assert quality.run_checks(sales(), AS_OF, raise_on_fail=True) == "PASS"


def test_report_agrees_with_single_checks(sales):
    frame = sales(*hours([1, 2, 3, 0, 2]), *current(30))
    for options in ({}, {"bounded": True}, {"zero_fill": True}):
        report = {r["check_name"]: r["status"] for r in quality.check_report(frame, AS_OF, **options).collect()}
        assert report["volume_anomaly"] == quality.volume_check(frame, AS_OF, **options).first()[0]
        assert report["revenue_anomaly"] == quality.revenue_check(frame, AS_OF, **options).first()[0]


def test_freshness(sales):
    assert rows(quality.freshness(sales(sale("a", "2024-01-08 11:45")), AS_OF)) == [("PASS", 1)]
    assert rows(quality.freshness(sales(sale("a", "2024-01-08 11:44")), AS_OF)) == [("WARN", 0)]


@pytest.mark.parametrize("time, status", [("11:45", "pass"), ("11:44", "warn"), ("11:30", "warn"), ("11:29", "error")])
def test_source_freshness(sales, time, status):
    assert quality.source_freshness(sales(sale("a", f"2024-01-08 {time}")), AS_OF).first()["freshness_status"] == status


def test_source_freshness_of_nothing(sales):
    assert quality.source_freshness(sales(), AS_OF).first()["freshness_status"] == "error"


def test_column_tests(sales):
    frame = sales(
        sale("a", "00:00", payment="Cash"), sale("a", "00:00", payment=None), sale(None, "00:00", payment="Cash"),
        sale(None, "00:00", payment="bitcoin"),
    )
    assert rows(column_tests.repeated_values(frame, ["transaction_id"])) == [("a", 2)]
    assert rows(column_tests.unexpected_values(frame, "payment_type", PAYMENT_TYPES)) == [("Cash", 2), ("bitcoin", 1)]
    assert rows(column_tests.null_counts(frame, ["transaction_id", "store_id"])) == [
        ("store_id", 0), ("transaction_id", 2),
    ]
    suite = column_tests.run_suite(with_revenue(frame), column_tests.FACT_TESTS)
    failing = rows(suite.where("status = 'FAIL'"), "column_name", "test_name", "failures")
    assert failing == [
        ("payment_type", "accepted_values", 2), ("transaction_id", "not_null", 2), ("transaction_id", "unique", 1),
    ]
    assert suite.count() == 9
    with pytest.raises(ValueError):
        column_tests.run_suite(frame, {"price": ["positive"]})


def test_orphans(sales):
    child = sales(sale("a", "00:00"), sale("b", "00:00"), sale(None, "00:00"))
    parent = sales(sale("a", "00:00"), sale("a", "00:01"))
    assert rows(column_tests.orphans(child, parent, "transaction_id"), "transaction_id") == [("b",)]

import pytest

from driver.tables import CATALOG_PRICES
from tests import frames
from tests.frames import acquisition, at, event, page_view
from valuelens import schemas
from valuelens.functions.hours import HOUR, Hours, boost_hours
from valuelens.operators.lookup import Lookup
from valuelens.operators.prices import boost_prices, price_dimension
from valuelens.plans.boosts import (
    active_boosts,
    boost_candidates,
    boost_entries,
    boost_records,
    passes_threshold,
    sequential_entries,
)

RATES = [("2024-01-01", "GBP", 0.8), ("2024-01-01", "EUR", 1.0)]
URL = "https://www.example.com/a"
NOW = at("2024-01-02T12:20")


def candidates(spark, views, acquired, hours=None, prices=None, **gates):
    found = boost_candidates(
        frames.page_views(spark, *views),
        frames.acquisitions(spark, *acquired),
        frames.rates(spark, *RATES),
        prices or boost_prices(spark),
        hours,
        **gates,
    )
    return found


def views(number, time="2024-01-02T09:30:00", **options):
    return [page_view("2024-01-02", [event(time)] * number, **options)]


def test_gates_are_strict(spark):
    acquired = [acquisition("2024-01-02T09:30:00", amount=100.0)]
    hours = boost_hours(NOW)
    assert candidates(spark, views(100), acquired, hours).count() == 0
    [row] = candidates(spark, views(101), acquired, hours).collect()
    assert (row.url, row.region, row.totalViews, row.totalAcquisitions) == (URL, "GB", 101, 1)
    assert row.totalAv == pytest.approx(80) and row.avPerView == pytest.approx(80 / 101)
    forty = [acquisition("2024-01-02T09:30:00", currency="EUR", amount=50.0)]
    assert candidates(spark, views(101), forty, hours).count() == 0


def test_an_article_needs_views_and_acquisitions_in_the_same_region(spark):
    other = [acquisition("2024-01-02T09:30:00", amount=100.0, country="DE")]
    gates = dict(min_views=-1, min_value=-1)
    assert candidates(spark, views(5), other, boost_hours(NOW), **gates).count() == 0
    assert candidates(spark, views(5), [], boost_hours(NOW), **gates).count() == 0
    assert candidates(spark, [], other, boost_hours(NOW), **gates).count() == 0


def test_missing_addresses_do_not_match(spark):
    acquired = [acquisition("2024-01-02T09:30:00", amount=100.0, url=None)]
    hidden = views(5, host=None)
    assert candidates(spark, hidden, acquired, boost_hours(NOW), min_views=0).count() == 0


def test_articles_without_acquisitions_are_dropped_early_if_that_is_cheap(spark, monkeypatch):
    seen = views(5) + views(7, path="/b") + views(2, country="DE")
    acquired = [acquisition("2024-01-02T09:30:00", amount=100.0)]
    found = candidates(spark, seen, acquired, boost_hours(NOW), min_views=0)
    assert "LeftSemi" in found._jdf.queryExecution().executedPlan().toString()
    never = lambda *tables, **_: [Lookup(getattr(t, "frame", t), False) for t in tables]
    monkeypatch.setattr(Lookup, "all", never)
    whole = candidates(spark, seen, acquired, boost_hours(NOW), min_views=0)
    assert "LeftSemi" not in whole._jdf.queryExecution().executedPlan().toString()
    assert frames.dicts(found) == frames.dicts(whole) != []


def test_value_has_no_cap(spark):
    acquired = [acquisition("2024-01-02T09:30:00", amount=1000.0)]
    [row] = candidates(spark, views(5), acquired, boost_hours(NOW), min_views=0).collect()
    assert row.totalAv == pytest.approx(800)


def test_catalog_prices_on_request(spark):
    acquired = [acquisition("2024-01-02T09:30:00", "DIGITAL_SUBSCRIPTION", "ANNUALLY")]
    options = dict(hours=boost_hours(NOW), min_views=0)
    assert candidates(spark, views(5), acquired, **options).count() == 0
    prices = price_dimension(frames.catalog(spark))
    [row] = candidates(spark, views(5), acquired, prices=prices, **options).collect()
    assert row.totalAv == pytest.approx(0.8 * CATALOG_PRICES["DigitalSubscription", "Annual"]["EUR"])


def test_windows_at_once_equal_each_alone(spark):
    seen = [view for i in range(24) for view in views(3, f"2024-01-02T{i:02}:30:00")]
    acquired = [acquisition(f"2024-01-02T{i:02}:40:00", amount=60.0 + i) for i in range(0, 24, 2)]
    hours = Hours(at("2024-01-02T05:00"), at("2024-01-02T12:00"), 3)
    together = frames.dicts(candidates(spark, seen, acquired, hours, min_views=2), "window_start")
    alone, start = [], hours.first
    while start <= hours.last:
        one = Hours(start, start, 3)
        alone += frames.dicts(candidates(spark, seen, acquired, one, min_views=2))
        start += HOUR
    assert [row["window_start"] for row in together] == [row["window_start"] for row in alone]
    for left, right in zip(together, alone):
        assert left["totalAv"] == pytest.approx(right["totalAv"])
        assert left["totalViews"] == right["totalViews"] == 9


def entry_rows(spark, *rows):
    schema = """window_start timestamp_ntz, url string, region string, totalAv double,
        totalAcquisitions bigint, totalViews bigint, avPerView double"""
    found = [(at("2024-01-02T08:00"), url, region, 1.0, 1, 1, value) for url, region, value in rows]
    return frames.table(spark, found, schema)


def boost(url=URL, region="GB", end="2024-01-02 13:00:00.000"):
    return (url, region, 1.0, 1, 1, 1.0, f"{region}_x", "2024-01-01 13:00:00.000", end[:10], end)


def boosts(spark, *rows):
    return frames.table(spark, list(rows), schemas.BOOST_RECORDS)


def test_thresholds(spark):
    rows = [(region, region, limit) for region, limit in schemas.BOOST_THRESHOLDS.items()]
    rows += [("below", "US", 0.0279), ("unknown", "XX", 1.0)]
    kept = {row.url for row in passes_threshold(entry_rows(spark, *rows)).collect()}
    assert kept == set(schemas.BOOST_THRESHOLDS)


def test_active_boosts(spark):
    stored = boosts(
        spark,
        boost("ended"  , end="2024-01-02 11:00:00.000"),
        boost("ending", end="2024-01-02 12:00:00.000"),
        boost("active", end="2024-01-02 13:00:00.000"),
        boost("tomorrow", end="2024-01-03 12:00:00.000"),
        boost("later", end="2024-01-04 00:00:00.000"),
    )
    assert {row.url for row in active_boosts(stored, NOW).collect()} == {"active", "tomorrow"}


def test_active_articles_do_not_enter_again(spark):
    found = entry_rows(spark, (URL, "GB", 1.0), (URL, "EU", 1.0), ("https://b", "GB", 1.0))
    stored = boosts(spark, boost(), boost("https://b", end="2024-01-02 12:00:00.000"))
    for active in (stored, active_boosts(stored, NOW)):
        entries = {(row.url, row.region) for row in boost_entries(found, active).collect()}
        assert entries == {(URL, "EU"), ("https://b", "GB")}


def test_records(spark):
    [record] = boost_records(entry_rows(spark, (URL, "GB", 1.0))).collect()
    assert record.id == "GB_aHR0cHM6Ly93d3cuZXhhbXBsZS5jb20vYQ=="
    assert record.startTimestamp == "2024-01-02 12:00:00.000"
    assert (record.endDate, record.endTimestamp) == ("2024-01-03", "2024-01-03 12:00:00.000")


def candidate_rows(spark, *rows):
    schema = """window_start timestamp_ntz, url string, region string, totalAv double,
        totalAcquisitions bigint, totalViews bigint, avPerView double"""
    return frames.table(spark, [(start, url, region, 1.0, 1, 1, value) for start, url, region, value in rows], schema)


@pytest.mark.parametrize("duration", [4, 24])
def test_sequential_entries_equal_hourly_runs(spark, duration):
    first = at("2024-01-02T00:00")
    rows = [
        (first + i * HOUR, f"https://{url}", region, 0.02 if (i * 7 + url) % 5 else 0.001)
        for i in range(14)
        for url in range(3)
        for region in ("GB", "US", "ROW")
        if (i * 3 + url) % 4
    ]
    found = candidate_rows(spark, *rows)
    stored = boosts(spark, boost("https://0", end="2024-01-02 11:00:00.000"), boost("https://1", "ROW", "2024-01-02 09:00:00.000"))
    entered, known = [], [tuple(row) for row in stored.collect()]
    for i in range(14):
        run = first + (i + 4) * HOUR
        active = active_boosts(boosts(spark, *known), run)
        now = boost_entries(found.where(f"window_start = timestamp_ntz'{first + i * HOUR}'"), active)
        entered += [tuple(row) for row in now.collect()]
        known += [tuple(row) for row in boost_records(now, duration_hours=duration).select(*stored.columns).collect()]
    together = sequential_entries(found, stored, duration_hours=duration)
    assert sorted(map(tuple, together.collect())) == sorted(entered)
    assert (len(entered) > len({row[1:3] for row in entered})) == (duration == 4)


def test_sequential_entries_need_one_shuffle_of_candidates(spark):
    found = candidate_rows(spark, (at("2024-01-02T00:00"), URL, "GB", 1.0))
    plan = sequential_entries(found, boosts(spark, boost()))._jdf.queryExecution().executedPlan().toString()
    fold = plan[: plan.index("ObjectHashAggregate", plan.index("ObjectHashAggregate") + 1)]
    assert fold.count("Exchange hashpartitioning(url") == 1 and "Python" not in plan


def test_candidates_out_of_order_and_repeated_windows(spark):
    rows = [(at(f"2024-01-02T{h:02}:00"), URL, "GB", 1.0) for h in (9, 3, 6, 3)]
    assert [r.window_start for r in sequential_entries(candidate_rows(spark, *rows), boosts(spark)).collect()] == [rows[1][0]]
    assert sequential_entries(candidate_rows(spark), boosts(spark)).count() == 0

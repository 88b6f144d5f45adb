from datetime import date, datetime, timedelta, timezone

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tests.frames import at
from valuelens.functions.hours import (
    HOUR,
    Hours,
    backfill_hours,
    boost_hours,
    floor_hour,
    hour_of,
    sampling_hours,
    window_starts,
)


def test_sampling_takes_the_hour_before_last():
    hours = sampling_hours(at("2026-05-01T09:45:10"))
    assert (hours.first, hours.end) == (at("2026-05-01T07:00"), at("2026-05-01T08:00"))


def test_times_with_a_zone_become_utc():
    time = datetime(2024, 1, 1, 1, 30, tzinfo=timezone(timedelta(hours=2)))
    assert floor_hour(time) == at("2023-12-31T23:00")


def test_boosts_take_three_hours_that_ended_an_hour_ago():
    hours = boost_hours(at("2024-01-01T09:20"))
    assert (hours.first, hours.end) == (at("2024-01-01T05:00"), at("2024-01-01T08:00"))


def test_days_read():
    hours = Hours(at("2024-01-01T23:00"), at("2024-01-02T01:00"))
    assert hours.received_dates == (date(2023, 12, 31), date(2024, 1, 2))
    assert hours.rates_dates == (date(2023, 12, 31), date(2024, 1, 1))


def runs_one_by_one(start, now):
    """Run times as a loop over hours gives them."""
    runs, time = [], start
    while time < floor_hour(now):
        time += HOUR
        runs.append(time)
    return runs


@given(
    st.datetimes(at("2024-01-01"), at("2024-01-05")),
    st.datetimes(at("2024-01-01"), at("2024-01-05")),
)
def test_backfill_covers_the_windows_of_its_runs(start, now):
    expected = [sampling_hours(time).first for time in runs_one_by_one(start, now)]
    hours = backfill_hours(start, now)
    if not expected:
        assert hours is None
    else:
        count = (hours.last - hours.first) // HOUR + 1
        assert [hours.first + i * HOUR for i in range(count)] == expected


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_hours_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = spark.sql(
            "select timestamp_ntz'2024-03-10 02:31:05.5' as t, timestamp_ntz'2024-03-10 01:00:00' as h"
        ).selectExpr(f"{hour_of('t')} as hour", f"{window_starts('h', 3)} as starts")
        row = row.selectExpr("cast(hour as string) as hour", "cast(starts as array<string>) as starts")
        found = row.first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found.hour == "2024-03-10 02:00:00"
    assert found.starts == ["2024-03-09 23:00:00", "2024-03-10 00:00:00", "2024-03-10 01:00:00"]


def test_spanning(spark):
    events = spark.sql("select timestamp_ntz'2024-01-01 05:10:00' as ts")
    assert Hours.spanning(events, "ts", 3) == Hours(at("2024-01-01T03:00"), at("2024-01-01T05:00"), 3)
    assert Hours.spanning(events.where("false"), "ts") is None

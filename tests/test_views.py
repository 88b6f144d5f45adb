from tests import frames
from tests.frames import at, event, page_view
from valuelens.functions.hours import Hours, sampling_hours
from valuelens.operators.configs import distinct_configs
from valuelens.operators.views import (
    article_views,
    component_views,
    landing_view_rows,
    landing_views_by_day,
    total_component_views,
    views_by_hour,
)
from valuelens.schemas import CHANNELS


def one_hour(text):
    return Hours(at(text), at(text))


def views_of(spark, rows, tests=(("Epic", "T"),), hours=None):
    tests = distinct_configs(frames.configs(spark, *tests))
    found = component_views(frames.page_views(spark, *rows), tests, hours)
    return {
        (str(row.window_start), row.channel, row.test_name, row.variant_name): row.views
        for row in found.collect()
    }


def test_counts_events_not_page_views(spark):
    rows = [page_view("2024-01-02", [event("2024-01-02T10:05:00"), event("2024-01-02T10:06:00")])]
    assert views_of(spark, rows) == {("2024-01-02 10:00:00", "Epic", "T", "control"): 2}


def test_null_and_empty_arrays(spark):
    assert views_of(spark, [page_view("2024-01-02"), page_view("2024-01-02", [])]) == {}


def test_other_actions_components_and_tests_do_not_count(spark):
    rows = [
        page_view(
            "2024-01-02",
            [
                event("2024-01-02T10:05:00", action="CLICK"),
                event("2024-01-02T10:05:00", action=None),
                event("2024-01-02T10:05:00", component="ACQUISITIONS_ENGAGEMENT_BANNER"),
                event("2024-01-02T10:05:00", component="OTHER"),
                event("2024-01-02T10:05:00", test="U"),
                event("2024-01-02T10:05:00", test=None),
            ],
        )
    ]
    assert views_of(spark, rows) == {}


def test_unknown_channel_has_no_views(spark):
    rows = [page_view("2024-01-02", [event("2024-01-02T10:05:00")])]
    assert views_of(spark, rows, [("Header", "T")]) == {}


def test_hours_are_half_open(spark):
    times = ["09:59:59.999999", "10:00:00", "10:59:59.999999", "11:00:00"]
    rows = [page_view("2024-01-02", [event(f"2024-01-02T{time}") for time in times])]
    assert list(views_of(spark, rows, hours=one_hour("2024-01-02T10:00")).values()) == [2]


def test_received_on_the_day_or_the_day_before(spark):
    rows = [
        page_view(day, [event("2024-01-02T10:05:00")])
        for day in ("2023-12-31", "2024-01-01", "2024-01-02", "2024-01-03")
    ]
    assert list(views_of(spark, rows).values()) == [2]
    assert list(views_of(spark, rows, hours=one_hour("2024-01-02T10:00")).values()) == [2]


def test_many_configs_give_the_same_without_broadcast(spark):
    from valuelens.operators.lookup import Lookup

    rows = [page_view("2024-01-02", [event("2024-01-02T10:05:00"), event("2024-01-02T11:05:00")])]
    tests = distinct_configs(frames.configs(spark, ("Epic", "T"), ("Banner1", "T")))
    small = Lookup.of(tests)
    large = Lookup.of(tests, max_rows=1)
    assert small.small and not large.small
    views = frames.page_views(spark, *rows)
    expected = frames.dicts(component_views(views, small))
    assert frames.dicts(component_views(views, large)) == expected != []
    landing = [page_view("2024-01-02", None, [("T", "a")], frames.HOST, "/contribute")]
    tests = distinct_configs(frames.configs(spark, ("SupportLandingPage", "T"), ("Epic", "T")))
    views = frames.page_views(spark, *landing)
    expected = frames.dicts(landing_views_by_day(views, Lookup.of(tests), frames.HOST))
    large = Lookup.of(tests, max_rows=1)
    assert frames.dicts(landing_views_by_day(views, large, frames.HOST)) == expected != []


def test_landing_views_count_for_every_hour_of_two_days(spark):
    page = dict(ab_tests=[("T", "a")], host=frames.HOST, path="/uk/contribute")
    views = frames.page_views(
        spark,
        page_view("2024-01-01", **page),
        page_view("2024-01-02", **page),
        page_view("2024-01-02", **{**page, "host": "www.example.com"}),
        page_view("2024-01-02", **{**page, "path": "/uk/contribute/x"}),
        page_view("2024-01-02", **{**page, "ab_tests": [("U", "a")]}),
        page_view("2024-01-02", **{**page, "ab_tests": None}),
    )
    tests = distinct_configs(frames.configs(spark, ("SupportLandingPage", "T"), ("Epic", "U")))
    by_day = landing_views_by_day(views, tests, frames.HOST)
    assert {str(row.day): row.views for row in by_day.collect()} == {
        "2024-01-01": 1,
        "2024-01-02": 2,
        "2024-01-03": 1,
    }
    hours = Hours(at("2024-01-01T22:00"), at("2024-01-02T01:00"))
    rows = landing_view_rows(views, tests, frames.HOST, hours)
    assert {str(row.window_start): row.views for row in rows.collect()} == {
        "2024-01-01 22:00:00": 1,
        "2024-01-01 23:00:00": 1,
        "2024-01-02 00:00:00": 2,
        "2024-01-02 01:00:00": 2,
    }


def test_total_views(spark):
    views = frames.page_views(
        spark,
        page_view("2024-01-02", [event("2024-01-02T10:05:00", test="any")]),
        page_view("2024-01-02", [event("2024-01-02T10:05:00", component="OTHER")]),
        page_view("2024-01-02", None, None, frames.HOST, "/contribute"),
    )
    hours = sampling_hours(at("2024-01-02T12:45"))

    def total(channels, hours=hours, **options):
        return total_component_views(views, channels, hours, **options).collect()[0].total_views

    assert total(CHANNELS) == 1
    assert total(["Banner1"]) == 0
    assert total(CHANNELS, sampling_hours(at("2024-01-03T12:45"))) == 0
    # A landing page has no component, so its views are not seen unless asked for.
    assert total(["SupportLandingPage"]) == 0
    assert total(["SupportLandingPage"], landing_host=frames.HOST) == 1
    assert total(CHANNELS, landing_host=frames.HOST) == 2
    assert views_by_hour(views, [], hours).count() == 0


def test_article_windows_slide(spark):
    views = frames.page_views(
        spark,
        page_view("2024-01-02", [event("2024-01-02T10:05:00"), event("2024-01-02T11:05:00")]),
        page_view("2024-01-02", [event("2024-01-02T10:05:00", component="OTHER")]),
        page_view("2024-01-02", [event("2024-01-02T10:05:00")], country="DE"),
    )
    found = {
        (row.window_start.hour, row.region): row.total_views for row in article_views(views).collect()
    }
    assert found == {
        (8, "GB"): 1, (9, "GB"): 2, (10, "GB"): 2, (11, "GB"): 1,
        (8, "EU"): 1, (9, "EU"): 1, (10, "EU"): 1,
    }


def test_article_windows_across_midnight_lose_the_new_day(spark):
    views = frames.page_views(
        spark,
        page_view("2024-01-02", [event("2024-01-02T00:05:00")]),
        page_view("2024-01-01", [event("2024-01-02T00:06:00")]),
    )
    late = Hours(at("2024-01-01T23:00"), at("2024-01-01T23:00"), 3)
    assert [row.total_views for row in article_views(views, late).collect()] == [1]
    found = {str(row.window_start): row.total_views for row in article_views(views).collect()}
    assert found == {
        "2024-01-01 22:00:00": 1,
        "2024-01-01 23:00:00": 1,
        "2024-01-02 00:00:00": 2,
    }


def test_one_window_at_a_time_gives_the_same(spark):
    views = frames.page_views(
        spark,
        *[
            page_view(f"2024-01-0{1 + i % 3}", [event(f"2024-01-0{1 + i % 2}T{i % 24:02}:30:00")])
            for i in range(60)
        ],
    )
    hours = Hours(at("2024-01-01T20:00"), at("2024-01-02T03:00"), 3)
    together = frames.dicts(article_views(views, hours))
    single = []
    for i in range(8):
        start = at("2024-01-01T20:00") + i * (at("2024-01-01T01:00") - at("2024-01-01T00:00"))
        single += frames.dicts(article_views(views, Hours(start, start, 3)))
    order = lambda row: str(row["window_start"])
    assert sorted(together, key=order) == sorted(single, key=order) != []

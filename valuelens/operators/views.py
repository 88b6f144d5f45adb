"""Views of components, landing pages and articles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuelens.functions.article import region_of, url_of
from valuelens.functions.hours import (
    Hours,
    days_between,
    hour_of,
    ntz,
    plus_hours,
    received_for,
    window_starts,
)
from valuelens.functions.text import one_of, quoted
from valuelens.operators.lookup import Lookup
from valuelens.schemas import (
    BOOST_COMPONENT_TYPE,
    BOOST_WINDOW_HOURS,
    COMPONENT_TYPES,
    LANDING_CHANNEL,
    LANDING_PATH,
)

SAMPLE_KEY = ["window_start", "channel", "test_name", "variant_name"]


def received_in(page_views: DataFrame, hours: Hours | None) -> DataFrame:
    """Page views of the days the windows read; prunes partitions."""
    if hours is None:
        return page_views
    return page_views.where(days_between("received_date", hours.received_dates))


def component_events(
    page_views: DataFrame, component_types: list[str], hours: Hours | None, *keep: str
) -> DataFrame:
    """One row per VIEW event of the component types, with the SQL columns to keep and ``event``."""
    wanted = f"event.event_action = 'VIEW' and {one_of('event.component_type', component_types)}"
    if hours is not None:
        wanted += f" and {hours.contains('event.event_timestamp')}"
    return (
        received_in(page_views, hours)
        .selectExpr(*keep, "received_date", "explode(component_event_array) as event")
        .where(wanted)
    )


def hourly_component_events(
    page_views: DataFrame, component_types: list[str], hours: Hours | None
) -> DataFrame:
    """VIEW events that count: (window_start, component_type, test_name, variant_name)."""
    return (
        component_events(page_views, component_types, hours)
        .where(received_for("event.event_timestamp"))
        .selectExpr(
            f"{hour_of('event.event_timestamp')} as window_start",
            "event.component_type",
            "event.ab_test_name as test_name",
            "event.ab_test_variant as variant_name",
        )
    )


def component_view_rows(
    page_views: DataFrame, configs: DataFrame | Lookup, hours: Hours | None = None
) -> DataFrame:
    """Rows of SAMPLE_KEY and ``views``, to be summed. ``configs`` are distinct configs."""
    configs = Lookup.of(configs)
    keys = ["component_type", "test_name"]
    events = hourly_component_events(page_views, list(COMPONENT_TYPES.values()), hours)
    if not configs.small:
        # Too many configs to broadcast: shuffle counts, not events.
        counts = events.groupBy("window_start", *keys, "variant_name").count()
        return counts.join(configs.side, keys).selectExpr(*SAMPLE_KEY, "count as views")
    return events.join(configs.side, keys).selectExpr(*SAMPLE_KEY, "1L as views")


def component_views(
    page_views: DataFrame, configs: DataFrame | Lookup, hours: Hours | None = None
) -> DataFrame:
    """Views per hour, test and variant: the number of events, not of page views."""
    rows = component_view_rows(page_views, configs, hours)
    return rows.groupBy(*SAMPLE_KEY).agg(F.expr("sum(views) as views"))


def landing_pages(page_views: DataFrame, landing_host: str, hours: Hours | None) -> DataFrame:
    return received_in(page_views, hours).where(
        f"host = {quoted(landing_host)} and path like {quoted(LANDING_PATH)}"
    )


def on_both_days(received: DataFrame, hours: Hours | None, *keep: str) -> DataFrame:
    """Page views of a received_date count for that day and for the next: (day, *keep)."""
    days = received.selectExpr(
        "explode(array(received_date, date_add(received_date, 1))) as day", *keep
    )
    if hours is None:
        return days
    return days.where(days_between("day", (hours.first.date(), hours.last.date())))


def each_hour(per_day: DataFrame, hours: Hours, *keep: str) -> DataFrame:
    """Repeats the rows of a day for each of its hours: (window_start, *keep)."""
    midnight = "cast(day as timestamp_ntz)"
    first = f"greatest({midnight}, {ntz(hours.first)})"
    last = f"least({plus_hours(midnight, 23)}, {ntz(hours.last)})"
    return per_day.selectExpr(
        f"explode(sequence({first}, {last}, interval 1 hour)) as window_start", *keep
    )


def landing_counts(page_views: DataFrame, landing_host: str, hours: Hours | None) -> DataFrame:
    """Landing-page views per day received, test and variant: (received_date, test_name, variant_name, pages)."""
    pages = landing_pages(page_views, landing_host, hours).selectExpr("received_date", "explode(ab_test_array) as ab")
    tested = pages.selectExpr("received_date", "ab.ab_test_name as test_name", "ab.ab_test_variant as variant_name")
    return tested.groupBy("received_date", "test_name", "variant_name").agg(F.expr("count(*) as pages"))


def landing_days(counts: DataFrame, configs: DataFrame | Lookup, hours: Hours | None = None) -> DataFrame:
    """Landing-page views per day, test and variant from ``landing_counts``."""
    tests = (
        Lookup.of(configs)
        .where(f"channel = {quoted(LANDING_CHANNEL)}")
        .selectExpr("channel", "test_name")
    )
    on_days = on_both_days(counts, hours, "test_name", "variant_name", "pages")
    return (
        on_days.join(tests.side, "test_name")
        .groupBy("channel", "day", "test_name", "variant_name")
        .agg(F.expr("sum(pages) as views"))
    )


def landing_views_by_day(
    page_views: DataFrame,
    configs: DataFrame | Lookup,
    landing_host: str,
    hours: Hours | None = None,
) -> DataFrame:
    """Landing-page views per day, test and variant: page views received that day or the day before.

    They are counted for the whole two days, not for the hour of a run. Only counts per day received are doubled, joined
    with configs and summed again.
    """
    return landing_days(landing_counts(page_views, landing_host, hours), configs, hours)


def landing_rows(per_day: DataFrame, hours: Hours) -> DataFrame:
    """Rows of SAMPLE_KEY and ``views``: every hour of a day has the views of that day."""
    return each_hour(per_day, hours, *SAMPLE_KEY[1:], "views")


def landing_view_rows(
    page_views: DataFrame, configs: DataFrame | Lookup, landing_host: str, hours: Hours
) -> DataFrame:
    return landing_rows(landing_views_by_day(page_views, configs, landing_host, hours), hours)


def views_by_hour(
    page_views: DataFrame,
    channels: list[str],
    hours: Hours | None = None,
    landing_host: str | None = None,
) -> DataFrame:
    """Per hour, the VIEW events of the channels' components, of any test.

    The landing-page channel has no components and adds nothing, unless ``landing_host`` asks to count
    the page views of a day for each of its hours.
    """
    types = [COMPONENT_TYPES[name] for name in channels if name in COMPONENT_TYPES]
    events = hourly_component_events(page_views, types, hours)
    counts = events.groupBy("window_start").agg(F.expr("count(*) as channel_views"))
    if landing_host is None or LANDING_CHANNEL not in channels:
        return counts
    pages = landing_pages(page_views, landing_host, hours)
    per_day = on_both_days(pages.groupBy("received_date").count(), hours, "count")
    landing = each_hour(per_day.groupBy("day").agg(F.expr("sum(count) as n")), hours, "n as channel_views")
    return (
        counts.unionByName(landing)
        .groupBy("window_start")
        .agg(F.expr("sum(channel_views) as channel_views"))
    )


def total_component_views(
    page_views: DataFrame,
    channels: list[str],
    hours: Hours | None = None,
    landing_host: str | None = None,
) -> DataFrame:
    """One row with the number of views of the channels, of any test."""
    counts = views_by_hour(page_views, channels, hours, landing_host)
    return counts.selectExpr("coalesce(sum(channel_views), 0) as total_views")


def article_view_rows(
    page_views: DataFrame,
    hours: Hours | None = None,
    span: int = BOOST_WINDOW_HOURS,
    only: Lookup | None = None,
) -> DataFrame:
    """Rows (window_start, url, region, views), to be summed over sliding windows of ``span`` hours.

    ``only`` holds the (url, region) of articles of interest; others are dropped before they are shuffled.
    """
    single = hours is not None and hours.single
    starts = window_starts(hour_of("event.event_timestamp"), span)
    events = component_events(
        page_views,
        [BOOST_COMPONENT_TYPE],
        hours,
        f"{url_of('protocol', 'host', 'path')} as url",
        f"{region_of('country_key')} as region",
    )
    if only is not None:
        events = events.join(only.side, ["url", "region"], "left_semi")
    rows = events.selectExpr(
        # Repeated per window where they are read, then summed there: only sums are shuffled, once.
        f"{ntz(hours.first) if single else f'explode({starts})'} as window_start",
        "received_date",
        "url",
        "region",
        "1L as views",
    )
    if hours is not None and not single:
        rows = rows.where(hours.starts("window_start"))
    return rows.where(received_for("window_start")).drop("received_date")


def article_views(
    page_views: DataFrame, hours: Hours | None = None, span: int = BOOST_WINDOW_HOURS
) -> DataFrame:
    """Epic views per window, article URL and region."""
    return (
        article_view_rows(page_views, hours, span)
        .groupBy("window_start", "url", "region")
        .agg(F.expr("sum(views) as total_views"))
    )

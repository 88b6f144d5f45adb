"""Article boosts: articles whose value per view is high enough to be shown more for a day."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuelens.functions.article import boost_id, threshold_of
from valuelens.functions.hours import (
    Hours,
    boost_date_text,
    boost_time_text,
    floor_hour,
    ntz,
    plus_hours,
)
from valuelens.functions.value import exact_sum
from valuelens.operators.acquisitions import acquired_articles, article_acquisition_values
from valuelens.operators.lookup import Lookup
from valuelens.operators.rates import boost_rates, rates_for
from valuelens.operators.views import article_view_rows
from valuelens.schemas import (
    BOOST_DURATION_HOURS,
    BOOST_MIN_VALUE,
    BOOST_MIN_VIEWS,
    BOOST_THRESHOLDS,
    BOOST_WINDOW_HOURS,
)


def boost_candidates(
    page_views: DataFrame,
    acquisitions: DataFrame,
    rates: DataFrame,
    prices: DataFrame | Lookup,
    hours: Hours | None,
    min_views: int = BOOST_MIN_VIEWS,
    min_value: float = BOOST_MIN_VALUE,
    span: int = BOOST_WINDOW_HOURS,
) -> DataFrame:
    """Articles per window and region with more than ``min_views`` views and ``min_value`` value.

    Views and acquisitions meet in one aggregation instead of a join; an article must have both.
    ``prices`` is the fixed list of the job, or a price dimension made from the catalog.
    """
    span = span if hours is None else hours.span
    article = ["window_start", "url", "region"]
    prices, rates, acquired = Lookup.all(
        prices, boost_rates(rates_for(rates, hours)), acquired_articles(acquisitions, hours)
    )
    # Few of the articles viewed are acquired from, so this spares most of the shuffle.
    views = article_view_rows(page_views, hours, span, acquired if acquired.small else None)
    values = article_acquisition_values(acquisitions, prices, rates, hours, span)
    return (
        views.selectExpr(*article, "views", "cast(null as double) as av_gbp", "0L as acquisitions")
        .unionByName(values.selectExpr(*article, "0L as views", "av_gbp", "n as acquisitions"))
        .where("url is not null")
        .groupBy(*article)
        .agg(
            F.expr(f"{exact_sum('av_gbp', 'acquisitions')} as totalAv"),
            F.expr("sum(acquisitions) as totalAcquisitions"),
            F.expr("sum(views) as totalViews"),
        )
        .where(f"totalViews > greatest(0, {min_views}) and totalAcquisitions > 0")
        .where(f"totalAv > {float(min_value)}d")
        .withColumn("avPerView", F.expr("totalAv / totalViews"))
    )


def run_hour(window_start: str, span: int = BOOST_WINDOW_HOURS) -> str:
    """The hour of the run that looks at a window."""
    return plus_hours(window_start, span + 1)


def passes_threshold(
    candidates: DataFrame, thresholds: dict[str, float] = BOOST_THRESHOLDS
) -> DataFrame:
    return candidates.where(f"avPerView >= {threshold_of('region', thresholds)}")


def active_boosts(boosts: DataFrame, as_of: datetime) -> DataFrame:
    """Boosts that end today or tomorrow, and after the current hour."""
    now = ntz(floor_hour(as_of))
    today, tomorrow = boost_date_text(now), boost_date_text(plus_hours(now, 24))
    return boosts.where(
        f"endDate in ({today}, {tomorrow}) and endTimestamp > {boost_time_text(now)}"
    )


def boosted_days(boosts: DataFrame) -> DataFrame:
    """(url, region, run_date, boosted_until): runs of a day find an article boosted before that time.

    Runs look at boosts that end on their day or the next.
    """
    run_dates = "array(endDate, cast(date_sub(cast(endDate as date), 1) as string))"
    return (
        boosts.selectExpr("url", "region", f"explode({run_dates}) as run_date", "endTimestamp")
        .groupBy("url", "region", "run_date")
        .agg(F.expr("max(endTimestamp) as boosted_until"))
    )


def boost_entries(
    candidates: DataFrame,
    boosts: DataFrame,
    span: int = BOOST_WINDOW_HOURS,
    thresholds: dict[str, float] = BOOST_THRESHOLDS,
) -> DataFrame:
    """Candidates that reach their region's threshold and are not boosted at the hour of their run.

    Each candidate meets at most one row, however often its article was boosted before.
    """
    run = run_hour("window_start", span)
    found = passes_threshold(candidates, thresholds).alias("c")
    boosted = F.expr(
        "c.url = b.url and c.region = b.region"
        f" and {boost_date_text(run)} = run_date and boosted_until > {boost_time_text(run)}"
    )
    return found.join(boosted_days(boosts).alias("b"), boosted, "left_anti")


def sequential_entries(
    candidates: DataFrame,
    boosts: DataFrame,
    span: int = BOOST_WINDOW_HOURS,
    thresholds: dict[str, float] = BOOST_THRESHOLDS,
    duration_hours: int = BOOST_DURATION_HOURS,
) -> DataFrame:
    """Entries of a plan of many windows, as hourly runs would have made them one after the other.

    An article that enters is boosted from the hour of its run, so that it does not enter again before its boost ends. Stored
    boosts are left out first; then the candidates of an article and region are gone through in order of time. They meet in
    one shuffle, and an array holds one candidate per window of the plan at most.
    """
    free = boost_entries(candidates, boosts, span, thresholds)
    columns = [name for name in candidates.columns if name not in ("url", "region")]
    # A run looks at boosts that end on its day or the next, and after its hour.
    run, entered = run_hour("x.window_start", span), run_hour("e.window_start", span)
    end = plus_hours(entered, duration_hours)
    seen = f"datediff(to_date({end}), to_date({run})) in (0, 1) and {end} > {run}"
    in_order = f"array_sort(collect_list(struct({', '.join(['window_start', *(c for c in columns if c != 'window_start')])})))"
    fold = f"aggregate(found, slice(found, 1, 0), (a, x) -> if(exists(a, e -> {seen}), a, concat(a, array(x))))"
    return (
        free.groupBy("url", "region")
        .agg(F.expr(in_order).alias("found"))
        .selectExpr("url", "region", f"inline({fold})")
        .select(*candidates.columns)
    )


def boost_records(
    entries: DataFrame,
    span: int = BOOST_WINDOW_HOURS,
    duration_hours: int = BOOST_DURATION_HOURS,
) -> DataFrame:
    """Entries with their key and the time the boost lasts, from the hour of the run."""
    start = run_hour("window_start", span)
    end = plus_hours(start, duration_hours)
    return entries.selectExpr(
        "url",
        "region",
        "totalAv",
        "totalAcquisitions",
        "totalViews",
        "avPerView",
        f"{boost_id('region', 'url')} as id",
        f"{boost_time_text(start)} as startTimestamp",
        f"{boost_date_text(end)} as endDate",
        f"{boost_time_text(end)} as endTimestamp",
    )

"""The same measures on streams: a window's row is emitted once, when its late events are in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from valuelens.functions.article import region_of, url_of
from valuelens.functions.hours import rates_date
from valuelens.functions.value import annualise, cap, exact_sum
from valuelens.operators.acquisitions import of_tests, unnest_tests, value_of_acquisitions
from valuelens.operators.configs import distinct_configs
from valuelens.operators.lookup import Lookup
from valuelens.operators.prices import price_acquisitions
from valuelens.operators.rates import boost_rates, sample_rates
from valuelens.operators.views import component_events
from valuelens.schemas import BOOST_COMPONENT_TYPE, COMPONENT_TYPES, VALUE_CAP

# Hourly runs at minute 45 look at the hour before last: events have this long to arrive.
LATENESS = "1 hour 45 minutes"

EVENT_TIME = "cast({} as timestamp) as event_time"


def _views(page_views: DataFrame, component_types: list[str], lateness: str, *keep) -> DataFrame:
    time = EVENT_TIME.format("event.event_timestamp")
    events = component_events(page_views, component_types, None, *keep)
    return events.selectExpr("*", time).withWatermark("event_time", lateness)


def _acquisitions(acquisitions: DataFrame, lateness: str) -> DataFrame:
    time = EVENT_TIME.format("event_timestamp")
    return acquisitions.selectExpr("*", time).withWatermark("event_time", lateness)


def _by_window_start(rows: DataFrame) -> DataFrame:
    # Through text, so the session's time zone cancels out.
    start = "to_timestamp_ntz(date_format(window.start, 'yyyy-MM-dd HH:mm:ss'))"
    return rows.withColumn("window_start", F.expr(start)).drop("window")


def stream_samples(
    page_views: DataFrame,
    acquisitions: DataFrame,
    rates: DataFrame,
    prices: DataFrame | Lookup,
    configs: DataFrame,
    lateness: str = LATENESS,
    value_cap: float = VALUE_CAP,
) -> DataFrame:
    """Hourly samples of component tests from streams of page views and acquisitions.

    Views and acquisitions meet in one windowed aggregation, not in a join of streams. The date a page
    view was received plays no part.
    """
    configs, prices, rates = Lookup.all(distinct_configs(configs), prices, sample_rates(rates))
    configs = configs.where("component_type is not null")
    group = ["channel", "test_name", "variant_name"]
    views = (
        _views(page_views, list(COMPONENT_TYPES.values()), lateness)
        .selectExpr(
            "event_time",
            "event.component_type",
            "event.ab_test_name as test_name",
            "event.ab_test_variant as variant_name",
        )
        .join(configs.side, ["component_type", "test_name"])
        .selectExpr(
            "event_time", *group, "1L as views", "cast(null as double) as capped_av_gbp", "0L as acquisitions"
        )
    )
    tested = of_tests(
        unnest_tests(_acquisitions(acquisitions, lateness), None, "event_time"), configs
    )
    values = (
        value_of_acquisitions(price_acquisitions(tested, prices), rates)
        .where("variant_name is not null")
        .selectExpr(
            "event_time",
            *group,
            "0L as views",
            f"{cap('av_gbp', value_cap)} as capped_av_gbp",
            "1L as acquisitions",
        )
    )
    sums = (
        views.unionByName(values)
        .groupBy(F.window("event_time", "1 hour"), *group)
        .agg(
            F.expr("sum(views) as views"),
            F.expr(f"coalesce({exact_sum('capped_av_gbp')}, 0) as sum_av_gbp"),
            F.expr("sum(acquisitions) as acquisitions"),
        )
        .where("views > 0")
        .withColumn("sum_av_gbp_per_view", F.expr("try_divide(sum_av_gbp, views)"))
    )
    return _by_window_start(sums)


def stream_articles(
    page_views: DataFrame,
    acquisitions: DataFrame,
    rates: DataFrame,
    prices: DataFrame | Lookup,
    lateness: str = LATENESS,
) -> DataFrame:
    """Views and value per article and region over three hours, every hour, before any gate."""
    prices, rates = Lookup.all(prices, boost_rates(rates))
    article = ["url", "region"]
    views = _views(
        page_views,
        [BOOST_COMPONENT_TYPE],
        lateness,
        f"{url_of('protocol', 'host', 'path')} as url",
        f"{region_of('country_key')} as region",
    ).selectExpr("event_time", *article, "1L as views", "cast(null as double) as av_gbp", "0L as acquisitions")
    paid = price_acquisitions(_acquisitions(acquisitions, lateness), prices).selectExpr(
        "event_time",
        "referrer_url as url",
        f"{region_of('country_code')} as region",
        "currency",
        "payment_frequency",
        "paid",
    )
    window = F.window("event_time", "3 hours", "1 hour")
    columns = ["window", *article, "views", "av_gbp", "acquisitions"]
    # Rates are joined to acquisitions alone; those without a rate do not count.
    values = (
        paid.withColumn("window", window)
        .withColumn("rates_date", F.expr(rates_date("window.start")))
        .join(rates.side, ["rates_date", "currency"])
        .withColumn("av_gbp", F.expr(annualise("paid * to_gbp_rate", "payment_frequency")))
        .selectExpr("window", *article, "0L as views", "av_gbp", "1L as acquisitions")
    )
    sums = (
        views.withColumn("window", window)
        .selectExpr("window", *article, "views", "av_gbp", "acquisitions")
        .unionByName(values.select(*columns))
        .where("url is not null")
        .groupBy("window", *article)
        .agg(
            F.expr("sum(views) as totalViews"),
            F.expr(f"{exact_sum('av_gbp')} as totalAv"),
            F.expr("sum(acquisitions) as totalAcquisitions"),
        )
        .where("totalViews > 0 and totalAcquisitions > 0")
        .withColumn("avPerView", F.expr("totalAv / totalViews"))
    )
    return _by_window_start(sums)


def write_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends all that is available to Parquet files, then stops."""
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

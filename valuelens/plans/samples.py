"""Variant samples: views, acquisitions and value per hour, test and variant."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuelens.functions.hours import Hours, sample_time_text
from valuelens.functions.text import quoted
from valuelens.functions.value import exact_sum
from valuelens.operators.acquisitions import acquisition_values
from valuelens.operators.configs import distinct_configs
from valuelens.operators.lookup import Lookup
from valuelens.operators.rates import rates_for, sample_rates
from valuelens.operators.views import SAMPLE_KEY, component_view_rows, landing_view_rows
from valuelens.schemas import LANDING_CHANNEL, VALUE_CAP


def combine(views: DataFrame, values: DataFrame) -> DataFrame:
    """Samples from view rows and acquisition values.

    Every group with views is kept, with zeros if it has no acquisitions; acquisitions of a group without
    views are dropped. Both inputs go through one aggregation, so there is one shuffle, of partial sums,
    and no join: a test that holds most of the rows is summed where its rows are read.
    """
    views = views.selectExpr(*SAMPLE_KEY, "views", "cast(null as double) as capped_av_gbp", "0L as acquisitions")
    # A variant without a name matches no other, so such acquisitions belong to no group of views.
    values = values.where("test_name is not null and variant_name is not null").selectExpr(
        *SAMPLE_KEY, "0L as views", "capped_av_gbp", "n as acquisitions"
    )
    return (
        views.unionByName(values)
        .groupBy(*SAMPLE_KEY)
        .agg(
            F.expr("sum(views) as views"),
            F.expr(f"coalesce({exact_sum('capped_av_gbp', 'acquisitions')}, 0) as sum_av_gbp"),
            F.expr("sum(acquisitions) as acquisitions"),
        )
        .where("views > 0")
        .withColumn("sum_av_gbp_per_view", F.expr("try_divide(sum_av_gbp, views)"))
    )


def variant_samples(
    page_views: DataFrame,
    acquisitions: DataFrame,
    rates: DataFrame,
    prices: DataFrame | Lookup,
    configs: DataFrame,
    hours: Hours | None,
    landing_host: str | None = None,
    value_cap: float = VALUE_CAP,
    fix_gbp: bool = False,
    quarterly: bool = False,
) -> DataFrame:
    """Samples of all tests and hours in one job.

    ``configs`` has channel and name. ``hours`` may be None (all hours in the data) for component tests;
    landing-page tests also need ``landing_host``.
    """
    configs, prices, rates = Lookup.all(
        distinct_configs(configs), prices, sample_rates(rates_for(rates, hours))
    )
    views = component_view_rows(page_views, configs, hours)
    if landing_host is None:
        configs = configs.where(f"channel <> {quoted(LANDING_CHANNEL)}")
    elif hours is None:
        raise ValueError("landing-page samples need the hours to report on")
    else:
        views = views.unionByName(landing_view_rows(page_views, configs, landing_host, hours))
    values = acquisition_values(
        acquisitions, prices, rates, configs, hours, value_cap, fix_gbp, quarterly
    )
    return combine(views, values)


def sample_records(config_hours: DataFrame, samples: DataFrame) -> DataFrame:
    """One record per test and hour with an array of its variants, empty where there were no views."""
    keys = ["channel", "test_name", "window_start"]
    variant = (
        "named_struct('variantName', variant_name, 'annualisedValueInGBP', sum_av_gbp,"
        " 'annualisedValueInGBPPerView', sum_av_gbp_per_view, 'views', views)"
    )
    return (
        config_hours.selectExpr(*keys, "null as variant")
        .unionByName(samples.selectExpr(*keys, f"{variant} as variant"))
        .groupBy(*keys)
        # collect_list skips the NULL of the config itself; variants of a test are few.
        .agg(F.expr("array_sort(collect_list(variant)) as variants"))
        .selectExpr(
            "concat(channel, '_', test_name) as testName",
            "variants",
            f"{sample_time_text('window_start')} as timestamp",
        )
    )


def sample_rows(records: DataFrame) -> DataFrame:
    """Records flattened to one row per variant; a record without variants gives one row of NULLs."""
    return records.selectExpr("testName", "timestamp", "explode_outer(variants) as variant").select(
        "testName", "timestamp", "variant.*"
    )

"""Checks of results, and the metrics of a run. A rule is the SQL of a violation, by its name."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuelens.functions.hours import Hours, ntz, rates_date
from valuelens.functions.text import one_of, quoted, struct_array
from valuelens.schemas import (
    BILLING_PERIODS,
    BOOST_THRESHOLDS,
    CATALOG_PRODUCTS,
    PRICED_FREQUENCIES,
)

SAMPLE_FIELDS = [
    "test_name",
    "variant_name",
    "views",
    "sum_av_gbp",
    "sum_av_gbp_per_view",
    "acquisitions",
]
BOOST_FIELDS = ["url", "region", "totalAv", "totalViews", "avPerView", "totalAcquisitions"]


class InvalidData(Exception):
    """A result or document breaks its rules; nothing of the run may be written."""


def _missing(fields: list[str]) -> dict[str, str]:
    return {f"{name} is missing": f"{name} is null" for name in fields}


def sample_rules() -> dict[str, str]:
    return _missing(SAMPLE_FIELDS)


def total_views_rules() -> dict[str, str]:
    return _missing(["total_views"])


def boost_rules() -> dict[str, str]:
    known = one_of("region", BOOST_THRESHOLDS)
    return {**_missing(BOOST_FIELDS), "region is unknown": f"not {known}"}


def catalog_rules() -> dict[str, str]:
    rules = {}
    for product, frequencies in PRICED_FREQUENCIES.items():
        name = CATALOG_PRODUCTS[product]
        rules[f"{name}.active is missing"] = f"{name}.active is null"
        for frequency in frequencies:
            plan = BILLING_PERIODS[frequency]
            pricing = f"{name}.ratePlans['{plan}'].pricing"
            rules[f"{name}.{plan} has no pricing"] = f"{pricing} is null"
            rules[f"{name}.{plan} has an empty price"] = (
                f"exists(map_values({pricing}), price -> price is null)"
            )
    return rules


def violations(rows: DataFrame, rules: dict[str, str], *by: str) -> DataFrame:
    """(rule, violations) of all rules, counted in one pass, per group of ``by``."""
    counts = rows.groupBy(*by).agg(
        *[F.expr(f"count_if({rule})").alias(f"_{i}") for i, rule in enumerate(rules.values())]
    )
    pairs = struct_array(
        ["rule", "violations"], [(quoted(name), f"_{i}") for i, name in enumerate(rules)]
    )
    return counts.selectExpr(*by, f"inline({pairs})")


def require(rows: DataFrame, rules: dict[str, str]) -> DataFrame:
    """The rows, if none breaks a rule."""
    broken = violations(rows, rules).where("violations > 0").collect()  # one row per rule
    if broken:
        raise InvalidData(", ".join(f"{row.rule}: {row.violations} rows" for row in broken))
    return rows


def hours_frame(spark: SparkSession, hours: Hours) -> DataFrame:
    """(window_start) of all windows."""
    return spark.range(1).select(F.expr(f"explode({hours.each()}) as window_start"))


def rejected_hours(samples: DataFrame) -> DataFrame:
    """Hours with an invalid sample."""
    return samples.where(" or ".join(sample_rules().values())).select("window_start").distinct()


def hours_with_zero_rates(rates: DataFrame, hours: Hours) -> DataFrame:
    """Hours valued at a day that has a rate of zero, which no value can be divided by."""
    days = rates.where("rate = 0").selectExpr("date as rates_day").distinct()
    return hours_frame(rates.sparkSession, hours).join(
        days, F.expr(f"{rates_date('window_start')} = rates_day"), "left_semi"
    )


def run_metrics(
    config_hours: DataFrame, samples: DataFrame, hours: DataFrame | None = None
) -> DataFrame:
    """Per hour: the number of configs, of configs with samples, and the views of all samples.

    Equal configs count each, as each would have been queried. Hours of ``hours`` without any config have zeros.
    """
    found = _metrics_of_configs(config_hours, samples)
    if hours is None:
        return found
    counts = ["total_tests", "tests_with_data", "variant_views"]
    return hours.join(found, "window_start", "left").select(
        "window_start", *[F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in counts]
    )


def _metrics_of_configs(config_hours: DataFrame, samples: DataFrame) -> DataFrame:
    keys = ["window_start", "channel", "test_name"]
    return (
        config_hours.selectExpr(*keys, "copies", "null as views")
        .unionByName(samples.selectExpr(*keys, "0L as copies", "views"))
        .groupBy(*keys)
        .agg(F.expr("sum(copies) as copies"), F.expr("sum(views) as views"))
        .where("copies > 0")
        .groupBy("window_start")
        .agg(
            F.expr("sum(copies) as total_tests"),
            F.expr("sum(if(views is null, 0L, copies)) as tests_with_data"),
            F.expr("coalesce(sum(copies * views), 0) as variant_views"),
        )
    )


def no_views_check(metrics: DataFrame, channel_views: DataFrame) -> DataFrame:
    """Hours without any view, of the tests or of any other test of their channels.

    ``no_views_data`` is 1 where both are zero: views are missing upstream. Tests without views while
    others of the channel have some are no cause for concern.
    """
    return (
        metrics.select("window_start", "variant_views")
        .join(channel_views, "window_start", "left")
        .selectExpr("window_start", "variant_views", "coalesce(channel_views, 0) as channel_views")
        .withColumn(
            "no_views_data", F.expr("cast(variant_views = 0 and channel_views = 0 as int)")
        )
    )


def metric_points(metrics: DataFrame, time: datetime, **columns: str) -> DataFrame:
    """Columns of a frame as long-format metrics: ``metric_points(m, now, Views='views')``."""
    points = struct_array(
        ["name", "value", "unit", "time"],
        [
            (quoted(name), f"cast({column} as double)", "'Count'", ntz(time))
            for name, column in columns.items()
        ],
    )
    return metrics.selectExpr(f"inline({points})")

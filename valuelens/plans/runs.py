"""Whole runs: compute, check, report, write."""

from __future__ import annotations

import logging
from dataclasses import dataclass, replace
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuelens.functions.hours import Hours, backfill_hours, boost_backfill_hours, boost_hours, sampling_hours
from valuelens.functions.text import one_of
from valuelens.operators.acquisitions import unrated_acquisitions
from valuelens.operators.configs import config_hours, sampled_tests, test_configs
from valuelens.operators.prices import boost_prices, missing_prices, price_dimension
from valuelens.operators.quality import (
    boost_rules,
    hours_frame,
    hours_with_zero_rates,
    metric_points,
    no_views_check,
    rejected_hours,
    require,
    run_metrics,
    sample_rules,
    total_views_rules,
)
from valuelens.operators.rates import rates_for, sample_rates
from valuelens.operators.views import views_by_hour
from valuelens.plans.boosts import (
    active_boosts,
    boost_candidates,
    boost_entries,
    boost_records,
    sequential_entries,
)
from valuelens.plans.samples import sample_records, variant_samples
from valuelens.schemas import BOOST_MIN_VALUE, BOOST_MIN_VIEWS, CHANNELS
from valuelens.sinks.records import append_boosts, append_metrics, append_samples

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Facts:
    """The tables a run reads."""

    page_views: DataFrame
    acquisitions: DataFrame
    rates: DataFrame


@dataclass(frozen=True)
class Outputs:
    """Where a sampling run writes."""

    samples: str
    metrics: str


def run_sampling(
    facts: Facts,
    catalog: DataFrame,
    tests: DataFrame,
    landing_host: str,
    outputs: Outputs,
    as_of: datetime,
    **options: bool,
) -> None:
    """The hourly run: samples the live tests over the hour before last."""
    configs = test_configs(sampled_tests(tests))
    sample(facts, catalog, configs, landing_host, outputs, sampling_hours(as_of), as_of, **options)


def run_backfill(
    facts: Facts,
    catalog: DataFrame,
    configs: DataFrame,
    landing_host: str,
    outputs: Outputs,
    start: datetime,
    now: datetime,
    **options: bool,
) -> None:
    """All hourly runs due after ``start`` up to ``now``, in one job. Invalid hours are logged and left out."""
    hours = backfill_hours(start, now)
    if hours is None:
        log.info("nothing to backfill")
        return
    options = {"skip_invalid": True, **options}
    sample(facts, catalog, configs, landing_host, outputs, hours, now, **options)


def sample(
    facts: Facts,
    catalog: DataFrame,
    configs: DataFrame,
    landing_host: str,
    outputs: Outputs,
    hours: Hours,
    now: datetime,
    skip_invalid: bool = False,
    landing_aware_check: bool = False,
    diagnostics: bool = False,
    fix_gbp: bool = False,
    quarterly: bool = False,
) -> None:
    """Samples the configs over the hours: validates, then reports, then writes.

    An invalid row or a rate of zero stops the run before anything is written; with ``skip_invalid`` it only
    drops its hours, which are logged and counted. ``landing_aware_check`` counts landing pages in the no-views
    check. ``diagnostics`` adds metrics about acquisitions without a rate and products without a price.
    ``fix_gbp`` and ``quarterly`` correct the values.
    """
    prices = price_dimension(catalog)
    due = hours_frame(facts.rates.sparkSession, hours)
    zero_rates = None
    if skip_invalid:
        zero_rates = hours_with_zero_rates(rates_for(facts.rates, hours), hours)
        facts = replace(facts, rates=facts.rates.where("rate is null or rate <> 0"))
    # Persisted: read by checks, metrics and records. It holds aggregates only.
    samples = variant_samples(
        facts.page_views, facts.acquisitions, facts.rates, prices, configs, hours, landing_host, fix_gbp=fix_gbp,
        quarterly=quarterly,
    ).persist()
    wanted = config_hours(configs, hours)
    try:
        if skip_invalid:
            rejected = rejected_hours(samples).union(zero_rates).distinct().persist()
            due = due.join(rejected, "window_start", "left_anti")
            wanted = wanted.join(rejected, "window_start", "left_anti")
            valid = samples.join(rejected, "window_start", "left_anti")
        else:
            rejected = None
            valid = require(samples, sample_rules())

        metrics = run_metrics(wanted, valid, due)
        points = metric_points(
            metrics, now, TotalBanditTests="total_tests", TestsWithVariantData="tests_with_data"
        )
        host = landing_host if landing_aware_check else None
        for more in (
            _no_views_points(facts, configs, metrics, now, host),
            _diagnostic_points(facts, prices, hours, now) if diagnostics else None,
            None if rejected is None else _rejected_points(rejected, now),
        ):
            points = points if more is None else points.unionByName(more)
        append_metrics(points, outputs.metrics)

        append_samples(sample_records(wanted, valid), outputs.samples)
    finally:
        samples.unpersist()


def _no_views_points(
    facts: Facts, configs: DataFrame, metrics: DataFrame, now: datetime, landing_host: str | None
) -> DataFrame | None:
    """Reads page views again, but only the partitions of days with an hour in which no test had any."""
    empty = metrics.where("variant_views = 0")
    days = empty.groupBy(F.to_date("window_start").alias("day")).agg(
        F.min("window_start").alias("first"), F.max("window_start").alias("last")
    ).collect()  # a row per day of the run
    if not days:
        return None
    first, last = min(row["first"] for row in days), max(row["last"] for row in days)
    received = sorted({row.day - back for row in days for back in (timedelta(0), timedelta(1))})
    page_views = facts.page_views.where(F.col("received_date").isin(received))
    known = configs.where(one_of("channel", CHANNELS)).select("channel").distinct()
    channels = [row.channel for row in known.collect()]  # at most one row per known channel
    views = views_by_hour(page_views, channels, Hours(first, last), landing_host)
    totals = views.join(empty.select("window_start"), "window_start", "left_semi")
    require(totals.withColumnRenamed("channel_views", "total_views"), total_views_rules())
    missing = no_views_check(empty, views).where("no_views_data = 1")
    return metric_points(missing, now, NoViewsData="no_views_data")


def _rejected_points(rejected: DataFrame, now: datetime) -> DataFrame:
    """Logs the hours that are left out, the first hundred by name, and counts all."""
    count = rejected.count()
    if count:
        some = [row.window_start for row in rejected.orderBy("window_start").limit(100).collect()]
        log.warning("%s hours left out, among them %s", count, ", ".join(map(str, some)))
    return metric_points(rejected.agg(F.count("*").alias("n")), now, RejectedHours="n")


def _diagnostic_points(facts: Facts, prices: DataFrame, hours: Hours, now: datetime) -> DataFrame:
    rates = sample_rates(rates_for(facts.rates, hours))
    unrated = unrated_acquisitions(facts.acquisitions, rates, hours).agg(
        F.coalesce(F.sum("unrated"), F.lit(0)).alias("unrated")
    )
    missing = missing_prices(prices).agg(F.count("*").alias("missing"))
    return metric_points(unrated, now, UnratedAcquisitions="unrated").unionByName(
        metric_points(missing, now, MissingPrices="missing")
    )


def run_boosts(
    facts: Facts,
    boosts: DataFrame,
    boosts_path: str,
    as_of: datetime,
    min_views: int = BOOST_MIN_VIEWS,
    min_value: float = BOOST_MIN_VALUE,
    catalog: DataFrame | None = None,
) -> None:
    """The hourly boost run: records of the articles that enter the boosted state now.

    ``boosts`` are the records stored so far. Prices are the fixed list, or those of ``catalog``.
    """
    if catalog is None:
        prices = boost_prices(facts.page_views.sparkSession)
    else:
        prices = price_dimension(catalog)
    candidates = boost_candidates(
        facts.page_views,
        facts.acquisitions,
        facts.rates,
        prices,
        boost_hours(as_of),
        min_views,
        min_value,
    ).persist()  # checked, then written; only articles beyond the gates
    try:
        entries = boost_entries(require(candidates, boost_rules()), active_boosts(boosts, as_of))
        append_boosts(boost_records(entries), boosts_path)
    finally:
        candidates.unpersist()


def run_boost_backfill(
    facts: Facts,
    boosts: DataFrame,
    boosts_path: str,
    start: datetime,
    now: datetime,
    min_views: int = BOOST_MIN_VIEWS,
    min_value: float = BOOST_MIN_VALUE,
    catalog: DataFrame | None = None,
) -> None:
    """All hourly boost runs due after ``start`` up to ``now``, in one job.

    An article that enters in one of the hours is boosted in the later ones, as if each run had seen the records of those
    before it. ``boosts`` are the records stored so far.
    """
    hours = boost_backfill_hours(start, now)
    if hours is None:
        log.info("nothing to backfill")
        return
    prices = boost_prices(facts.page_views.sparkSession) if catalog is None else price_dimension(catalog)
    candidates = boost_candidates(
        facts.page_views, facts.acquisitions, facts.rates, prices, hours, min_views, min_value
    ).persist()  # checked, then written; only articles beyond the gates
    try:
        entries = sequential_entries(require(candidates, boost_rules()), boosts)
        append_boosts(boost_records(entries), boosts_path)
    finally:
        candidates.unpersist()

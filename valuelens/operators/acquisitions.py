"""Acquisitions and their annualised value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuelens.functions.article import region_of
from valuelens.functions.hours import Hours, hour_of, ntz, rates_date, window_starts
from valuelens.functions.value import annualise, cap, eur_to_gbp, exact_sum, paid_or_list_price
from valuelens.operators.lookup import Lookup
from valuelens.operators.prices import list_prices, price_acquisitions
from valuelens.operators.views import SAMPLE_KEY
from valuelens.schemas import BOOST_WINDOW_HOURS, VALUE_CAP


def acquired_in(acquisitions: DataFrame, hours: Hours | None) -> DataFrame:
    """Acquisitions of the windows; the bounds reach the scan."""
    return acquisitions if hours is None else acquisitions.where(hours.contains("event_timestamp"))


def unnest_tests(acquisitions: DataFrame, hours: Hours | None = None, *keep: str) -> DataFrame:
    """One row per acquisition and test: an acquisition in two tests appears twice."""
    columns = ["product", "payment_frequency", "currency", "amount", "component_type"]
    return (
        acquired_in(acquisitions, hours)
        .selectExpr(
            *keep,
            f"{hour_of('event_timestamp')} as window_start",
            *columns,
            "explode(ab_tests) as ab",
        )
        .selectExpr(
            *keep, "window_start", *columns, "ab.name as test_name", "ab.variant as variant_name"
        )
    )


def counted(rows: DataFrame) -> DataFrame:
    """Equal rows as one with their number ``n``, so that what follows shuffles counts, not acquisitions."""
    return rows.groupBy(*rows.columns).agg(F.expr("count(*) as n"))


def of_tests(unnested: DataFrame, configs: DataFrame | Lookup) -> DataFrame:
    """Acquisitions of configured tests, with the channel of the test.

    Tests of a component count acquisitions made through that component only. Landing-page tests, and
    tests of a channel without a component, count all.
    """
    tests = Lookup.of(configs).selectExpr(
        "channel", "test_name", "component_type as test_component_type"
    )
    return (
        unnested.join(tests.side, "test_name")
        .where("test_component_type is null or test_component_type = component_type")
        .drop("test_component_type")
    )


def value_of_acquisitions(
    priced: DataFrame,
    rates: DataFrame | Lookup,
    fix_gbp: bool = False,
    quarterly: bool = False,
) -> DataFrame:
    """Adds av_eur and av_gbp to acquisitions that have window_start and ``paid``.

    ``rates`` are sample rates. Acquisitions in a currency without a rate on the day are dropped.
    """
    av_eur = annualise("paid * reverse_rate", "payment_frequency", quarterly)
    return (
        priced.withColumn("rates_date", F.expr(rates_date("window_start")))
        .join(Lookup.of(rates).side, ["rates_date", "currency"])
        .selectExpr(*priced.columns, "gbp_rate", f"{av_eur} as av_eur")
        .selectExpr(
            *priced.columns,
            "av_eur",
            f"{eur_to_gbp('av_eur', 'currency', 'gbp_rate', fix_gbp)} as av_gbp",
        )
    )


def acquisition_values(
    acquisitions: DataFrame,
    prices: DataFrame | Lookup,
    rates: DataFrame | Lookup,
    configs: DataFrame | Lookup,
    hours: Hours | None = None,
    value_cap: float = VALUE_CAP,
    fix_gbp: bool = False,
    quarterly: bool = False,
) -> DataFrame:
    """Rows of SAMPLE_KEY, ``capped_av_gbp`` and ``n``, the acquisitions in a configured test that have this value.

    Where a lookup is too large to broadcast, acquisitions that are equal in all that their value depends on are counted
    first: the joins then shuffle counts. The cap is that of a single acquisition either way.
    """
    configs, prices, rates = Lookup.all(configs, prices, rates)
    unnested = unnest_tests(acquisitions, hours)
    if configs.small and prices.small and rates.small:
        unnested = unnested.withColumn("n", F.expr("1L"))
    else:
        unnested = counted(unnested)
    tested = of_tests(unnested, configs)
    valued = value_of_acquisitions(price_acquisitions(tested, prices), rates, fix_gbp, quarterly)
    return valued.selectExpr(*SAMPLE_KEY, f"{cap('av_gbp', value_cap)} as capped_av_gbp", "n")


def acquisition_totals(values: DataFrame) -> DataFrame:
    """Value and number of acquisitions per hour, test and variant."""
    return values.groupBy(*SAMPLE_KEY).agg(
        F.expr(f"{exact_sum('capped_av_gbp', 'n')} as sum_av_gbp"), F.expr("sum(n) as acquisitions")
    )


def unrated_acquisitions(
    acquisitions: DataFrame, rates: DataFrame | Lookup, hours: Hours | None = None
) -> DataFrame:
    """Per hour, the acquisitions that count nowhere as their currency has no rate on the day."""
    hours_and_currencies = acquired_in(acquisitions, hours).selectExpr(
        f"{hour_of('event_timestamp')} as window_start", "currency"
    )
    return (
        counted(hours_and_currencies)
        .withColumn("rates_date", F.expr(rates_date("window_start")))
        .join(Lookup.of(rates).side, ["rates_date", "currency"], "left_anti")
        .groupBy("window_start")
        .agg(F.expr("sum(n) as unrated"))
    )


def article_acquisition_values(
    acquisitions: DataFrame,
    prices: DataFrame | Lookup,
    rates: DataFrame | Lookup,
    hours: Hours | None = None,
    span: int = BOOST_WINDOW_HOURS,
) -> DataFrame:
    """Rows (window_start, url, region, av_gbp, n): the acquisitions of an article that have this value, per window.

    ``rates`` are boost rates. The value has no cap. Rates are those of the window, so an acquisition
    may have another value in the next window. Where the lookups are too large to broadcast, equal acquisitions of an hour are
    counted before they are joined.
    """
    single = hours is not None and hours.single
    window_start = ntz(hours.first) if single else f"explode({window_starts('hour', span)})"
    columns = ["payment_frequency", "currency", "url", "region"]
    prices, rates = Lookup.all(prices, rates)
    rows = acquired_in(acquisitions, hours).selectExpr(
        f"{hour_of('event_timestamp')} as hour",
        "product",
        "amount",
        "payment_frequency",
        "currency",
        "referrer_url as url",
        f"{region_of('country_code')} as region",
    )
    rows = rows.withColumn("n", F.expr("1L")) if prices.small and rates.small else counted(rows)
    paid = paid_or_list_price("product", "amount", "price")
    rows = (
        list_prices(rows, prices)
        .selectExpr(f"{window_start} as window_start", *columns, f"{paid} as paid", "n")
        .selectExpr("*", f"{rates_date('window_start')} as rates_date")
    )
    if hours is not None and not single:
        rows = rows.where(hours.starts("window_start"))
    return rows.join(rates.side, ["rates_date", "currency"]).selectExpr(
        "window_start",
        "url",
        "region",
        f"{annualise('paid * to_gbp_rate', 'payment_frequency')} as av_gbp",
        "n",
    )


def acquired_articles(acquisitions: DataFrame, hours: Hours | None = None) -> DataFrame:
    """The (url, region) with any acquisition, of value or not."""
    return (
        acquired_in(acquisitions, hours)
        .where("referrer_url is not null")
        .selectExpr("referrer_url as url", f"{region_of('country_code')} as region")
        .distinct()
    )


def article_acquisitions(values: DataFrame) -> DataFrame:
    """Value and number of acquisitions per window, article URL and region."""
    return values.groupBy("window_start", "url", "region").agg(
        F.expr(f"{exact_sum('av_gbp', 'n')} as sum_av_gbp"), F.expr("sum(n) as acquisitions")
    )

"""List prices: from the product catalog to a price per product, frequency and currency."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuelens.functions.text import one_of, quoted, struct_array
from valuelens.functions.value import paid_or_list_price
from valuelens.operators.lookup import Lookup
from valuelens.schemas import (
    BILLING_PERIODS,
    BOOST_PRICES,
    CATALOG_CURRENCIES,
    CATALOG_PRODUCTS,
    PRICED_FREQUENCIES,
)

PRICE_KEY = ["product", "currency", "payment_frequency"]

_PRICED = [
    (product, frequency)
    for product, frequencies in PRICED_FREQUENCIES.items()
    for frequency in frequencies
]


def price_dimension(catalog: DataFrame, *keep: str) -> DataFrame:
    """(product, payment_frequency, currency, price) of a catalog; absent prices have no row.

    ``keep`` names further columns of the catalog to carry along, such as a version.
    """
    plans = struct_array(
        ["product", "payment_frequency", "pricing"],
        [
            (
                quoted(product),
                quoted(frequency),
                f"{CATALOG_PRODUCTS[product]}.ratePlans['{BILLING_PERIODS[frequency]}'].pricing",
            )
            for product, frequency in _PRICED
        ],
    )
    return (
        catalog.selectExpr(*keep, f"inline({plans})")
        .selectExpr(
            *keep, "product", "payment_frequency", "explode(pricing) as (currency, price)"
        )
        .where(f"{one_of('currency', CATALOG_CURRENCIES)} and price is not null")
    )


def boost_prices(spark: SparkSession) -> DataFrame:
    """The fixed price list of the boost job."""
    rows = [(*(quoted(name) for name in row[:3]), f"{row[3]}d") for row in BOOST_PRICES]
    prices = struct_array([*PRICE_KEY, "price"], rows)
    return spark.range(0, 1, 1, 1).selectExpr(f"inline({prices})")


def list_prices(requests: DataFrame, prices: DataFrame | Lookup, strict: bool = False) -> DataFrame:
    """Adds ``price`` to rows that have product, currency and payment_frequency.

    A missing price is NULL, or fails the query if ``strict``.
    """
    found = requests.join(Lookup.of(prices).side, PRICE_KEY, "left")
    if not strict:
        return found
    missing = f"raise_error(concat_ws(' ', 'no list price:', {', '.join(PRICE_KEY)}))"
    return found.withColumn("price", F.expr(f"coalesce(price, {missing})"))


def price_matrix(prices: DataFrame, *keep: str) -> DataFrame:
    """Per product and currency, a map from payment frequency to price.

    With ``keep`` there are about as many groups as catalogs, and sums of a task hardly shrink its rows: these are dealt by group
    first, so that no task holds the groups of all that it read. Without it the groups are few, and summed where they are read.
    """
    # A map of at most three frequencies, so no group can grow.
    frequencies = ", ".join(quoted(name) for name in BILLING_PERIODS)
    found = ", ".join(
        f"max(price) filter (where payment_frequency = '{name}')" for name in BILLING_PERIODS
    )
    all_prices = f"map_from_arrays(array({frequencies}), array({found}))"
    groups = [*keep, "product", "currency"]
    dealt = prices.repartition(*groups) if keep else prices
    return dealt.groupBy(*groups).agg(
        F.expr(f"map_filter({all_prices}, (frequency, price) -> price is not null)").alias("prices")
    )


def price_acquisitions(acquisitions: DataFrame, prices: DataFrame | Lookup) -> DataFrame:
    """Adds ``paid``: the amount of contributions, the list price of other products."""
    paid = paid_or_list_price("product", "amount", "price")
    return list_prices(acquisitions, prices).withColumn("paid", F.expr(paid))


def missing_prices(prices: DataFrame) -> DataFrame:
    """The (product, payment_frequency, currency) that should have a list price but do not."""
    wanted = struct_array(
        ["product", "payment_frequency", "currency"],
        [
            (quoted(product), quoted(frequency), quoted(currency))
            for product, frequency in _PRICED
            for currency in CATALOG_CURRENCIES
        ],
    )
    return (
        prices.sparkSession.range(0, 1, 1, 1)
        .selectExpr(f"inline({wanted})")
        .join(prices, PRICE_KEY, "left_anti")
    )

"""Exchange rates. A rate is the number of units of ``target`` per EUR on a day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuelens.functions.hours import Hours, days_between
from valuelens.functions.value import reverse_rate


def rates_for(rates: DataFrame, hours: Hours | None) -> DataFrame:
    """Only the days the windows need."""
    return rates if hours is None else rates.where(days_between("date", hours.rates_dates))


def eur_rates(rates: DataFrame) -> DataFrame:
    """EUR per unit of each currency: (date, currency, reverse_rate)."""
    return rates.selectExpr(
        "date", "target as currency", f"{reverse_rate('rate')} as reverse_rate"
    )


def gbp_rates(rates: DataFrame) -> DataFrame:
    return rates.where("target = 'GBP'").selectExpr("date", "rate as gbp_rate")


def sample_rates(rates: DataFrame) -> DataFrame:
    """(rates_date, currency, reverse_rate, gbp_rate), the rates variant samples are valued at.

    A day without a GBP rate has no row. A day with two GBP rates has every row twice, which counts
    the acquisitions valued at it twice.
    """
    return eur_rates(rates).join(gbp_rates(rates), "date").withColumnRenamed("date", "rates_date")


def boost_rates(rates: DataFrame) -> DataFrame:
    """(rates_date, currency, to_gbp_rate), the rates boosts are valued at.

    A day without a GBP rate has NULL rates. A day with two fails the query.
    """
    two_rates = "raise_error('more than one GBP rate on ' || date)"
    gbp = (
        gbp_rates(rates)
        .groupBy("date")
        .agg(F.expr("min(gbp_rate) as gbp_rate"), F.expr("count(*) as n"))
        .selectExpr("date", f"if(n > 1, {two_rates}, gbp_rate) as gbp_rate")
    )
    return (
        eur_rates(rates)
        .join(gbp, "date", "left")
        .selectExpr("date as rates_date", "currency", "gbp_rate * reverse_rate as to_gbp_rate")
    )

"""SQL expressions that turn a payment into annualised value. Arguments are SQL text."""

from __future__ import annotations

from valuelens.functions.text import case_of, one_of
from valuelens.schemas import (
    PAID_AMOUNT_PRODUCTS,
    PAYMENTS_PER_YEAR,
    QUARTERLY_PAYMENTS_PER_YEAR,
    VALUE_CAP,
)


def reverse_rate(rate: str) -> str:
    """EUR per unit of a currency. A rate of zero fails the query."""
    return f"1 / {rate}"


def paid_or_list_price(product: str, amount: str, price: str) -> str:
    """What was paid for a contribution, the list price (or NULL) for everything else."""
    return f"if({one_of(product, PAID_AMOUNT_PRODUCTS)}, {amount}, {price})"


def annualise(value: str, frequency: str, quarterly: bool = False) -> str:
    """Value of a year of payments; NULL for any frequency without a rule.

    Quarterly payments have no rule unless ``quarterly`` asks for one.
    """
    payments = dict(PAYMENTS_PER_YEAR)
    if quarterly:
        payments["QUARTERLY"] = QUARTERLY_PAYMENTS_PER_YEAR
    return case_of(
        frequency,
        {name: f"({value})" if times == 1 else f"({value}) * {times}" for name, times in payments.items()},
    )


def eur_to_gbp(av_eur: str, currency: str, gbp_rate: str, fix_gbp: bool = False) -> str:
    """GBP value of a EUR value.

    Payments made in GBP keep the EUR figure, as the results compared against do; ``fix_gbp`` converts
    them like all others.
    """
    converted = f"{av_eur} * {gbp_rate}"
    return converted if fix_gbp else f"if({currency} = 'GBP', {av_eur}, {converted})"


def cap(value: str, limit: float = VALUE_CAP) -> str:
    """At most ``limit``. A NULL stays NULL, which ``least`` would replace by the limit."""
    return f"if({value} >= {float(limit)}d, {float(limit)}d, {value})"


PART = 1 << 30


def exact_sum(value: str, times: str = "1L") -> str:
    """The sum of a column of doubles, each counted ``times`` times, in which the order of rows plays no part.

    Every double is cut into a whole number and two fractions of thirty bits, which are summed as whole numbers; what is
    beyond sixty bits behind the point is dropped, which is nothing for values of a cent or more. The sum of no values, or of
    NULLs alone, is NULL. A group may have eight billion rows.
    """
    fraction = f"({value} - floor({value})) * {PART}d"
    rest = f"({fraction} - floor({fraction})) * {PART}d"
    whole, upper, lower = (f"cast(sum(floor({part}) * {times}) as double)" for part in (value, fraction, rest))
    return f"({whole} + ({upper} + {lower} / {PART}d) / {PART}d)"

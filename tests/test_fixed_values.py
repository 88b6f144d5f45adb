"""The fixed values that results depend on, once more: the SQL twins read the same constants, so that they cannot show a wrong one."""

from collections import Counter

from valuelens import schemas


def test_boosts():
    assert schemas.BOOST_THRESHOLDS == {"GB": 0.003, "US": 0.028, "AU": 0.006, "NZ": 0.004, "CA": 0.004, "EU": 0.003, "ROW": 0.003}
    assert (schemas.BOOST_WINDOW_HOURS, schemas.BOOST_DURATION_HOURS) == (3, 24)
    assert (schemas.BOOST_MIN_VIEWS, schemas.BOOST_MIN_VALUE) == (100, 40)
    monthly = {currency: price for _, currency, frequency, price in schemas.BOOST_PRICES if frequency == "MONTHLY"}
    yearly = {currency: (frequency, price) for _, currency, frequency, price in schemas.BOOST_PRICES if frequency != "MONTHLY"}
    assert monthly == {"GBP": 12, "USD": 15, "AUD": 20, "EUR": 12, "NZD": 20, "CAD": 15}
    # One plan has a key that no event has.
    assert yearly == {c: ("ANNUAL" if c == "AUD" else "ANNUALLY", 10 * price) for c, price in monthly.items()}
    assert Counter(product for product, *_ in schemas.BOOST_PRICES) == {"SUPPORTER_PLUS": 12}


def test_regions():
    assert schemas.COUNTRY_REGIONS == ["GB", "US", "AU", "NZ", "CA"]
    countries = schemas.EU_COUNTRIES
    assert len(countries) == len(set(countries)) == 55 and all(len(c) == 2 and c.isupper() for c in countries)
    assert {"DE", "FR", "IE", "IT", "ES", "NL", "PL", "SE", "CH", "NO", "IS", "AX"} <= set(countries)
    assert not {"GB", "UK", "RU", "UA", "JP", "IN"} & set(countries)


def test_samples():
    assert schemas.VALUE_CAP == 250
    assert schemas.PAYMENTS_PER_YEAR == {"ONE_OFF": 1, "MONTHLY": 12, "ANNUALLY": 1}
    assert schemas.CHANNELS == ["Epic", "Banner1", "Banner2", "SupportLandingPage"]
    assert list(schemas.COMPONENT_TYPES.values()) == [
        "ACQUISITIONS_EPIC", "ACQUISITIONS_ENGAGEMENT_BANNER", "ACQUISITIONS_SUBSCRIPTIONS_BANNER",
    ]
    assert schemas.SAMPLED_METHODOLOGIES == ["EpsilonGreedyBandit", "Roulette"]
    assert schemas.PAID_AMOUNT_PRODUCTS == ["CONTRIBUTION", "RECURRING_CONTRIBUTION"]
    assert schemas.LANDING_PATH == "%/contribute" and schemas.CATALOG_CURRENCIES == ["GBP", "USD", "AUD", "EUR", "NZD", "CAD"]

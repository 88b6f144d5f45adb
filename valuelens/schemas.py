"""Table schemas and the fixed values the results depend on."""

from __future__ import annotations

# Narrow schemas: reading with them keeps unused sub-fields of the nested arrays out of the scan.
PAGE_VIEWS = """
    protocol string, host string, path string, country_key string,
    component_event_array array<struct<
        event_timestamp: timestamp_ntz, event_action: string, component_type: string,
        ab_test_name: string, ab_test_variant: string>>,
    ab_test_array array<struct<ab_test_name: string, ab_test_variant: string>>,
    received_date date
"""

ACQUISITIONS = """
    event_timestamp timestamp_ntz, product string, payment_frequency string, currency string,
    amount double, component_type string, country_code string, referrer_url string,
    ab_tests array<struct<name: string, variant: string>>
"""

EXCHANGE_RATES = "date date, target string, rate double"

CHANNEL_TESTS = """
    channel string, name string, status string,
    methodologies array<struct<name: string, testName: string, epsilon: double>>
"""

RATE_PLAN = "struct<billingPeriod: string, pricing: map<string, double>>"
PRODUCT = f"struct<active: boolean, ratePlans: map<string, {RATE_PLAN}>>"
PRODUCT_CATALOG = f"SupporterPlus {PRODUCT}, DigitalSubscription {PRODUCT}"

SAMPLE_RECORDS = """
    testName string,
    variants array<struct<
        variantName: string, annualisedValueInGBP: double,
        annualisedValueInGBPPerView: double, views: bigint>>,
    timestamp string
"""

BOOST_RECORDS = """
    url string, region string, totalAv double, totalAcquisitions bigint, totalViews bigint,
    avPerView double, id string, startTimestamp string, endDate string, endTimestamp string
"""

METRICS = "name string, value double, unit string, time timestamp_ntz"

# ---------------------------------------------------------------- fixed values

# Channel -> type of its component events. The landing-page channel has none.
COMPONENT_TYPES = {
    "Epic": "ACQUISITIONS_EPIC",
    "Banner1": "ACQUISITIONS_ENGAGEMENT_BANNER",
    "Banner2": "ACQUISITIONS_SUBSCRIPTIONS_BANNER",
}
LANDING_CHANNEL = "SupportLandingPage"
CHANNELS = [*COMPONENT_TYPES, LANDING_CHANNEL]
BOOST_COMPONENT_TYPE = "ACQUISITIONS_EPIC"

SAMPLED_METHODOLOGIES = ["EpsilonGreedyBandit", "Roulette"]

LANDING_PATH = "%/contribute"

# Annualised value counted per acquisition in variant samples, at most.
VALUE_CAP = 250

# Times a year that a payment of each frequency is taken.
PAYMENTS_PER_YEAR = {"ONE_OFF": 1, "MONTHLY": 12, "ANNUALLY": 1}
QUARTERLY_PAYMENTS_PER_YEAR = 4

# Products that are valued at what was paid, not at a list price.
PAID_AMOUNT_PRODUCTS = ["CONTRIBUTION", "RECURRING_CONTRIBUTION"]

# Event product -> catalog product, and the payment frequencies that have a list price.
CATALOG_PRODUCTS = {
    "SUPPORTER_PLUS": "SupporterPlus",
    "DIGITAL_SUBSCRIPTION": "DigitalSubscription",
}
BILLING_PERIODS = {"MONTHLY": "Monthly", "ANNUALLY": "Annual", "QUARTERLY": "Quarterly"}
PRICED_FREQUENCIES = {
    "SUPPORTER_PLUS": ["MONTHLY", "ANNUALLY"],
    "DIGITAL_SUBSCRIPTION": ["MONTHLY", "QUARTERLY", "ANNUALLY"],
}
CATALOG_CURRENCIES = ["GBP", "USD", "AUD", "EUR", "NZD", "CAD"]

# List prices of the boost job. The AUD annual plan carries the key ANNUAL, which no event has.
BOOST_PRICES = [
    ("SUPPORTER_PLUS", "GBP", "MONTHLY", 12.0),
    ("SUPPORTER_PLUS", "GBP", "ANNUALLY", 120.0),
    ("SUPPORTER_PLUS", "USD", "MONTHLY", 15.0),
    ("SUPPORTER_PLUS", "USD", "ANNUALLY", 150.0),
    ("SUPPORTER_PLUS", "AUD", "MONTHLY", 20.0),
    ("SUPPORTER_PLUS", "AUD", "ANNUAL", 200.0),
    ("SUPPORTER_PLUS", "EUR", "MONTHLY", 12.0),
    ("SUPPORTER_PLUS", "EUR", "ANNUALLY", 120.0),
    ("SUPPORTER_PLUS", "NZD", "MONTHLY", 20.0),
    ("SUPPORTER_PLUS", "NZD", "ANNUALLY", 200.0),
    ("SUPPORTER_PLUS", "CAD", "MONTHLY", 15.0),
    ("SUPPORTER_PLUS", "CAD", "ANNUALLY", 150.0),
]

# Boost job: window, duration, gates and the value per view an article must reach.
BOOST_WINDOW_HOURS = 3
BOOST_DURATION_HOURS = 24
BOOST_MIN_VIEWS = 100
BOOST_MIN_VALUE = 40
BOOST_THRESHOLDS = {
    "GB": 0.003,
    "US": 0.028,
    "AU": 0.006,
    "NZ": 0.004,
    "CA": 0.004,
    "EU": 0.003,
    "ROW": 0.003,
}

# Countries that are a region of their own, and those reported as EU. All others are ROW.
COUNTRY_REGIONS = ["GB", "US", "AU", "NZ", "CA"]
EU_COUNTRIES = """
    AD AL AT BA BE BG BL CH CY CZ DE DK EE ES FI FO FR GF GL GP GR HR HU IE IT LI LT LU
    LV MC ME MF IS MQ MT NL NO PF PL PM PT RE RO RS SE SI SJ SK SM TF TR WF YT VA AX
""".split()

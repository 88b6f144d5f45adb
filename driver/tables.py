"""The driver's tables in the shape the library reads. Every rule works row by row, so that hot users or
keys cost nothing, and is repeated in SQL in ``oracle.py``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LANDING_HOST = "support.example.com"

COMPONENTS = [
    "ACQUISITIONS_EPIC",
    "ACQUISITIONS_ENGAGEMENT_BANNER",
    "ACQUISITIONS_SUBSCRIPTIONS_BANNER",
]
COUNTRIES = ["GB", "US", "AU", "NZ", "CA", "DE", "FR", "JP"]
PRODUCTS = ["CONTRIBUTION", "RECURRING_CONTRIBUTION", "SUPPORTER_PLUS", "DIGITAL_SUBSCRIPTION"]
CURRENCIES = ["GBP", "USD", "AUD", "EUR", "NZD", "CAD", "JPY"]
FREQUENCIES = ["ONE_OFF", "MONTHLY", "ANNUALLY", "QUARTERLY"]
CHANNELS = ["Epic", "Banner1", "Banner2", "SupportLandingPage", "Header"]

CONFIGS = [
    ("Epic", "TEST_0"),
    ("Banner1", "TEST_1"),
    ("Banner2", "TEST_2"),
    ("SupportLandingPage", "LP_TEST_1"),
]

# Units per EUR; the rate of a day is base * (1 + day of month / 1000), that of EUR always 1.
BASE_RATES = {"GBP": 0.85, "USD": 1.1, "AUD": 1.65, "EUR": 1.0, "NZD": 1.78, "CAD": 1.48}

# (catalog product, rate plan): price per currency. Made up: a month's price in pounds, what a plan costs in months, and
# what a currency's prices are raised by.
MONTH = {"SupporterPlus": 11.5, "DigitalSubscription": 17.25}
MONTHS = {"Monthly": 1, "Quarterly": 2.75, "Annual": 10}
RAISED = {"GBP": 1, "USD": 1.25, "AUD": 1.75, "EUR": 1.125, "NZD": 1.875, "CAD": 1.5}
PLANS = {"SupporterPlus": ["Monthly", "Annual"], "DigitalSubscription": ["Monthly", "Quarterly", "Annual"]}
CATALOG_PRICES = {
    (product, plan): {currency: MONTH[product] * MONTHS[plan] * by for currency, by in RAISED.items()}
    for product, plans in PLANS.items()
    for plan in plans
}


EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_pick(options: list[str], index: str) -> str:
    names = ", ".join(f"'{o}'" for o in options)
    return f"element_at(array({names}), cast({index} as int) + 1)"


def pick(options: list[str], index: str) -> Column:
    return F.expr(sql_pick(options, index))


def rows_of(spark: SparkSession, structs: str) -> DataFrame:
    """A small table from SQL for an array of structs."""
    return spark.range(0, 1, 1, 1).select(F.expr(f"inline({structs})"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet")
    return keyed(source.parquet(sf_dir))


def keyed(rows: DataFrame) -> DataFrame:
    # json_tuple, as Spark would repeat get_json_object for every use of k.
    return rows.select(
        "event_id", "ts", "user_id", "event_type", "value", F.json_tuple("props", "k").alias("k")
    ).withColumn("k", F.col("k").cast("int"))


def page_views(rows: DataFrame) -> DataFrame:
    """A page view per event. Its components: the event, for half of the views also a closing; for some
    other events none, as an empty or a missing array."""
    component = (
        "named_struct('event_timestamp', ts, 'event_action', {}, 'component_type', "
        + sql_pick(COMPONENTS, "k % 3")
        + ", 'ab_test_name', 'TEST_' || (k % 5),"
        " 'ab_test_variant', if(user_id % 2 = 0, 'control', 'variant'))"
    ).format
    number = (
        "case when event_type = 'view' then if(k % 2 = 0, 2, 1)"
        " when k % 10 = 0 then null when k % 10 = 1 then 0 else 1 end"
    )
    return rows.select(
        F.expr("if(event_id % 50 = 0, date_add(date(ts), 1), date(ts - interval 1 hour))").alias(
            "received_date"
        ),
        F.lit("https").alias("protocol"),
        F.expr("if(user_id % 10 = 0, 'support.example.com', 'www.example.com')").alias("host"),
        F.expr(
            "case when user_id % 20 = 0 then '/uk/contribute' when user_id % 10 = 0 then '/uk/checkout'"
            " else '/article/' || (user_id % 10) end"
        ).alias("path"),
        pick(COUNTRIES, "user_id % 8").alias("country_key"),
        F.expr(
            f"slice(array({component('upper(event_type)')}, {component("'CLOSE'")}), 1, {number})"
        ).alias("component_event_array"),
        F.expr(
            "if(user_id % 20 = 0, array(named_struct('ab_test_name', 'LP_TEST_1', 'ab_test_variant',"
            " if(user_id % 40 = 0, 'control', 'variant'))), null)"
        ).alias("ab_test_array"),
    )


def acquisitions(rows: DataFrame) -> DataFrame:
    tests = (
        "array(named_struct('name', 'TEST_' || (k % 5), 'variant',"
        " if(user_id % 2 = 0, 'control', 'variant')))"
    )
    landing = (
        "array(named_struct('name', 'LP_TEST_1', 'variant',"
        " if(user_id % 40 = 0, 'control', 'variant')))"
    )
    return rows.where("event_type = 'purchase'").select(
        F.col("ts").alias("event_timestamp"),
        pick(PRODUCTS, "k % 4").alias("product"),
        pick(FREQUENCIES, "event_id % 4").alias("payment_frequency"),
        pick(CURRENCIES, "event_id % 7").alias("currency"),
        F.col("value").alias("amount"),
        pick(COMPONENTS, "k % 3").alias("component_type"),
        pick(COUNTRIES, "user_id % 8").alias("country_code"),
        F.expr("'https://www.example.com/article/' || (user_id % 10)").alias("referrer_url"),
        F.expr(f"if(user_id % 20 = 0, concat({tests}, {landing}), {tests})").alias("ab_tests"),
    )


def exchange_rates(spark: SparkSession) -> DataFrame:
    rates = ", ".join(f"'{c}', {r}d" for c, r in BASE_RATES.items())
    return (
        spark.range(0, 35, 1, 1)
        .select(F.expr("date_add(date'2023-12-28', cast(id as int))").alias("date"))
        .select("date", F.explode(F.expr(f"map({rates})")).alias("target", "base"))
        .select(
            "date",
            "target",
            F.expr("if(target = 'EUR', 1d, base * (1 + day(date) / 1000d))").alias("rate"),
        )
    )


def quoted_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates as quoted on the orders' days, several a day and currency."""
    rates = ", ".join(f"{r}d" for r in BASE_RATES.values())
    return table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("date"),
        pick(list(BASE_RATES), "o_orderkey % 6").alias("target"),
        F.expr(
            f"element_at(array({rates}), cast(o_orderkey % 6 as int) + 1)"
            " * (1 + (o_orderkey % 100) / 1000d)"
        ).alias("rate"),
    )


def daily_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lowest quote of each day and currency."""
    return quoted_rates(spark, sf_dir).groupBy("date", "target").agg(F.min("rate").alias("rate"))


def configs(spark: SparkSession) -> DataFrame:
    structs = [f"named_struct('channel', '{c}', 'name', '{n}')" for c, n in CONFIGS]
    return rows_of(spark, f"array({', '.join(structs)})")


def channel_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A test document per customer, with and without methodologies to sample."""
    methodology = "named_struct('name', '{}', 'testName', {}, 'epsilon', {})".format
    no_name, no_epsilon = "cast(null as string)", "cast(null as double)"
    bandit, roulette = "EpsilonGreedyBandit", "Roulette"
    name = "'TEST_' || c_custkey"
    return table(spark, sf_dir, "customer").select(
        pick(CHANNELS, "c_custkey % 5").alias("channel"),
        F.expr(name).alias("name"),
        F.expr("element_at(array('Live', 'Draft', 'Archived', null), c_nationkey % 4 + 1)").alias(
            "status"
        ),
        F.expr(
            f"""
            case c_custkey % 7
            when 0 then null
            when 1 then slice(array({methodology('ABTest', no_name, no_epsilon)}), 1, 0)
            when 2 then array({methodology('ABTest', no_name, no_epsilon)})
            when 3 then array({methodology(roulette, no_name, no_epsilon)},
                              {methodology(bandit, no_name, '0.1d')})
            when 4 then array({methodology(bandit, name + " || '_EG'", '0.2d')},
                              {methodology('ABTest', no_name, no_epsilon)})
            when 5 then array({methodology(roulette, "''", no_epsilon)})
            else array({methodology(bandit, no_name, '0.5d')})
            end
            """
        ).alias("methodologies"),
    )


def catalog_text(raised_by: str = "0", pricing_of=None, active_of=None) -> str:
    """SQL for a catalog document, its prices raised by an expression."""
    plans: dict[str, list[str]] = {}
    for (product, plan), prices in CATALOG_PRICES.items():
        amounts = ", ".join(f"'{c}', {float(p)}d + {raised_by}" for c, p in prices.items())
        pricing = f"map({amounts})"
        if pricing_of:
            pricing = pricing_of(product, plan, pricing)
        plans.setdefault(product, []).append(
            f"'{plan}', named_struct('billingPeriod', '{plan}', 'pricing', {pricing})"
        )
    products = [
        f"'{product}', named_struct('active', {active_of(product) if active_of else 'true'}, 'ratePlans', map({', '.join(parts)}))"
        for product, parts in plans.items()
    ]
    return f"to_json(named_struct({', '.join(products)}))"


def catalog_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A version of the catalog per part, some with gaps: no AUD price of the quarterly plan, prices in
    one more currency, no pricing of an annual plan."""

    def with_gaps(product: str, plan: str, pricing: str) -> str:
        if (product, plan) == ("DigitalSubscription", "Quarterly"):
            return f"map_filter({pricing}, (c, p) -> not (c = 'AUD' and p_partkey % 5 = 0))"
        if (product, plan) == ("SupporterPlus", "Monthly"):
            return f"if(p_partkey % 7 = 0, map_concat({pricing}, map('JPY', 1900d)), {pricing})"
        if (product, plan) == ("DigitalSubscription", "Annual"):
            return f"if(p_partkey % 11 = 0, null, {pricing})"
        return pricing

    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("version"),
        F.expr(catalog_text("(p_partkey % 10)", with_gaps)).alias("document"),
    )


#: By remainder of the version: the rule that its document breaks.
BROKEN = {
    **{2 * i: (product, plan, "gone") for i, (product, plan) in enumerate(CATALOG_PRICES)},
    **{2 * i + 1: (product, plan, "empty") for i, (product, plan) in enumerate(CATALOG_PRICES)},
    10: ("SupporterPlus", None, "inactive"),
    11: ("DigitalSubscription", None, "inactive"),
}
BROKEN_OF = 97
MALFORMED = 50
BUNDLES = 40


def broken_catalog_documents(spark: SparkSession, sf_dir: str, malformed: bool = False) -> DataFrame:
    """A version of the catalog per part; some break one of the rules, each rule in another version."""
    remainder = f"p_partkey % {BROKEN_OF}"
    where = {broken: f"{remainder} = {k}" for k, broken in BROKEN.items()}

    def broken_pricing(product: str, plan: str, pricing: str) -> str:
        no_price = f"map_concat(map_filter({pricing}, (c, p) -> c <> 'GBP'), map('GBP', cast(null as double)))"
        return (
            f"case when {where[product, plan, 'gone']} then null"
            f" when {where[product, plan, 'empty']} then {no_price} else {pricing} end"
        )

    text = catalog_text("(p_partkey % 10)", broken_pricing, lambda product: f"if({where[product, None, 'inactive']}, null, true)")
    if malformed:
        text = f"if({remainder} = {MALFORMED}, substr({text}, 2), {text})"
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("version"), F.expr(f"p_partkey % {BUNDLES}").alias("bundle"), F.expr(text).alias("document")
    )


def catalog_document(spark: SparkSession) -> DataFrame:
    return spark.range(0, 1, 1, 1).select(F.expr(catalog_text()).alias("document"))


def stored_boosts(rows: DataFrame) -> DataFrame:
    """Boost records as earlier runs may have left them: one per sign-up, some stored repeatedly."""
    article = "'https://www.example.com/article/' || (user_id % 10)"
    region = pick(["GB", "US", "AU", "NZ", "CA", "EU", "EU", "ROW"], "user_id % 8")
    start = F.expr("date_trunc('hour', ts)")
    end = F.expr("date_trunc('hour', ts) + interval 24 hours")
    return rows.where("event_type = 'signup'").select(
        F.concat(region, F.lit("_"), F.translate(F.base64(F.expr(article)), "\r\n", "")).alias("id"),
        F.expr(article).alias("url"),
        region.alias("region"),
        F.date_format(start, "yyyy-MM-dd HH:00:00.000").alias("startTimestamp"),
        F.date_format(end, "yyyy-MM-dd").alias("endDate"),
        F.date_format(end, "yyyy-MM-dd HH:00:00.000").alias("endTimestamp"),
        F.col("value").alias("totalAv"),
        (F.col("value") / 100).alias("avPerView"),
        F.col("k").cast("bigint").alias("totalViews"),
        F.lit(1).cast("bigint").alias("totalAcquisitions"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("written_at"),
        F.lpad(F.col("event_id").cast("string"), 20, "0").alias("run_id"),
    )

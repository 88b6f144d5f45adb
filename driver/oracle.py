"""The queries once more, as DuckDB SQL over the driver's tables."""

from __future__ import annotations

from driver import tables as t
from valuelens.schemas import (
    BOOST_PRICES,
    BOOST_THRESHOLDS,
    COMPONENT_TYPES,
    COUNTRY_REGIONS,
    EU_COUNTRIES,
)


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _rows(rows) -> str:
    return ", ".join("(" + ", ".join(_value(v) for v in row) + ")" for row in rows)


def _value(value) -> str:
    if value is None:
        return "NULL"
    return f"'{value}'" if isinstance(value, str) else f"{value}::double"


def _region(country: str) -> str:
    return (
        f"CASE WHEN {country} IN {_in(COUNTRY_REGIONS)} THEN {country}"
        f" WHEN {country} IN {_in(EU_COUNTRIES)} THEN 'EU' ELSE 'ROW' END"
    )


FREQUENCY_OF_PLAN = {"Monthly": "MONTHLY", "Annual": "ANNUALLY", "Quarterly": "QUARTERLY"}
PRODUCT_OF_NAME = {
    "SupporterPlus": "SUPPORTER_PLUS",
    "DigitalSubscription": "DIGITAL_SUBSCRIPTION",
}
LIST_PRICES = [
    (PRODUCT_OF_NAME[product], currency, FREQUENCY_OF_PLAN[plan], float(price))
    for (product, plan), prices in t.CATALOG_PRICES.items()
    for currency, price in prices.items()
]

# One CTE per line of work, given the ones it builds on.
CTES = {
    "e": "SELECT *, json_extract_string(props, '$.k')::int AS k FROM events",
    "page_views": f"""
        SELECT CASE WHEN event_id % 50 = 0 THEN ts::date + 1
                    ELSE (ts - INTERVAL 1 HOUR)::date END AS received_date,
            CASE WHEN user_id % 10 = 0 THEN 'support.example.com' ELSE 'www.example.com' END AS host,
            CASE WHEN user_id % 20 = 0 THEN '/uk/contribute' WHEN user_id % 10 = 0 THEN '/uk/checkout'
                 ELSE '/article/' || (user_id % 10) END AS path,
            {_list(t.COUNTRIES)}[user_id % 8 + 1] AS country_key,
            CASE WHEN event_type <> 'view' AND k % 10 = 0 THEN NULL
                 WHEN event_type <> 'view' AND k % 10 = 1 THEN []
                 WHEN event_type = 'view' AND k % 2 = 0 THEN [upper(event_type), 'CLOSE']
                 ELSE [upper(event_type)] END AS actions,
            ts, {_list(t.COMPONENTS)}[k % 3 + 1] AS component_type, 'TEST_' || (k % 5) AS test_name,
            CASE WHEN user_id % 2 = 0 THEN 'control' ELSE 'variant' END AS variant_name,
            CASE WHEN user_id % 20 = 0 THEN 'LP_TEST_1' END AS landing_test,
            CASE WHEN user_id % 40 = 0 THEN 'control' ELSE 'variant' END AS landing_variant
        FROM e""",
    "view_events": """
        SELECT * FROM (SELECT * EXCLUDE (actions), unnest(actions) AS action FROM page_views)
        WHERE action = 'VIEW'""",
    "hourly_events": """
        SELECT *, date_trunc('hour', ts)::timestamp AS window_start FROM view_events
        WHERE received_date BETWEEN ts::date - 1 AND ts::date""",
    "acquisitions": f"""
        SELECT event_id, ts AS event_timestamp, date_trunc('hour', ts)::timestamp AS window_start,
            {_list(t.PRODUCTS)}[k % 4 + 1] AS product,
            {_list(t.FREQUENCIES)}[event_id % 4 + 1] AS payment_frequency,
            {_list(t.CURRENCIES)}[event_id % 7 + 1] AS currency, value AS amount,
            {_list(t.COMPONENTS)}[k % 3 + 1] AS component_type,
            {_list(t.COUNTRIES)}[user_id % 8 + 1] AS country_code,
            'https://www.example.com/article/' || (user_id % 10) AS referrer_url, k, user_id
        FROM e WHERE event_type = 'purchase'""",
    "unnested": """
        SELECT *, 'TEST_' || (k % 5) AS test_name,
            CASE WHEN user_id % 2 = 0 THEN 'control' ELSE 'variant' END AS variant_name
        FROM acquisitions
        UNION ALL
        SELECT *, 'LP_TEST_1', CASE WHEN user_id % 40 = 0 THEN 'control' ELSE 'variant' END
        FROM acquisitions WHERE user_id % 20 = 0""",
    "configs": f"""
        SELECT * FROM (VALUES {_rows([(c, n, COMPONENT_TYPES.get(c)) for c, n in t.CONFIGS])})
            v(channel, test_name, test_type)""",
    "tested": """
        SELECT u.*, channel FROM unnested u JOIN configs USING (test_name)
        WHERE test_type IS NULL OR test_type = component_type""",
    "list_prices": f"""
        SELECT * FROM (VALUES {_rows(LIST_PRICES)}) v(product, currency, payment_frequency, price)""",
    "fixed_prices": f"""
        SELECT * FROM (VALUES {_rows(BOOST_PRICES)}) v(product, currency, payment_frequency, price)""",
    "rates": f"""
        SELECT date, target,
            CASE WHEN target = 'EUR' THEN 1.0::double
                 ELSE base * (1 + day(date) / 1000.0::double) END AS rate
        FROM (SELECT (DATE '2023-12-28' + i::int)::date AS date FROM range(35) r(i)),
            (VALUES {_rows(t.BASE_RATES.items())}) v(target, base)""",
    "sample_fx": """
        SELECT r.date AS rates_date, r.target AS currency, 1 / r.rate AS reverse_rate, g.rate AS gbp_rate
        FROM rates r JOIN rates g ON g.target = 'GBP' AND g.date = r.date""",
    "boost_fx": """
        SELECT r.date AS rates_date, r.target AS currency, g.rate * (1 / r.rate) AS to_gbp_rate
        FROM rates r LEFT JOIN rates g ON g.target = 'GBP' AND g.date = r.date""",
}


def _priced(source: str, prices: str) -> str:
    return f"""
        SELECT s.*, price,
            CASE WHEN product IN ('CONTRIBUTION', 'RECURRING_CONTRIBUTION') THEN amount
                 ELSE price END AS paid
        FROM {source} s LEFT JOIN {prices} USING (product, currency, payment_frequency)"""


def _valued(source: str, quarterly: bool = False, fix_gbp: bool = False) -> str:
    quarter = "WHEN 'QUARTERLY' THEN (paid * reverse_rate) * 4" if quarterly else ""
    gbp = "av_eur * gbp_rate" if fix_gbp else "av_eur"
    return f"""
        SELECT *, CASE currency WHEN 'GBP' THEN {gbp} ELSE av_eur * gbp_rate END AS av_gbp
        FROM (SELECT s.*, gbp_rate,
                CASE payment_frequency WHEN 'ONE_OFF' THEN paid * reverse_rate
                    WHEN 'MONTHLY' THEN (paid * reverse_rate) * 12
                    WHEN 'ANNUALLY' THEN paid * reverse_rate {quarter} END AS av_eur
            FROM {source} s JOIN sample_fx f
                ON f.currency = s.currency AND f.rates_date = s.window_start::date - 1)"""


def _exact_sum(value: str) -> str:
    """Whole numbers, and two fractions of thirty bits: a sum that does not depend on the order of rows."""
    part = "1073741824::double"
    fraction = f"({value} - floor({value})) * {part}"
    rest = f"({fraction} - floor({fraction})) * {part}"
    whole, upper, lower = (f"SUM(floor({x})::bigint)::double" for x in (value, fraction, rest))
    return f"({whole} + ({upper} + {lower} / {part}) / {part})"


def _totals(value_cap: float = 250.0) -> str:
    return f"""
        SELECT window_start, channel, test_name, variant_name, COUNT(*) AS acquisitions,
            {_exact_sum(f"(CASE WHEN av_gbp >= {value_cap} THEN {value_cap}::double ELSE av_gbp END)")} AS sum_av_gbp
        FROM valued GROUP BY ALL"""


def _samples(views: str, totals: str = "totals") -> str:
    return f"""
        SELECT v.*, COALESCE(sum_av_gbp, 0) AS sum_av_gbp,
            COALESCE(sum_av_gbp, 0) / views AS sum_av_gbp_per_view,
            COALESCE(acquisitions, 0)::bigint AS acquisitions
        FROM {views} v LEFT JOIN {totals} USING (window_start, channel, test_name, variant_name)"""


CTES |= {
    "component_views": """
        SELECT window_start, channel, test_name, variant_name, COUNT(*)::bigint AS views
        FROM hourly_events h JOIN configs c USING (test_name)
        WHERE c.test_type = h.component_type GROUP BY ALL""",
    "landing_days": """
        SELECT day, channel, test_name, variant_name, SUM(n)::bigint AS views
        FROM (SELECT unnest([received_date, received_date + 1])::date AS day, landing_test AS test_name,
                landing_variant AS variant_name, 1 AS n
            FROM page_views
            WHERE host = 'support.example.com' AND path LIKE '%/contribute'
                AND landing_test IS NOT NULL)
        JOIN configs USING (test_name) WHERE channel = 'SupportLandingPage' GROUP BY ALL""",
    "windows": """
        SELECT unnest(generate_series(date_trunc('hour', MIN(ts)), date_trunc('hour', MAX(ts)),
            INTERVAL 1 HOUR))::timestamp AS window_start
        FROM events""",
    "landing_views": """
        SELECT window_start, channel, test_name, variant_name, views
        FROM windows JOIN landing_days ON day = window_start::date""",
    "all_views": "SELECT * FROM component_views UNION ALL BY NAME SELECT * FROM landing_views",
    "priced": _priced("tested", "list_prices"),
    "valued": _valued("priced"),
    "totals": _totals(),
    "component_samples": _samples("component_views"),
    "all_samples": _samples("all_views"),
    "config_hours": "SELECT channel, test_name, window_start FROM configs, windows",
    "boost_hours": """
        SELECT unnest([0, 1, 2]) AS back, * FROM (
            SELECT date_trunc('hour', ts)::timestamp AS hour, *, 'https://' || host || path AS url,
                """ + _region("country_key") + """ AS region
            FROM view_events WHERE component_type = 'ACQUISITIONS_EPIC')""",
    "boost_views": """
        SELECT window_start, url, region, COUNT(*)::bigint AS total_views
        FROM (SELECT *, hour - back * INTERVAL 1 HOUR AS window_start FROM boost_hours)
        WHERE received_date BETWEEN window_start::date - 1 AND window_start::date GROUP BY ALL""",
    "boost_priced": _priced("acquisitions", "fixed_prices"),
    "boost_totals": """
        SELECT window_start, referrer_url AS url, region, COUNT(*)::bigint AS acquisitions,
            """ + _exact_sum("""(CASE payment_frequency WHEN 'ONE_OFF' THEN paid * to_gbp_rate
                WHEN 'MONTHLY' THEN (paid * to_gbp_rate) * 12
                WHEN 'ANNUALLY' THEN paid * to_gbp_rate END)""") + """ AS sum_av_gbp
        FROM (SELECT * EXCLUDE (window_start), window_start - back * INTERVAL 1 HOUR AS window_start
            FROM (SELECT *, unnest([0, 1, 2]) AS back, """ + _region("country_code") + """ AS region
                FROM boost_priced)) a
        JOIN boost_fx f ON f.currency = a.currency AND f.rates_date = a.window_start::date - 1
        GROUP BY ALL""",
    "candidates": """
        SELECT window_start, url, region, sum_av_gbp AS "totalAv", acquisitions AS "totalAcquisitions",
            total_views AS "totalViews", sum_av_gbp / total_views AS "avPerView"
        FROM boost_totals JOIN boost_views USING (window_start, url, region)
        WHERE total_views > 0 AND sum_av_gbp > 40""",
    "stored": f"""
        SELECT region || '_' || to_base64(encode(url)) AS id, url, region,
            strftime(start, '%Y-%m-%d %H:00:00.000') AS "startTimestamp",
            strftime(start + INTERVAL 24 HOUR, '%Y-%m-%d') AS "endDate",
            strftime(start + INTERVAL 24 HOUR, '%Y-%m-%d %H:00:00.000') AS "endTimestamp",
            value AS "totalAv", value / 100 AS "avPerView", k::bigint AS "totalViews",
            1::bigint AS "totalAcquisitions", event_id
        FROM (SELECT *, 'https://www.example.com/article/' || (user_id % 10) AS url,
                {_list(["GB", "US", "AU", "NZ", "CA", "EU", "EU", "ROW"])}[user_id % 8 + 1] AS region,
                date_trunc('hour', ts) AS start
            FROM e WHERE event_type = 'signup')""",
    "latest_boosts": """
        SELECT * EXCLUDE (event_id, n) FROM (
            SELECT *, row_number() OVER (PARTITION BY id, "startTimestamp" ORDER BY event_id DESC) AS n
            FROM stored) WHERE n = 1""",
    "entries": f"""
        SELECT c.* FROM candidates c
        JOIN (VALUES {_rows(BOOST_THRESHOLDS.items())}) th(region, lowest) ON th.region = c.region
        WHERE "avPerView" >= lowest AND NOT EXISTS (
            SELECT 1 FROM latest_boosts b WHERE b.url = c.url AND b.region = c.region
            AND b."endDate" IN (strftime(c.window_start + INTERVAL 4 HOUR, '%Y-%m-%d'),
                                strftime(c.window_start + INTERVAL 28 HOUR, '%Y-%m-%d'))
            AND b."endTimestamp" > strftime(c.window_start + INTERVAL 4 HOUR, '%Y-%m-%d %H:00:00.000'))""",
    "test_documents": """
        SELECT c_custkey, 'TEST_' || c_custkey AS name,
            ['Epic', 'Banner1', 'Banner2', 'SupportLandingPage', 'Header'][c_custkey % 5 + 1] AS channel
        FROM customer
        WHERE c_custkey % 5 < 4 AND c_nationkey % 4 <> 1""",
    "methodologies": """
        SELECT * FROM (VALUES (2, 0, 'ABTest', NULL, NULL), (3, 0, 'Roulette', NULL, NULL),
            (3, 1, 'EpsilonGreedyBandit', NULL, 0.1), (4, 0, 'EpsilonGreedyBandit', '_EG', 0.2),
            (4, 1, 'ABTest', NULL, NULL), (5, 0, 'Roulette', '', NULL),
            (6, 0, 'EpsilonGreedyBandit', NULL, 0.5)) v(kind, position, methodology, suffix, epsilon)""",
    "catalog_prices": f"""
        SELECT p_partkey AS version, product, payment_frequency, currency,
            price + p_partkey % 10 AS price
        FROM part, (VALUES {_rows(LIST_PRICES)}) v(product, currency, payment_frequency, price)
        WHERE NOT (product = 'DIGITAL_SUBSCRIPTION' AND payment_frequency = 'QUARTERLY'
                AND currency = 'AUD' AND p_partkey % 5 = 0)
            AND NOT (product = 'DIGITAL_SUBSCRIPTION' AND payment_frequency = 'ANNUALLY'
                AND p_partkey % 11 = 0)""",
    "quotes": f"""
        SELECT o_orderdate::date AS date, {_list(t.BASE_RATES)}[o_orderkey % 6 + 1] AS target,
            [{", ".join(f"{r}::double" for r in t.BASE_RATES.values())}][o_orderkey % 6 + 1]
                * (1 + (o_orderkey % 100) / 1000.0::double) AS rate
        FROM orders""",
    "daily_quotes": "SELECT date, target, MIN(rate) AS rate FROM quotes GROUP BY ALL",
    "damaged": """
        SELECT * REPLACE (CASE WHEN hour(window_start) <> 3 THEN test_name END AS test_name,
            CASE WHEN hour(window_start) % 5 <> 0 THEN variant_name END AS variant_name)
        FROM component_samples""",
    "damaged_boosts": """
        SELECT * REPLACE (CASE WHEN region = 'ROW' THEN 'XX' ELSE region END AS region,
            CASE WHEN hour(window_start) <> 7 THEN url END AS url)
        FROM candidates""",
    "metric_hours": """
        SELECT window_start, SUM(copies)::bigint AS total_tests,
            SUM(CASE WHEN views IS NULL THEN 0 ELSE copies END)::bigint AS tests_with_data,
            COALESCE(SUM(copies * views), 0)::bigint AS variant_views
        FROM (SELECT *, CASE channel WHEN 'Epic' THEN 2 ELSE 1 END AS copies FROM config_hours)
        LEFT JOIN (SELECT window_start, channel, test_name, SUM(views) AS views FROM all_samples
            GROUP BY ALL) USING (window_start, channel, test_name)
        GROUP BY window_start""",
}


def _uses(text: str, name: str) -> bool:
    import re

    return re.search(rf"\b{name}\b", text) is not None


def _query(select: str, **overrides: str) -> str:
    """The select behind the CTEs it needs, in the order they are defined."""
    ctes = {**CTES, **overrides}
    needed, queue = set(), [select]
    while queue:
        text = queue.pop()
        for name in ctes:
            if name not in needed and _uses(text, name):
                needed.add(name)
                queue.append(ctes[name])
    parts = []
    done: set[str] = set()

    def add(name: str) -> None:
        if name in done:
            return
        done.add(name)
        for other in ctes:
            if other != name and other in needed and _uses(ctes[name], other):
                add(other)
        parts.append(f"{name} AS ({ctes[name]})")

    for name in ctes:
        if name in needed:
            add(name)
    return f"WITH {', '.join(parts)}\n{select}" if parts else select


SAMPLE = """window_start, channel, test_name, variant_name, views, acquisitions,
    sum_av_gbp AS sum_av_gbp, sum_av_gbp_per_view AS sum_av_gbp_per_view"""
ACQUISITION = """window_start, product, payment_frequency, currency, amount, component_type, test_name,
    variant_name"""
BOOST = """url, region, "totalAv" AS "totalAv", "totalAcquisitions", "totalViews",
    "avPerView" AS "avPerView\""""


def _flat(samples: str, hours: str, name: str = "config_hours") -> str:
    return f"""
        SELECT channel || '_' || test_name AS "testName",
            strftime(window_start, '%Y-%m-%d %H:%M:%S.') || '000Z' AS "timestamp",
            variant_name AS "variantName", sum_av_gbp AS "annualisedValueInGBP",
            sum_av_gbp_per_view AS "annualisedValueInGBPPerView", views
        FROM (SELECT * FROM {name} WHERE {hours})
        LEFT JOIN {samples} USING (channel, test_name, window_start)"""


def _counts(table: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, COUNT(*) FILTER (WHERE {test})::bigint AS violations FROM {table}"
        for name, test in rules.items()
    )


def _missing(*names: str) -> dict[str, str]:
    return {f"{name} is missing": f'"{name}" IS NULL' for name in names}


# What a stream has emitted when its input ends: windows that end before the latest event of the
# slower input, less the time events may take to arrive.
CLOSED = """(SELECT least((SELECT MAX(ts) FROM view_events {views}),
    (SELECT MAX(event_timestamp) FROM acquisitions)) - INTERVAL 105 MINUTE)"""

# From each entry to the next one a day later at least.
CHAIN = """
        SELECT url, region, MIN(window_start) AS window_start FROM entries GROUP BY ALL
        UNION ALL SELECT e.url, e.region, MIN(e.window_start) FROM chain c JOIN entries e
            ON e.url = c.url AND e.region = c.region AND e.window_start >= c.window_start + INTERVAL 24 HOUR
        GROUP BY ALL"""

CATALOG_RULES = {
    f"{product}.{plan} {text}" if plan else f"{product}.active is missing": f"p_partkey % {t.BROKEN_OF} = {k}"
    for k, (product, plan, kind) in t.BROKEN.items()
    for text in [{"gone": "has no pricing", "empty": "has an empty price", "inactive": ""}[kind]]
}

ORACLE: dict[str, str] = {
    "experiment_configs": _query(f"""
        SELECT channel, CASE WHEN suffix IS NULL THEN name WHEN suffix = '' THEN ''
                ELSE name || suffix END AS name,
            CASE channel WHEN 'Epic' THEN 'ACQUISITIONS_EPIC'
                WHEN 'Banner1' THEN 'ACQUISITIONS_ENGAGEMENT_BANNER'
                WHEN 'Banner2' THEN 'ACQUISITIONS_SUBSCRIPTIONS_BANNER' END AS component_type
        FROM test_documents JOIN methodologies ON kind = c_custkey % 7
        WHERE methodology <> 'ABTest'"""),
    "sampled_test_documents": _query("""
        SELECT name, channel, position, methodology, epsilon::double AS epsilon
        FROM test_documents JOIN methodologies ON kind = c_custkey % 7
        WHERE c_custkey % 7 >= 3"""),
    "price_dimension": _query("SELECT * FROM catalog_prices"),
    "price_matrix": _query("""
        SELECT version, product, currency, COUNT(*)::int AS frequencies,
            MAX(price) FILTER (WHERE payment_frequency = 'MONTHLY') AS monthly,
            MAX(price) FILTER (WHERE payment_frequency = 'ANNUALLY') AS annually,
            MAX(price) FILTER (WHERE payment_frequency = 'QUARTERLY') AS quarterly
        FROM catalog_prices GROUP BY ALL"""),
    "price_lookup": _query(f"""
        SELECT r.*, price FROM (
            SELECT event_id, ['SUPPORTER_PLUS', 'DIGITAL_SUBSCRIPTION'][k % 2 + 1] AS product,
                {_list(t.CURRENCIES)}[event_id % 7 + 1] AS currency,
                {_list(t.FREQUENCIES)}[event_id % 4 + 1] AS payment_frequency
            FROM e) r
        LEFT JOIN list_prices USING (product, currency, payment_frequency)"""),
    "catalog_violations": _counts("part", CATALOG_RULES),
    "fx_reverse_rate": _query(
        "SELECT date, target AS currency, 1 / rate AS reverse_rate FROM quotes"
    ),
    "fx_to_gbp": _query(
        """SELECT rates_date, currency, to_gbp_rate FROM boost_fx""",
        rates="SELECT * FROM daily_quotes",
    ),
    "fx_sample_rates": _query(
        """SELECT rates_date, currency, reverse_rate, gbp_rate FROM sample_fx""",
        rates="SELECT * FROM daily_quotes",
    ),
    "component_views_hourly": _query("SELECT * FROM component_views"),
    "landing_views_daily": _query("SELECT * FROM landing_days"),
    "total_component_views": _query("SELECT COUNT(*)::bigint AS total_views FROM hourly_events"),
    "channel_views_hourly": _query("""
        SELECT window_start, COUNT(*)::bigint AS channel_views FROM hourly_events
        WHERE component_type <> 'ACQUISITIONS_ENGAGEMENT_BANNER' GROUP BY window_start"""),
    "acquisitions_unnested": _query(f"SELECT {ACQUISITION} FROM unnested"),
    "acquisitions_of_tests": _query(f"SELECT {ACQUISITION}, channel FROM tested"),
    "acquisitions_priced": _query(
        f"SELECT {ACQUISITION}, price, paid FROM priced", priced=_priced("unnested", "list_prices")
    ),
    "acquisitions_priced_fixed": _query(
        f"SELECT {ACQUISITION}, price, paid FROM priced", priced=_priced("unnested", "fixed_prices")
    ),
    "acquisitions_av_gbp": _query(
        f"SELECT {ACQUISITION}, av_eur, av_gbp FROM valued",
        priced=_priced("unnested", "list_prices"),
    ),
    "acquisitions_av_gbp_corrected": _query(
        f"SELECT {ACQUISITION}, av_eur, av_gbp FROM valued",
        priced=_priced("unnested", "list_prices"),
        valued=_valued("priced", quarterly=True, fix_gbp=True),
    ),
    "acquisitions_capped": _query(
        f"""SELECT {ACQUISITION},
            CASE WHEN av_gbp >= 250 THEN 250 ELSE av_gbp END AS capped_av_gbp
        FROM valued""",
        priced=_priced("unnested", "list_prices"),
    ),
    "acquisition_totals": _query("""
        SELECT window_start, channel, test_name, variant_name, sum_av_gbp AS sum_av_gbp,
            acquisitions
        FROM totals"""),
    "acquisitions_unrated": _query("""
        SELECT window_start, COUNT(*)::bigint AS unrated FROM acquisitions a
        WHERE NOT EXISTS (SELECT 1 FROM sample_fx f WHERE f.currency = a.currency
            AND f.rates_date = a.window_start::date - 1)
        GROUP BY window_start"""),
    "variant_samples_component": _query(f"SELECT {SAMPLE} FROM component_samples"),
    "variant_samples_landing": _query(
        f"SELECT {SAMPLE} FROM all_samples WHERE channel = 'SupportLandingPage'"
    ),
    "variant_samples": _query(f"SELECT {SAMPLE} FROM all_samples"),
    "backfill_windows": _query(
        """SELECT window_start, COUNT(event_timestamp)::bigint AS acquisitions
        FROM backfill LEFT JOIN acquisitions USING (window_start) GROUP BY window_start""",
        backfill="""
        SELECT unnest(generate_series(date_trunc('hour', low) - INTERVAL 1 HOUR,
            date_trunc('hour', low) - INTERVAL 1 HOUR + (ceil(epoch(date_trunc('hour', high) - low)
                / 3600)::int - 1) * INTERVAL 1 HOUR, INTERVAL 1 HOUR))::timestamp AS window_start
        FROM (SELECT MIN(ts) AS low, MAX(ts) AS high FROM events)""",
    ),
    "backfill_samples": _query(
        f"""SELECT {SAMPLE} FROM all_samples, (
            SELECT MIN(ts) + (MAX(ts) - MIN(ts)) / 2 AS start, MAX(ts) AS high FROM events)
        WHERE window_start >= date_trunc('hour', start) - INTERVAL 1 HOUR
            AND window_start < date_trunc('hour', start) - INTERVAL 1 HOUR
                + ceil(epoch(date_trunc('hour', high) - start) / 3600)::int * INTERVAL 1 HOUR"""
    ),
    "sample_records_flat": _query(_flat("all_samples", "true")),
    "samples_latest": _query(
        _flat("component_samples", "window_start >= (SELECT middle FROM half)")
        + " UNION ALL "
        + _flat("low_samples", "window_start < (SELECT middle FROM half)"),
        half="""
        SELECT MIN(window_start) + ((COUNT(*) - 1) // 2)::int * INTERVAL 1 HOUR AS middle FROM windows""",
        low_totals=_totals(10.0),
        low_samples=_samples("component_views", "low_totals"),
    ),
    "region_of_country": _query(
        f"""SELECT country, {_region("country")} AS region, COUNT(*)::bigint AS acquisitions
        FROM (SELECT CASE minute(event_timestamp) % 10 WHEN 0 THEN NULL
            WHEN 1 THEN lower(country_code) WHEN 2 THEN 'IE' ELSE country_code END AS country
            FROM acquisitions) GROUP BY ALL"""
    ),
    "boost_views": _query("SELECT * FROM boost_views"),
    "boost_acquisitions": _query("""
        SELECT window_start, url, region, sum_av_gbp AS sum_av_gbp, acquisitions
        FROM boost_totals"""),
    "boost_candidates": _query(f"SELECT window_start, {BOOST} FROM candidates"),
    "boosts_latest": _query("SELECT * FROM latest_boosts"),
    "boost_active": _query("""
        SELECT * FROM latest_boosts WHERE "endDate" IN ('2024-01-15', '2024-01-16')
            AND "endTimestamp" > '2024-01-15 12:00:00.000'"""),
    "boost_entries": _query(f"SELECT window_start, {BOOST} FROM entries"),
    "boost_records": _query(f"""
        SELECT {BOOST}, region || '_' || to_base64(encode(url)) AS id,
            strftime(window_start + INTERVAL 4 HOUR, '%Y-%m-%d %H:00:00.000') AS "startTimestamp",
            strftime(window_start + INTERVAL 28 HOUR, '%Y-%m-%d') AS "endDate",
            strftime(window_start + INTERVAL 28 HOUR, '%Y-%m-%d %H:00:00.000') AS "endTimestamp"
        FROM entries"""),
    "boost_entries_sequential": _query(
        f"""SELECT window_start, {BOOST} FROM entries JOIN chain USING (url, region, window_start)""",
        chain=CHAIN,
    ).replace("WITH ", "WITH RECURSIVE ", 1),
    "boost_candidates_default_gates": _query(
        f"""SELECT window_start, {BOOST} FROM candidates""",
        boost_hours="""
        SELECT unnest(range(48)) AS back, date_trunc('hour', ts)::timestamp AS hour, received_date,
            'https://www.example.com/' AS url, 'ROW' AS region
        FROM view_events, range(6) WHERE component_type = 'ACQUISITIONS_EPIC' AND host = 'www.example.com'""",
        boost_totals=CTES["boost_totals"]
        .replace("[0, 1, 2]", "range(48)")
        .replace("referrer_url AS url, region", "'https://www.example.com/' AS url, 'ROW' AS region"),
        candidates=CTES["candidates"].replace("total_views > 0", "total_views > 100"),
    ),
    "run_metrics": _query("SELECT * FROM metric_hours"),
    "run_metrics_without_configs": _query("""
        SELECT window_start, 0::bigint AS total_tests, 0::bigint AS tests_with_data, 0::bigint AS variant_views
        FROM windows"""),
    "sampling_windows": _query("""
        SELECT event_id, date_trunc('hour', ts)::timestamp - INTERVAL 2 HOUR AS sample_start,
            date_trunc('hour', ts)::timestamp - INTERVAL 1 HOUR AS sample_end,
            date_trunc('hour', ts)::timestamp - INTERVAL 4 HOUR AS boost_start,
            date_trunc('hour', ts)::timestamp - INTERVAL 1 HOUR AS boost_end
        FROM events"""),
    "backfill_rejected_hours": _query("""
        SELECT window_start FROM windows WHERE window_start::date IN (
            SELECT min(ts)::date + 3 FROM events)
        UNION SELECT window_start FROM damaged WHERE test_name IS NULL OR variant_name IS NULL"""),
    "no_views_check": _query("""
        SELECT window_start, variant_views, channel_views,
            (variant_views = 0 AND channel_views = 0)::int AS no_views_data
        FROM (SELECT window_start, COALESCE(variant_views, 0)::bigint AS variant_views,
                COALESCE(channel_views, 0)::bigint AS channel_views
            FROM windows
            LEFT JOIN (SELECT window_start, SUM(views) AS variant_views FROM component_samples
                GROUP BY ALL) USING (window_start)
            LEFT JOIN (SELECT window_start, COUNT(*) AS channel_views FROM hourly_events
                GROUP BY ALL) USING (window_start))"""),
    "sample_violations": _query(
        _counts(
            "damaged",
            _missing(
                "test_name",
                "variant_name",
                "views",
                "sum_av_gbp",
                "sum_av_gbp_per_view",
                "acquisitions",
            ),
        )
    ),
    "sample_rejected_hours": _query("""
        SELECT DISTINCT window_start FROM damaged
        WHERE test_name IS NULL OR variant_name IS NULL"""),
    "boost_violations": _query(
        _counts(
            "damaged_boosts",
            _missing("url", "region", "totalAv", "totalViews", "avPerView", "totalAcquisitions")
            | {"region is unknown": f"region NOT IN {_in(BOOST_THRESHOLDS)}"},
        )
    ),
    # The date a page view was received plays no part in a stream.
    "stream_hourly_samples": _query(
        f"""SELECT {SAMPLE} FROM component_samples
        WHERE window_start + INTERVAL 1 HOUR <= {CLOSED.format(views="")}""",
        hourly_events="SELECT *, date_trunc('hour', ts)::timestamp AS window_start FROM view_events",
    ),
    "stream_article_windows": _query(
        f"""SELECT window_start, url, region, total_views AS "totalViews",
            sum_av_gbp AS "totalAv", acquisitions AS "totalAcquisitions",
            sum_av_gbp / total_views AS "avPerView"
        FROM boost_totals JOIN boost_views USING (window_start, url, region)
        WHERE window_start + INTERVAL 3 HOUR <=
            {CLOSED.format(views="WHERE component_type = 'ACQUISITIONS_EPIC'")}""",
        boost_views="""
        SELECT window_start, url, region, COUNT(*)::bigint AS total_views
        FROM (SELECT *, hour - back * INTERVAL 1 HOUR AS window_start FROM boost_hours) GROUP BY ALL""",
    ),
}

ORACLE |= {
    "stream_keyed_samples": _query(
        """SELECT channel || '_' || test_name AS "testName",
            strftime(window_start, '%Y-%m-%d %H:%M:%S.') || '000Z' AS "timestamp", variant_name AS "variantName",
            sum_av_gbp AS "annualisedValueInGBP", sum_av_gbp_per_view AS "annualisedValueInGBPPerView", views
        FROM component_samples""",
        hourly_events="SELECT *, date_trunc('hour', ts)::timestamp AS window_start FROM view_events",
    ),
    "stream_boost_entries": _query(
        f"""SELECT {BOOST}, region || '_' || to_base64(encode(url)) AS id,
            strftime(window_start + INTERVAL 4 HOUR, '%Y-%m-%d %H:00:00.000') AS "startTimestamp",
            strftime(window_start + INTERVAL 28 HOUR, '%Y-%m-%d') AS "endDate",
            strftime(window_start + INTERVAL 28 HOUR, '%Y-%m-%d %H:00:00.000') AS "endTimestamp"
        FROM entries JOIN chain USING (url, region, window_start)""",
        boost_views="""
        SELECT window_start, url, region, COUNT(*)::bigint AS total_views
        FROM (SELECT *, hour - back * INTERVAL 1 HOUR AS window_start FROM boost_hours) GROUP BY ALL""",
        entries=f"""
        SELECT c.* FROM candidates c
        JOIN (VALUES {_rows(BOOST_THRESHOLDS.items())}) th(region, lowest) ON th.region = c.region
        WHERE "avPerView" >= lowest AND window_start + INTERVAL 3 HOUR <=
            {CLOSED.format(views="WHERE component_type = 'ACQUISITIONS_EPIC'")}""",
        chain=CHAIN,
    ).replace("WITH ", "WITH RECURSIVE ", 1),
    "stream_landing_hours": _query("SELECT * FROM landing_views"),
    "catalog_files": f"""
        SELECT p_partkey % {t.BUNDLES} AS bundle, COUNT(*) AS documents,
            coalesce(string_agg(DISTINCT rule, ', ' ORDER BY rule), '') AS rules,
            CASE WHEN COUNT(rule) > 0 THEN 0 ELSE COUNT(*) * {len(LIST_PRICES)} END AS prices
        FROM part LEFT JOIN (VALUES {", ".join(
            f"({k}, '{name}')" for k, name in [
                *((int(test.rsplit(" ", 1)[1]), name) for name, test in CATALOG_RULES.items()),
                (t.MALFORMED, "document is malformed"),
            ])}) v(remainder, rule) ON p_partkey % {t.BROKEN_OF} = remainder
        GROUP BY p_partkey % {t.BUNDLES}""",
    "run_outputs": _query(
        """
        SELECT 'TotalBanditTests' AS name, given, COUNT(*) AS points, 3.0::double * COUNT(*) AS value FROM due GROUP BY given
        UNION ALL SELECT 'TestsWithVariantData', given, COUNT(*), SUM(coalesce(tests, 0))::double
            FROM due LEFT JOIN with_views USING (window_start) GROUP BY given
        UNION ALL SELECT 'NoViewsData', given, COUNT(*), COUNT(*)::double FROM due
            WHERE window_start NOT IN (SELECT window_start FROM with_views)
            AND window_start NOT IN (SELECT window_start FROM channel_hours) GROUP BY given
        UNION ALL SELECT 'RejectedHours', false, 1, 0
        UNION ALL SELECT 'MissingPrices', false, 1, 0
        UNION ALL SELECT 'UnratedAcquisitions', false, 1, COUNT(*)::double FROM acquisitions a
            WHERE window_start IN (SELECT window_start FROM due) AND NOT EXISTS (SELECT 1 FROM sample_fx f
                WHERE f.currency = a.currency AND f.rates_date = a.window_start::date - 1)
        UNION ALL SELECT 'records of ' || window_start::date, NULL, 3 * COUNT(*), SUM(coalesce(variants, 0))::double
            FROM (SELECT DISTINCT window_start FROM due) LEFT JOIN with_views USING (window_start) GROUP BY window_start::date""",
        due="""
        SELECT false AS given, unnest(generate_series(date_trunc('hour', low) - INTERVAL 1 HOUR,
            date_trunc('hour', low) - INTERVAL 1 HOUR + (ceil(epoch(date_trunc('hour', high) - low)
                / 3600)::int - 1) * INTERVAL 1 HOUR, INTERVAL 1 HOUR))::timestamp AS window_start
        FROM (SELECT MIN(ts) AS low, MAX(ts) AS high FROM events)
        UNION ALL SELECT true, TIMESTAMP '2024-01-10 12:00:00'""",
        with_views="""
        SELECT window_start, COUNT(DISTINCT channel) AS tests, COUNT(*) AS variants FROM component_views GROUP BY window_start""",
        channel_hours="SELECT DISTINCT window_start FROM hourly_events",
    ),
    "run_metrics_partial": _query("""
        SELECT window_start, COUNT(channel) AS total_tests, COUNT(views) AS tests_with_data,
            COALESCE(SUM(views), 0)::bigint AS variant_views
        FROM windows
        LEFT JOIN (SELECT * FROM config_hours WHERE hour(window_start) >= 6) USING (window_start)
        LEFT JOIN (SELECT window_start, channel, test_name, SUM(views) AS views FROM all_samples GROUP BY ALL)
            USING (window_start, channel, test_name)
        GROUP BY window_start"""),
}

# Compaction changes no record.
ORACLE |= {"samples_compacted": ORACLE["samples_latest"], "boosts_compacted": ORACLE["boosts_latest"]}

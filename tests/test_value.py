import math
from fractions import Fraction

import pytest

from driver.tables import CATALOG_PRICES
from tests import frames
from valuelens.functions.article import boost_id, region_of, url_of
from valuelens.functions.value import annualise, cap, exact_sum
from valuelens.operators.acquisitions import (
    article_acquisition_values,
    unnest_tests,
    unrated_acquisitions,
    value_of_acquisitions,
)
from valuelens.operators.prices import (
    boost_prices,
    list_prices,
    missing_prices,
    price_acquisitions,
    price_dimension,
    price_matrix,
)
from valuelens.operators.quality import InvalidData
from valuelens.operators.rates import boost_rates, sample_rates
from valuelens.sources.catalog import read_catalog

PRICE_KEY = "product string, currency string, payment_frequency string"
NOON = "2024-01-02T12:10:00"
RATES = [("2024-01-01", "GBP", 0.8), ("2024-01-01", "EUR", 1.0), ("2024-01-01", "USD", 1.25)]


def sample_values(spark, rows, rates=RATES, **options):
    """(currency, av_eur, av_gbp) of acquisitions, valued as for samples."""
    prices = price_dimension(frames.catalog(spark))
    unnested = unnest_tests(frames.acquisitions(spark, *rows))
    valued = value_of_acquisitions(
        price_acquisitions(unnested, prices), sample_rates(frames.rates(spark, *rates)), **options
    )
    return sorted(
        (row.currency, row.av_eur, row.av_gbp)
        for row in valued.select("currency", "av_eur", "av_gbp").collect()
    )


def boost_values(spark, rows, rates=RATES):
    values = article_acquisition_values(
        frames.acquisitions(spark, *rows),
        boost_prices(spark),
        boost_rates(frames.rates(spark, *rates)),
        span=1,
    )
    return [row.av_gbp for row in values.collect()]


def test_gbp_stays_in_eur_in_samples_but_not_in_boosts(spark):
    row = frames.acquisition(NOON, currency="GBP", amount=10.0)
    assert sample_values(spark, [row]) == [("GBP", 12.5, 12.5)]
    assert sample_values(spark, [row], fix_gbp=True) == [("GBP", 12.5, 10.0)]
    assert boost_values(spark, [row]) == pytest.approx([10.0])


def test_other_currencies_go_through_eur(spark):
    row = frames.acquisition(NOON, currency="USD", amount=25.0, frequency="MONTHLY")
    assert sample_values(spark, [row]) == [("USD", 240.0, 192.0)]
    assert boost_values(spark, [row]) == pytest.approx([192.0])


def test_quarterly_has_no_value(spark):
    row = frames.acquisition(NOON, product="DIGITAL_SUBSCRIPTION", frequency="QUARTERLY")
    assert sample_values(spark, [row]) == [("EUR", None, None)]
    [(_, av_eur, _)] = sample_values(spark, [row], quarterly=True)
    assert av_eur == pytest.approx(4 * CATALOG_PRICES["DigitalSubscription", "Quarterly"]["EUR"])


def test_list_price_beats_amount(spark):
    row = frames.acquisition(NOON, product="SUPPORTER_PLUS", frequency="ANNUALLY", amount=1.0)
    assert sample_values(spark, [row])[0][1] == CATALOG_PRICES["SupporterPlus", "Annual"]["EUR"]


def test_unknown_product_has_no_value(spark):
    assert sample_values(spark, [frames.acquisition(NOON, product="HAT")]) == [("EUR", None, None)]


def test_aud_annual_plan_has_no_boost_price(spark):
    key = {"product": "SUPPORTER_PLUS", "currency": "AUD", "payment_frequency": "ANNUALLY"}
    request = frames.table(spark, [tuple(key.values())], PRICE_KEY)
    assert list_prices(request, boost_prices(spark)).first().price is None
    assert list_prices(request, price_dimension(frames.catalog(spark))).first().price == CATALOG_PRICES["SupporterPlus", "Annual"]["AUD"]


def test_currency_without_a_rate_drops_out(spark):
    rows = [frames.acquisition(NOON, currency="JPY"), frames.acquisition(NOON)]
    assert [value[0] for value in sample_values(spark, rows)] == ["EUR"]
    rates = sample_rates(frames.rates(spark, *RATES))
    [row] = unrated_acquisitions(frames.acquisitions(spark, *rows), rates).collect()
    assert row.unrated == 1


def test_rates_are_those_of_the_day_before(spark):
    late = [("2024-01-02", "GBP", 0.8), ("2024-01-02", "EUR", 1.0)]
    assert sample_values(spark, [frames.acquisition(NOON)], late) == []


def test_two_gbp_rates_double_samples_and_fail_boosts(spark):
    twice = [*RATES, ("2024-01-01", "GBP", 0.9)]
    row = frames.acquisition(NOON)
    assert len(sample_values(spark, [row], twice)) == 2
    with pytest.raises(Exception, match="more than one GBP rate"):
        boost_values(spark, [row], twice)


def test_no_gbp_rate(spark):
    without = [("2024-01-01", "EUR", 1.0)]
    row = frames.acquisition(NOON)
    assert sample_values(spark, [row], without) == []
    assert boost_values(spark, [row], without) == [None]


def test_a_rate_of_zero_fails(spark):
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        sample_values(spark, [frames.acquisition(NOON)], [*RATES, ("2024-01-01", "EUR", 0.0)])


def test_cap_keeps_nulls(spark):
    values = frames.table(spark, [(249.99,), (250.0,), (300.0,), (None,)], "v double")
    capped = [row.c for row in values.selectExpr(f"{cap('v')} as c").collect()]
    assert capped == [249.99, 250.0, 250.0, None]


def test_annualise(spark):
    names = ["ONE_OFF", "MONTHLY", "ANNUALLY", "QUARTERLY", "monthly", None]
    rows = frames.table(spark, [(name,) for name in names], "f string")
    values = [row.v for row in rows.selectExpr(f"{annualise('2d', 'f')} as v").collect()]
    assert values == [2.0, 24.0, 2.0, None, None, None]


def test_regions(spark):
    rows = frames.table(spark, [(c,) for c in [None, "gb", "IE", "JP", "GB", "CA"]], "c string")
    found = [row.r for row in rows.selectExpr(f"{region_of('c')} as r").collect()]
    assert found == ["ROW", "ROW", "EU", "ROW", "GB", "CA"]


def test_url_and_id(spark):
    path = "/" + "é" * 200
    row = (
        frames.table(spark, [("https", "h", path), ("https", None, "/p")], "p string, h string, t string")
        .selectExpr(f"{url_of('p', 'h', 't')} as url")
        .selectExpr("url", f"{boost_id(repr('GB'), 'url')} as id")
        .collect()
    )
    import base64

    url = f"https://h{path}"
    assert row[0].id == "GB_" + base64.b64encode(url.encode()).decode()
    assert row[1].url is None


class TestCatalog:
    def price(self, spark, product, currency, frequency, **options):
        key = {"product": product, "currency": currency, "payment_frequency": frequency}
        prices = price_dimension(frames.catalog(spark))
        return list_prices(frames.table(spark, [tuple(key.values())], PRICE_KEY), prices, **options).first().price

    def test_prices(self, spark):
        assert self.price(spark, "SUPPORTER_PLUS", "GBP", "MONTHLY") == CATALOG_PRICES["SupporterPlus", "Monthly"]["GBP"]
        assert self.price(spark, "SUPPORTER_PLUS", "USD", "ANNUALLY") == CATALOG_PRICES["SupporterPlus", "Annual"]["USD"]
        assert self.price(spark, "DIGITAL_SUBSCRIPTION", "GBP", "QUARTERLY") == CATALOG_PRICES["DigitalSubscription", "Quarterly"]["GBP"]

    def test_missing_price(self, spark):
        assert self.price(spark, "SUPPORTER_PLUS", "JPY", "MONTHLY") is None
        with pytest.raises(Exception, match="no list price: SUPPORTER_PLUS JPY MONTHLY"):
            self.price(spark, "SUPPORTER_PLUS", "JPY", "MONTHLY", strict=True)

    def test_matrix(self, spark):
        matrix = price_matrix(price_dimension(frames.catalog(spark)))
        found = {(row["product"], row.currency): row.prices for row in matrix.collect()}
        assert found["SUPPORTER_PLUS", "GBP"] == {"MONTHLY": 11.5, "ANNUALLY": 115.0}
        assert len(found) == 12 and len(found["DIGITAL_SUBSCRIPTION", "CAD"]) == 3

    def test_matrix_of_versions(self, spark):
        rows = [
            (version, "P", frequency, "GBP", price)
            for version, frequency, price in [
                (1, "MONTHLY", 1.0), (1, "MONTHLY", 2.0), (1, "ANNUALLY", 9.0), (2, "MONTHLY", 3.0), (None, "QUARTERLY", 4.0), (None, "QUARTERLY", 4.0), (None, "MONTHLY", None),
            ]
        ]
        prices = frames.table(spark, rows, "version long, product string, payment_frequency string, currency string, price double")
        matrix = price_matrix(prices, "version")
        assert sorted((row.version or 0, row.prices) for row in matrix.collect()) == [
            (0, {"QUARTERLY": 4.0}), (1, {"MONTHLY": 2.0, "ANNUALLY": 9.0}), (2, {"MONTHLY": 3.0}),
        ]

        def aggregates_before_exchange(frame):
            plan = frame._jdf.queryExecution().executedPlan().toString().rpartition("Initial Plan")[2]
            return "Aggregate" in plan[plan.index("Exchange"):]

        # Versions are many: a task that reads does not hold their groups. Without them groups are few, and summed there.
        assert not aggregates_before_exchange(matrix)
        assert aggregates_before_exchange(price_matrix(prices))

    def test_file(self, spark, tmp_path):
        path = tmp_path / "catalog.json"
        path.write_text(frames.catalog_json(Other={"active": False}))
        assert price_dimension(read_catalog(spark, str(path))).count() == 30

    @pytest.mark.parametrize(
        "text",
        [
            '{"invalid": "data"}',
            frames.catalog_json(SupporterPlus={"active": True, "ratePlans": {}}),
            frames.catalog_json(SupporterPlus={"active": True}),
        ],
    )
    def test_wrong_shape(self, spark, tmp_path, text):
        path = tmp_path / "catalog.json"
        path.write_text(text)
        with pytest.raises(InvalidData):
            read_catalog(spark, str(path))

    def test_wrong_type(self, spark, tmp_path):
        path = tmp_path / "catalog.json"
        path.write_text(frames.catalog_json(SupporterPlus="free"))
        with pytest.raises(Exception):
            read_catalog(spark, str(path))

    def test_missing_prices(self, spark):
        prices = price_dimension(frames.catalog(spark)).where("currency <> 'CAD'")
        assert missing_prices(prices).count() == 5


@pytest.mark.parametrize("partitions", [1, 7, 211])
def test_exact_sums_do_not_depend_on_order(spark, partitions):
    values = [0.1, 1e15 + 0.5, -0.3, 2.675, 1 / 3, 249.99999999999997, -1e15, 7e-9] * 100 + [None]
    rows = frames.table(spark, [(v, i % 3) for i, v in enumerate(values)], "v double, n bigint").repartition(partitions)
    [row] = rows.selectExpr(f"{exact_sum('v')} as total", f"{exact_sum('v', 'n')} as times").collect()
    expected = sum(Fraction(math.floor(Fraction(v) * 2**60), 2**60) for v in values if v is not None)
    times = sum(Fraction(math.floor(Fraction(v) * 2**60), 2**60) * (i % 3) for i, v in enumerate(values) if v is not None)
    assert row.total == pytest.approx(float(expected), rel=1e-15) and row.times == pytest.approx(float(times), rel=1e-15)
    assert float.hex(row.total) == float.hex(exact_total(spark, values))
    [none] = rows.where("false").selectExpr(f"{exact_sum('v')} as total").collect()
    assert none.total is None


def exact_total(spark, values):
    rows = frames.table(spark, [(v,) for v in values], "v double").coalesce(1)
    return rows.selectExpr(f"{exact_sum('v')} as total").first().total

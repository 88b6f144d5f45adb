import pytest

from tests import frames
from tests.frames import acquisition, at, event, page_view
from valuelens.functions.hours import HOUR, Hours, backfill_hours, sampling_hours
from valuelens.operators.configs import (
    config_hours,
    distinct_configs,
    sampled_tests,
    test_configs as configs_of,
)
from valuelens.operators.prices import price_dimension
from valuelens.plans.samples import sample_records, sample_rows, variant_samples
from valuelens.sources.tables import live_tests

RATES = [
    (day, currency, rate)
    for day in ("2024-01-01", "2024-01-02")
    for currency, rate in (("GBP", 1.0), ("EUR", 1.0))
]
NOON = "2024-01-02T12:10:00"


def samples(spark, views, acquired, tests=(("Epic", "T"),), hours=None, **options):
    found = variant_samples(
        frames.page_views(spark, *views),
        frames.acquisitions(spark, *acquired),
        frames.rates(spark, *RATES),
        price_dimension(frames.catalog(spark)),
        frames.configs(spark, *tests),
        hours,
        **options,
    )
    return frames.dicts(found, "window_start", "channel", "test_name", "variant_name")


def view(time=NOON, **options):
    return page_view(time[:10], [event(time, **options)])


def test_views_without_acquisitions_stay_and_acquisitions_without_views_go(spark):
    [row] = samples(spark, [view()], [acquisition(NOON, tests=[("T", "variant")])])
    assert row["variant_name"] == "control" and row["views"] == 1
    assert (row["sum_av_gbp"], row["sum_av_gbp_per_view"], row["acquisitions"]) == (0.0, 0.0, 0)


def test_cap_and_nulls(spark):
    acquired = [acquisition(NOON, amount=amount) for amount in (249.99, 250.0, 300.0)]
    acquired.append(acquisition(NOON, product="HAT"))
    [row] = samples(spark, [view(), view()], acquired)
    assert row["sum_av_gbp"] == pytest.approx(749.99) and row["acquisitions"] == 4
    assert row["sum_av_gbp_per_view"] == pytest.approx(749.99 / 2)


def test_a_group_of_nulls_is_worth_nothing(spark):
    [row] = samples(spark, [view()], [acquisition(NOON, product="HAT")])
    assert row["sum_av_gbp"] == 0 and row["acquisitions"] == 1


def test_acquisitions_of_other_components_count_for_landing_pages_only(spark):
    landing = page_view("2024-01-02", None, [("L", "a")], frames.HOST, "/contribute")
    acquired = [
        acquisition(NOON, component="ACQUISITIONS_ENGAGEMENT_BANNER", tests=[("T", "control"), ("L", "a")])
    ]
    tests = [("Epic", "T"), ("SupportLandingPage", "L")]
    hours = sampling_hours(at("2024-01-02T14:45"))
    rows = samples(spark, [view(), landing], acquired, tests, hours, landing_host=frames.HOST)
    assert [(row["test_name"], row["acquisitions"]) for row in rows] == [("T", 0), ("L", 1)]


def test_an_acquisition_counts_once_per_test(spark):
    acquired = [acquisition(NOON, tests=[("T", "control"), ("U", "control")])]
    rows = samples(spark, [view(), view(test="U")], acquired, [("Epic", "T"), ("Epic", "U")])
    assert [row["acquisitions"] for row in rows] == [1, 1]


def test_variants_without_a_name_do_not_match(spark):
    rows = samples(spark, [view(variant=None)], [acquisition(NOON, tests=[("T", None)])])
    assert [(row["variant_name"], row["acquisitions"]) for row in rows] == [(None, 0)]


def test_landing_samples_need_hours(spark):
    with pytest.raises(ValueError, match="hours"):
        samples(spark, [], [], landing_host=frames.HOST)


def busy_site():
    """Three days of views and acquisitions in several tests."""
    times = [f"2024-01-0{1 + i % 3}T{(7 * i) % 24:02}:{i % 60:02}:00" for i in range(120)]
    views = [
        page_view(
            time[:10],
            [event(time, "TU"[i % 2], "ab"[i // 2 % 2])],
            [("L", "ab"[i % 2])] if i % 5 == 0 else None,
            frames.HOST if i % 5 == 0 else "www.example.com",
            "/contribute",
        )
        for i, time in enumerate(times)
    ]
    acquired = [
        acquisition(time, amount=i + 0.5, tests=[("TU"[i % 2], "ab"[i // 2 % 2]), ("L", "ab"[i % 2])])
        for i, time in enumerate(times[::3])
    ]
    return views, acquired


TESTS = [("Epic", "T"), ("Epic", "U"), ("SupportLandingPage", "L")]


def test_backfill_equals_single_runs(spark):
    views, acquired = busy_site()
    hours = backfill_hours(at("2024-01-02T10:30"), at("2024-01-02T15:30"))
    together = samples(spark, views, acquired, TESTS, hours, landing_host=frames.HOST)
    single = []
    start = hours.first
    while start <= hours.last:
        one = Hours(start, start)
        single += samples(spark, views, acquired, TESTS, one, landing_host=frames.HOST)
        start += HOUR
    assert together == single != []


def test_all_tests_at_once_equal_each_alone(spark):
    views, acquired = busy_site()
    hours = Hours(at("2024-01-01T00:00"), at("2024-01-02T23:00"))
    together = samples(spark, views, acquired, TESTS, hours, landing_host=frames.HOST)
    alone = [
        row
        for test in TESTS
        for row in samples(spark, views, acquired, [test], hours, landing_host=frames.HOST)
    ]
    order = lambda row: str(row)
    assert sorted(together, key=order) == sorted(alone, key=order) != []


def test_repeated_configs_do_not_repeat_samples(spark):
    rows = samples(spark, [view()], [acquisition(NOON)], [("Epic", "T"), ("Epic", "T")])
    assert [(row["views"], row["acquisitions"]) for row in rows] == [(1, 1)]


class TestRecords:
    def records(self, spark, views, tests):
        found = variant_samples(
            frames.page_views(spark, *views),
            frames.acquisitions(spark, acquisition(NOON, amount=50.0)),
            frames.rates(spark, *RATES),
            price_dimension(frames.catalog(spark)),
            frames.configs(spark, *tests),
            sampling_hours(at("2024-01-02T14:45")),
        )
        hours = sampling_hours(at("2024-01-02T14:45"))
        return sample_records(config_hours(frames.configs(spark, *tests), hours), found)

    def test_shape(self, spark):
        [record] = frames.dicts(self.records(spark, [view()] * 100, [("Epic", "T")]))
        assert record == {
            "testName": "Epic_T",
            "variants": [
                {
                    "variantName": "control",
                    "annualisedValueInGBP": 50.0,
                    "annualisedValueInGBPPerView": 0.5,
                    "views": 100,
                }
            ],
            "timestamp": "2024-01-02 12:00:00.000Z",
        }

    def test_a_test_without_views_has_an_empty_record(self, spark):
        records = self.records(spark, [view()], [("Epic", "T"), ("Banner1", "V")])
        found = {row.testName: len(row.variants) for row in records.collect()}
        assert found == {"Epic_T": 1, "Banner1_V": 0}
        assert sample_rows(records).count() == 2

    def test_repeated_configs_give_one_record(self, spark):
        assert self.records(spark, [view()], [("Epic", "T"), ("Epic", "T")]).count() == 1


class TestConfigs:
    @pytest.fixture()
    def tests(self, spark):
        bandit, roulette = ("EpsilonGreedyBandit", None, 0.1), ("Roulette", None, None)
        rows = [
            ("Epic", "two", "Live", [bandit, ("ABTest", None, None), roulette]),
            ("Banner1", "named", None, [("EpsilonGreedyBandit", "other", 0.2)]),
            ("Banner1", "blank", "Live", [("Roulette", "", None)]),
            ("Banner2", "draft", "Draft", [bandit]),
            ("Banner2", "plain", "Live", [("ABTest", None, None)]),
            ("SupportLandingPage", "none", "Live", None),
            ("Header", "elsewhere", "Live", [bandit]),
        ]
        from valuelens.schemas import CHANNEL_TESTS

        return frames.table(spark, rows, CHANNEL_TESTS)

    def test_live(self, tests):
        names = {row.name for row in live_tests(tests).collect()}
        assert names == {"two", "named", "blank", "plain", "none"}

    def test_sampled_tests_keep_all_methodologies(self, tests):
        found = {row.name: len(row.methodologies) for row in sampled_tests(tests).collect()}
        assert found == {"two": 3, "named": 1, "blank": 1, "draft": 1, "elsewhere": 1}

    def test_configs(self, tests):
        found = configs_of(sampled_tests(live_tests(tests)))
        assert sorted((row.channel, row.name) for row in found.collect()) == [
            ("Banner1", ""),
            ("Banner1", "other"),
            ("Epic", "two"),
            ("Epic", "two"),
        ]
        assert distinct_configs(found).count() == 3

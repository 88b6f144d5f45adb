import json

import pytest

from tests import frames
from tests.frames import acquisition, at, event, page_view
from valuelens import schemas
from valuelens.functions.hours import HOUR, sampling_hours
from valuelens.operators.quality import InvalidData
from valuelens.plans.runs import Facts, Outputs, run_backfill, run_boost_backfill, run_boosts, run_sampling
from valuelens.sinks.records import (
    append_boosts,
    append_metrics,
    append_samples,
    read_boosts,
    read_metrics,
    read_samples,
)
from valuelens.sources import tables
from valuelens.sources.catalog import read_catalog

NOW = at("2024-01-02T12:45")


@pytest.fixture()
def site(spark, tmp_path):
    """Tables on disk, as a run reads them."""
    views = [
        page_view(f"2024-01-0{1 + i % 2}", [event(f"2024-01-02T{i % 12:02}:{i % 60:02}:00")])
        for i in range(600)
    ] + [page_view("2024-01-02", None, [("L", "a")], frames.HOST, "/contribute")]
    acquired = [
        acquisition(f"2024-01-02T{i % 12:02}:30:00", amount=100.0, tests=[("T", "control"), ("L", "a")])
        for i in range(24)
    ]
    day_rates = [("2024-01-01", "GBP", 0.8), ("2024-01-01", "EUR", 1.0)]
    write = lambda frame: frame.write.mode("append")
    write(frames.page_views(spark, *views)).partitionBy("received_date").parquet(f"{tmp_path}/views")
    write(frames.acquisitions(spark, *acquired)).parquet(f"{tmp_path}/acquisitions")
    write(frames.rates(spark, *day_rates)).parquet(f"{tmp_path}/rates")
    (tmp_path / "catalog.json").write_text(frames.catalog_json())
    methodologies = [{"name": "Roulette"}]
    tests = [
        {"channel": "Epic", "name": "T", "status": "Live", "methodologies": methodologies},
        {"channel": "SupportLandingPage", "name": "L", "methodologies": methodologies},
        {"channel": "Banner1", "name": "Quiet", "status": "Live", "methodologies": methodologies},
        {"channel": "Epic", "name": "D", "status": "Draft", "methodologies": methodologies},
    ]
    (tmp_path / "tests.json").write_text("\n".join(json.dumps(test) for test in tests))

    def facts(hours=None):
        return Facts(
            tables.page_views(spark, f"{tmp_path}/views", hours),
            tables.acquisitions(spark, f"{tmp_path}/acquisitions", hours),
            tables.exchange_rates(spark, f"{tmp_path}/rates", hours),
        )

    class Site:
        path = str(tmp_path)
        outputs = Outputs(f"{tmp_path}/samples", f"{tmp_path}/metrics")
        catalog = read_catalog(spark, f"{tmp_path}/catalog.json")
        tests = tables.channel_tests(spark, f"{tmp_path}/tests.json")

    Site.facts = staticmethod(facts)
    return Site


def metrics(spark, site):
    return sorted((row.name, row.value) for row in read_metrics(spark, site.outputs.metrics).collect())


def test_sampling_run(spark, site):
    hours = sampling_hours(NOW)
    run_sampling(
        site.facts(hours), site.catalog, site.tests, frames.HOST, site.outputs, NOW, diagnostics=True
    )
    records = {row.testName: row for row in read_samples(spark, site.outputs.samples).collect()}
    assert {name: len(row.variants) for name, row in records.items()} == {
        "Epic_T": 1,
        "SupportLandingPage_L": 1,
        "Banner1_Quiet": 0,
    }
    [variant] = records["Epic_T"].variants
    assert (variant.views, variant.annualisedValueInGBP) == (50, 160.0)
    assert records["Epic_T"].timestamp == "2024-01-02 10:00:00.000Z"
    assert metrics(spark, site) == [
        ("MissingPrices", 0.0),
        ("TestsWithVariantData", 2.0),
        ("TotalBanditTests", 3.0),
        ("UnratedAcquisitions", 0.0),
    ]


def test_a_repeated_run_replaces_its_records(spark, site):
    for minutes in (45, 50):
        now = NOW.replace(minute=minutes)
        run_sampling(site.facts(), site.catalog, site.tests, frames.HOST, site.outputs, now)
    log = spark.read.parquet(site.outputs.samples)
    assert log.count() == 6
    current = read_samples(spark, site.outputs.samples)
    assert current.count() == 3 and set(current.columns) == {
        "testName", "timestamp", "sample_date", "variants",
    }


def values(spark, site):
    rows = read_samples(spark, site.outputs.samples).collect()
    return {r.timestamp[:13]: r.variants[0].annualisedValueInGBP for r in rows if r.testName == "Epic_T"}


def cheaper(site):
    """The same facts with a tenth of every amount."""
    facts = site.facts()
    less = facts.acquisitions.withColumn("amount", facts.acquisitions.amount / 10)
    return Facts(facts.page_views, less, facts.rates)


def test_a_rerun_of_the_same_time_replaces_higher_values(spark, site):
    run = lambda facts: run_sampling(facts, site.catalog, site.tests, frames.HOST, site.outputs, NOW)
    run(site.facts())
    assert values(spark, site) == {"2024-01-02 10": 160.0}
    run(cheaper(site))
    assert values(spark, site) == {"2024-01-02 10": 16.0}


def test_a_manual_run_of_an_earlier_hour_replaces_what_a_backfill_wrote(spark, site):
    configs = frames.configs(spark, ("Epic", "T"))
    start, now = at("2024-01-02T04:00"), at("2024-01-02T06:30")
    run_backfill(site.facts(), site.catalog, configs, frames.HOST, site.outputs, start, now)
    assert values(spark, site) == {"2024-01-02 03": 160.0, "2024-01-02 04": 160.0}
    again = at("2024-01-02T05:45")
    run_sampling(cheaper(site), site.catalog, site.tests, frames.HOST, site.outputs, again)
    assert values(spark, site) == {"2024-01-02 03": 16.0, "2024-01-02 04": 160.0}


def test_a_run_without_configs_reports_zeros(spark, site):
    none = site.tests.where("false")
    run_sampling(site.facts(), site.catalog, none, frames.HOST, site.outputs, NOW)
    assert [m for m in metrics(spark, site) if m[0] != "NoViewsData"] == [
        ("TestsWithVariantData", 0.0), ("TotalBanditTests", 0.0),
    ]


def test_a_failing_query_of_metrics_stops_the_run_before_any_write(spark, site, monkeypatch):
    from valuelens.plans import runs

    failing = lambda *a: site.tests.selectExpr("raise_error('no views') as name", "1d as value", "'Count' as unit", "now() as time")
    monkeypatch.setattr(runs, "_no_views_points", failing)
    with pytest.raises(Exception, match="no views"):
        run_sampling(site.facts(), site.catalog, site.tests, frames.HOST, site.outputs, NOW)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(site.outputs.samples)


def test_backfill_leaves_hours_with_a_zero_rate_out(spark, site):
    facts = site.facts()
    zero = frames.rates(spark, ("2024-01-02", "GBP", 0.8), ("2024-01-02", "USD", 0.0))
    facts = Facts(facts.page_views, facts.acquisitions, facts.rates.unionByName(zero))
    configs = frames.configs(spark, ("Epic", "T"))
    start, now = at("2024-01-02T23:00"), at("2024-01-03T03:30")
    run_backfill(facts, site.catalog, configs, frames.HOST, site.outputs, start, now)
    times = {row.timestamp[:13] for row in read_samples(spark, site.outputs.samples).collect()}
    assert times == {"2024-01-02 22", "2024-01-02 23"}
    assert ("RejectedHours", 2.0) in metrics(spark, site)


def test_corrections_reach_runs(spark, site):
    facts = site.facts()
    in_pounds = facts.acquisitions.selectExpr(
        "event_timestamp", "product", "'QUARTERLY' as payment_frequency", "'GBP' as currency",
        "amount", "component_type", "country_code", "referrer_url", "ab_tests",
    )
    facts = Facts(facts.page_views, in_pounds, facts.rates)
    run_sampling(facts, site.catalog, site.tests, frames.HOST, site.outputs, NOW, quarterly=True, fix_gbp=True)
    assert values(spark, site)["2024-01-02 10"] > 0


@pytest.mark.parametrize("documents", ["", "[{0}, {0}]"])
def test_there_must_be_one_catalog(spark, tmp_path, documents):
    path = tmp_path / "catalog.json"
    path.write_text(documents.replace("{0}", frames.catalog_json()))
    with pytest.raises(InvalidData, match="exactly one"):
        read_catalog(spark, str(path))


def test_no_views_are_reported(spark, site):
    later = at("2024-01-02T23:45")
    component_tests = site.tests.where("channel <> 'SupportLandingPage'")
    run_sampling(site.facts(), site.catalog, component_tests, frames.HOST, site.outputs, later)
    assert ("NoViewsData", 1.0) in metrics(spark, site)


def test_tests_without_views_are_no_concern_if_others_have_some(spark, site):
    quiet = site.tests.where("name = 'Quiet'").withColumn("channel", site.tests.channel)
    other = quiet.selectExpr("'Epic' as channel", "name", "status", "methodologies")
    run_sampling(site.facts(), site.catalog, other, frames.HOST, site.outputs, NOW)
    assert [name for name, _ in metrics(spark, site)] == ["TestsWithVariantData", "TotalBanditTests"]


def test_landing_tests_alone_look_like_missing_data_unless_counted(spark, site):
    late = at("2024-01-01T02:45")  # two days before the landing page was viewed
    landing = site.tests.where("channel = 'SupportLandingPage'")
    run_sampling(site.facts(), site.catalog, landing, frames.HOST, site.outputs, late)
    assert ("NoViewsData", 1.0) in metrics(spark, site)


def test_an_invalid_row_stops_the_run_before_anything_is_written(spark, site):
    bad = frames.page_views(spark, page_view("2024-01-02", [event("2024-01-02T10:00:00", variant=None)]))
    facts = site.facts()
    facts = Facts(facts.page_views.unionByName(bad), facts.acquisitions, facts.rates)
    with pytest.raises(InvalidData, match="variant_name"):
        run_sampling(facts, site.catalog, site.tests, frames.HOST, site.outputs, NOW)
    for path in (site.outputs.samples, site.outputs.metrics):
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            spark.read.parquet(path)


def test_backfill_leaves_invalid_hours_out(spark, site):
    bad = frames.page_views(spark, page_view("2024-01-02", [event("2024-01-02T05:00:00", variant=None)]))
    facts = site.facts()
    facts = Facts(facts.page_views.unionByName(bad), facts.acquisitions, facts.rates)
    configs = frames.configs(spark, ("Epic", "T"), ("Banner1", "Quiet"))
    run_backfill(
        facts, site.catalog, configs, frames.HOST, site.outputs, at("2024-01-02T04:00"), at("2024-01-02T09:30")
    )
    times = {row.timestamp for row in read_samples(spark, site.outputs.samples).collect()}
    hours = [at("2024-01-02T03:00") + i * HOUR for i in range(5)]
    assert times == {f"{hour} "[:19] + ".000Z" for hour in hours if hour.hour != 5}
    assert [value for name, value in metrics(spark, site) if name == "TotalBanditTests"] == [2.0] * 4


def test_nothing_to_backfill(spark, site):
    configs = frames.configs(spark, ("Epic", "T"))
    run_backfill(site.facts(), site.catalog, configs, frames.HOST, site.outputs, NOW, NOW)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(site.outputs.samples)


def test_boost_runs(spark, site):
    path = f"{site.path}/boosts"
    nothing = frames.table(spark, [], schemas.BOOST_RECORDS)
    run_boosts(site.facts(), nothing, path, NOW)
    [record] = read_boosts(spark, path).collect()
    assert (record.region, record.totalViews, record.totalAcquisitions) == ("GB", 150, 6)
    # An hour later the article is still boosted, so nothing is added.
    run_boosts(site.facts(), read_boosts(spark, path), path, NOW + HOUR)
    assert read_boosts(spark, path).count() == 1


def test_boost_run_with_catalog_prices(spark, site):
    path = f"{site.path}/boosts"
    nothing = frames.table(spark, [], schemas.BOOST_RECORDS)
    run_boosts(site.facts(), nothing, path, NOW, catalog=site.catalog, min_views=150)
    assert spark.read.schema(schemas.BOOST_RECORDS).parquet(path).count() == 0


def test_latest_boost_per_key(spark, tmp_path):
    path = f"{tmp_path}/boosts"
    times = ("2024-01-01 13:00:00.000", "2024-01-02", "2024-01-02 13:00:00.000")
    row = ("u", "GB", 1.0, 1, 1, 1.0, "GB_u", *times)
    for value, minute in ((2.0, 30), (3.0, 20)):
        records = frames.table(spark, [(*row[:2], value, *row[3:])], schemas.BOOST_RECORDS)
        append_boosts(records, path, NOW.replace(minute=minute))
    [current] = read_boosts(spark, path).collect()
    assert current.totalAv == 2.0
    plan = read_boosts(spark, path).where("endDate = '2024-01-02'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(endDate" in plan


def test_sample_log_is_pruned_by_date(spark, tmp_path):
    path = f"{tmp_path}/samples"
    records = frames.table(spark, [("Epic_T", [], "2024-01-02 10:00:00.000Z")], schemas.SAMPLE_RECORDS)
    append_samples(records, path, NOW)
    found = read_samples(spark, path).where("sample_date = date'2024-01-02'")
    assert found.count() == 1
    assert "PartitionFilters: [isnotnull(sample_date" in found._jdf.queryExecution().toString()


def test_failed_metrics_do_not_fail(spark, tmp_path):
    blocked = tmp_path / "file"
    blocked.write_text("")
    points = frames.table(spark, [("n", 1.0, "Count", NOW)], schemas.METRICS)
    assert append_metrics(points, f"{blocked}/metrics") is False
    assert append_metrics(points, f"{tmp_path}/metrics") is True


def test_boost_backfill_equals_hourly_runs(spark, site):
    hourly, at_once = f"{site.path}/hourly", f"{site.path}/at_once"
    nothing = frames.table(spark, [], schemas.BOOST_RECORDS)
    start = at("2024-01-02T10:20")
    stored = nothing
    for hour in range(4):
        run_boosts(site.facts(), stored, hourly, start + (hour + 1) * HOUR)
        stored = read_boosts(spark, hourly)
    run_boost_backfill(site.facts(), nothing, at_once, start, start + 4 * HOUR)
    key = lambda path: sorted((r.id, r.startTimestamp, r.totalViews) for r in read_boosts(spark, path).collect())
    assert key(at_once) == key(hourly) and len(key(hourly)) == 1
    run_boost_backfill(site.facts(), nothing, f"{site.path}/none", NOW, NOW)

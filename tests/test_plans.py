"""What Spark makes of the plans: what is read, what is shuffled, what is broadcast."""

import re

import pytest

from tests import frames
from tests.frames import acquisition, at, event, page_view
from valuelens.functions.hours import Hours
from valuelens.operators.lookup import Lookup
from valuelens.operators.prices import boost_prices, price_dimension
from valuelens.plans.boosts import boost_candidates
from valuelens.plans.samples import variant_samples
from valuelens.sources import tables

HOUR = Hours(at("2024-01-02T10:00"), at("2024-01-02T10:00"))


@pytest.fixture(scope="module")
def site(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("site")
    time = "2024-01-02T10:30:00"
    views = frames.page_views(
        spark, *[page_view(f"2024-01-{1 + i % 28:02}", [event(time)]) for i in range(56)]
    )
    # Columns and sub-fields nobody asks for.
    wide = views.selectExpr(
        "* except (component_event_array)",
        "'agent' as user_agent",
        "transform(component_event_array, e -> named_struct('event_timestamp', e.event_timestamp,"
        " 'event_action', e.event_action, 'component_type', e.component_type, 'ab_test_name',"
        " e.ab_test_name, 'ab_test_variant', e.ab_test_variant, 'page_view_id', 'id'))"
        " as component_event_array",
    )
    wide.write.partitionBy("received_date").parquet(f"{path}/views")
    acquired = frames.acquisitions(spark, acquisition(time), acquisition("2024-01-09T10:30:00"))
    acquired.write.parquet(f"{path}/acquisitions")
    dated = acquired.selectExpr("*", "date(event_timestamp) as event_date")
    dated.write.partitionBy("event_date").parquet(f"{path}/dated")
    frames.rates(spark, ("2024-01-01", "GBP", 0.8), ("2024-01-01", "EUR", 1.0)).write.parquet(
        f"{path}/rates"
    )
    return str(path)


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def samples(spark, site, tests, hours=HOUR, host=None):
    return variant_samples(
        tables.page_views(spark, f"{site}/views", hours),
        tables.acquisitions(spark, f"{site}/acquisitions", hours),
        tables.exchange_rates(spark, f"{site}/rates", hours),
        price_dimension(frames.catalog(spark)),
        frames.configs(spark, *tests),
        hours,
        host,
    )


def scans(plan: str, table: str) -> list[str]:
    return [line for line in plan.splitlines() if "FileScan" in line and f"/{table}]" in line]


@pytest.fixture()
def long_plans(spark):
    before = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield
    spark.conf.set("spark.sql.maxMetadataStringLength", before)


def test_one_scan_for_any_number_of_tests(spark, site):
    for number in (1, 50):
        plan = plan_of(samples(spark, site, [("Epic", f"T{i}") for i in range(number)]))
        assert len(scans(plan, "views")) == 1
        assert len(scans(plan, "acquisitions")) == 1


def test_only_needed_partitions_columns_and_fields_are_read(spark, site, long_plans):
    [scan] = scans(plan_of(samples(spark, site, [("Epic", "T")])), "views")
    assert "(received_date" in scan and ">= 2024-01-01)" in scan and "<= 2024-01-02)" in scan
    schema = re.search(r"ReadSchema: struct<(.*)>", scan).group(1)
    assert "page_view_id" not in schema and "user_agent" not in schema and "path" not in schema


def test_landing_scan_reads_its_own_columns_and_pushes_its_filters(spark, site, long_plans):
    tests = [("Epic", "T"), ("SupportLandingPage", "L")]
    plan = plan_of(samples(spark, site, tests, host=frames.HOST))
    components, landing = sorted(scans(plan, "views"), key=lambda line: "ab_test_array" in line)
    assert "component_event_array" not in landing and "host" not in components
    assert "EqualTo(host,support.example.com)" in landing
    assert "StringEndsWith(path,/contribute)" in landing


def test_times_reach_the_scan_of_acquisitions(spark, site, long_plans):
    [scan] = scans(plan_of(samples(spark, site, [("Epic", "T")])), "acquisitions")
    assert "GreaterThanOrEqual(event_timestamp,2024-01-02T10:00)" in scan
    assert "LessThan(event_timestamp,2024-01-02T11:00)" in scan


def test_acquisitions_by_date_are_pruned(spark, site, long_plans):
    rows = tables.acquisitions(spark, f"{site}/dated", HOUR, by_date=True)
    assert rows.count() == 1 and "event_date" not in rows.columns
    assert "PartitionFilters: [isnotnull(event_date" in plan_of(rows)
    late = Hours(at("2024-01-01T23:00"), at("2024-01-01T23:00"), 3)
    assert [str(day) for day in late.event_dates] == ["2024-01-01", "2024-01-02"]


JOINS_TO_AVOID = ("SortMergeJoin", "ShuffledHashJoin", "NestedLoop", "Cartesian")


def test_samples_are_summed_before_one_shuffle(spark, site):
    plan = plan_of(samples(spark, site, [("Epic", "T")]))
    assert not any(name in plan for name in JOINS_TO_AVOID)
    assert "Python" not in plan and "Window" not in plan.replace("window_", "")
    # The other exchanges belong to the small distinct list of configs.
    shuffles = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert shuffles.count("window_start") == 1 and set(shuffles) <= {"window_start", "channel"}
    assert "partial_sum((FLOOR(capped_av_gbp" in plan


@pytest.mark.parametrize(
    "hours", [Hours(at("2024-01-02T08:00"), at("2024-01-02T08:00"), 3), None], ids=["one", "all"]
)
def test_boosts_are_summed_before_one_shuffle(spark, site, hours):
    candidates = boost_candidates(
        tables.page_views(spark, f"{site}/views", hours),
        tables.acquisitions(spark, f"{site}/acquisitions", hours),
        tables.exchange_rates(spark, f"{site}/rates", hours),
        boost_prices(spark),
        hours,
    )
    plan = plan_of(candidates)
    assert not any(name in plan for name in JOINS_TO_AVOID)
    assert len(re.findall(r"Exchange hashpartitioning\(window_start#", plan)) == 1
    assert "partial_sum(views" in plan
    assert (">= 2024-01-01)" in scans(plan, "views")[0]) == (hours is not None)


def test_large_lookups_are_not_broadcast(spark):
    table = spark.range(0, 1000, 1, 4).selectExpr("id", "repeat('x', 100) as text")
    assert Lookup.of(table).small
    assert not Lookup.of(table, max_rows=999).small
    assert not Lookup.of(table, max_bytes=50_000).small
    small, kept, large = Lookup.all(
        table.limit(10), Lookup(table, small=True), table, max_rows=999
    )
    assert (small.small, kept.small, large.small) == (True, True, False)
    assert "hint" in small.side._jdf.queryExecution().analyzed().toString().lower()
    assert "hint" not in large.side._jdf.queryExecution().analyzed().toString().lower()


def test_results_do_not_depend_on_broadcasting(spark, site, monkeypatch):
    tests = [("Epic", "T"), ("SupportLandingPage", "L")]
    expected = frames.dicts(samples(spark, site, tests, host=frames.HOST))
    never = lambda *tables, **_: [Lookup(getattr(t, "frame", t), False) for t in tables]
    monkeypatch.setattr(Lookup, "all", never)
    monkeypatch.setattr(Lookup, "of", lambda table, **_: never(table)[0])
    assert frames.dicts(samples(spark, site, tests, host=frames.HOST)) == expected != []


def above_scan(plan, folder):
    """The lines above the scan of a folder, from the scan up, as far as the first exchange."""
    lines = plan.splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-*"))
    [start] = [i for i, line in enumerate(lines) if "FileScan" in line and f"/{folder}]" in line.replace(",", "]")]
    above, level = [], depth(lines[start])
    for line in reversed(lines[:start]):
        if depth(line) < level:
            level = depth(line)
            above.append(line)
            if "Exchange" in line:
                return above
    return above


def test_without_broadcasts_acquisitions_are_counted_before_they_are_shuffled(spark, site, monkeypatch):
    never = lambda *tables, **_: [Lookup(getattr(t, "frame", t), False) for t in tables]
    monkeypatch.setattr(Lookup, "all", never)
    monkeypatch.setattr(Lookup, "of", lambda table, **_: never(table)[0])
    hours = Hours(at("2024-01-02T08:00"), at("2024-01-02T08:00"), 3)
    read = tables.acquisitions(spark, f"{site}/acquisitions", hours), tables.exchange_rates(spark, f"{site}/rates", hours)
    candidates = boost_candidates(tables.page_views(spark, f"{site}/views", hours), *read, boost_prices(spark), hours)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plans = [plan_of(samples(spark, site, [("Epic", "T")])), plan_of(candidates)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for plan in plans:
        above = above_scan(plan, "acquisitions")
        assert "Exchange" in above[-1] and any("partial_count(1)" in line for line in above)

import json

import pytest

from tests import frames
from tests.frames import at
from valuelens.functions.hours import Hours
from valuelens.operators.configs import config_hours
from valuelens.operators.quality import (
    InvalidData,
    boost_rules,
    metric_points,
    no_views_check,
    rejected_hours,
    require,
    run_metrics,
    sample_rules,
    total_views_rules,
    violations,
)
from valuelens.sources.catalog import MALFORMED, accepted_catalogs, read_catalog_files, rejected_files

SAMPLES = """window_start timestamp_ntz, channel string, test_name string, variant_name string,
    views bigint, sum_av_gbp double, sum_av_gbp_per_view double, acquisitions bigint"""
HOUR = at("2024-01-02T12:00")
GOOD = (HOUR, "Epic", "T", "control", 100, 10.5, 0.105, 5)


def samples(spark, *rows):
    return frames.table(spark, list(rows), SAMPLES)


def test_valid_rows_pass(spark):
    rows = samples(spark, GOOD)
    assert require(rows, sample_rules()) is rows


@pytest.mark.parametrize("missing", range(2, 8))
def test_a_missing_field_rejects(spark, missing):
    bad = tuple(None if i == missing else value for i, value in enumerate(GOOD))
    with pytest.raises(InvalidData, match="is missing: 1 rows"):
        require(samples(spark, GOOD, bad), sample_rules())


def test_rejected_hours(spark):
    later = at("2024-01-02T13:00")
    rows = samples(spark, GOOD, (later, *GOOD[1:]), (later, "Epic", "T", None, *GOOD[4:]))
    assert [row.window_start for row in rejected_hours(rows).collect()] == [later]


def test_total_views(spark):
    require(frames.table(spark, [(1000,)], "total_views bigint"), total_views_rules())
    with pytest.raises(InvalidData):
        require(frames.table(spark, [(None,)], "total_views bigint"), total_views_rules())


def test_boost_rows(spark):
    schema = """url string, region string, totalAv double, totalViews bigint, avPerView double,
        totalAcquisitions bigint"""
    rows = [("u", "GB", 1.0, 1, 1.0, 1), ("u", "XX", 1.0, 1, 1.0, 1), ("u", None, 1.0, 1, None, 1)]
    found = violations(frames.table(spark, rows, schema), boost_rules())
    counts = {row.rule: row.violations for row in found.collect() if row.violations}
    assert counts == {"region is unknown": 1, "region is missing": 1, "avPerView is missing": 1}


def test_run_metrics_count_repeated_configs(spark):
    hours = Hours(HOUR, at("2024-01-02T13:00"))
    configs = frames.configs(spark, ("Epic", "T"), ("Epic", "T"), ("Banner1", "U"))
    metrics = run_metrics(config_hours(configs, hours), samples(spark, GOOD))
    found = {row.window_start: tuple(row)[1:] for row in metrics.collect()}
    assert found == {HOUR: (3, 2, 200), at("2024-01-02T13:00"): (3, 0, 0)}


def test_one_test_with_one_variant(spark):
    configs = frames.table(spark, [("Epic", "T")], "channel string, name string")
    metrics = run_metrics(config_hours(configs, Hours(HOUR, HOUR)), samples(spark, GOOD))
    points = metric_points(
        metrics, HOUR, TotalBanditTests="total_tests", TestsWithVariantData="tests_with_data"
    )
    assert {(row.name, row.value, row.unit, row.time) for row in points.collect()} == {
        ("TotalBanditTests", 1.0, "Count", HOUR),
        ("TestsWithVariantData", 1.0, "Count", HOUR),
    }


def test_no_views(spark):
    schema = "window_start timestamp_ntz, {} bigint"
    hours = [at(f"2024-01-02T{i:02}:00") for i in range(3)]
    metrics = frames.table(spark, list(zip(hours, [0, 0, 5])), schema.format("variant_views"))
    views = frames.table(spark, [(hours[0], 7)], schema.format("channel_views"))
    found = {row.window_start: row.no_views_data for row in no_views_check(metrics, views).collect()}
    assert found == dict(zip(hours, [0, 1, 0]))


def test_catalog_files_are_accepted_or_rejected_one_by_one(spark, tmp_path):
    good, other = json.loads(frames.catalog_json()), json.loads(frames.catalog_json())
    del other["DigitalSubscription"]["ratePlans"]["Quarterly"]
    empty = json.loads(frames.catalog_json())
    empty["SupporterPlus"]["ratePlans"]["Monthly"]["pricing"]["GBP"] = None
    text = json.loads(frames.catalog_json())
    text["SupporterPlus"]["ratePlans"]["Monthly"]["pricing"]["GBP"] = "twelve"
    files = {"a": [good, good], "b": [good, other], "c": [empty], "d": [good, "{"], "e": [text], "f": [good], "g": []}
    for name, documents in files.items():
        lines = [d if isinstance(d, str) else json.dumps(d) for d in documents]
        (tmp_path / f"{name}.json").write_text("\n".join([*lines, ""]))
    documents = read_catalog_files(spark, str(tmp_path))
    broken = {(row.file[-6], row.rule): row.violations for row in rejected_files(documents).collect()}
    assert broken == {
        ("b", "DigitalSubscription.Quarterly has no pricing"): 1,
        ("c", "SupporterPlus.Monthly has an empty price"): 1,
        ("d", MALFORMED): 1,
        ("e", MALFORMED): 1,
    }
    assert sorted(row.file[-6] for row in accepted_catalogs(documents).collect()) == ["a", "a", "f"]
    (tmp_path / "whole").mkdir()
    (tmp_path / "whole" / "x.json").write_text(json.dumps(good, indent=1))
    whole = read_catalog_files(spark, f"{tmp_path}/whole", lines=False)
    assert accepted_catalogs(whole).count() == 1 and rejected_files(whole).count() == 0

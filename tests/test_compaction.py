"""Compacted logs hold what the logs held."""

import shutil

import pytest

from tests import frames
from tests.frames import at
from valuelens import schemas
from valuelens.sinks import compaction
from valuelens.sinks.records import append_samples, compact_samples, read_samples

NOW = at("2024-01-05T12:00")


def records(spark, value, *days):
    rows = [(f"Epic_T{i}", [("v", value, value, 1)], f"2024-01-{day:02} 10:00:00.000Z") for day in days for i in range(3)]
    return frames.table(spark, rows, schemas.SAMPLE_RECORDS)


def current(spark, path):
    return sorted((r.testName, r.timestamp, r.variants[0].annualisedValueInGBP) for r in read_samples(spark, path).collect())


def files(spark, path, date=None):
    rows = read_samples(spark, path)
    return rows.where(f"sample_date = date'{date}'").inputFiles() if date else rows.inputFiles()


def test_records_stay_and_files_become_fewer(spark, tmp_path):
    path = f"{tmp_path}/samples"
    for run in range(6):
        append_samples(records(spark, float(run), 1 + run % 3, 4), path, NOW, f"{run}")
    before, many = current(spark, path), len(files(spark, path))
    compact_samples(spark, path, settled=True)
    assert current(spark, path) == before and len(files(spark, path)) < many
    # An earlier version that is written later does not win; a later one does, for its day alone.
    append_samples(records(spark, 50.0, 2), path, NOW, "0")
    append_samples(records(spark, 60.0, 3), path, NOW, "7")
    expected = [(t, time, 60.0 if time[9] == "3" else value) for t, time, value in before]
    assert current(spark, path) == expected
    compact_samples(spark, path, settled=True)
    assert current(spark, path) == expected
    assert compaction.state_of(spark, path).open_epoch == 2


def test_an_open_epoch_is_merged_by_the_compaction_after_next(spark, tmp_path):
    path = f"{tmp_path}/samples"
    append_samples(records(spark, 1.0, 1), path, NOW, "1")
    slow = compaction.append_path(spark, path)  # a run that started before the compaction and writes behind it
    compact_samples(spark, path)
    rows = records(spark, 2.0, 1).selectExpr("*", "date'2024-01-01' as sample_date", f"timestamp_ntz'{NOW}' as written_at", "'2' as run_id")
    rows.write.mode("append").partitionBy("sample_date").parquet(slow)
    append_samples(records(spark, 3.0, 2), path, NOW, "3")
    expected = current(spark, path)
    assert {value for *_, value in expected} == {2.0, 3.0}
    for _ in range(3):
        compact_samples(spark, path)
        assert current(spark, path) == expected


def test_a_compaction_that_stops_between_write_and_swap_changes_nothing(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/samples"
    for run in range(2):
        append_samples(records(spark, float(run), 1, 2), path, NOW, f"{run}")
    before, commit, commits = current(spark, path), compaction._commit, []

    def stops(spark_, path_, row):
        commits.append(row)
        if len(commits) == 2:
            raise RuntimeError("lost")
        commit(spark_, path_, row)

    with monkeypatch.context() as patch:
        patch.setattr(compaction, "_commit", stops)
        with pytest.raises(RuntimeError):
            compact_samples(spark, path, settled=True)
    assert current(spark, path) == before
    append_samples(records(spark, 9.0, 2), path, NOW, "9")
    compact_samples(spark, path, settled=True)
    assert {value for _, time, value in current(spark, path) if time[9] == "2"} == {9.0}
    assert {value for _, time, value in current(spark, path) if time[9] == "1"} == {1.0}


def test_a_filter_on_the_date_lists_one_partition(spark, tmp_path):
    path = f"{tmp_path}/samples"
    append_samples(records(spark, 1.0, 1, 2, 3), path, NOW, "1")
    compact_samples(spark, path, settled=True)
    append_samples(records(spark, 2.0, 3), path, NOW, "2")
    for day in (1, 3):
        found = read_samples(spark, path).where(f"sample_date = date'2024-01-0{day}'")
        assert found.count() == 3
        plan = found._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.splitlines() if "FileScan" in line and "Location" in line]
        assert scans and all("sample_date" in line.split("PartitionFilters: ")[1] for line in scans)


def test_superseded_folders_are_named(spark, tmp_path):
    path = f"{tmp_path}/samples"
    for run in range(3):
        append_samples(records(spark, float(run), 1), path, NOW, f"{run}")
        compact_samples(spark, path, settled=True)
    before, names = current(spark, path), compaction.superseded(spark, path)
    assert sum("epochs" in n for n in names) == 2 and sum("version=" in n for n in names) == 2
    for name in names:
        shutil.rmtree(name)
    assert current(spark, path) == before

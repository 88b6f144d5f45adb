"""Compaction of record logs: the current records of settled runs, so that readers need not go through all versions.

A log is appended to in epochs; epoch 0 is the folder itself, later ones and all else lie beside it in
``<log>_compaction``. Compacting closes the open epoch, merges epochs that were closed before, and writes the current record
of each key of the dates they touch as a new version of those dates. A row in the manifest is what makes it valid: a run
that stops before it has changed nothing, and may be repeated. Readers take each date's last version and go through the epochs
that no version covers; dates without any such row are read as they are.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuelens.functions.text import one_of
from valuelens.operators.latest import VERSION, newest_per_key

MANIFEST = "sequence int, open_epoch int, covered int, version string, dates array<string>"


@dataclass(frozen=True)
class Keyed:
    """How records of a log are told apart and laid out. The date follows from the key."""

    columns: str
    key: tuple[str, ...]
    date: str

    @property
    def schema(self) -> str:
        return f"{self.columns}, written_at timestamp_ntz, run_id string"


@dataclass(frozen=True)
class State:
    """What the manifest says: the epoch to append to, the last one that versions cover, and each date's version."""

    sequence: int = 0
    open_epoch: int = 0
    covered: int = -1
    versions: dict[str, str] = field(default_factory=dict)


def state_of(spark: SparkSession, path: str) -> State:
    try:
        rows = spark.read.schema(MANIFEST).parquet(f"{path}_compaction/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return State()
    found = State()
    for row in rows.orderBy("sequence", "version").collect():  # a row for each step of a compaction
        versions = {**found.versions, **dict.fromkeys(row.dates, row.version)}
        found = State(row.sequence, max(found.open_epoch, row.open_epoch), max(found.covered, row.covered), versions)
    return found


def epoch_path(path: str, epoch: int) -> str:
    return path if epoch == 0 else f"{path}_compaction/epochs/{epoch}"


def append_path(spark: SparkSession, path: str) -> str:
    """Where a run that starts now appends."""
    return epoch_path(path, state_of(spark, path).open_epoch)


def _epochs(spark: SparkSession, path: str, kind: Keyed, first: int, last: int) -> DataFrame:
    """Few, as each compaction covers all but the last."""
    parts = [spark.read.schema(kind.schema).parquet(epoch_path(path, e)) for e in range(first, last + 1)]
    return reduce(DataFrame.unionByName, parts)


def _base(spark: SparkSession, path: str, kind: Keyed, versions: dict[str, str]) -> DataFrame:
    """The valid version of each date; the condition holds folder names only, so nothing else is listed."""
    dates: dict[str, list[str]] = {}
    for date, version in versions.items():
        dates.setdefault(version, []).append(date)
    valid = " or ".join(
        f"({one_of('version', [version])} and {one_of(f'cast({kind.date} as string)', of)})" for version, of in dates.items()
    )
    rows = spark.read.schema(f"{kind.schema}, version string").parquet(f"{path}_compaction/base")
    return rows.where(valid).drop("version")


def _touched(rows: DataFrame, kind: Keyed) -> list[str]:
    """Dates with rows in epochs that are not covered yet: as few as there were since the last compaction."""
    return [row[0] for row in rows.select(F.col(kind.date).cast("string")).distinct().collect()]


def _merged(spark: SparkSession, path: str, kind: Keyed, tail: DataFrame, state: State, dates: list[str]) -> DataFrame:
    """The newest row of each key of these dates, with its version columns."""
    older = {date: state.versions[date] for date in dates if date in state.versions}
    rows = tail if not older else tail.unionByName(_base(spark, path, kind, older))
    return newest_per_key(rows, [*kind.key, kind.date])


def read(spark: SparkSession, path: str, kind: Keyed) -> DataFrame:
    """The current record per key. A filter on the date is one on folders."""
    state = state_of(spark, path)
    tail = _epochs(spark, path, kind, state.covered + 1, state.open_epoch)
    if not state.versions:
        return newest_per_key(tail, [*kind.key, kind.date]).drop(*VERSION)
    dates = _touched(tail, kind)
    merged = _merged(spark, path, kind, tail, state, dates)
    settled = {date: version for date, version in state.versions.items() if date not in dates}
    if settled:
        merged = merged.unionByName(_base(spark, path, kind, settled))
    return merged.drop(*VERSION)


def _commit(spark: SparkSession, path: str, row: tuple) -> None:
    spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}_compaction/manifest")


def compact(spark: SparkSession, path: str, kind: Keyed, settled: bool = False) -> None:
    """Merges the epochs closed by earlier compactions, and closes the open one.

    A run must not outlast the time between two compactions, as what it appends to a merged epoch is lost. ``settled``
    says that no run is writing: the open epoch is merged too. One compaction at a time.
    """
    state = state_of(spark, path)
    last = state.open_epoch if settled else state.open_epoch - 1
    opened = state.open_epoch + 1
    spark.createDataFrame([], kind.schema).write.mode("ignore").parquet(epoch_path(path, opened))
    _commit(spark, path, (state.sequence + 1, opened, state.covered, "", []))
    if last <= state.covered:
        return
    tail = _epochs(spark, path, kind, state.covered + 1, last)
    dates, version = _touched(tail, kind), uuid.uuid4().hex
    if dates:
        (
            _merged(spark, path, kind, tail, state, dates)
            .hint("rebalance", F.col(kind.date))
            .write.partitionBy(kind.date)
            .parquet(f"{path}_compaction/base/version={version}")
        )
    _commit(spark, path, (state.sequence + 2, opened, last, version, dates))


def superseded(spark: SparkSession, path: str) -> list[str]:
    """Folders that no reader asks for any more: covered epochs beyond the first, and versions without a valid date.

    Readers that started before the last compaction may still need them; what to delete, and when, is the caller's choice.
    """
    state = state_of(spark, path)
    epochs = [epoch_path(path, e) for e in range(1, state.covered + 1)]
    versions = spark.read.schema(MANIFEST).parquet(f"{path}_compaction/manifest").where("version <> '' and size(dates) > 0")
    known = sorted({row.version for row in versions.select("version").collect()} - set(state.versions.values()))
    return [*epochs, *(f"{path}_compaction/base/version={version}" for version in known)]

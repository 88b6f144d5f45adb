"""Keyed records and metrics on Parquet.

Runs append; readers see the record written last for each key. A repeated run therefore replaces its
records, whatever hours either covered, and a run that dies half-way can simply be repeated. ``compact_samples`` and
``compact_boosts``, now and then, keep readers from going through all versions ever written.
"""

from __future__ import annotations

import logging
import time
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuelens import schemas
from valuelens.functions.hours import ntz
from valuelens.operators.latest import BOOST_RECORD_KEY, SAMPLE_RECORD_KEY
from valuelens.sinks import compaction

log = logging.getLogger(__name__)

SAMPLES = compaction.Keyed(f"{schemas.SAMPLE_RECORDS}, sample_date date", tuple(SAMPLE_RECORD_KEY), "sample_date")
BOOSTS = compaction.Keyed(schemas.BOOST_RECORDS, tuple(BOOST_RECORD_KEY), "endDate")


def new_run_id() -> str:
    """Later runs of one writer sort behind earlier ones."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex}"


def _append(
    records: DataFrame, path: str, partition: str, written_at: datetime | None, run_id: str | None
) -> None:
    """Stamps the records with the time of writing (not the time a run is for) and with the run."""
    stamp = written_at or datetime.now(timezone.utc).replace(tzinfo=None)
    (
        records.withColumn("written_at", F.expr(ntz(stamp)))
        .withColumn("run_id", F.lit(run_id or new_run_id()))
        # Few files per partition, and no task that must write a large partition alone.
        .hint("rebalance", F.col(partition))
        .write.mode("append")
        .partitionBy(partition)
        .parquet(compaction.append_path(records.sparkSession, path))
    )


def append_samples(
    records: DataFrame, path: str, written_at: datetime | None = None, run_id: str | None = None
) -> None:
    """Adds sample records, at most one per test and hour, to the log."""
    day = F.to_date(F.substring("timestamp", 1, 10))
    _append(records.withColumn("sample_date", day), path, "sample_date", written_at, run_id)


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """The current record per test and hour. Filter on sample_date to read few files."""
    return compaction.read(spark, path, SAMPLES)


def compact_samples(spark: SparkSession, path: str, settled: bool = False) -> None:
    compaction.compact(spark, path, SAMPLES, settled)


def append_boosts(
    records: DataFrame, path: str, written_at: datetime | None = None, run_id: str | None = None
) -> None:
    """Adds boost records to the log, by the date they end."""
    _append(records, path, "endDate", written_at, run_id)


def read_boosts(spark: SparkSession, path: str) -> DataFrame:
    """The current record per article, region and start. The end date follows from the start."""
    return compaction.read(spark, path, BOOSTS)


def compact_boosts(spark: SparkSession, path: str, settled: bool = False) -> None:
    compaction.compact(spark, path, BOOSTS, settled)


def append_keyed(rows: DataFrame, path: str, kind: compaction.Keyed, run_id: str) -> None:
    """Adds rows of a kind to their log, with at most one row per key."""
    _append(rows, path, kind.date, None, run_id)


def read_keyed(spark: SparkSession, path: str, kind: compaction.Keyed) -> DataFrame:
    return compaction.read(spark, path, kind)


def append_metrics(points: DataFrame, path: str) -> bool:
    """Adds metric points. A failing write is logged, not raised: metrics must not fail a run.

    The points are worked out before that, so that a failing query does fail the run.
    """
    points = points.persist()
    try:
        points.count()
        try:
            points.hint("rebalance").write.mode("append").parquet(path)
        except Exception:  # whatever the storage raises
            log.exception("could not write metrics to %s", path)
            return False
        return True
    finally:
        points.unpersist()


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.METRICS).parquet(path)

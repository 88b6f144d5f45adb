"""Fact and dimension tables on Parquet, read with narrow schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from valuelens import schemas
from valuelens.functions.hours import Hours, days_between
from valuelens.functions.text import one_of
from valuelens.operators.acquisitions import acquired_in
from valuelens.operators.rates import rates_for
from valuelens.operators.views import received_in


def page_views(spark: SparkSession, path: str, hours: Hours | None = None) -> DataFrame:
    """Page views, partitioned by received_date; only the partitions the windows need are listed."""
    return received_in(spark.read.schema(schemas.PAGE_VIEWS).parquet(path), hours)


def acquisitions(
    spark: SparkSession, path: str, hours: Hours | None = None, by_date: bool = False
) -> DataFrame:
    """Acquisitions. ``by_date`` tells that the table is partitioned by event_date."""
    if not by_date:
        return acquired_in(spark.read.schema(schemas.ACQUISITIONS).parquet(path), hours)
    rows = spark.read.schema(f"{schemas.ACQUISITIONS}, event_date date").parquet(path)
    if hours is not None:
        rows = rows.where(days_between("event_date", hours.event_dates))
    return acquired_in(rows, hours).drop("event_date")


def exchange_rates(spark: SparkSession, path: str, hours: Hours | None = None) -> DataFrame:
    return rates_for(spark.read.schema(schemas.EXCHANGE_RATES).parquet(path), hours)


def channel_tests(spark: SparkSession, path: str) -> DataFrame:
    return live_tests(spark.read.schema(schemas.CHANNEL_TESTS).json(path))


def live_tests(tests: DataFrame) -> DataFrame:
    """Tests of the sampled channels that are not drafts. A test without a status is live."""
    return tests.where(f"{one_of('channel', schemas.CHANNELS)} and not (status <=> 'Draft')")

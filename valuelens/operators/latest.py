"""Latest version per key of an append-only log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_RECORD_KEY = ["testName", "timestamp"]
BOOST_RECORD_KEY = ["id", "startTimestamp"]


VERSION = ["written_at", "run_id"]


def newest_per_key(log: DataFrame, key: list[str]) -> DataFrame:
    """The row of each key that was written last, by the time of writing, then by the run that wrote it.

    An aggregation rather than a ranking: versions of a key are reduced before they are shuffled. A run writes a
    key once, so the values of a row never decide.
    """
    rest = [name for name in log.columns if name not in [*key, *VERSION]]
    newest = F.max(F.struct(*VERSION, F.struct(*rest).alias("row")))
    return log.groupBy(*key).agg(newest.alias("newest")).select(
        *key, *[F.col("newest.row")[name].alias(name) for name in rest], *[f"newest.{name}" for name in VERSION]
    )


def latest_per_key(log: DataFrame, key: list[str]) -> DataFrame:
    """One row per key, as written last, without its version columns."""
    return newest_per_key(log, key).drop(*VERSION)

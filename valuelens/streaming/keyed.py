"""Streams into keyed records: corrected as late events come in, and the same after a restart.

A batch writes under its number as run id, and a batch that is repeated writes the same again; so whatever stops a stream, and
wherever, no record is lost or counted twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from valuelens.functions.hours import Hours
from valuelens.functions.value import cap, exact_sum
from valuelens.operators.acquisitions import unnest_tests, value_of_acquisitions
from valuelens.operators.configs import distinct_configs
from valuelens.operators.lookup import Lookup
from valuelens.operators.prices import price_acquisitions
from valuelens.operators.rates import sample_rates
from valuelens.operators.views import landing_days, landing_pages, landing_rows
from valuelens.plans.boosts import boost_records, sequential_entries
from valuelens.plans.samples import sample_records
from valuelens.schemas import BOOST_MIN_VALUE, BOOST_MIN_VIEWS, COMPONENT_TYPES, VALUE_CAP
from valuelens.sinks.compaction import Keyed
from valuelens.sinks.records import append_boosts, append_keyed, append_samples, read_boosts, read_keyed
from valuelens.streaming.rollups import LATENESS, _acquisitions, _by_window_start, _views

COMPONENT_SUMS = Keyed(
    """window_start timestamp_ntz, component_type string, test_name string, variant_name string, views bigint,
    sum_av_gbp double, acquisitions bigint, sample_date date""",
    ("window_start", "component_type", "test_name", "variant_name"),
    "sample_date",
)
LANDING_COUNTS = Keyed(
    "test_name string, variant_name string, pages bigint, received_date date", ("test_name", "variant_name"), "received_date"
)


def stream_component_sums(
    page_views: DataFrame,
    acquisitions: DataFrame,
    rates: DataFrame,
    prices: DataFrame | Lookup,
    lateness: str = LATENESS,
    value_cap: float = VALUE_CAP,
) -> DataFrame:
    """Views, value and acquisitions per hour, component type, test and variant, of all tests.

    Configs play no part yet: they are joined with sums, so that no raw row of the stream is shuffled to meet them.
    """
    prices, rates = Lookup.all(prices, sample_rates(rates))
    group = ["component_type", "test_name", "variant_name"]
    views = _views(page_views, list(COMPONENT_TYPES.values()), lateness).selectExpr(
        "event_time", "event.component_type", "event.ab_test_name as test_name", "event.ab_test_variant as variant_name",
        "1L as views", "cast(null as double) as capped_av_gbp", "0L as acquisitions",
    )
    tested = unnest_tests(_acquisitions(acquisitions, lateness), None, "event_time").where(
        "test_name is not null and variant_name is not null"
    )
    values = value_of_acquisitions(price_acquisitions(tested, prices), rates).selectExpr(
        "event_time", *group, "0L as views", f"{cap('av_gbp', value_cap)} as capped_av_gbp", "1L as acquisitions"
    )
    sums = (
        views.unionByName(values)
        .groupBy(F.window("event_time", "1 hour"), *group)
        .agg(
            F.expr("sum(views) as views"),
            F.expr(f"{exact_sum('capped_av_gbp')} as sum_av_gbp"),
            F.expr("sum(acquisitions) as acquisitions"),
        )
    )
    return _by_window_start(sums).withColumn("sample_date", F.to_date("window_start"))


def samples_of_sums(sums: DataFrame, configs: DataFrame) -> DataFrame:
    """Samples of component tests from the sums of all tests."""
    tests = distinct_configs(configs).where("component_type is not null")
    return (
        sums.where("views > 0")
        .join(tests, ["component_type", "test_name"])
        .selectExpr(
            "window_start", "channel", "test_name", "variant_name", "views", "acquisitions",
            "coalesce(sum_av_gbp, 0) as sum_av_gbp",
        )
        .withColumn("sum_av_gbp_per_view", F.expr("try_divide(sum_av_gbp, views)"))
    )


def _run_id(batch_id: int) -> str:
    return f"{batch_id:020d}"


def _in_batches(
    rows: DataFrame, checkpoint: str, mode: str, save: Callable[[DataFrame, int], None]
) -> StreamingQuery:
    def saved(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # written and read again
        try:
            save(batch, batch_id)
        finally:
            batch.unpersist()

    return (
        rows.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(saved)
        .start()
    )


def write_samples(
    sums: DataFrame, configs: DataFrame, sums_path: str, samples_path: str, checkpoint: str
) -> StreamingQuery:
    """Keeps the record of every test and hour up to date, as long as its events may be late.

    A batch appends the sums that it changed; the records of their tests and hours are then written anew from the current sums, so that
    they hold all variants.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        append_keyed(batch, sums_path, COMPONENT_SUMS, _run_id(batch_id))
        days = [row.sample_date for row in batch.select("sample_date").distinct().collect()]  # as late as events may be
        touched = batch.select("window_start", "component_type", "test_name").distinct()
        current = read_keyed(batch.sparkSession, sums_path, COMPONENT_SUMS).where(F.col("sample_date").isin(days))
        samples = samples_of_sums(current.join(touched, ["window_start", "component_type", "test_name"], "left_semi"), configs)
        hours = samples.select("channel", "test_name", "window_start").distinct()
        append_samples(sample_records(hours, samples), samples_path, run_id=_run_id(batch_id))

    return _in_batches(sums, checkpoint, "update", save)


def write_boosts(
    windows: DataFrame,
    path: str,
    checkpoint: str,
    min_views: int = BOOST_MIN_VIEWS,
    min_value: float = BOOST_MIN_VALUE,
) -> StreamingQuery:
    """Boost records of the windows that close, in order of time; ``windows`` are those of ``stream_articles``.

    A batch compares with all records stored, its own included if it is repeated: then it adds nothing to them.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id == 0:
            append_boosts(boost_records(batch.where("false")), path, run_id=_run_id(0))  # so that there is a log to read
        beyond = batch.where(f"totalViews > greatest(0, {min_views}) and totalAv > {float(min_value)}d")
        entries = sequential_entries(beyond, read_boosts(spark, path))
        append_boosts(boost_records(entries), path, run_id=_run_id(batch_id))

    return _in_batches(windows, checkpoint, "append", save)


def stream_landing_counts(page_views: DataFrame, landing_host: str, lateness: str = "2 days") -> DataFrame:
    """Landing-page views per day received, test and variant: the pane that hours of two days share."""
    pages = landing_pages(page_views, landing_host, None).selectExpr("received_date", "explode(ab_test_array) as ab")
    return (
        pages.selectExpr(
            "cast(received_date as timestamp) as event_time",
            "received_date",
            "ab.ab_test_name as test_name",
            "ab.ab_test_variant as variant_name",
        )
        .withWatermark("event_time", lateness)
        # The day is the event time; it must be a key for its state to be dropped some time.
        .groupBy("event_time", "received_date", "test_name", "variant_name")
        .agg(F.expr("count(*) as pages"))
        .drop("event_time")
    )


def write_landing_counts(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    def save(batch: DataFrame, batch_id: int) -> None:
        append_keyed(batch, path, LANDING_COUNTS, _run_id(batch_id))

    return _in_batches(counts, checkpoint, "update", save)


def landing_hours(counts: DataFrame, configs: DataFrame, hours: Hours) -> DataFrame:
    """Rows of SAMPLE_KEY and ``views`` from counts by day: every hour of a day has those of it and of the day before."""
    return landing_rows(landing_days(counts, distinct_configs(configs), hours), hours)

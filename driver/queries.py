"""One query per operator or plan, over the driver's whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driver import tables as t
from valuelens.functions.hours import (
    DAY,
    HOUR,
    Hours,
    backfill_hours,
    boost_window,
    hour_of,
    ntz,
    sampling_window,
)
from valuelens.functions.article import region_of
from valuelens.functions.value import cap
from valuelens.operators import acquisitions as acq
from valuelens.operators import quality, views
from valuelens.operators.configs import (
    config_hours,
    distinct_configs,
    sampled_tests,
    test_configs,
)
from valuelens.operators.latest import BOOST_RECORD_KEY, SAMPLE_RECORD_KEY, latest_per_key
from valuelens.operators.prices import (
    boost_prices,
    list_prices,
    price_acquisitions,
    price_dimension,
    price_matrix,
)
from valuelens.operators.rates import boost_rates, eur_rates, rates_for, sample_rates
from valuelens.plans import boosts
from valuelens.plans.runs import Facts, Outputs, run_backfill, run_sampling
from valuelens.plans.samples import SAMPLE_KEY, sample_records, sample_rows, variant_samples
from valuelens.schemas import CHANNELS
from valuelens.session import shared_folder
from valuelens.sinks.compaction import append_path
from valuelens.sinks.records import (
    append_samples,
    compact_boosts,
    compact_samples,
    read_boosts,
    read_keyed,
    read_metrics,
    read_samples,
)
from valuelens.sources.catalog import accepted_catalogs, parse_catalogs, read_catalog_files, rejected_files
from valuelens.sources.tables import live_tests
from valuelens.streaming import keyed, rollups

Query = Callable[[SparkSession, str], DataFrame]

# Gates low enough for the small tables to have articles beyond them.
MIN_VIEWS, MIN_VALUE = 0, 40
TWO_DAYS = 48  # hours

ACTIVE_AT = datetime(2024, 1, 15, 12, 34)
RUN_AT = datetime(2024, 2, 1)
RUN_OF = datetime(2024, 1, 10, 14, 45)  # covers 12:00 to 13:00


class Inputs:
    """The driver's tables in the library's shape."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.events = t.events(spark, sf_dir)
        self.page_views = t.page_views(self.events)
        self.acquisitions = t.acquisitions(self.events)
        self.rates = t.exchange_rates(spark)
        self.configs = t.configs(spark)

    @property
    def prices(self) -> DataFrame:
        return price_dimension(parse_catalogs(t.catalog_document(self.spark), "document"))

    @property
    def tests(self) -> DataFrame:
        return distinct_configs(self.configs)

    def hours(self, span: int = 1) -> Hours:
        return Hours.spanning(self.events, "ts", span)

    def samples(self, hours: Hours | None = None, landing: bool = False, **options) -> DataFrame:
        host = t.LANDING_HOST if landing else None
        return variant_samples(
            self.page_views,
            self.acquisitions,
            self.rates,
            self.prices,
            self.configs,
            hours,
            host,
            **options,
        )

    def candidates(self) -> DataFrame:
        return boosts.boost_candidates(
            self.page_views,
            self.acquisitions,
            self.rates,
            boost_prices(self.spark),
            None,
            MIN_VIEWS,
            MIN_VALUE,
        )

    def priced(self, prices) -> DataFrame:
        return price_acquisitions(acq.unnest_tests(self.acquisitions), prices)

    def valued(self, **options) -> DataFrame:
        return acq.value_of_acquisitions(
            self.priced(self.prices), sample_rates(self.rates), **options
        )


SAMPLE_VALUES = ["sum_av_gbp", "sum_av_gbp_per_view"]
BOOST_VALUES = ["totalAv", "avPerView"]
ACQUISITION = ["window_start", "product", "payment_frequency", "currency", "amount"]
TEST = ["component_type", "test_name", "variant_name"]


def experiment_configs(spark, sf_dir):
    tests = live_tests(t.channel_tests(spark, sf_dir))
    return test_configs(sampled_tests(tests))


def sampled_test_documents(spark, sf_dir):
    tests = sampled_tests(live_tests(t.channel_tests(spark, sf_dir)))
    return tests.select(
        "name", "channel", F.posexplode("methodologies").alias("position", "m")
    ).select("name", "channel", "position", F.col("m.name").alias("methodology"), "m.epsilon")


def price_dimension_query(spark, sf_dir):
    catalogs = parse_catalogs(t.catalog_documents(spark, sf_dir), "document", "version")
    return price_dimension(catalogs, "version")


def price_matrix_query(spark, sf_dir):
    matrix = price_matrix(price_dimension_query(spark, sf_dir), "version")
    return matrix.select(
        "version",
        "product",
        "currency",
        F.size("prices").alias("frequencies"),
        *[
            F.element_at("prices", name).alias(name.lower())
            for name in ("MONTHLY", "ANNUALLY", "QUARTERLY")
        ],
    )


def price_lookup(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    requests = inputs.events.select(
        "event_id",
        t.pick(["SUPPORTER_PLUS", "DIGITAL_SUBSCRIPTION"], "k % 2").alias("product"),
        t.pick(t.CURRENCIES, "event_id % 7").alias("currency"),
        t.pick(t.FREQUENCIES, "event_id % 4").alias("payment_frequency"),
    )
    return list_prices(requests, inputs.prices)


def catalog_violations(spark, sf_dir):
    catalogs = parse_catalogs(t.broken_catalog_documents(spark, sf_dir), "document", "version")
    return quality.violations(catalogs, quality.catalog_rules())


def catalog_files(spark, sf_dir):
    """Bundles of catalog files: how many documents each has, how many prices are accepted, and which rules it breaks."""
    folder = f"{shared_folder(spark)}/catalogs-{uuid.uuid4()}"
    written = t.broken_catalog_documents(spark, sf_dir, malformed=True).select("bundle", "document")
    written.repartition("bundle").write.partitionBy("bundle").text(folder)
    documents = read_catalog_files(spark, folder)
    bundle = F.regexp_extract("file", "bundle=([0-9]+)/", 1).cast("long").alias("bundle")
    broken = rejected_files(documents).groupBy(bundle).agg(F.array_join(F.array_sort(F.collect_set("rule")), ", ").alias("rules"))
    prices = price_dimension(accepted_catalogs(documents), "file").groupBy(bundle).agg(F.count("*").alias("prices"))
    counts = documents.groupBy(bundle).agg(F.count("*").alias("documents"))
    return counts.join(broken, "bundle", "left").join(prices, "bundle", "left").select(
        "bundle", "documents", F.coalesce("rules", F.lit("")).alias("rules"), F.coalesce("prices", F.lit(0).cast("long")).alias("prices")
    )


def fx_reverse_rate(spark, sf_dir):
    return eur_rates(t.quoted_rates(spark, sf_dir))


def fx_to_gbp(spark, sf_dir):
    return boost_rates(t.daily_rates(spark, sf_dir))


def fx_sample_rates(spark, sf_dir):
    return sample_rates(t.daily_rates(spark, sf_dir))


def component_views_hourly(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    return views.component_views(inputs.page_views, inputs.tests)


def landing_views_daily(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    return views.landing_views_by_day(inputs.page_views, inputs.tests, t.LANDING_HOST)


def total_component_views(spark, sf_dir):
    return views.total_component_views(Inputs(spark, sf_dir).page_views, CHANNELS)


def channel_views_hourly(spark, sf_dir):
    return views.views_by_hour(Inputs(spark, sf_dir).page_views, ["Epic", "Banner2"])


def acquisitions_unnested(spark, sf_dir):
    return acq.unnest_tests(Inputs(spark, sf_dir).acquisitions)


def acquisitions_of_tests(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    return acq.of_tests(acq.unnest_tests(inputs.acquisitions), inputs.tests)


def acquisitions_priced(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    return inputs.priced(inputs.prices).select(*ACQUISITION, *TEST, "price", "paid")


def acquisitions_priced_fixed(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    return inputs.priced(boost_prices(spark)).select(*ACQUISITION, *TEST, "price", "paid")


def acquisitions_av_gbp(spark, sf_dir):
    return Inputs(spark, sf_dir).valued().select(*ACQUISITION, *TEST, "av_eur", "av_gbp")


def acquisitions_av_gbp_corrected(spark, sf_dir):
    valued = Inputs(spark, sf_dir).valued(fix_gbp=True, quarterly=True)
    return valued.select(*ACQUISITION, *TEST, "av_eur", "av_gbp")


def acquisitions_capped(spark, sf_dir):
    valued = Inputs(spark, sf_dir).valued()
    return valued.select(*ACQUISITION, *TEST, F.expr(cap("av_gbp")).alias("capped_av_gbp"))


def acquisition_totals(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    values = acq.acquisition_values(
        inputs.acquisitions, inputs.prices, sample_rates(inputs.rates), inputs.tests
    )
    return acq.acquisition_totals(values)


def acquisitions_unrated(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    return acq.unrated_acquisitions(inputs.acquisitions, sample_rates(inputs.rates))


def variant_samples_component(spark, sf_dir):
    return Inputs(spark, sf_dir).samples()


def variant_samples_landing(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    inputs.configs = inputs.configs.where("channel = 'SupportLandingPage'")
    return inputs.samples(inputs.hours(), landing=True)


def variant_samples_all(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    return inputs.samples(inputs.hours(), landing=True)


def backfill_windows(spark, sf_dir):
    """Acquisitions per window of a backfill from the first event to the last."""
    inputs = Inputs(spark, sf_dir)
    first, last = inputs.events.agg(F.min("ts"), F.max("ts")).first()
    hours = backfill_hours(first, last)
    windows = spark.range(1).select(F.expr(f"explode({hours.each()})").alias("window_start"))
    counts = inputs.acquisitions.groupBy(F.expr(hour_of("event_timestamp")).alias("window_start"))
    return windows.join(counts.agg(F.count("*").alias("n")), "window_start", "left").select(
        "window_start", F.coalesce("n", F.lit(0)).alias("acquisitions")
    )


def backfill_samples(spark, sf_dir):
    """Samples of the hours of a backfill that starts at the mean time of all events."""
    inputs = Inputs(spark, sf_dir)
    first, last = inputs.events.agg(F.min("ts"), F.max("ts")).first()
    hours = backfill_hours(first + (last - first) / 2, last)
    return inputs.samples(hours, landing=True)


def sample_records_flat(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    hours = inputs.hours()
    records = sample_records(config_hours(inputs.configs, hours), inputs.samples(hours, True))
    return _flat(records)


def _flat(records: DataFrame) -> DataFrame:
    return sample_rows(records)


def _sampled_twice(spark, sf_dir):
    """All hours sampled with a low cap, then the later half again with the usual one."""
    inputs = Inputs(spark, sf_dir)
    hours = inputs.hours()
    wanted = config_hours(inputs.configs, hours)
    first = sample_records(wanted, inputs.samples(hours, value_cap=10.0))
    middle = hours.first + (hours.last - hours.first) // HOUR // 2 * HOUR
    later = Hours(middle, hours.last)
    return first, sample_records(config_hours(inputs.configs, later), inputs.samples(later))


def samples_latest(spark, sf_dir):
    """The current records of two runs of one time."""
    first, again = _sampled_twice(spark, sf_dir)
    log = first.withColumn("run_id", F.lit("1")).unionByName(again.withColumn("run_id", F.lit("2")))
    log = log.withColumn("written_at", F.expr(ntz(RUN_AT)))
    return _flat(latest_per_key(log, SAMPLE_RECORD_KEY))


def region_of_country(spark, sf_dir):
    """The region of each acquisition, some countries made unknown, lower case or missing."""
    rows = t.acquisitions(t.events(spark, sf_dir))
    country = F.expr(
        "case when minute(event_timestamp) % 10 = 0 then null"
        " when minute(event_timestamp) % 10 = 1 then lower(country_code)"
        " when minute(event_timestamp) % 10 = 2 then 'IE' else country_code end"
    )
    return (
        rows.select(country.alias("country"))
        .withColumn("region", F.expr(region_of("country")))
        .groupBy("country", "region")
        .agg(F.count("*").alias("acquisitions"))
    )


def boost_views(spark, sf_dir):
    return views.article_views(Inputs(spark, sf_dir).page_views)


def boost_acquisitions(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    values = acq.article_acquisition_values(
        inputs.acquisitions, boost_prices(spark), boost_rates(inputs.rates)
    )
    return acq.article_acquisitions(values)


def boost_candidates(spark, sf_dir):
    return Inputs(spark, sf_dir).candidates()


def boosts_latest(spark, sf_dir):
    return latest_per_key(t.stored_boosts(t.events(spark, sf_dir)), BOOST_RECORD_KEY)


def boost_active(spark, sf_dir):
    return boosts.active_boosts(boosts_latest(spark, sf_dir), ACTIVE_AT)


def boost_entries(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    entries = boosts.boost_entries(inputs.candidates(), boosts_latest(spark, sf_dir))
    return entries


def boost_records(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    entries = boosts.boost_entries(inputs.candidates(), boosts_latest(spark, sf_dir))
    return boosts.boost_records(entries)


def boost_entries_sequential(spark, sf_dir):
    """Entries of all windows, an article that entered being boosted for a day."""
    inputs = Inputs(spark, sf_dir)
    entries = boosts.sequential_entries(inputs.candidates(), boosts_latest(spark, sf_dir))
    return entries


def boost_candidates_default_gates(spark, sf_dir):
    """Candidates with the gates that a run has: the whole site as one article, every event shown six times, two days long."""
    inputs = Inputs(spark, sf_dir)
    shown = F.flatten(F.array_repeat("component_event_array", 6))
    site = {"path": F.lit("/"), "country_key": F.lit(None).cast("string"), "component_event_array": shown}
    acquired = {"referrer_url": F.lit("https://www.example.com/"), "country_code": F.lit(None).cast("string")}
    found = boosts.boost_candidates(
        inputs.page_views.where("host = 'www.example.com'").withColumns(site),
        inputs.acquisitions.withColumns(acquired),
        inputs.rates,
        boost_prices(spark),
        None,
        span=TWO_DAYS,
    )
    return found


def _compacted(spark, name, append, read, compact, *runs):
    """What a log holds after it was compacted between its runs, and once more after the last."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4()}"
    for number, records in enumerate(runs, 1):
        append(records, path, RUN_AT, str(number))
        compact(spark, path, settled=number < len(runs))
    return read(spark, path)


def samples_compacted(spark, sf_dir):
    first, again = _sampled_twice(spark, sf_dir)
    found = _compacted(spark, "samples", append_samples, read_samples, compact_samples, first, again)
    return _flat(found)


def boosts_compacted(spark, sf_dir):
    """Stored boosts, of which each sign-up's records are a run, in two parts by hour; the later one is not merged yet."""
    path = f"{shared_folder(spark)}/boosts-{uuid.uuid4()}"
    rows = t.stored_boosts(t.events(spark, sf_dir))
    early = F.hour("written_at") < 12
    for part, settled in ((rows.where(early), True), (rows.where(~early), False)):
        part.write.mode("append").partitionBy("endDate").parquet(append_path(spark, path))
        compact_boosts(spark, path, settled)
    return read_boosts(spark, path)


def run_metrics(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    hours = inputs.hours()
    configs = inputs.configs.unionByName(inputs.configs.where("channel = 'Epic'"))
    wanted = config_hours(configs, hours)
    return quality.run_metrics(wanted, inputs.samples(hours, landing=True))


def run_metrics_without_configs(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    hours = inputs.hours()
    none = inputs.configs.where("false")
    samples = inputs.samples(hours, landing=True).where("false")
    due = quality.hours_frame(spark, hours)
    return quality.run_metrics(config_hours(none, hours), samples, due)


def run_outputs(spark, sf_dir):
    """What two runs leave behind, read back: a backfill of all hours, then a run at a time that is given.

    Metrics by run, and by hour how many records hold how many variants.
    """
    inputs = Inputs(spark, sf_dir)
    folder = f"{shared_folder(spark)}/run-{uuid.uuid4()}"
    outputs = Outputs(f"{folder}/samples", f"{folder}/metrics")
    facts = Facts(inputs.page_views, inputs.acquisitions, inputs.rates)
    catalog = parse_catalogs(t.catalog_document(spark), "document")
    configs = inputs.configs.where("channel <> 'SupportLandingPage'")
    first, last = inputs.events.agg(F.min("ts"), F.max("ts")).first()
    run_backfill(facts, catalog, configs, t.LANDING_HOST, outputs, first, last, diagnostics=True)
    methodology = F.expr("array(named_struct('name', 'Roulette', 'testName', cast(null as string), 'epsilon', cast(null as double)))")
    run_sampling(facts, catalog, configs.withColumn("methodologies", methodology), t.LANDING_HOST, outputs, RUN_OF)
    metrics = read_metrics(spark, outputs.metrics).groupBy("name", "time").agg(
        F.count("*").alias("points"), F.sum("value").alias("value")
    )
    records = read_samples(spark, outputs.samples).select(
        F.concat(F.lit("records of "), F.col("sample_date").cast("string")).alias("name"), F.size("variants").alias("n")
    )
    found = records.groupBy("name").agg(F.count("*").alias("points"), F.sum("n").cast("double").alias("value"))
    later = F.expr(f"time = {ntz(RUN_OF)}")
    return metrics.select("name", later.alias("given"), "points", "value").unionByName(
        found.select("name", F.lit(None).cast("boolean").alias("given"), "points", "value")
    )


def run_metrics_partial(spark, sf_dir):
    """Metrics of a run in which configs only cover some hours: those of night hours are without any."""
    inputs = Inputs(spark, sf_dir)
    hours = inputs.hours()
    wanted = config_hours(inputs.configs, hours).where("hour(window_start) >= 6")
    return quality.run_metrics(wanted, inputs.samples(hours, landing=True), quality.hours_frame(spark, hours))


def sampling_windows(spark, sf_dir):
    """What runs at the time of each event cover."""
    sample, boost = sampling_window("ts"), boost_window("ts")
    names = ["sample_start", "sample_end", "boost_start", "boost_end"]
    bounds = [F.expr(sql).alias(name) for sql, name in zip((*sample, *boost), names)]
    return t.events(spark, sf_dir).select("event_id", *bounds)


def backfill_rejected_hours(spark, sf_dir):
    """Hours of a backfill with a damaged sample, or valued at a day with a rate of zero."""
    inputs = Inputs(spark, sf_dir)
    hours = inputs.hours()
    day = f"date'{(hours.first + 2 * DAY).date()}'"  # its rates value the day after
    zero = inputs.rates.withColumn("rate", F.expr(f"if(date = {day} and target = 'USD', 0d, rate)"))
    damaged = quality.rejected_hours(_damaged(inputs.samples()))
    return quality.hours_with_zero_rates(rates_for(zero, hours), hours).union(damaged).distinct()


def no_views_check(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    hours = inputs.hours()
    metrics = quality.run_metrics(config_hours(inputs.configs, hours), inputs.samples(hours))
    return quality.no_views_check(metrics, views.views_by_hour(inputs.page_views, CHANNELS, hours))


def _damaged(samples: DataFrame) -> DataFrame:
    """Samples with names missing at some hours."""
    hour = F.hour("window_start")
    return samples.withColumns(
        {
            "test_name": F.when(hour != 3, F.col("test_name")),
            "variant_name": F.when(hour % 5 != 0, F.col("variant_name")),
        }
    )


def sample_violations(spark, sf_dir):
    samples = _damaged(Inputs(spark, sf_dir).samples())
    return quality.violations(samples, quality.sample_rules())


def sample_rejected_hours(spark, sf_dir):
    return quality.rejected_hours(_damaged(Inputs(spark, sf_dir).samples()))


def boost_violations(spark, sf_dir):
    candidates = Inputs(spark, sf_dir).candidates()
    damaged = candidates.withColumn(
        "region", F.when(F.col("region") == "ROW", "XX").otherwise(F.col("region"))
    ).withColumn("url", F.when(F.hour("window_start") != 7, F.col("url")))
    return quality.violations(damaged, quality.boost_rules())


def _streamed(spark: SparkSession, rows: DataFrame) -> DataFrame:
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4()}"
    query = rollups.write_stream(rows, f"{folder}/rows", f"{folder}/state")
    try:
        query.awaitTermination()
    finally:
        query.stop()
    return spark.read.schema(rows.schema).parquet(f"{folder}/rows")


def stream_hourly_samples(spark, sf_dir):
    """Windows closed by the watermark: those still open at the end of the data are not emitted."""
    inputs, stream = Inputs(spark, sf_dir), t.event_stream(spark, sf_dir)
    rows = rollups.stream_samples(
        t.page_views(stream), t.acquisitions(stream), inputs.rates, inputs.prices, inputs.configs
    )
    return _streamed(spark, rows).select(
        *SAMPLE_KEY, "views", "acquisitions", *SAMPLE_VALUES
    )


def stream_article_windows(spark, sf_dir):
    inputs, stream = Inputs(spark, sf_dir), t.event_stream(spark, sf_dir)
    rows = rollups.stream_articles(
        t.page_views(stream), t.acquisitions(stream), inputs.rates, boost_prices(spark)
    )
    return _streamed(spark, rows)


def _ended(query) -> None:
    try:
        query.awaitTermination()
    finally:
        query.stop()


def stream_keyed_samples(spark, sf_dir):
    """Records of a stream's hours, the open ones too."""
    inputs, stream = Inputs(spark, sf_dir), t.event_stream(spark, sf_dir)
    folder = f"{shared_folder(spark)}/keyed-{uuid.uuid4()}"
    sums = keyed.stream_component_sums(t.page_views(stream), t.acquisitions(stream), inputs.rates, inputs.prices)
    _ended(keyed.write_samples(sums, inputs.configs, f"{folder}/sums", f"{folder}/samples", f"{folder}/state"))
    return _flat(read_samples(spark, f"{folder}/samples"))


def stream_boost_entries(spark, sf_dir):
    """Boost records of a stream's closed windows."""
    inputs, stream = Inputs(spark, sf_dir), t.event_stream(spark, sf_dir)
    folder = f"{shared_folder(spark)}/keyed-{uuid.uuid4()}"
    windows = rollups.stream_articles(
        t.page_views(stream), t.acquisitions(stream), inputs.rates, boost_prices(spark)
    )
    _ended(keyed.write_boosts(windows, f"{folder}/boosts", f"{folder}/state", MIN_VIEWS, MIN_VALUE))
    return read_boosts(spark, f"{folder}/boosts")


def stream_landing_hours(spark, sf_dir):
    """Landing-page views of every hour, from a stream's counts by day."""
    inputs, stream = Inputs(spark, sf_dir), t.event_stream(spark, sf_dir)
    folder = f"{shared_folder(spark)}/keyed-{uuid.uuid4()}"
    counts = keyed.stream_landing_counts(t.page_views(stream), t.LANDING_HOST)
    _ended(keyed.write_landing_counts(counts, f"{folder}/counts", f"{folder}/state"))
    return keyed.landing_hours(read_keyed(spark, f"{folder}/counts", keyed.LANDING_COUNTS), inputs.configs, inputs.hours())


QUERIES: dict[str, Query] = {
    "experiment_configs": experiment_configs,
    "sampled_test_documents": sampled_test_documents,
    "price_dimension": price_dimension_query,
    "price_matrix": price_matrix_query,
    "price_lookup": price_lookup,
    "catalog_violations": catalog_violations,
    "fx_reverse_rate": fx_reverse_rate,
    "fx_to_gbp": fx_to_gbp,
    "fx_sample_rates": fx_sample_rates,
    "component_views_hourly": component_views_hourly,
    "landing_views_daily": landing_views_daily,
    "total_component_views": total_component_views,
    "channel_views_hourly": channel_views_hourly,
    "acquisitions_unnested": acquisitions_unnested,
    "acquisitions_of_tests": acquisitions_of_tests,
    "acquisitions_priced": acquisitions_priced,
    "acquisitions_priced_fixed": acquisitions_priced_fixed,
    "acquisitions_av_gbp": acquisitions_av_gbp,
    "acquisitions_av_gbp_corrected": acquisitions_av_gbp_corrected,
    "acquisitions_capped": acquisitions_capped,
    "acquisition_totals": acquisition_totals,
    "acquisitions_unrated": acquisitions_unrated,
    "variant_samples_component": variant_samples_component,
    "variant_samples_landing": variant_samples_landing,
    "variant_samples": variant_samples_all,
    "backfill_windows": backfill_windows,
    "backfill_samples": backfill_samples,
    "sample_records_flat": sample_records_flat,
    "samples_latest": samples_latest,
    "region_of_country": region_of_country,
    "boost_views": boost_views,
    "boost_acquisitions": boost_acquisitions,
    "boost_candidates": boost_candidates,
    "boosts_latest": boosts_latest,
    "boost_active": boost_active,
    "boost_entries": boost_entries,
    "boost_records": boost_records,
    "boost_entries_sequential": boost_entries_sequential,
    "boost_candidates_default_gates": boost_candidates_default_gates,
    "samples_compacted": samples_compacted,
    "boosts_compacted": boosts_compacted,
    "run_metrics": run_metrics,
    "run_metrics_without_configs": run_metrics_without_configs,
    "sampling_windows": sampling_windows,
    "backfill_rejected_hours": backfill_rejected_hours,
    "no_views_check": no_views_check,
    "sample_violations": sample_violations,
    "sample_rejected_hours": sample_rejected_hours,
    "boost_violations": boost_violations,
    "stream_hourly_samples": stream_hourly_samples,
    "stream_article_windows": stream_article_windows,
    "stream_keyed_samples": stream_keyed_samples,
    "stream_boost_entries": stream_boost_entries,
    "stream_landing_hours": stream_landing_hours,
    "catalog_files": catalog_files,
    "run_outputs": run_outputs,
    "run_metrics_partial": run_metrics_partial,
}

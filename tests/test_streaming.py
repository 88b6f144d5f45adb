import pytest

from tests import frames
from tests.frames import acquisition, event, page_view
from valuelens import schemas
from valuelens.operators.prices import boost_prices, price_dimension
from valuelens.session import shared_folder
from valuelens.streaming.rollups import stream_articles, stream_samples, write_stream

RATES = [("2024-01-01", "GBP", 0.8), ("2024-01-01", "EUR", 1.0), ("2023-12-31", "EUR", 1.0)]


@pytest.fixture()
def site(spark, tmp_path):
    class Site:
        views, acquired = f"{tmp_path}/views", f"{tmp_path}/acquired"
        out, state = f"{tmp_path}/out", f"{tmp_path}/state"

        def add(self, views, acquired):
            one = lambda frame: frame.coalesce(1).write.mode("append")
            one(frames.page_views(spark, *views)).parquet(self.views)
            one(frames.acquisitions(spark, *acquired)).parquet(self.acquired)

        def run(self, build):
            """Processes what was added since the last run; returns all rows so far."""
            rows = build(
                spark.readStream.schema(schemas.PAGE_VIEWS).parquet(self.views),
                spark.readStream.schema(schemas.ACQUISITIONS).parquet(self.acquired),
            )
            write_stream(rows, self.out, self.state).awaitTermination()
            return frames.dicts(spark.read.schema(rows.schema).parquet(self.out), "window_start")

    return Site()


def view(time):
    return page_view("2024-01-02", [event(time)])


def test_hours_are_emitted_when_late_events_are_in(spark, site):
    def build(views, acquired):
        return stream_samples(
            views,
            acquired,
            frames.rates(spark, *RATES),
            price_dimension(frames.catalog(spark)),
            frames.configs(spark, ("Epic", "T"), ("SupportLandingPage", "L")),
        )

    site.add([view("2024-01-02T10:05:00")], [acquisition("2024-01-02T10:30:00", amount=50.0)])
    assert site.run(build) == []
    # In time: the watermark is at 08:45.
    site.add([view("2024-01-02T10:50:00")], [acquisition("2024-01-02T10:20:00", amount=500.0)])
    assert site.run(build) == []
    # Moves both clocks on, past 11:00 with the delay.
    site.add([view("2024-01-02T13:00:00")], [acquisition("2024-01-02T13:00:00")])
    [row] = site.run(build)
    assert (row["views"], row["acquisitions"], row["variant_name"]) == (2, 2, "control")
    assert row["sum_av_gbp"] == pytest.approx(50 * 0.8 + 250)
    assert str(row["window_start"]) == "2024-01-02 10:00:00"
    # Too late: the hour was emitted.
    site.add([view("2024-01-02T10:55:00")], [acquisition("2024-01-02T10:55:00")])
    assert len(site.run(build)) == 1


def test_the_slower_stream_sets_the_pace(spark, site):
    def build(views, acquired):
        return stream_articles(views, acquired, frames.rates(spark, *RATES), boost_prices(spark))

    first = acquisition("2024-01-02T10:30:00", amount=50.0)
    site.add([view("2024-01-02T10:05:00"), view("2024-01-02T23:00:00")], [first])
    assert site.run(build) == []
    site.add([view("2024-01-02T23:30:00")], [acquisition("2024-01-02T14:00:00", currency="JPY")])
    rows = site.run(build)
    # Windows from 08:00 and 09:00 have ended by 12:15.
    assert [str(row["window_start"])[11:13] for row in rows] == ["08", "09"]
    assert rows[0]["totalViews"] == 1 and rows[0]["totalAcquisitions"] == 1
    assert rows[0]["totalAv"] == pytest.approx(40) and rows[0]["region"] == "GB"


def test_shared_folder_is_the_one_of_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")

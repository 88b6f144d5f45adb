"""Hourly windows: which hours a run covers, and hour arithmetic in SQL. All times are UTC.

Functions that work on columns take SQL text (mostly a column's name) and return SQL text or a column.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuelens.schemas import BOOST_WINDOW_HOURS

HOUR = timedelta(hours=1)
DAY = timedelta(days=1)


def floor_hour(time: datetime) -> datetime:
    """The UTC hour a time falls in, without a zone."""
    if time.tzinfo is not None:
        time = time.astimezone(timezone.utc).replace(tzinfo=None)
    return time.replace(minute=0, second=0, microsecond=0)


@dataclass(frozen=True)
class Hours:
    """Windows that start at every full hour from ``first`` to ``last`` and are ``span`` hours long."""

    first: datetime
    last: datetime
    span: int = 1

    @classmethod
    def spanning(cls, events: DataFrame, column: str, span: int = 1) -> Hours | None:
        """The windows that hold at least part of the events; None if there are no events."""
        low, high = events.agg(F.min(column), F.max(column)).first()
        if low is None:
            return None
        return cls(floor_hour(low) - (span - 1) * HOUR, floor_hour(high), span)

    @property
    def single(self) -> bool:
        return self.first == self.last

    @property
    def end(self) -> datetime:
        return self.last + self.span * HOUR

    @property
    def received_dates(self) -> tuple[date, date]:
        """Partitions of page views any window reads: the day a window starts, and the day before."""
        return self.first.date() - DAY, self.last.date()

    @property
    def rates_dates(self) -> tuple[date, date]:
        """Exchange rates are those of the day before a window starts: the table lags by a day."""
        return self.first.date() - DAY, self.last.date() - DAY

    @property
    def event_dates(self) -> tuple[date, date]:
        return self.first.date(), (self.end - HOUR).date()

    def contains(self, time: str) -> str:
        return f"{time} >= {ntz(self.first)} and {time} < {ntz(self.end)}"

    def starts(self, window_start: str) -> str:
        return f"{window_start} between {ntz(self.first)} and {ntz(self.last)}"

    def each(self) -> str:
        """An array of all window starts, to explode."""
        return f"sequence({ntz(self.first)}, {ntz(self.last)}, interval 1 hour)"


def sampling_hours(as_of: datetime) -> Hours:
    """The hour before last, as events of the last hour may still arrive."""
    start = floor_hour(as_of) - 2 * HOUR
    return Hours(start, start)


def boost_hours(as_of: datetime, span: int = BOOST_WINDOW_HOURS) -> Hours:
    """The ``span`` hours that ended an hour ago."""
    start = floor_hour(as_of) - (1 + span) * HOUR
    return Hours(start, start, span)


def sampling_window(time: str) -> tuple[str, str]:
    """Start and end of the window that a sampling run at this time covers, as SQL."""
    return plus_hours(hour_of(time), -2), plus_hours(hour_of(time), -1)


def boost_window(time: str, span: int = BOOST_WINDOW_HOURS) -> tuple[str, str]:
    """Start and end of the window that a boost run at this time covers, as SQL."""
    return plus_hours(hour_of(time), -1 - span), plus_hours(hour_of(time), -1)


def backfill_hours(start: datetime, now: datetime) -> Hours | None:
    """Windows of the runs at start+1h, start+2h, ... as long as the run before was due before now."""
    runs = -((_utc(start) - floor_hour(now)) // HOUR)
    if runs <= 0:
        return None
    first = floor_hour(start) - HOUR
    return Hours(first, first + (runs - 1) * HOUR)


def boost_backfill_hours(start: datetime, now: datetime, span: int = BOOST_WINDOW_HOURS) -> Hours | None:
    """Windows of the boost runs at start+1h, start+2h, ... as long as the run before was due before now."""
    hours = backfill_hours(start, now)
    if hours is None:
        return None
    back = (span - 1) * HOUR
    return Hours(hours.first - back, hours.last - back, span)


def _utc(time: datetime) -> datetime:
    return time.astimezone(timezone.utc).replace(tzinfo=None) if time.tzinfo else time


def ntz(time: datetime) -> str:
    return f"timestamp_ntz'{time.isoformat(sep=' ')}'"


def days_between(column: str, days: tuple[date, date]) -> str:
    return f"{column} between date'{days[0].isoformat()}' and date'{days[1].isoformat()}'"


def plus_hours(time: str, hours: int | str) -> str:
    return f"({time} + make_dt_interval(0, {hours}))"


def hour_of(time: str) -> str:
    """Start of the hour, whatever the session's time zone."""
    return plus_hours(f"cast(to_date({time}) as timestamp_ntz)", f"hour({time})")


def window_starts(hour: str, span: int) -> str:
    """Starts of the windows of ``span`` hours that hold an hour, to explode."""
    return f"sequence({plus_hours(hour, 1 - span)}, {hour}, interval 1 hour)"


def received_for(window_start: str, received_date: str = "received_date") -> str:
    """Only page views received on the day a window starts, or the day before, count for it."""
    start_date = f"to_date({window_start})"
    return f"{received_date} between date_sub({start_date}, 1) and {start_date}"


def rates_date(window_start: str) -> str:
    return f"date_sub(to_date({window_start}), 1)"


def sample_time_text(time: str) -> str:
    return f"concat(date_format({time}, 'yyyy-MM-dd HH:mm:ss.SSS'), 'Z')"


def boost_time_text(time: str) -> str:
    return f"date_format({time}, 'yyyy-MM-dd HH:00:00.000')"


def boost_date_text(time: str) -> str:
    return f"date_format({time}, 'yyyy-MM-dd')"

"""Small tables that fact tables are joined with."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ROWS = 200_000
MAX_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class Lookup:
    """A table to join facts with, broadcast only if it was measured to be small.

    Beyond the limits the join is left to Spark: it shuffles, and adaptive execution splits the
    partitions of hot keys.
    """

    frame: DataFrame
    small: bool

    @classmethod
    def of(
        cls, frame: DataFrame | Lookup, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES
    ) -> Lookup:
        return cls.all(frame, max_rows=max_rows, max_bytes=max_bytes)[0]

    @classmethod
    def all(
        cls, *frames: DataFrame | Lookup, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES
    ) -> list[Lookup]:
        """Lookups of several tables, measured in one job."""
        # The limit keeps the measurement itself small, however large a table is.
        measured = [
            frame.limit(max_rows + 1).selectExpr(
                f"{i} as i",
                "count(*) as n",
                "coalesce(sum(octet_length(to_json(struct(*)))), 0) as size",
            )
            for i, frame in enumerate(frames)
            if isinstance(frame, DataFrame)
        ]
        sizes = reduce(DataFrame.unionAll, measured).collect() if measured else []
        small = {row.i: row.n <= max_rows and row.size <= max_bytes for row in sizes}
        return [
            cls(frame, small[i]) if i in small else frame for i, frame in enumerate(frames)
        ]

    @property
    def side(self) -> DataFrame:
        return F.broadcast(self.frame) if self.small else self.frame

    def selectExpr(self, *columns: str) -> Lookup:
        return Lookup(self.frame.selectExpr(*columns), self.small)

    def where(self, condition: str) -> Lookup:
        return Lookup(self.frame.where(condition), self.small)

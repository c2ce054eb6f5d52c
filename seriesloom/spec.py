"""Names of the columns that make a DataFrame a panel of time series."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SeriesSpec:
    """Key, time and measure columns of a panel.

    ``history`` columns are added to the window partition. With ``("split",)``
    the history of a row starts afresh in every split (no value crosses from
    train to test); with ``()`` history is continuous.
    """

    keys: tuple[str, ...] = ("series",)
    time: str = "date"
    target: str = "dispatched"
    order: str = "ordered"
    history: tuple[str, ...] = ()

    @property
    def partition(self) -> tuple[str, ...]:
        return self.keys + self.history

    def window(self) -> WindowSpec:
        """Rows of one series (and split) in time order."""
        return Window.partitionBy(*self.partition).orderBy(self.time)

    def frame(self, start: int, end: int) -> WindowSpec:
        """``window()`` restricted to rows ``start`` .. ``end`` around the current row."""
        return self.window().rowsBetween(start, end)

    def whole(self) -> WindowSpec:
        """All rows of one series (and split), unordered."""
        return Window.partitionBy(*self.partition)

    def t(self) -> Column:
        return F.col(self.time)

    def with_history(self, *columns: str) -> "SeriesSpec":
        return SeriesSpec(self.keys, self.time, self.target, self.order, tuple(columns))

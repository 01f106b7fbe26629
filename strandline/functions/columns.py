"""Column expressions over an ordered series, and over a feature vector.

Everything here is a built-in Spark expression, so it stays inside the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType


@dataclass(frozen=True)
class Series:
    """How rows form a series.

    Windows restart at every calendar ``period`` (in the session time zone) and
    for every value of ``entity_cols``. A rolling frame is the current row and
    the ``preceding`` rows before it: rows are counted, not time, so gaps in
    the series are not seen.

    ``order_col`` must be unique within an entity; otherwise the order of rows
    sharing a value is open.
    """

    order_col: str = "time_tag"
    period: str = "month"
    entity_cols: tuple[str, ...] = ()
    preceding: int = 5

    def period_start(self) -> Column:
        return F.date_trunc(self.period, F.col(self.order_col))

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.entity_cols, self.period_start()).orderBy(self.order_col)

    def frame(self, window: WindowSpec) -> WindowSpec:
        return window.rowsBetween(-self.preceding, Window.currentRow)


def micros(df: DataFrame, col: str) -> Column:
    """Microseconds since 1970 of a timestamp column.

    For a timestamp without a zone, those of its wall clock, in whole seconds.
    A cast through the session's zone would not do: it does not keep the order
    across the hour a change to summer time leaves out.
    """
    at = F.col(col)
    if not isinstance(df.schema[col].dataType, TimestampNTZType):
        return F.unix_micros(at)
    days, hours = F.unix_date(at.cast("date")).cast("long"), F.hour(at)
    return (((days * 24 + hours) * 60 + F.minute(at)) * 60 + F.second(at)) * 1_000_000


def rolling_mean(col: str, frame: WindowSpec) -> Column:
    """Mean over the frame; the value itself where the frame has no value."""
    return F.coalesce(F.avg(col).over(frame), F.col(col))


def rolling_std(col: str, frame: WindowSpec) -> Column:
    """Sample standard deviation over the frame; 0.0 for fewer than two values."""
    return F.coalesce(F.stddev_samp(col).over(frame), F.lit(0.0))


def previous(col: str, window: WindowSpec) -> Column:
    """Value of the row before, NULL on the first row.

    Select it under a name first and derive :func:`lag_value` and :func:`delta`
    from that name: Spark would evaluate two equal ``lag`` calls twice.
    """
    return F.lag(col, 1).over(window)


def lag_value(col: str, previous_col: str) -> Column:
    """Value of the row before; the row's own value where there is none."""
    return F.coalesce(F.col(previous_col), F.col(col))


def delta(col: str, previous_col: str) -> Column:
    """Change from the row before; 0.0 where there is none."""
    return F.coalesce(F.col(col) - F.col(previous_col), F.lit(0.0))


def zscore(col: str, mean: float, std: float) -> Column:
    """(x - mean) / std, and 0.0 for a column without spread."""
    if std == 0.0:
        return F.when(F.col(col).isNotNull(), F.lit(0.0))
    return (F.col(col) - F.lit(mean)) / F.lit(std)


def squared_distance(cols: Sequence[str], center: Sequence[float]) -> Column:
    """Squared Euclidean distance of a row from a fixed point."""
    if len(cols) != len(center):
        raise ValueError(f"{len(cols)} columns for a point of {len(center)} coordinates")
    total = F.lit(0.0)
    for col, coordinate in zip(cols, center):
        difference = F.col(col) - F.lit(float(coordinate))
        total = total + difference * difference
    return total


def nearest_center(cols: Sequence[str], centers: Sequence[Sequence[float]]) -> Column:
    """Index of the closest centre, the lowest index on a tie."""
    ranked = [
        F.struct(squared_distance(cols, center).alias("distance"), F.lit(i).alias("index"))
        for i, center in enumerate(centers)
    ]
    if len(ranked) == 1:
        return ranked[0]["index"]
    return F.least(*ranked)["index"]

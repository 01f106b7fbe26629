"""The feature table of a series: raw values, rolling figures, lags, changes.

Windows restart each month, so one task per month is the most a plain window
plan can use. :func:`cut_points` finds where to cut months that hold more rows
than a task should, and :func:`build` then works chunk by chunk with the same
result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from strandline.functions.columns import (
    Series,
    delta,
    lag_value,
    micros,
    previous,
    rolling_mean,
    rolling_std,
)
from strandline.sources.schemas import MEASURES

# Feature names, the measure behind each, and their order in the
# feature vector.
ROLLING_MEANS = {
    "rolling_5p_wind_speed": "solar_wind_speed",
    "rolling_mag_mean": "magnetic_field_total",
    "rolling_density_mean": "proton_density",
    "rolling_temp_mean": "plasma_temperature",
    "rolling_bz_mean": "magnetic_field_bz",
}
ROLLING_STDS = {
    "rolling_std_mag_field": "magnetic_field_total",
    "rolling_std_wind_speed": "solar_wind_speed",
}
LAGS = {"wind_lag_1": "solar_wind_speed", "bz_lag_1": "magnetic_field_bz"}
DELTAS = {"wind_delta": "solar_wind_speed", "bz_delta": "magnetic_field_bz"}
FEATURE_COLS = (*MEASURES, *ROLLING_MEANS, *ROLLING_STDS, *LAGS, *DELTAS)

SERIES = Series()

# About 150 MB of rows. A task takes several chunks, which evens out the hashing.
ROWS_PER_CHUNK = 2_500_000
CHUNKS_PER_TASK = 4

FIRST = -(1 << 62)  # the chunk before any cut of an entity
MICROS_PER_DAY = 86_400_000_000
DAYS = {"week": 7, "month": 31, "quarter": 92, "year": 366}  # the most a period has


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows with a NULL or NaN in any column; Infinity stays."""
    return df.na.drop("any")


def build(
    df: DataFrame, series: Series = SERIES, cuts: Sequence[int] | Sequence[tuple] = ()
) -> DataFrame:
    """Entity columns, order column and the 16 features; incomplete rows dropped."""
    return drop_incomplete(compute(df, series, cuts))


def compute(
    df: DataFrame, series: Series = SERIES, cuts: Sequence[int] | Sequence[tuple] = ()
) -> DataFrame:
    """The same table with incomplete rows still in it.

    Rows without an instant are left out: they belong to no month.
    Select some of the columns and Spark computes only those.

    ``cuts`` come from :func:`cut_points`, for a series with entities as tuples of
    entity and instant. They change how the work is divided and never the result,
    so take them from stored rows, such as what ``df`` was computed from, or an
    earlier or larger state of the table. Without them no month is divided; no job
    runs here to find out.

    Without cuts: one shuffle by month, one sort, one window operator. With
    cuts the shuffle is by (month, chunk). All rows but the first few of a
    chunk have their whole frame inside the chunk. The first few are computed
    again from the edges of all chunks: both ends of every chunk, put back in
    order, hold a full frame for each row that starts a chunk. The edges are a
    handful of rows per chunk, and both branches read the same shuffle.

    Windows restart each month, so to recompute some months give ``df`` filtered
    to those whole months on the order column: the scan then skips the others.
    """
    # Rows without an instant would all meet in one window partition.
    rows = df.select(*series.entity_cols, series.order_col, *MEASURES).filter(
        F.col(series.order_col).isNotNull()
    )
    if not cuts:
        return _features(rows, series, series.window())

    reach = max(series.preceding, 1)
    # Both branches name the period and the chunk alike, or Spark would not see
    # that they want the same shuffle.
    in_months = rows.withColumn("_period", series.period_start())
    if series.entity_cols and isinstance(cuts[0], tuple):
        chunked, divided = _with_own_chunk(in_months, series, cuts), F.col("_divided")
        begins = F.col("_chunk") == FIRST  # nothing comes before it in its month
    else:
        chunked, divided, begins = _with_chunk(in_months, series, cuts), F.lit(True), F.lit(False)
    tasks = math.ceil((len(cuts) + 1) / CHUNKS_PER_TASK)
    if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        # The chunks tell the size of the table; the session's number may not fit it.
        chunked = chunked.repartition(tasks, *series.entity_cols, "_period", "_chunk")
    in_period = Window.partitionBy(*series.entity_cols, "_period").orderBy(series.order_col)
    in_chunk = Window.partitionBy(*series.entity_cols, "_period", "_chunk").orderBy(
        series.order_col
    )
    place = F.row_number().over(in_chunk).alias("_place")

    # (Both branches read the same columns, or they would not share the shuffle.)
    inner = _features(
        chunked, series, in_chunk, place, (begins | ~divided).alias("_begins")
    ).filter((F.col("_place") > reach) | F.col("_begins"))

    # An instant `reach` rows further on is missing only in a chunk's last rows.
    ahead = F.lead(series.order_col, reach).over(in_chunk).alias("_ahead")
    edges = chunked.select("*", place, ahead, begins.alias("_begins")).filter(
        divided
        & ((~F.col("_begins") & (F.col("_place") <= reach)) | F.col("_ahead").isNull())
    )
    heads = _features(
        edges, series, in_period, F.col("_place"), F.col("_begins")
    ).filter(~F.col("_begins") & (F.col("_place") <= reach))
    return inner.drop("_place", "_begins").unionByName(heads.drop("_place", "_begins"))


def _features(
    rows: DataFrame, series: Series, window: WindowSpec, *more: Column
) -> DataFrame:
    """All window expressions in one select, hence one window operator."""
    frame = series.frame(window)
    lagged = sorted({*LAGS.values(), *DELTAS.values()})
    given = [*series.entity_cols, series.order_col, *MEASURES]
    names = [*given, *ROLLING_MEANS, *ROLLING_STDS]
    windowed = rows.select(
        *given,
        *[rolling_mean(c, frame).alias(name) for name, c in ROLLING_MEANS.items()],
        *[rolling_std(c, frame).alias(name) for name, c in ROLLING_STDS.items()],
        *[previous(c, window).alias(f"_previous_{c}") for c in lagged],
        *more,
    )
    return windowed.select(
        *names,
        *[lag_value(c, f"_previous_{c}").alias(name) for name, c in LAGS.items()],
        *[delta(c, f"_previous_{c}").alias(name) for name, c in DELTAS.items()],
        *windowed.columns[len(names) + len(lagged) :],
    )


def cut_points(
    df: DataFrame,
    order_col: str = SERIES.order_col,
    rows_per_chunk: int = ROWS_PER_CHUNK,
    period: str = SERIES.period,
    slot_seconds: int = 60,
    entity_cols: Sequence[str] = (),
) -> list[int] | list[tuple]:
    """Instants (microseconds since 1970) that cut each month into even chunks; with
    ``entity_cols``, tuples of an entity and an instant that cuts its month.

    Reads the order column and the entities. Only months of more than
    ``rows_per_chunk`` rows (of one entity) are looked at closer: their rows are
    counted per minute before the shuffle, and the running count of a month spans at
    most 44,640 minutes. Only the cuts reach the driver: no more than the table's
    rows / ``rows_per_chunk``. A chunk exceeds ``rows_per_chunk`` by its last minute
    at most, which holds 60 million rows of one series at the very most; where that
    is too much for a task, count in slots of one second.
    """
    at, width = micros(df, order_col), slot_seconds * 1_000_000
    timed = df.filter(F.col(order_col).isNotNull()).select(
        *entity_cols,
        F.date_trunc(period, F.col(order_col)).alias("_period"),
        (at - F.pmod(at, F.lit(width))).alias("_slot"),
    )
    group = [*entity_cols, "_period"]
    if entity_cols:
        large = timed.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).filter(
            F.col("_n") > rows_per_chunk
        )
        large = large.select(*[F.col(c).alias(f"_large_{c}") for c in group])
        timed = timed.join(
            large, F.expr(" AND ".join(f"`{c}` <=> `_large_{c}`" for c in group)), "left_semi"
        )
    counts = timed.groupBy(*group, "_slot").agg(F.count(F.lit(1)).alias("_n"))
    in_period = Window.partitionBy(*group).orderBy("_slot")
    before = F.sum("_n").over(in_period.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
    chunks = counts.select(*group, "_slot", F.floor(before / rows_per_chunk).alias("_chunk"))
    starts = chunks.select(
        *entity_cols, "_slot", (F.col("_chunk") != F.lag("_chunk").over(in_period)).alias("_starts")
    ).filter("_starts")
    found = [tuple(row)[:-1] for row in starts.collect()]
    return found if entity_cols else sorted(slot for (slot,) in found)


def _with_chunk(rows: DataFrame, series: Series, cuts: Sequence[int]) -> DataFrame:
    """Number of the chunk a row falls in, by binary search among the cuts."""
    bounds = [float("-inf"), *[float(c) for c in sorted(set(cuts))], float("inf")]
    search = Bucketizer(splits=bounds, inputCol="_at", outputCol="_bucket")
    at = micros(rows, series.order_col).cast("double")
    found = search.transform(rows.withColumn("_at", at))
    # The cast also leaves behind the column metadata, one label per bucket.
    return found.withColumn("_chunk", F.col("_bucket").cast("int")).drop("_at", "_bucket")


def _with_own_chunk(rows: DataFrame, series: Series, cuts: Sequence[tuple]) -> DataFrame:
    """Each row's last cut of its own entity (FIRST before any), and whether the entity
    has cuts around that time at all.

    The cuts are dealt out by entity and day, each day also holding the last cut before
    it, so that a row meets the few cuts of its day by an equi-join. Entities without
    cuts meet nothing.
    """
    names = list(series.entity_cols)
    fields = [rows.schema[c] for c in names]
    schema = StructType([*fields, StructField("_cut", LongType())])
    span = DAYS[series.period]
    day = F.floor(F.col("_cut") / MICROS_PER_DAY)
    own = [F.col(c).alias(f"_own_{c}") for c in names]
    by_day = (
        rows.sparkSession.createDataFrame(list(cuts), schema)
        .select(*own, "_cut", F.explode(F.sequence(day - span, day + span)).alias("_own_day"))
        .groupBy(*[f"_own_{c}" for c in names], "_own_day")
        .agg(
            F.max(F.when(F.col("_cut") < F.col("_own_day") * MICROS_PER_DAY, F.col("_cut"))).alias(
                "_before"
            ),
            F.collect_list(
                F.when(F.floor(F.col("_cut") / MICROS_PER_DAY) == F.col("_own_day"), F.col("_cut"))
            ).alias("_inside"),
        )
    )
    at = micros(rows, series.order_col)
    same = " AND ".join(f"`{c}` <=> `_own_{c}`" for c in names)
    passed = F.array_max(F.filter("_inside", lambda c: c <= F.col("_at")))
    return (
        rows.withColumn("_at", at)
        .withColumn("_day", F.floor(F.col("_at") / MICROS_PER_DAY))
        .join(by_day, F.expr(f"{same} AND _day = _own_day"), "left")
        .withColumn("_divided", F.col("_own_day").isNotNull())
        .withColumn("_chunk", F.coalesce(passed, F.col("_before"), F.lit(FIRST)))
        .select(*rows.columns, "_divided", "_chunk")
    )

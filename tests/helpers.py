"""Small inputs."""

from __future__ import annotations

from datetime import datetime, timedelta

from strandline.sources.schemas import TELEMETRY

NAN, INF = float("nan"), float("inf")
START = datetime(2024, 1, 31, 23, 50)


def readings(spark, rows):
    """Rows of (instant, the five measures)."""
    return spark.createDataFrame(rows, TELEMETRY)


def speeds(spark, values, start=START):
    """One reading a minute with the given speeds; other measures constant."""
    return readings(
        spark,
        [(start + timedelta(minutes=i), v, 5.0, 6.0, -1.0, 1e4) for i, v in enumerate(values)],
    )


def rows(df, *cols):
    """Sorted tuples, NaN made comparable."""
    picked = df.select(*cols) if cols else df
    return sorted(
        tuple("NaN" if isinstance(v, float) and v != v else v for v in r)
        for r in picked.collect()
    )

"""Counts and sums known for the driver's smallest tables."""

import pytest
from pyspark.sql import functions as F

from checks import queries as q
from strandline import features, gate
from strandline.sources.schemas import KEY

SF_DIR = "/root/testdata/sf0.001"


def test_gate(spark):
    failed = gate.quarantine(q.telemetry(spark, SF_DIR)).groupBy("quarantine_reason").count()
    counts = {r["quarantine_reason"]: r["count"] for r in failed.collect()}
    assert [counts[rule.reason] for rule in gate.RULES] == [10, 10, 12, 12, 13, 14, 11]
    assert q.gate_valid(spark, SF_DIR).count() == 918


@pytest.mark.parametrize("rows_per_chunk", [25, 10**9])
def test_sums_per_month(spark, rows_per_chunk):
    cuts = q.cuts(spark, SF_DIR, rows_per_chunk)
    built = features.build(q.silver(spark, SF_DIR), cuts=cuts)
    sums = built.groupBy(F.date_format(KEY, "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)),
        F.round(F.sum("rolling_5p_wind_speed"), 6),
        F.round(F.sum("rolling_std_wind_speed"), 6),
        F.round(F.sum("wind_delta"), 6),
    )
    assert sorted(tuple(r) for r in sums.collect()) == [
        ("2024-01", 506, 177156.717333, 21500.796624, -98.57),
        ("2024-02", 402, 141435.857667, 18518.74381, -17.66),
    ]


@pytest.mark.parametrize(
    "name", ["feature_table", "rolling_mean", "month_boundary", "feature_table_nan"]
)
def test_large_months_are_cut_in_the_queries(spark, monkeypatch, name):
    """A month above the size that production cuts at is divided, with the same rows."""
    query = getattr(q, name)
    whole = sorted(map(tuple, query(spark, SF_DIR).collect()))
    monkeypatch.setattr(features, "ROWS_PER_CHUNK", 200)
    divided = query(spark, SF_DIR)
    assert "_chunk" in divided._jdf.queryExecution().toString()
    assert sorted(map(tuple, divided.collect())) == whole

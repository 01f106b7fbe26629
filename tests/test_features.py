import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strandline import columns, features
from strandline.sources.schemas import KEY, MEASURES
from tests.helpers import NAN, readings, rows, speeds

JAN = datetime(2024, 1, 31, 23, 53)
FEB = datetime(2024, 2, 1)


def cuts_of(df, rows_per_chunk):
    return [] if rows_per_chunk is None else features.cut_points(df, rows_per_chunk=rows_per_chunk)


def by_time(df):
    return {r[KEY]: r for r in df.collect()}


def test_month_by_hand(spark):
    seven = speeds(spark, [10.0, 20.0, 30.0, 40.0, 50.0, 60.0, 70.0], JAN)
    got = by_time(features.build(seven.unionByName(speeds(spark, [100.0], FEB))))

    def row(at):
        r = got[at]
        return tuple(
            round(r[c], 6)
            for c in ("rolling_5p_wind_speed", "rolling_std_wind_speed", "wind_lag_1", "wind_delta")
        )

    assert row(JAN) == (10.0, 0.0, 10.0, 0.0)
    assert row(JAN + timedelta(minutes=1)) == (15.0, 7.071068, 10.0, 10.0)
    assert row(JAN + timedelta(minutes=5)) == (35.0, 18.708287, 50.0, 10.0)
    assert row(JAN + timedelta(minutes=6)) == (45.0, 18.708287, 60.0, 10.0)
    assert row(FEB) == (100.0, 0.0, 100.0, 0.0)


def test_columns_in_order(spark):
    built = features.build(speeds(spark, [1.0]))
    assert built.columns == [KEY, *features.FEATURE_COLS]
    assert len(features.FEATURE_COLS) == 16


@pytest.mark.parametrize("rows_per_chunk", [None, 2])
def test_nan_spoils_the_frames_that_hold_it(spark, rows_per_chunk):
    data = speeds(spark, [NAN, 20.0, 30.0, 40.0, 50.0, 60.0, 70.0], JAN)
    cuts = cuts_of(data, rows_per_chunk)
    kept = rows(features.build(data, cuts=cuts), KEY)
    assert kept == [(JAN + timedelta(minutes=6),)]


def test_rows_without_an_instant_leave(spark):
    data = readings(spark, [(None, 1.0, 1.0, 1.0, 1.0, 1.0), (FEB, 1.0, 1.0, 1.0, 1.0, 1.0)])
    assert features.build(data).count() == 1


def test_drop_incomplete(spark):
    data = spark.createDataFrame(
        [(1.0, 1.0), (None, 1.0), (NAN, 1.0), (float("inf"), 1.0)], "a double, b double"
    )
    assert rows(features.drop_incomplete(data), "a") == [(1.0,), (float("inf"),)]


def brute_force(data, preceding=5):
    """The features of one series, straight from their definition."""
    out = {}
    months = {}
    for r in sorted(data):
        months.setdefault((r[0].year, r[0].month), []).append(r)
    for month in months.values():
        for i, r in enumerate(month):
            frame = month[max(0, i - preceding) : i + 1]
            value = dict(zip(MEASURES, r[1:]))
            cols = {m: [f[1 + j] for f in frame] for j, m in enumerate(MEASURES)}
            before = dict(zip(MEASURES, month[i - 1][1:])) if i else value

            def std(xs):
                mean = sum(xs) / len(xs)
                return (sum((x - mean) ** 2 for x in xs) / (len(xs) - 1)) ** 0.5 if xs[1:] else 0.0

            out[r[0]] = (
                [value[m] for m in MEASURES]
                + [sum(cols[c]) / len(cols[c]) for c in features.ROLLING_MEANS.values()]
                + [std(cols[c]) for c in features.ROLLING_STDS.values()]
                + [before[c] for c in features.LAGS.values()]
                + [value[c] - before[c] for c in features.DELTAS.values()]
            )
    return out


def some_series(n, seed):
    rng = random.Random(seed)
    at, out = datetime(2024, 1, 30), []
    for _ in range(n):
        at += timedelta(seconds=rng.choice([1, 7, 60, 600, 40_000]))
        out.append((at, *[round(rng.uniform(0, 500), 2) for _ in MEASURES]))
    return out


@pytest.mark.parametrize("rows_per_chunk", [None, 1, 3, 6, 10, 37, 1000])
def test_against_brute_force(spark, rows_per_chunk):
    data = some_series(240, seed=3)
    df = readings(spark, data)
    cuts = cuts_of(df, rows_per_chunk)
    got = by_time(features.build(df, cuts=cuts))
    expected = brute_force(data)
    assert got.keys() == expected.keys()
    for at, values in expected.items():
        assert [got[at][c] for c in features.FEATURE_COLS] == pytest.approx(values, abs=1e-9)


@settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    n=st.integers(1, 60),
    seed=st.integers(0, 10**6),
    offsets=st.lists(st.integers(0, 3 * 86_400), max_size=12),
)
def test_any_cuts_give_the_same_table(spark, n, seed, offsets):
    data = some_series(n, seed)
    df = readings(spark, data)
    cuts = [1706572800_000000 + s * 1_000_000 for s in offsets]
    plain, cut = (
        rows(features.build(df, cuts=c).select(
            KEY, *[F.round(c2, 9).alias(c2) for c2 in features.FEATURE_COLS]
        ))
        for c in ((), cuts)
    )
    assert plain == cut


def test_entities_do_not_mix(spark):
    a, b = some_series(40, 1), some_series(40, 2)
    both = readings(spark, a).withColumn("sensor", F.lit("a")).unionByName(
        readings(spark, b).withColumn("sensor", F.lit("b"))
    )
    series = columns.Series(entity_cols=("sensor",))
    cuts = features.cut_points(both, rows_per_chunk=9)
    for c in ((), cuts):
        built = features.build(both, series, c)
        for name, data in (("a", a), ("b", b)):
            got = by_time(built.filter(F.col("sensor") == name))
            expected = brute_force(data)
            assert got.keys() == expected.keys()
            for at, values in expected.items():
                assert [got[at][x] for x in features.FEATURE_COLS] == pytest.approx(
                    values, abs=1e-9
                )


def sensors(spark, sizes, seed=7):
    """Series of the given lengths, one per sensor."""
    parts = {f"s{i}": some_series(n, seed + i) for i, n in enumerate(sizes)}
    frame = None
    for name, data in parts.items():
        one = readings(spark, data).withColumn("sensor", F.lit(name).cast("string"))
        frame = one if frame is None else frame.unionByName(one)
    return parts, frame


@pytest.mark.parametrize("rows_per_chunk", [7, 40])
def test_cuts_of_a_large_entity_among_small_ones(spark, rows_per_chunk, tmp_path):
    parts, frame = sensors(spark, [160, 30, 3, 1, 90])
    frame.write.parquet(str(tmp_path / "sensors"))
    frame = spark.read.parquet(str(tmp_path / "sensors"))
    series = columns.Series(entity_cols=("sensor",))
    cuts = features.cut_points(frame, rows_per_chunk=rows_per_chunk, entity_cols=["sensor"])
    sizes = {
        r["sensor"]: r["n"]
        for r in frame.groupBy("sensor", F.date_trunc("month", KEY)).agg(F.count("*").alias("n"))
        .groupBy("sensor").agg(F.max("n").alias("n")).collect()
    }
    assert {s for s, _ in cuts} == {s for s, n in sizes.items() if n > rows_per_chunk}
    built = features.build(frame, series, cuts)
    for name, data in parts.items():
        got = by_time(built.filter(F.col("sensor").eqNullSafe(name)))
        expected = brute_force(data)
        assert got.keys() == expected.keys()
        for at, values in expected.items():
            assert [got[at][x] for x in features.FEATURE_COLS] == pytest.approx(values, abs=1e-9)
    built.collect()
    final = plan_of(built).split("== Initial Plan ==")[0]
    assert count(final, "ReusedExchange") >= 1 and count(final, "FileScan parquet") == 1
    divided = features._with_own_chunk(
        frame.withColumn("_period", series.period_start()), series, cuts
    )
    assert divided.filter("sensor = 's2'").filter("_divided").isEmpty()
    per = divided.groupBy("sensor", "_period", "_chunk").count().agg(F.max("count")).first()[0]
    assert per <= rows_per_chunk + 5  # and what its last minute holds


def test_small_entities_are_not_cut(spark):
    many = spark.range(20_000).select(
        (F.col("id") % 500).alias("sensor"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 60).alias(KEY),
    )
    assert features.cut_points(many, rows_per_chunk=100, entity_cols=["sensor"]) == []
    hot = many.withColumn("sensor", F.when(F.col("sensor") < 250, -1).otherwise(F.col("sensor")))
    cuts = features.cut_points(hot, rows_per_chunk=1000, entity_cols=["sensor"])
    assert {c[0] for c in cuts} == {-1} and len(cuts) == 9


def test_micros(spark):
    at = spark.createDataFrame([("1969-12-31 23:59:59.5",), ("2024-02-29 13:14:15",)], "s string")
    both = at.select(F.col("s").cast("timestamp").alias("z"), F.col("s").cast("timestamp_ntz"))
    got = both.select(columns.micros(both, "z"), columns.micros(both, "s")).collect()
    assert [tuple(r) for r in got] == [
        (-500_000, -1_000_000), (1709212455_000000, 1709212455_000000),
    ]


@pytest.mark.parametrize("rows_per_chunk", [3, 10])
def test_wall_clock_over_a_left_out_hour(spark, rows_per_chunk):
    """Instants that do not exist in the session's zone keep their order."""
    at = datetime(2024, 3, 10, 0, 0)
    data = [(at + timedelta(minutes=7 * i), float(i % 9), 1.0, float(i % 4), 2.0, 3.0)
            for i in range(60)]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame(
            data, "time_tag timestamp_ntz, " + ", ".join(f"{m} double" for m in MEASURES)
        )
        cuts = features.cut_points(df, rows_per_chunk=rows_per_chunk)
        got = by_time(features.build(df, cuts=cuts))
        expected = brute_force(data)
        assert cuts and got.keys() == expected.keys()
        for when, values in expected.items():
            assert [got[when][c] for c in features.FEATURE_COLS] == pytest.approx(values)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("slot_seconds", [60, 1])
def test_cut_points_even_out_a_hot_month(spark, slot_seconds):
    hot = spark.range(30_000).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 5).alias(KEY)
    )
    cold = spark.range(60).select(
        F.timestamp_seconds(F.lit(1709251200) + F.col("id") * 86_400).alias(KEY)
    )
    df = hot.unionByName(cold)
    cuts = features.cut_points(df, rows_per_chunk=1000, slot_seconds=slot_seconds)
    assert len(cuts) == 29
    with_chunk = features._with_chunk(df, columns.Series(), cuts)
    sizes = [r["count"] for r in
             with_chunk.groupBy(F.date_trunc("month", KEY), "_chunk").count().collect()]
    assert sum(sizes) == 30_060
    assert max(sizes) <= 1000 + 12


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored(spark, tmp_path):
    path = str(tmp_path / "series")
    readings(spark, some_series(200, 5)).write.parquet(path)
    return spark.read.parquet(path)


def count(plan, text):
    return sum(text in line for line in plan.splitlines())


def test_plain_plan_is_one_shuffle_and_one_window(spark, tmp_path):
    plan = plan_of(features.build(stored(spark, tmp_path), cuts=()))
    assert count(plan, "+- Window [") == 1
    assert count(plan, "Exchange hashpartitioning") == 1
    assert count(plan, "lag(solar_wind_speed") == 1
    assert "Python" not in plan


def test_chunked_branches_share_the_shuffle(spark, tmp_path):
    data = stored(spark, tmp_path)
    built = features.build(data, cuts=features.cut_points(data, rows_per_chunk=20))
    built.collect()
    final = plan_of(built).split("== Initial Plan ==")[0]
    assert count(final, "ReusedExchange") == 1
    assert count(final, "FileScan parquet") == 1
    assert "Python" not in final


def test_no_job_looks_for_cuts(spark, tmp_path, monkeypatch):
    data = stored(spark, tmp_path)
    monkeypatch.setattr(features, "cut_points", lambda *a, **k: pytest.fail("asked for cuts"))
    assert count(plan_of(features.build(data)), "FileScan parquet") == 1


def test_many_chunks_get_tasks_of_their_own(spark, tmp_path):
    data = stored(spark, tmp_path)
    cuts = features.cut_points(data, rows_per_chunk=2)
    built = features.build(data, cuts=cuts)
    tasks = -(-(len(cuts) + 1) // features.CHUNKS_PER_TASK)
    assert tasks > 8
    built.collect()
    final = plan_of(built).split("== Initial Plan ==")[0]
    assert "hashpartitioning(_period" in final and f", {tasks})" in final
    assert count(final, "ReusedExchange") == 1


def test_unused_features_are_not_computed(spark, tmp_path):
    plan = plan_of(features.compute(stored(spark, tmp_path)).select(KEY, "wind_lag_1"))
    assert "avg(" not in plan
    assert "proton_density" not in plan


def test_whole_months_may_be_filtered_first(spark, tmp_path):
    """The way to recompute a few months: the scan skips the others."""
    data = stored(spark, tmp_path)
    months = (F.col(KEY) >= datetime(2024, 2, 1)) & (F.col(KEY) < datetime(2024, 3, 1))
    before, after = features.build(data.filter(months)), features.build(data).filter(months)
    assert rows(before) == rows(after) != []
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    assert "GreaterThanOrEqual(time_tag,2024-02-01" in plan_of(data.filter(months))

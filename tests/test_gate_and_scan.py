from datetime import datetime, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strandline import features, gate, scan
from strandline.sources.schemas import KEY, MEASURES, TELEMETRY
from tests.helpers import INF, NAN, readings

T = datetime(2024, 1, 31, 23, 58)
GOOD = (T, 400.0, 5.0, 6.0, -1.0, 1e4)


def row(**changes):
    values = dict(zip(TELEMETRY.names, GOOD)) | changes
    return tuple(values[n] for n in TELEMETRY.names)


@pytest.mark.parametrize(
    "changes, reason",
    [
        ({"time_tag": None}, "Missing Primary Key (time_tag)"),
        ({"solar_wind_speed": None}, "Null Solar Wind Speed Measurement"),
        ({"proton_density": None}, "Null Proton Density Measurement"),
        ({"magnetic_field_total": None}, "Null Magnetic Field Measurement"),
        ({"magnetic_field_bz": None}, "Null Z Magnetic Field Measurement"),
        ({"plasma_temperature": None}, "Null Plasma Temperature Measurement"),
        ({"solar_wind_speed": -3.0}, "Negative Solar Wind Speed Value"),
        ({"time_tag": None, "solar_wind_speed": -3.0}, "Missing Primary Key (time_tag)"),
        ({"proton_density": None, "plasma_temperature": None}, "Null Proton Density Measurement"),
        ({"solar_wind_speed": -INF}, "Negative Solar Wind Speed Value"),
    ],
)
def test_reason(spark, changes, reason):
    passed, failed = gate.split(readings(spark, [row(**changes)]))
    assert passed.count() == 0
    assert [r["quarantine_reason"] for r in failed.collect()] == [reason]


@pytest.mark.parametrize(
    "changes",
    [{}, {"solar_wind_speed": 0.0}, {"solar_wind_speed": NAN}, {"plasma_temperature": INF},
     {"magnetic_field_bz": -7.0}],
)
def test_valid(spark, changes):
    passed, failed = gate.split(readings(spark, [row(**changes)]))
    assert (passed.count(), failed.count()) == (1, 0)


@pytest.mark.parametrize("value, kept", [(NAN, 0), (INF, 0), (-INF, 0), (1.0, 1)])
def test_finite_rules_are_optional(spark, value, kept):
    data = readings(spark, [row(plasma_temperature=value)])
    strict = (*gate.RULES, *gate.FINITE_RULES)
    passed, failed = gate.split(data, strict)
    assert (passed.count(), failed.count()) == (kept, 1 - kept)
    assert gate.split(data)[0].count() == 1


value = st.one_of(st.none(), st.floats(allow_nan=True, allow_infinity=True))


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.tuples(st.one_of(st.none(), st.just(T)), value, value, value, value, value),
        min_size=1,
        max_size=30,
    )
)
def test_split_is_a_partition(spark, data):
    df = readings(spark, data)
    passed, failed = gate.split(df)
    assert passed.count() + failed.count() == len(data)
    assert failed.filter(F.col("quarantine_reason") == gate.OTHER_REASON).count() == 0
    assert df.filter(gate.valid().isNull()).count() == 0


def test_gate_filters_reach_the_scan(spark, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    readings(spark, [GOOD]).write.parquet(str(tmp_path / "t"))
    passed, failed = gate.split(spark.read.parquet(str(tmp_path / "t")))
    kept = passed._jdf.queryExecution().executedPlan().toString()
    bad = failed._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(solar_wind_speed,0.0)" in kept
    assert "PushedFilters: [Or(" in bad


CSV = """wrong,header,names,on,purpose,here
2024-01-31 23:58:00,400.0,5,6,-1,10000
2024-01-31 23:59:00,NaN,5,6,-1,10000
2024-02-01 00:00:00,-3,5,6,-1,10000
bad-ts,410,5,6,-1,10000
2024-02-01 00:01:00,abc,5,6,-1,10000
2024-02-01 00:02:00,420,5,,-1,10000
2024-02-01 00:03:00,420
2024-02-01T00:04:00Z,Infinity,Inf,6,-1,10000
2024-02-01 00:05:00,430,5,6,-1,10000,EXTRA
"""


def test_typed_csv(spark, tmp_path):
    (tmp_path / "in.csv").write_text(CSV)
    df = scan.read_typed_csv(spark, str(tmp_path / "in.csv"))
    assert df.schema == TELEMETRY
    assert df.count() == 9
    assert df.filter(F.col(KEY).isNull()).count() == 1
    passed, failed = gate.split(df)
    assert passed.count() == 4
    reasons = {r["quarantine_reason"]: r["n"] for r in
               failed.groupBy("quarantine_reason").agg(F.count("*").alias("n")).collect()}
    assert reasons == {
        "Negative Solar Wind Speed Value": 1,
        "Missing Primary Key (time_tag)": 1,
        "Null Solar Wind Speed Measurement": 1,
        "Null Magnetic Field Measurement": 1,
        "Null Proton Density Measurement": 1,
    }
    infinite = passed.filter(F.col("proton_density") == INF)
    assert infinite.count() == 1
    assert features.build(passed).filter(F.col("proton_density") == INF).count() == 1


def test_malformed_rows_have_a_reason_of_their_own(spark, tmp_path):
    (tmp_path / "in.csv").write_text(CSV)
    df = scan.read_typed_csv(spark, str(tmp_path / "in.csv"), malformed_col="_malformed")
    df.write.parquet(str(tmp_path / "stored"))  # Spark parses the columns that are read
    stored = spark.read.parquet(str(tmp_path / "stored"))
    plain = scan.read_typed_csv(spark, str(tmp_path / "in.csv"))
    assert sorted(map(str, stored.drop("_malformed").collect())) == sorted(
        map(str, plain.collect())
    )
    judged = gate.judged(stored, (gate.MALFORMED, *gate.RULES))
    found = {(r["quarantine_reason"], r["_malformed"]) for r in judged.collect()}
    assert found == {
        (None, None),
        ("Malformed Row", "bad-ts,410,5,6,-1,10000"),
        ("Malformed Row", "2024-02-01 00:01:00,abc,5,6,-1,10000"),
        ("Malformed Row", "2024-02-01 00:03:00,420"),
        ("Malformed Row", "2024-02-01 00:05:00,430,5,6,-1,10000,EXTRA"),
        ("Null Magnetic Field Measurement", None),  # an empty cell
        ("Negative Solar Wind Speed Value", None),
    }


def test_judged_is_split(spark, tmp_path):
    (tmp_path / "in.csv").write_text(CSV)
    df = scan.read_typed_csv(spark, str(tmp_path / "in.csv"))
    passed, failed = gate.split(df)
    judged = gate.judged(df)
    assert judged.columns == failed.columns
    texts = lambda x: sorted(str(tuple(r)) for r in x.collect())
    assert texts(judged.filter("quarantine_reason IS NOT NULL")) == texts(failed)
    assert texts(judged.filter("quarantine_reason IS NULL").select(*df.columns)) == texts(passed)


def test_stamp(spark):
    at = datetime(2024, 3, 1, tzinfo=timezone.utc)
    df = scan.stamp(readings(spark, [GOOD, GOOD]), "_at")
    assert df.columns == [KEY, *MEASURES, "_at"]
    assert len({r["_at"] for r in df.collect()}) == 1
    fixed = scan.stamp(df, "_at", at).select(F.unix_seconds("_at")).first()[0]
    assert fixed == int(at.timestamp())

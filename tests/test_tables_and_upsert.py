import os
import random
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from strandline import dedupe, shared, tables, upsert
from tests.helpers import rows

KV = "k int, v string"


@pytest.fixture
def path(spark):
    return shared.work_folder(spark, "test") + "/things"


def kv(spark, *pairs):
    return spark.createDataFrame(list(pairs), KV)


# ------------------------------------------------------------------ dedupe


def test_one_per_key_follows_the_order(spark):
    df = spark.createDataFrame(
        [(1, 3, "c"), (1, 1, "a"), (2, None, "n"), (2, 5, "x"), (None, 1, "p"), (None, 0, "q")],
        "k int, o int, v string",
    )
    first = rows(dedupe.one_per_key(df.na.fill({"k": -1}), ["k"], ["o"]), "k", "o", "v")
    assert first == [(-1, 0, "q"), (1, 1, "a"), (2, None, "n")]
    last = rows(dedupe.one_per_key(df.na.fill({"k": -1}), ["k"], ["o"], keep="last"), "k", "v")
    assert last == [(-1, "p"), (1, "c"), (2, "x")]


def test_ties_do_not_depend_on_partitioning(spark):
    rng = random.Random(1)
    data = [(rng.randrange(20), rng.randrange(3), rng.random()) for _ in range(2000)]
    df = spark.createDataFrame(data, "k int, o int, v double")
    picks = {tuple(rows(dedupe.one_per_key(df.repartition(n), ["k"], ["o"]))) for n in (1, 3, 16)}
    assert len(picks) == 1
    best = {}
    for k, o, v in data:
        best[k] = min(best.get(k, (o, v)), (o, v))
    assert picks.pop() == tuple(sorted((k, o, v) for k, (o, v) in best.items()))


def test_all_columns_as_key(spark):
    assert rows(dedupe.one_per_key(kv(spark, (1, "a"), (1, "a")), ["k", "v"])) == [(1, "a")]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    hot = spark.range(0, 90_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), "id"
    )
    one = dedupe.one_per_key(hot, ["k"], ["id"])
    assert one.count() == 60_001
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min") > plan.index("Exchange hashpartitioning")


# ------------------------------------------------------------------ upsert


def test_upsert_rows(spark):
    target, source = kv(spark, (1, "a"), (2, "b")), kv(spark, (2, "B"), (3, "C"))
    once = upsert.upsert_rows(target, source, ["k"])
    assert rows(once) == [(1, "a"), (2, "B"), (3, "C")]
    assert rows(upsert.upsert_rows(once, source, ["k"])) == rows(once)


def test_null_keys_never_match(spark):
    target, source = kv(spark, (None, "old"), (1, "a")), kv(spark, (None, "new"), (1, "A"))
    values = {r["v"] for r in upsert.upsert_rows(target, source, ["k"]).collect()}
    assert values == {"old", "new", "A"}
    stats = dict(rows(upsert.upsert_stats(target, source, ["k"])))
    assert stats == {"kept": 1, "inserted": 1, "updated": 1}


def test_outcomes(spark):
    target, source = kv(spark, (1, "a"), (2, "b")), kv(spark, (2, "B"), (3, "C"))
    assert rows(upsert.outcomes(target, source, ["k"])) == [
        (1, "kept"), (2, "updated"), (3, "inserted"),
    ]


keyed = st.dictionaries(st.integers(0, 12), st.text("abc", max_size=2), max_size=10)


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(old=keyed, new=keyed)
def test_upsert_like_a_dict(spark, old, new):
    target, source = kv(spark, *old.items()), kv(spark, *new.items())
    merged = upsert.upsert_rows(target, source, ["k"])
    assert dict(rows(merged)) == old | new
    assert merged.count() == len(old | new)
    if new:
        bounds = F.lit(min(new)), F.lit(max(new))
        by_range = upsert.unmatched(target, source, ["k"], bounds)
        assert rows(by_range) == sorted((k, v) for k, v in old.items() if k not in new)


def test_a_source_without_keys_replaces_nothing(spark, path):
    tables.upsert(kv(spark, (1, "a"), (None, "n")), path, ["k"])
    tables.upsert(kv(spark, (None, "x")), path, ["k"])
    tables.upsert(kv(spark, (1, "x")).filter("k = 0"), path, ["k"])
    assert {r["v"] for r in tables.read(spark, path).collect()} == {"a", "n", "x"}


def test_two_keys_by_range(spark):
    cols = "a int, b int, v string"
    target = spark.createDataFrame(
        [(1, 1, "p"), (1, 2, "q"), (2, 1, "r"), (1, None, "s"), (None, 1, "t")], cols
    )
    source = spark.createDataFrame([(1, 2, "Q"), (1, None, "S"), (5, 5, "N")], cols)
    for bounds in (None, (F.lit(1), F.lit(5))):
        kept = upsert.unmatched(target, source, ["a", "b"], bounds)
        assert {r["v"] for r in kept.collect()} == {"p", "r", "s", "t"}


def scanned(df):
    """Rows each file scan of the plan puts out, once it has run."""
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = df.select("*")
        again.collect()
        leaves = again._jdf.queryExecution().executedPlan().collectLeaves()
        found = [leaves.apply(i) for i in range(leaves.size())]
        return [
            x.metrics().apply("numOutputRows").value() for x in found if "Scan" in x.nodeName()
        ]
    finally:
        df.sparkSession.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("kind", ["bigint", "timestamp", "date", "string"])
def test_the_target_is_read_about_once(spark, path, kind, monkeypatch):
    def keyed(first, last):
        k = F.col("id") if kind in ("bigint", "string") else F.timestamp_seconds(F.col("id") * 86400)
        key = F.lpad(k.cast("string"), 8, "0") if kind == "string" else k.cast(kind)
        return spark.range(first, last).select(key.alias("k"), F.col("id").alias("v"))

    tables.replace(keyed(0, 20_000), path)
    tables.cluster_by(spark, path, "k", files=20)
    seen = []
    asked = upsert.unmatched
    monkeypatch.setattr(
        tables, "unmatched", lambda *a: seen.append(asked(*a)) or seen[-1]
    )
    assert tables.upsert(keyed(19_500, 20_100), path, ["k"]) == 600
    out = tables.read(spark, path)
    assert out.count() == 20_100 and out.select("k").distinct().count() == 20_100
    read = scanned(seen[0])
    # The source's keys, and the two parts of the target.
    assert sum(read) - 600 <= 20_000 * 1.15, read


def test_repeated_source_keys_are_refused(spark, path):
    twice = kv(spark, (1, "x"), (1, "y"))
    for period in (None,):
        with pytest.raises(ValueError, match="several rows of one key"):
            tables.upsert(twice, path, ["k"], period)
    assert not tables.exists(spark, path)
    tables.upsert(kv(spark, (1, "a"), (2, "b"), (None, "n"), (None, "m")), path, ["k"])
    with pytest.raises(ValueError, match="several rows of one key"):
        tables.upsert(twice, path, ["k"])
    assert tables.latest_version(spark, path) == 0
    tables.upsert(kv(spark, (None, "p"), (None, "q"), (2, "B")), path, ["k"])
    assert {r["v"] for r in tables.read(spark, path).collect()} == set("anmpqB")


def test_many_appends_keep_few_folders(spark, path, monkeypatch):
    monkeypatch.setattr(tables, "MOST_APPENDS", 5)
    tables.replace(kv(spark, (0, "v0")), path)
    for i in range(1, 13):
        assert tables.append(kv(spark, (i, f"v{i}")), path) == 1
    assert rows(tables.read(spark, path)) == [(i, f"v{i}") for i in range(13)]
    assert rows(tables.read(spark, path, version=7)) == [(i, f"v{i}") for i in range(8)]
    newest = tables._commit_row(spark, path, None)
    assert newest["n_rows"] == 13 and len(tables._folders(spark, path, newest)) <= 6


def test_the_second_of_two_writers_fails(spark, path):
    tables.replace(kv(spark, (0, "a")), path)
    before = tables._newest(spark, path)
    planned = tables._next_version(spark, path, before)
    tables.append(kv(spark, (1, "b")), path)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(tables, "_newest", lambda *a: before)
        with pytest.raises(RuntimeError, match="by another"):
            tables.append(kv(spark, (2, "c")), path)  # sees the claim when it plans
        patch.setattr(tables, "_next_version", lambda *a: planned)
        with pytest.raises(RuntimeError, match="by another"):
            tables.append(kv(spark, (2, "c")), path)  # or when it commits
    assert rows(tables.read(spark, path)) == [(0, "a"), (1, "b")]
    tables.append(kv(spark, (3, "d")), path)
    assert rows(tables.read(spark, path)) == [(0, "a"), (1, "b"), (3, "d")]
    assert rows(tables.read(spark, path, version=0)) == [(0, "a")]


def test_a_failed_commit_gives_its_version_back(spark, path, monkeypatch):
    tables.replace(kv(spark, (0, "a")), path)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(tables, "one_row", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            tables.append(kv(spark, (1, "b")), path)
    assert tables.append(kv(spark, (2, "c")), path) == 1
    # A writer that died between claim and commit: its number is passed over in time.
    with tables._claimed(spark, path, 2):
        pass
    with pytest.raises(RuntimeError, match="by another"):
        tables.append(kv(spark, (3, "d")), path)
    monkeypatch.setattr(tables, "CLAIM_SECONDS", -1)
    tables.append(kv(spark, (3, "d")), path)
    assert tables.latest_version(spark, path) == 3
    assert rows(tables.read(spark, path)) == [(0, "a"), (2, "c"), (3, "d")]


def test_an_empty_append_leaves_no_files(spark, path):
    tables.replace(kv(spark, (0, "a")), path)
    tables.append(kv(spark, (1, "b")).filter("k = 9"), path)
    assert len([f for f in os.listdir(path) if f.startswith("v=")]) == 1


def test_maps_cannot_settle_ties(spark):
    df = spark.range(3).select("id", F.create_map(F.lit("a"), F.col("id")).alias("m"))
    with pytest.raises(ValueError, match="maps"):
        dedupe.one_per_key(df, ["id"])


# ------------------------------------------------------------------ tables


def test_versions(spark, path):
    assert not tables.exists(spark, path)
    with pytest.raises(LookupError):
        tables.read(spark, path)
    assert tables.replace(kv(spark, (1, "a"), (2, "b")), path) == 2
    assert tables.append(kv(spark, (3, "c")), path) == 1
    assert tables.append(kv(spark, (4, "d")), path) == 1
    assert tables.upsert(kv(spark, (2, "B"), (5, "E")), path, ["k"]) == 2
    assert tables.append(kv(spark, (6, "f")), path) == 1
    assert tables.exists(spark, path)
    assert tables.latest_version(spark, path) == 4
    assert tables.row_count(spark, path) == 6
    assert tables.row_count(spark, path, 1) == 3
    by_version = [rows(tables.read(spark, path, v)) for v in range(5)]
    assert by_version[0] == [(1, "a"), (2, "b")]
    assert by_version[1] == [(1, "a"), (2, "b"), (3, "c")]
    assert by_version[2] == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]
    assert by_version[3] == [(1, "a"), (2, "B"), (3, "c"), (4, "d"), (5, "E")]
    assert by_version[4] == [*by_version[3], (6, "f")]
    assert rows(tables.read(spark, path)) == by_version[4]
    history = [(r["version"], r["operation"], r["n_rows"])
               for r in tables.history(spark, path).collect()]
    assert history == [(4, "append", 6), (3, "upsert", 5), (2, "append", 4), (1, "append", 3),
                       (0, "replace", 2)]
    with pytest.raises(LookupError):
        tables.read(spark, path, 9)


def test_a_table_may_be_replaced_by_what_is_read_from_it(spark, path):
    tables.replace(kv(spark, (1, "a"), (2, "b")), path)
    tables.replace(tables.read(spark, path).filter("k = 1"), path)
    assert rows(tables.read(spark, path)) == [(1, "a")]
    assert rows(tables.read(spark, path, 0)) == [(1, "a"), (2, "b")]


def test_schema_is_kept_unless_told_otherwise(spark, path):
    tables.replace(kv(spark, (1, "a")), path)
    other = spark.createDataFrame([(1,)], "k int")
    for write in (tables.replace, tables.append, lambda d, p: tables.upsert(d, p, ["k"])):
        with pytest.raises(ValueError, match="columns of"):
            write(other, path)
    tables.append(kv(spark, (2, "b")).select("v", "k"), path)
    assert rows(tables.read(spark, path)) == [(1, "a"), (2, "b")]
    tables.replace(other, path, allow_schema_change=True)
    assert tables.read(spark, path).columns == ["k"]
    assert tables.read(spark, path, 1).columns == ["k", "v"]


def test_empty_append_makes_no_version(spark, path):
    nothing = kv(spark, (1, "a")).filter("k = 2")
    assert tables.append(nothing, path) == 0
    assert not tables.exists(spark, path)
    tables.replace(kv(spark, (1, "a")), path)
    assert tables.append(nothing, path) == 0
    assert tables.latest_version(spark, path) == 0


def test_half_written_version_is_invisible(spark, path):
    tables.replace(kv(spark, (1, "a")), path)
    # A write that died before its commit, in both shapes a version can have.
    kv(spark, (9, "z")).write.parquet(f"{path}/v=1/rows")
    kv(spark, (9, "z")).write.parquet(f"{path}/v=1/kept")
    assert rows(tables.read(spark, path)) == [(1, "a")]
    tables.upsert(kv(spark, (2, "b")), path, ["k"])
    assert rows(tables.read(spark, path)) == [(1, "a"), (2, "b")]
    tables.append(kv(spark, (3, "c")), path)
    assert rows(tables.read(spark, path)) == [(1, "a"), (2, "b"), (3, "c")]


def test_failed_write_leaves_the_table_as_it_was(spark, path):
    tables.replace(kv(spark, (1, "a")), path)
    broken = kv(spark, (2, "b")).withColumn(
        "v", F.when(F.col("k") == 2, F.raise_error(F.lit("no"))).otherwise(F.col("v"))
    )
    with pytest.raises(Exception):
        tables.append(broken, path)
    assert tables.latest_version(spark, path) == 0
    assert rows(tables.read(spark, path)) == [(1, "a")]


def test_cluster_by_gives_disjoint_files(spark, path):
    df = spark.range(0, 20_000, 1, 8).select(
        F.timestamp_seconds(1704067200 + (F.col("id") * 7919) % 20_000).alias("t"), "id"
    )
    tables.replace(df, path)
    tables.cluster_by(spark, path, "t", files=5)
    stored = tables.read(spark, path)
    assert rows(stored) == rows(df)
    ranges = (
        stored.groupBy(F.input_file_name()).agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
    ).orderBy("lo").collect()
    assert len(ranges) == 5
    assert all(a["hi"] < b["lo"] for a, b in zip(ranges, ranges[1:]))
    found = stored.filter(F.col("t") < datetime(2024, 1, 1, 0, 10))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(t), LessThan(t," in plan


def test_cluster_by_spreads_a_hot_value(spark, path):
    df = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id")).alias("k")
    )
    tables.replace(df, path)
    tables.cluster_by(spark, path, "k", rows_per_file=3000)
    sizes = [
        r["count"]
        for r in tables.read(spark, path).groupBy(F.input_file_name()).count().collect()
    ]
    assert sum(sizes) == 30_000
    assert len(sizes) == 10
    assert max(sizes) < 6000


def opened(spark, path, condition):
    """Files whose range of values leaves room for a match."""
    stored = tables.read(spark, path).withColumn("file", F.input_file_name())
    ranges = stored.groupBy("file").agg(
        *[f(c).alias(f"{n}_{c}") for c in ("a", "b") for n, f in (("lo", F.min), ("hi", F.max))]
    )
    return ranges.filter(condition).count()


def test_layout_along_two_columns(spark, path):
    df = spark.range(0, 40_000, 1, 8).select(
        (F.xxhash64("id") % 1000).cast("int").alias("a"),
        F.timestamp_seconds(1704067200 + F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(10**6))).alias("b"),
        "id",
    )
    tables.replace(df, path)
    tables.cluster_by(spark, path, ["a", "b"], files=16)
    stored = tables.read(spark, path)
    assert stored.columns == ["a", "b", "id"]
    assert tables.checksum(stored) == tables.checksum(df)
    for value in (-900, 17, 950):
        assert opened(spark, path, f"lo_a <= {value} AND hi_a >= {value}") <= 8
    for second in (1704067300, 1704567200, 1705060000):
        at = f"timestamp_seconds({second})"
        assert opened(spark, path, f"lo_b <= {at} AND hi_b >= {at}") <= 8
    # Along one column, a filter on the other opens every file.
    tables.cluster_by(spark, path, "a", files=16)
    assert opened(spark, path, "lo_b <= timestamp_seconds(1704567200) AND hi_b >= "
                  "timestamp_seconds(1704567200)") == 16


def test_layout_along_odd_columns(spark, path):
    """Hot values, NULL, NaN, texts, dates, and one value throughout."""
    df = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, F.lit(7.0))
        .when(F.col("id") % 3 == 0, F.lit(float("nan")))
        .when(F.col("id") % 5 != 0, F.rand(1)).alias("a"),
        F.when(F.col("id") % 7 != 0, F.md5(F.col("id").cast("string"))).alias("b"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("c"),
        F.lit(1).alias("d"),
        F.lit(None).cast("long").alias("e"),
    )
    stored = f"{path}-given"
    df.write.parquet(stored)
    tables.replace(spark.read.parquet(stored), path)
    tables.cluster_by(spark, path, ["a", "b", "c", "d", "e"], rows_per_file=3000)
    assert tables.checksum(tables.read(spark, path)) == tables.checksum(spark.read.parquet(stored))
    sizes = [r["count"] for r in
             tables.read(spark, path).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 10 and max(sizes) < 6000
    with pytest.raises(ValueError, match="no layout by"):
        tables.interleaved(spark.createDataFrame([([1],)], "a array<int>"), ["a"])


def test_bits_take_turns(spark):
    df = spark.range(16).select((F.col("id") % 4).alias("x"), F.floor(F.col("id") / 4).alias("y"))
    order = tables.interleaved(df, ["x", "y"], bits=2)
    found = {(r["x"], r["y"]): r["z"] for r in df.select("x", "y", order.alias("z")).collect()}

    def rank(v):  # quartiles of 0, 1, 2, 3 are 0, 1, 2 by their own values
        return min(v + 1, 3)

    def turn(x, y):
        return sum(((x >> b) & 1) << (2 * b + 1) | ((y >> b) & 1) << (2 * b) for b in range(2))

    assert found == {(x, y): turn(rank(x), rank(y)) for x in range(4) for y in range(4)}


def test_audit(spark, path):
    tables.replace(kv(spark, (1, "a"), (2, "b")), path)
    assert tables.audit(spark, path).first().asDict() == {
        "version": 0, "n_rows": 2, "previous_version": None, "previous_rows": None,
        "difference": None,
    }
    tables.append(kv(spark, (3, "c")), path)
    assert tuple(tables.audit(spark, path).first()) == (1, 3, 0, 2, 1)
    tables.cluster_by(spark, path, "k", files=2)
    assert tuple(tables.audit(spark, path).first()) == (2, 3, 1, 3, 0)
    skipped = tables.audit(spark, path, skip_operations=["cluster"]).first()
    assert tuple(skipped) == (2, 3, 0, 2, 1)


def test_view(spark, path):
    tables.replace(kv(spark, (1, "a")), path)
    tables.view(spark, path, "things_now")
    assert spark.sql("SELECT v FROM things_now").first()[0] == "a"


def dated(spark, *pairs):
    return spark.createDataFrame(
        [(None if d is None else datetime.fromisoformat(d), v) for d, v in pairs],
        "t timestamp, v string",
    )


def folders_of(spark, path, version):
    return set(tables._folders(spark, path, tables._commit_row(spark, path, version)))


def test_upsert_rewrites_only_the_months_it_touches(spark, path):
    first = dated(spark, ("2024-01-05", "a"), ("2024-02-05", "b"), ("2024-03-05", "c"))
    second = dated(spark, ("2024-03-05", "C"), ("2024-03-06", "d"), ("2024-04-01", "e"))
    assert tables.upsert(first, path, ["t"], "month") == 3
    assert tables.upsert(second, path, ["t"], "month") == 3
    assert "".join(sorted(r["v"] for r in tables.read(spark, path).collect())) == "Cabde"
    assert "".join(sorted(r["v"] for r in tables.read(spark, path, 0).collect())) == "abc"
    assert tables.read(spark, path).columns == ["t", "v"]
    assert tables.row_count(spark, path) == 5
    taken_over = folders_of(spark, path, 0) & folders_of(spark, path, 1)
    assert {f.rsplit("=", 1)[1] for f in taken_over} == {"2024-01-01", "2024-02-01"}
    # Nothing is left of March but what came in.
    assert not any("kept" in f for f in folders_of(spark, path, 1))
    assert tables.append(dated(spark, ("2024-01-07", "f")), path) == 1
    assert tables.upsert(dated(spark, ("2024-01-05", "A")), path, ["t"], "month") == 1
    assert "".join(sorted(r["v"] for r in tables.read(spark, path).collect())) == "ACbdef"
    assert tables.row_count(spark, path) == tables.read(spark, path).count() == 6


def test_upsert_by_month_keeps_rows_without_a_key(spark, path):
    tables.upsert(dated(spark, (None, "n"), ("2024-01-05", "a")), path, ["t"], "month")
    tables.upsert(dated(spark, (None, "m"), ("2024-01-05", "A")), path, ["t"], "month")
    tables.upsert(dated(spark, ("2024-05-05", "x")), path, ["t"], "month")
    assert "".join(sorted(r["v"] for r in tables.read(spark, path).collect())) == "Amnx"


@pytest.mark.parametrize("period", [None, "month"])
def test_a_whole_reload_keeps_nothing(spark, path, period):
    days = ["2024-01-05", "2024-02-05", "2024-03-05"]
    tables.upsert(dated(spark, *[(d, "a") for d in days]), path, ["t"], period)
    tables.upsert(dated(spark, *[(d, "b") for d in days], ("2024-03-06", "b")), path, ["t"], period)
    assert not any("kept" in f for f in folders_of(spark, path, 1))
    assert [r["v"] for r in tables.read(spark, path).collect()] == ["b"] * 4
    # As many rows, but not the same keys.
    other = dated(spark, *[(d, "c") for d in days], ("2024-03-09", "c"))
    tables.upsert(other, path, ["t"], period)
    assert "".join(sorted(r["v"] for r in tables.read(spark, path).collect())) == "bcccc"
    assert tables.row_count(spark, path) == 5


def test_matched_reads_only_keys(spark, path):
    tables.replace(kv(spark, (1, "a"), (None, "b"), (2, "c")), path)
    found = upsert.matched(tables.read(spark, path), kv(spark, (2, "x"), (None, "y")), ["k"])
    assert rows(found) == [(2,)]
    assert "ReadSchema: struct<k:int>" in found._jdf.queryExecution().executedPlan().toString()


def test_month_of_a_key_does_not_follow_the_session_zone(spark, path):
    at = F.timestamp_micros(F.lit(1706747400_000000))  # 2024-02-01 00:30 UTC
    old, new = (spark.range(1).select(at.alias("t"), F.lit(v).alias("v")) for v in "ab")
    tables.upsert(old, path, ["t"], "month")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        tables.upsert(new, path, ["t"], "month")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r["v"] for r in tables.read(spark, path).collect()] == ["b"]
    assert {f.rsplit("=", 1)[1] for f in folders_of(spark, path, 1)} == {"2024-02-01"}


def test_loads_may_change_period_and_column(spark, path):
    def two(*pairs):
        return spark.createDataFrame(
            [(datetime.fromisoformat(a), datetime.fromisoformat(b), v) for a, b, v in pairs],
            "t timestamp, u timestamp, v string",
        )

    def values():
        return "".join(sorted(r["v"] for r in tables.read(spark, path).collect()))

    tables.upsert(two(("2024-01-09", "2024-05-09", "a"), ("2024-02-09", "2024-05-10", "b")),
                  path, ["t", "u"], "month")
    tables.upsert(two(("2024-01-09", "2024-05-09", "A")), path, ["t", "u"], "week")
    assert values() == "Ab"
    tables.upsert(two(("2024-02-09", "2024-05-10", "B")), path, ["u", "t"], "month")
    assert values() == "AB"
    tables.upsert(two(("2024-01-09", "2024-05-09", "c")), path, ["t", "u"], "month")
    assert values() == "Bc"
    tables.upsert(two(("2024-02-09", "2024-05-10", "d")), path, ["t", "u"])
    assert values() == "cd"


def test_odd_column_name(spark, path):
    odd = "t = /x y"
    for v in "ab":
        one = dated(spark, ("2024-01-09", v), ("2024-02-09", v)).withColumnRenamed("t", odd)
        tables.upsert(one.filter(F.col("v") == "a") if v == "a" else one.limit(1), path,
                      [odd], "month")
    assert "".join(sorted(r["v"] for r in tables.read(spark, path).collect())) == "ab"


def test_unknown_period(spark, path):
    with pytest.raises(ValueError, match="no such period"):
        tables.upsert(dated(spark, ("2024-01-05", "a")), path, ["t"], "fortnight")


def test_upsert_of_nothing(spark, path):
    tables.upsert(dated(spark, ("2024-01-05", "a")), path, ["t"], "month")
    for period in ("month", None):
        nothing = dated(spark, ("2024-01-05", "b")).filter("v = 'z'")
        assert tables.upsert(nothing, path, ["t"], period) == 0
        assert [r["v"] for r in tables.read(spark, path).collect()] == ["a"]


moments = st.dictionaries(
    st.integers(0, 9).map(lambda i: f"2024-0{1 + i // 3}-{10 + i}"), st.text("abc", max_size=2),
    max_size=8,
)


@settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(loads=st.lists(moments.filter(bool), min_size=2, max_size=3))
def test_upsert_by_month_like_a_dict(spark, loads):
    path = shared.work_folder(spark, "test") + "/things"
    expected = {}
    for load in loads:
        expected |= load
        tables.upsert(dated(spark, *load.items()), path, ["t"], "month")
        stored = {r["t"].strftime("%Y-%m-%d"): r["v"] for r in tables.read(spark, path).collect()}
        assert stored == expected
        assert tables.row_count(spark, path) == len(expected)


def test_a_hot_month_is_written_by_several_tasks(spark, path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    try:
        hot = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.timestamp_seconds(1706745600 + F.col("id") * 400))
            .otherwise(F.timestamp_seconds(1704067200 + F.col("id")))
            .alias("t"),
            F.xxhash64("id").alias("v"),
        )
        tables.upsert(hot, path, ["t"], "month")
        stored = tables.read(spark, path).withColumn("file", F.input_file_name())
        files = stored.groupBy(F.date_trunc("month", "t")).agg(
            F.count_distinct("file").alias("files"), F.count("*").alias("n")
        )
        by_month = {r[0].strftime("%Y-%m"): (r["files"], r["n"]) for r in files.collect()}
        assert by_month["2024-01"][1] == 40_000
        assert by_month["2024-01"][0] > 3
        assert by_month["2024-03"][0] <= 2
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_small_source_does_not_shuffle_the_target(spark, path):
    tables.replace(spark.range(1000).select(F.col("id").alias("k")), path)
    source = f"{path}-source"
    spark.range(5).select(F.col("id").alias("k")).write.parquet(source)
    kept = upsert.unmatched(tables.read(spark, path), spark.read.parquet(source), ["k"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan


# ------------------------------------------------------- upsert by touched files


def keyed_files(spark, path, n_files=10):
    """Keys 0 to 999 in files of disjoint ranges, and a few rows without a key."""
    df = spark.range(1000).select(
        F.when(F.col("id") % 250 != 249, F.col("id")).alias("k"), F.lit("old").alias("v")
    )
    tables.replace(df, path)
    tables.cluster_by(spark, path, "k", files=n_files)


def files_of(spark, path, version=None):
    commit = tables._commit_row(spark, path, version)
    return tables._single(spark, path, set(tables._folders(spark, path, commit)))


def load_of(spark, *keys):
    return kv(spark, *[(k, "new") for k in keys]).select(F.col("k").cast("long").alias("k"), "v")


def test_only_files_with_matches_are_rewritten(spark, path):
    keyed_files(spark, path)
    before = files_of(spark, path)
    # A late reading far back, a recent one, a new key; the range spans the whole table.
    assert tables.upsert(load_of(spark, 105, 990, 5000, None), path, ["k"]) == 4
    after = files_of(spark, path)
    assert len(before) == 10 and len(before - after) == 2
    stored = tables.read(spark, path)
    assert stored.count() == tables.row_count(spark, path) == 1002
    assert sorted(r["k"] for r in stored.filter("v = 'new' AND k IS NOT NULL").collect()) == [
        105, 990, 5000,
    ]
    assert stored.filter("k IS NULL").count() == 5
    assert stored.filter("k IS NOT NULL").groupBy("k").count().filter("count > 1").isEmpty()
    # The version before is as it was.
    old = tables.read(spark, path, 1)
    assert old.count() == 1000 and old.filter("v = 'new'").isEmpty()
    # Once more over a version made of single files, and its layout.
    tables.upsert(load_of(spark, 105, 106), path, ["k"])
    assert len(files_of(spark, path) & before) == 8
    tables.cluster_by(spark, path, "k", files=3)
    assert tables.read(spark, path).filter("v = 'new' AND k IS NOT NULL").count() == 4


def test_keys_that_match_nothing_rewrite_nothing(spark, path):
    keyed_files(spark, path)
    before = files_of(spark, path)
    for source in (load_of(spark, 249, 5000), load_of(spark, None), load_of(spark, 1).limit(0)):
        tables.upsert(source, path, ["k"])
        assert before <= files_of(spark, path)
    assert tables.read(spark, path).count() == tables.row_count(spark, path) == 1003


def test_files_of_a_touched_month_are_taken_over_too(spark, path):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 100)
    try:
        hours = spark.range(1440).select(
            F.timestamp_seconds(1704067200 + F.col("id") * 3600).alias("t"),
            F.col("id").cast("string").alias("v"),
        )
        tables.upsert(hours, path, ["t"], "month")
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    before = files_of(spark, path)
    load = dated(spark, ("2024-01-20 05:00:00", "new"), ("2024-01-20 05:30:00", "new"))
    assert tables.upsert(load, path, ["t"], "month") == 2
    assert len(before) > 10 and len(before - files_of(spark, path)) == 1
    assert tables.read(spark, path).count() == tables.row_count(spark, path) == 1441
    # The month's files are still known to be its own.
    tables.upsert(dated(spark, ("2024-02-03", "x")), path, ["t"], "month")
    assert tables.read(spark, path).filter("v = 'new'").count() == 2
    assert tables.read(spark, path).count() == 1441


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(loads=st.lists(st.dictionaries(st.integers(0, 30), st.text("ab", max_size=2)), max_size=4))
def test_upsert_by_files_like_a_dict(spark, loads):
    path = shared.work_folder(spark, "test") + "/things"
    expected = {k: "" for k in range(0, 30, 2)}
    tables.replace(kv(spark, *expected.items()), path)
    tables.cluster_by(spark, path, "k", files=5)
    for load in loads:
        expected |= load
        source = kv(spark, *load.items(), (None, "n")).filter("k IS NOT NULL")
        tables.upsert(source, path, ["k"])
        stored = {r["k"]: r["v"] for r in tables.read(spark, path).collect()}
        assert stored == expected
        assert tables.row_count(spark, path) == len(expected)


# ------------------------------------------------------------ parts of a table


def test_parts(spark, path):
    months = tables.Split("t", "month")
    year = dated(spark, *[(f"2024-{m:02}-{d:02}", "a") for m in (1, 2, 3) for d in (1, 28)])
    assert tables.replace(year, path, split=months) == 6
    new = dated(spark, ("2024-02-10", "b"))
    assert tables.replace_parts(new, path, months, ["2024-02-01"]) == 1
    assert tables.row_count(spark, path) == tables.read(spark, path).count() == 5
    assert tables.changed_parts(spark, path, 0, months) == ["2024-02-01"]
    assert tables.changed_parts(spark, path, 1, months) == []
    part = tables.read_parts(spark, path, months, ["2024-02-01", "2024-09-01"])
    assert [r["v"] for r in part.collect()] == ["b"]
    # A part that ends up empty, and one that is new.
    april = dated(spark, ("2024-04-10", "c"))
    tables.replace_parts(april, path, months, ["2024-01-01", "2024-04-01"])
    assert tables.changed_parts(spark, path, 1, months) == ["2024-01-01", "2024-04-01"]
    assert "".join(sorted(r["v"] for r in tables.read(spark, path).collect())) == "aabc"
    with pytest.raises(ValueError, match="outside of the parts"):
        tables.replace_parts(april, path, months, ["2024-05-01"])
    assert tables.latest_version(spark, path) == 2
    with pytest.raises(ValueError, match="not split by"):
        tables.replace_parts(april, path, tables.Split("t", "year"), ["2024-01-01"])
    assert tables.changed_parts(spark, path, 0, tables.Split("t", "year")) is None
    tables.append(april, path)
    assert tables.changed_parts(spark, path, 0, months) is None


# ------------------------------------------------- audit of contents, appends


def test_checksum_sees_values_and_not_order(spark):
    df = spark.createDataFrame(
        [(1, "a", 0.5, [1, None], {"x": 1, "y": 2}), (None, "b", None, None, None)],
        "k int, v string, d double, l array<int>, m map<string,int>",
    )
    same = tables.checksum(df.repartition(3))
    assert tables.checksum(df.orderBy(F.desc("v"))) == same
    assert tables.checksum(df.unionByName(df)) != same
    others = [
        df.withColumn("v", F.lit("a")),
        df.withColumn("l", F.reverse("l")),
        df.withColumn("l", F.when(F.col("k") == 1, F.array(F.lit(1)))),
        df.withColumn("d", F.coalesce("d", F.lit(0.0))),
        df.withColumns({"k": F.col("d").cast("int"), "d": F.col("k").cast("double")}),
    ]
    assert len({same, *map(tables.checksum, others)}) == 6
    turned = df.withColumn("m", F.expr("map_from_entries(reverse(map_entries(m)))"))
    assert tables.checksum(turned) == same
    assert tables.checksum(df.limit(0)) == "0-0-0"
    swapped = spark.createDataFrame([(None, 1)], "a int, b int")
    assert tables.checksum(swapped) != tables.checksum(swapped.selectExpr("b AS a", "a AS b"))


def test_audit_of_contents(spark, path):
    def same(**kw):
        row = tables.audit(spark, path, contents=True, **kw).first()
        return row["difference"], row["same_contents"]

    tables.replace(kv(spark, *[(i, "a") for i in range(100)]), path)
    assert same() == (None, None)
    tables.cluster_by(spark, path, "k", files=4)
    assert same() == (0, True)
    tables.upsert(kv(spark, (7, "b")), path, ["k"])  # equal counts, one value changed
    assert same() == (0, False)
    tables.upsert(kv(spark, (7, "b")), path, ["k"])  # the same row again
    assert same() == (0, True)
    tables.append(kv(spark, (7, "b")), path)
    assert same() == (1, False)
    tables.replace(tables.read(spark, path).withColumn("k", F.col("k").cast("long")), path,
                   allow_schema_change=True)
    assert same() == (0, False)  # another type of column


def test_audit_reads_only_what_differs(spark, path, monkeypatch):
    keyed_files(spark, path)
    tables.upsert(load_of(spark, 5), path, ["k"])
    read = []
    asked = tables.checksum
    monkeypatch.setattr(tables, "checksum", lambda df: read.append(df.count()) or asked(df))
    assert tables.audit(spark, path, contents=True).first()["same_contents"] is False
    assert sorted(read) == [100, 100]


def test_append_new_holds_each_row_once(spark, path):
    def load(stamp, *pairs):
        return kv(spark, *pairs).withColumn("at", F.lit(stamp))

    first = [(1, "a"), (1, "a"), (None, "n"), (2, None), (2, "")]
    assert tables.append_new(load("x", *first), path, ignore=["at"]) == 4
    assert tables.append_new(load("y", *first), path, ignore=["at"]) == 0
    assert tables.latest_version(spark, path) == 0
    assert tables.append_new(load("z", *first, (3, "c")), path, ignore=["at"]) == 1
    assert tables.append_new(load("z", (3, "c")), path) == 0  # the stamp counts, and is equal
    assert tables.append_new(load("w", (3, "c")), path) == 1
    assert tables.read(spark, path).count() == 6


def test_appending_writes_both_sides_once(spark, path):
    runs = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    df = kv(spark, *[(i if i % 10 else None, "a") for i in range(100)])
    counted = df.mapInArrow(seen, df.schema)
    with tables.appending(counted, path, F.col("k").isNull(), "odd") as (n, others):
        assert n == 10
        assert sorted(r["k"] for r in others.collect()) == [i for i in range(100) if i % 10]
        assert others.columns == ["k", "v"]
    assert runs.value == 100
    assert tables.read(spark, path).count() == tables.row_count(spark, path) == 10
    # Nothing to add; a condition that is NULL; nothing else; nothing at all.
    for where, n_added, n_other in (("k > 5000", 0, 90), ("k > 0", 90, 0), ("v = 'z'", 0, 90)):
        some = df.filter("k IS NOT NULL") if n_other or n_added else df
        with tables.appending(some, path, F.expr(where)) as (n, others):
            assert (n, others.count()) == (n_added, n_other)
    with tables.appending(df.limit(0), path, F.lit(True)) as (n, others):
        assert (n, others.count()) == (0, 0)
    assert tables.read(spark, path).count() == 100
    folders = [f for f in os.listdir(path) if f.startswith("v=")]
    assert len(folders) == 2  # what was not added is gone
    with pytest.raises(ZeroDivisionError):
        with tables.appending(df, path, F.col("k") == 1):
            raise ZeroDivisionError
    assert tables.read(spark, path).count() == 101


def test_appending_many_times(spark, path, monkeypatch):
    monkeypatch.setattr(tables, "MOST_APPENDS", 3)
    for i in range(8):
        with tables.appending(kv(spark, (i, "a"), (-i, "b")), path, F.col("v") == "a") as (n, rest):
            assert (n, rest.count()) == (1, 1)
    assert sorted(r["k"] for r in tables.read(spark, path).collect()) == list(range(8))
    newest = tables._commit_row(spark, path, None)
    assert len(tables._folders(spark, path, newest)) <= 4


def test_work_folder_needs_a_shared_root_on_a_cluster():
    class Conf:
        def __init__(self, **values):
            self.values = {k.replace("_", "."): v for k, v in values.items()}

        def get(self, name, default=None):
            return self.values.get(name, default)

    class Session:
        conf = Conf(spark_master="yarn")

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared.work_folder(Session, "x")
    Session.conf.values["spark.checkpoint.dir"] = "hdfs:///shared/"
    assert shared.work_folder(Session, "x").startswith("hdfs:///shared/x-")


def test_work_folder_of_a_local_session_without_a_shared_root():
    class Conf:
        @staticmethod
        def get(name, default=None):
            return {"spark.master": "local[2]"}.get(name, default)

    class Session:
        conf = Conf

    folder = shared.work_folder(Session, "x")
    assert "/x-" in folder
    assert folder != shared.work_folder(Session, "x")


def test_files_of_many_rows_are_made_of_sorted_ranges(spark, path):
    """Few files, whole and in order, with no task that sorts more than its range."""
    df = spark.range(0, 60_000, 1, 8).select(
        F.timestamp_seconds(1704067200 + (F.col("id") * 7919) % 997).alias("t"),
        F.when(F.col("id") % 5 != 0, F.col("id")).alias("v"),
    )
    tables.replace(df, path)
    before = set(os.listdir(path))
    sorts = []
    write = DataFrameWriter.parquet

    def watched(self, target, *args, **kwargs):
        sorts.append((target, self._df.rdd.getNumPartitions()))
        return write(self, target, *args, **kwargs)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(DataFrameWriter, "parquet", watched)
        tables.cluster_by(spark, path, "t", files=3, rows_per_sort=4000)
    # 15 tasks sort; 3 write the files.
    assert [n for target, n in sorts if "/commits" not in target] == [15, 3]
    stored = tables.read(spark, path)
    assert tables.checksum(stored) == tables.checksum(df)
    files = stored.select(F.input_file_name().alias("f")).distinct().collect()
    assert len(files) == 3
    spans = []
    for row in files:
        found = [r["t"] for r in spark.read.parquet(row["f"]).coalesce(1).collect()]
        assert found == sorted(found) and 15_000 < len(found) < 25_000
        spans.append((found[0], found[-1]))
    spans.sort()
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    # Nothing is left of the ranges.
    assert len(set(os.listdir(path)) - before) == 1
    assert spark.conf.get(tables.UNIONS) == "true"


def test_few_rows_in_many_ranges(spark, path):
    """Fewer rows than ranges, and one value throughout."""
    for n, files, per_sort in ((7, 3, 1), (1, 1, 1), (500, 2, 100)):
        df = spark.range(0, n, 1, 4).select(F.lit(1).alias("k"), "id")
        tables.replace(df, path, allow_schema_change=True)
        tables.cluster_by(spark, path, "k", files=files, rows_per_sort=per_sort)
        stored = tables.read(spark, path)
        assert rows(stored) == rows(df)
        assert stored.select(F.input_file_name()).distinct().count() <= files

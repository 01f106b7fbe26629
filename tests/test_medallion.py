import dataclasses
import itertools

import pytest
from pyspark.sql import functions as F

from strandline import features, medallion, runs, shared, tables
from strandline.sources.schemas import KEY, TELEMETRY
from tests.test_features import readings, some_series


@pytest.fixture(scope="module")
def cfg(spark):
    source = shared.work_folder(spark, "source")
    good = readings(spark, some_series(300, 21))
    bad = readings(spark, some_series(20, 22)).withColumn("solar_wind_speed", F.lit(-1.0))
    again = good.limit(50)
    good.unionByName(bad).unionByName(again).write.csv(source, header=True)
    return medallion.Config(source=source, root=shared.work_folder(spark, "job"),
                            rows_per_chunk=40, rows_per_file=100)


@pytest.fixture(scope="module")
def first_log(spark, cfg):
    return medallion.run(spark, cfg).collect()


def table(spark, cfg, name):
    if name == "runs":
        return runs.read(spark, cfg.path(name))
    if name == "stage_log":
        return medallion.stage_log(spark, cfg)
    if name == "gold_audit":
        return spark.read.parquet(cfg.path(name))
    return tables.read(spark, cfg.path(name))


def test_stage_log(first_log):
    assert {r["stage"] for r in first_log} == {"ingest", "clean", "train", "score"}
    assert {r["status"] for r in first_log} == {"FINISHED"}
    assert {r["stage"]: r["budget_seconds"] for r in first_log} == {
        "ingest": 600, "clean": 600, "train": 1200, "score": 900,
    }
    assert not any(r["over_budget"] for r in first_log)
    assert len({r["run_id"] for r in first_log}) == 1
    assert {r["stage"]: r["n_rows"] for r in first_log} == {
        "ingest": 370, "clean": 300, "train": 300, "score": 300,
    }


def test_tables(spark, cfg, first_log):
    assert table(spark, cfg, "bronze").columns == [*TELEMETRY.names, "_ingested_at"]
    assert table(spark, cfg, "silver").select(KEY).distinct().count() == 300
    quarantine = table(spark, cfg, "quarantine")
    assert quarantine.columns[-2:] == ["quarantine_reason", "_quarantined_at"]
    assert quarantine.count() == 20
    gold = table(spark, cfg, "gold")
    assert gold.columns == [KEY, *features.FEATURE_COLS, "anomaly_cluster"]
    assert dict(gold.dtypes)["anomaly_cluster"] == "int"
    assert table(spark, cfg, "training_eval").schema == gold.schema
    assert [r["operation"] for r in tables.history(spark, cfg.path("gold")).collect()] == [
        "cluster", "replace",
    ]
    plain = features.build(table(spark, cfg, "silver"))
    chunked = table(spark, cfg, "features")
    def rounded(df):
        return sorted(tuple(r) for r in df.select(
            KEY, *[F.round(c, 9) for c in features.FEATURE_COLS]).collect())
    assert rounded(plain) == rounded(chunked)


def test_run_record(spark, cfg, first_log):
    run = table(spark, cfg, "runs").first()
    assert run["status"] == runs.FINISHED
    assert run["params"]["k_clusters"] == "3" and run["params"]["seed"] == "25"
    assert -1 <= run["metrics"]["silhouette_score"] <= 1


def test_second_run(spark, cfg, first_log):
    silver = table(spark, cfg, "silver").drop("_ingested_at")
    before = sorted(tuple(r) for r in silver.collect())
    log = medallion.run(spark, cfg)
    assert log.count() == 4
    after = table(spark, cfg, "silver").drop("_ingested_at")
    assert sorted(tuple(r) for r in after.collect()) == before
    assert table(spark, cfg, "quarantine").count() == 40
    assert table(spark, cfg, "bronze").count() == 370
    assert tables.latest_version(spark, cfg.path("silver")) == 1
    assert tables.latest_version(spark, cfg.path("gold")) == 3
    audits = sorted(tuple(r) for r in table(spark, cfg, "gold_audit").collect())
    assert audits == [(1, 300, 0, 300, 0), (3, 300, 2, 300, 0)]
    # Scoring took over the features that training had built.
    assert tables.latest_version(spark, cfg.path("features")) == 1
    assert table(spark, cfg, "stage_log").count() == 8


def test_stages_do_not_follow_the_session_zone(spark, cfg, first_log):
    alone = medallion.Config(source=cfg.source, root=shared.work_folder(spark, "alone"))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        for stage in medallion.STAGES:
            stage.work(spark, alone)
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    def figures(c):
        return sorted(tuple(r) for r in table(spark, c, "features").select(
            KEY, *[F.round(x, 9) for x in features.FEATURE_COLS]).collect())
    assert figures(alone) == figures(cfg)


def test_failure_halts_the_job(spark, cfg, tmp_path):
    broken = medallion.Config(source=str(tmp_path / "missing.csv"),
                              root=shared.work_folder(spark, "broken"))
    with pytest.raises(medallion.StageFailed, match="'ingest'") as caught:
        medallion.run(spark, broken)
    assert caught.value.__cause__ is not None
    log = table(spark, broken, "stage_log").collect()
    assert [(r["stage"], r["status"]) for r in log] == [("ingest", "FAILED")]
    assert "missing.csv" in log[0]["error"]


def test_failed_training_is_recorded(spark):
    empty = medallion.Config(source="unused", root=shared.work_folder(spark, "untrained"))
    with pytest.raises(LookupError):
        medallion.train(spark, empty)
    run = table(spark, empty, "runs").first()
    assert (run["status"], run["model_path"]) == (runs.FAILED, None)


def test_a_killed_fit_leaves_a_running_run(spark, cfg, first_log, monkeypatch):
    def killed(*args):
        raise KeyboardInterrupt  # as from outside: the job notes nothing more

    job = medallion.Config(source=cfg.source, root=cfg.root, rows_per_chunk=40)
    before = runs.latest(table(spark, job, "runs"), job.experiment).first()["run_id"]
    monkeypatch.setattr(medallion.model, "train", killed)
    with pytest.raises(KeyboardInterrupt):
        medallion.train(spark, job)
    all_runs = table(spark, job, "runs")
    newest = runs.latest(all_runs, job.experiment, finished_only=False).first()
    assert newest["status"] == runs.RUNNING and newest["params"]["k_clusters"] == "3"
    assert runs.latest(all_runs, job.experiment).first()["run_id"] == before


def test_features_follow_the_time_zone_and_the_table(spark, cfg, first_log):
    job = medallion.Config(source=cfg.source, root=shared.work_folder(spark, "zones"))
    rows = table(spark, cfg, "silver")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    tables.replace(rows, job.path("silver"))
    medallion.stored_features(spark, job)
    medallion.stored_features(spark, job)
    assert tables.latest_version(spark, job.path("features")) == 0
    far = medallion.Config(source=cfg.source, root=job.root, time_zone="America/New_York")
    medallion.stored_features(spark, far)
    assert tables.latest_version(spark, job.path("features")) == 1
    # The same version number of a table made anew.
    other = f"{job.root}/other"
    tables.replace(rows.limit(5), other)
    where = spark._jvm.org.apache.hadoop.fs.Path(job.path("silver"))
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(where, True)
    files.rename(spark._jvm.org.apache.hadoop.fs.Path(other), where)
    assert medallion.stored_features(spark, far).count() == 5


def test_only_the_months_of_a_load_are_rewritten(spark, cfg):
    job = medallion.Config(source="unused", root=shared.work_folder(spark, "months"))
    days = spark.range(60).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 86400).alias(KEY),
        *[F.lit(1.0).alias(c) for c in TELEMETRY.names[1:]],
    )
    for part in (days, days.filter("time_tag >= '2024-02-10'")):
        tables.replace(part, job.path("bronze"), allow_schema_change=True)
        medallion.clean(spark, job)
    folders = tables._folders(spark, job.path("silver"), tables._newest(spark, job.path("silver")))
    own = {f.rsplit("=", 1)[-1]: f.startswith("v=1-") for f in folders}
    assert own == {"2024-01-01": False, "2024-02-01": True}
    assert table(spark, job, "silver").count() == 60


def test_over_budget_is_flagged(spark, cfg):
    slow = medallion.Stage("nothing", lambda s, c: 0, -1)
    entry = medallion.run(spark, cfg, [slow]).first()
    assert entry["over_budget"] is True and entry["status"] == "FINISHED"


# --------------------------------------------------- months that changed only


def hourly(spark, first, n, speed):
    """Readings an hour apart from a second of 1970 on."""
    at = F.timestamp_seconds(F.lit(first) + F.col("id") * 3600)
    noise = F.pmod(F.xxhash64("id"), F.lit(100)) / 10
    return spark.range(n).select(
        at.alias(KEY),
        (F.lit(float(speed)) + noise).alias("solar_wind_speed"),
        *[(noise * (i + 1)).alias(c) for i, c in enumerate(TELEMETRY.names[2:])],
    )


JANUARY, MARCH = 1704067200, 1709251200  # the first instants of them in 2024, UTC


def loaded(spark, job, rows):
    tables.replace(rows, job.path("bronze"), allow_schema_change=True)
    return medallion.clean(spark, job)


def entries(spark, path, version=None):
    return set(tables._folders(spark, path, tables._commit_row(spark, path, version)))


@pytest.mark.parametrize(
    "zone, rows_per_chunk, n_months",
    [("UTC", 10**9, 1), ("UTC", 50, 1), ("Asia/Tokyo", 10**9, 2), ("America/New_York", 50, 2)],
)
def test_only_changed_months_of_features_are_built(
    spark, monkeypatch, zone, rows_per_chunk, n_months
):
    job = medallion.Config(source="", root=shared.work_folder(spark, "changed"),
                           time_zone=zone, rows_per_chunk=rows_per_chunk)
    build = medallion.in_time_zone(lambda s, c: medallion.stored_features(s, c).count())
    loaded(spark, job, hourly(spark, JANUARY, 24 * 150, 300))
    assert build(spark, job) == 3600
    before = entries(spark, job.path("features"))
    read = []
    asked = features.build
    monkeypatch.setattr(
        medallion.features, "build", lambda df, **kw: read.append(df.count()) or asked(df, **kw)
    )
    # All of March anew, at another speed: a month of UTC, parts of two elsewhere.
    loaded(spark, job, hourly(spark, MARCH, 24 * 31, 400))
    assert build(spark, job) == 3600
    assert read and read[0] <= 24 * 31 * n_months
    after = entries(spark, job.path("features"))
    assert len(before - after) == n_months
    assert build(spark, job) == 3600 and len(read) == 1  # stored for this version
    full = medallion.in_time_zone(
        lambda s, c: tables.checksum(rounded(asked(tables.read(s, c.path("silver")))))
    )
    stored = rounded(tables.read(spark, job.path("features")))
    assert tables.checksum(stored) == full(spark, job)
    # A load of nothing new; then a new month.
    loaded(spark, job, hourly(spark, MARCH, 24 * 31, 400).limit(0))
    assert build(spark, job) == 3600
    loaded(spark, job, hourly(spark, JANUARY + 86400 * 150, 24 * 40, 500))
    assert build(spark, job) == 3600 + 960
    stored = rounded(tables.read(spark, job.path("features")))
    assert tables.checksum(stored) == full(spark, job)


def rounded(df):
    return df.select(KEY, *[(F.round(c, 6) + 0.0).alias(c) for c in features.FEATURE_COLS])


def test_features_of_another_history_are_built_whole(spark):
    """No change set: silver not by month, silver made anew, features stored otherwise."""
    root = shared.work_folder(spark, "anew")
    job = medallion.Config(source="", root=root)
    rows = hourly(spark, JANUARY, 24 * 70, 300)
    loaded(spark, job, rows)
    medallion.stored_features(spark, job)
    tables.replace(tables.read(spark, job.path("features")), job.path("features"))
    loaded(spark, job, hourly(spark, MARCH, 5, 1))
    assert medallion.stored_features(spark, job).count() == 24 * 70
    tables.replace(tables.read(spark, job.path("silver")).limit(9), job.path("silver"))
    assert medallion.stored_features(spark, job).count() == 9
    plain = medallion.Config(source="", root=root, silver_period=None)
    loaded(spark, plain, hourly(spark, MARCH, 30, 1))
    silver = tables.read(spark, job.path("silver"))
    assert medallion.stored_features(spark, plain).count() == silver.count()


def test_figures_are_taken_of_changed_months_only(spark, monkeypatch):
    job = medallion.Config(source="", root=shared.work_folder(spark, "figures"),
                           merge_figures=True)
    loaded(spark, job, hourly(spark, JANUARY, 24 * 150, 300))
    rows = medallion.stored_features(spark, job)
    medallion._scaler(spark, job, rows)
    read = []
    asked = medallion.figures.by_part
    monkeypatch.setattr(
        medallion.figures, "by_part", lambda df, *a: read.append(df.count()) or asked(df, *a)
    )
    medallion._scaler(spark, job, rows)
    assert read == []
    loaded(spark, job, hourly(spark, MARCH, 24 * 31, 400))
    rows = medallion.stored_features(spark, job)
    found = medallion._scaler(spark, job, rows)
    assert read == [24 * 31]
    whole = medallion.model.fit_scaler(medallion.model.assemble(rows))
    for a, b in ((found.mean, whole.mean), (found.std, whole.std)):
        assert all(abs(x - y) <= 1e-9 * max(1, abs(y)) for x, y in zip(a, b, strict=True))
    assert medallion.train(spark, job) == 3600


def test_clusters_keep_their_numbers_from_run_to_run(spark, cfg):
    job = medallion.Config(source=cfg.source, root=shared.work_folder(spark, "numbers"),
                           keep_numbers=True)
    medallion.ingest(spark, job)
    medallion.clean(spark, job)
    found = []
    for seed in (25, 3):
        medallion.train(spark, dataclasses.replace(job, seed=seed))
        found.append(runs.load_model(spark, job.path("runs"), job.experiment))
    old, new = map(medallion.model.centers, found)
    std = [s or 1.0 for s in found[0].stages[0].std.toArray()]

    def apart(a, b):
        return sum(((x - y) / s) ** 2 for x, y, s in zip(a, b, std, strict=True))

    totals = {
        p: sum(apart(new[c], old[n]) for c, n in enumerate(p))
        for p in itertools.permutations(range(3))
    }
    assert totals[0, 1, 2] == min(totals.values())
    assert medallion.score(spark, job) == 300


# ------------------------------------------------------------ one scan, options


def test_bronze_is_scanned_once(spark, monkeypatch):
    job = medallion.Config(source="", root=shared.work_folder(spark, "once"))
    bad = hourly(spark, MARCH, 10, -900)
    tables.replace(hourly(spark, JANUARY, 90, 300).unionByName(bad), job.path("bronze"))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    asked = tables.read
    monkeypatch.setattr(
        medallion.tables, "read",
        lambda s, p, *a: asked(s, p, *a).mapInArrow(count, asked(s, p, *a).schema)
        if p.endswith("bronze") else asked(s, p, *a),
    )
    assert medallion.clean(spark, job) == 90
    assert seen.value == 100
    quarantine = asked(spark, job.path("quarantine"))
    assert quarantine.columns == [*TELEMETRY.names, "quarantine_reason", "_quarantined_at"]
    assert quarantine.count() == 10
    assert {r[0] for r in quarantine.select("quarantine_reason").collect()} == {
        "Negative Solar Wind Speed Value"
    }
    assert asked(spark, job.path("silver")).columns == TELEMETRY.names


def test_quarantine_once(spark):
    job = medallion.Config(source="", root=shared.work_folder(spark, "once"),
                           quarantine_once=True)
    bad = hourly(spark, MARCH, 10, -900).unionByName(
        hourly(spark, MARCH, 2, 1).withColumn(KEY, F.lit(None).cast("timestamp"))
    )
    rows = hourly(spark, JANUARY, 20, 300).unionByName(bad)
    for n in (12, 12):
        stamped = rows.withColumn("_ingested_at", F.current_timestamp())
        assert loaded(spark, job, stamped) == 20
        assert tables.read(spark, job.path("quarantine")).count() == n
    more = rows.unionByName(hourly(spark, MARCH + 10**6, 1, -900))
    loaded(spark, job, more.withColumn("_ingested_at", F.current_timestamp()))
    assert tables.read(spark, job.path("quarantine")).count() == 13


def test_malformed_rows_reach_quarantine(spark, tmp_path):
    good = "2024-01-01 00:0{}:00,400,5,6,-1,10000"
    lines = ["a,b,c,d,e,f", *[good.format(i) for i in range(5)]]
    lines += ["2024-01-01 00:05:00,4OO,5,6,-1,10000", "2024-01-01 00:06:00,,5,6,-1,10000"]
    (tmp_path / "in.csv").write_text("\n".join(lines))
    job = medallion.Config(source=str(tmp_path / "in.csv"), keep_malformed=True,
                           root=shared.work_folder(spark, "malformed"))
    assert medallion.ingest(spark, job) == 7
    assert medallion.clean(spark, job) == 5
    found = table(spark, job, "quarantine").select("quarantine_reason", "_malformed").collect()
    assert {tuple(r) for r in found} == {
        ("Malformed Row", "2024-01-01 00:05:00,4OO,5,6,-1,10000"),
        ("Null Solar Wind Speed Measurement", None),
    }
    assert table(spark, job, "silver").columns == [*TELEMETRY.names, "_ingested_at"]

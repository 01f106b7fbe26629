"""The batch job: file -> bronze -> silver / quarantine -> features -> model -> gold.

Stages hand data on through tables only, so each can be run, or run again, by
itself under any scheduler.
"""

from __future__ import annotations

import functools
import re
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StandardScalerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators import dedupe, features, figures, gate, model
from strandline.plans import limits
from strandline.sources import records, runs, scan, tables
from strandline.sources.schemas import KEY


@dataclass(frozen=True)
class Config:
    """Where things are, and the settings of a job. ``root`` is shared storage."""

    source: str | list[str]
    root: str
    experiment: str = "anomaly-clusters"
    run_name: str = "kmeans_anomaly"
    clusters: int = model.CLUSTERS
    seed: int = model.SEED
    rules: tuple[gate.Rule, ...] = gate.RULES
    rows_per_chunk: int = features.ROWS_PER_CHUNK
    rows_per_file: int = tables.ROWS_PER_FILE
    silver_period: str | None = "month"  # silver files are kept, and rewritten, by it
    keep_malformed: bool = False  # text and reason of rows with cells that do not parse
    quarantine_once: bool = False  # a failing row that is loaded again is not added again
    keep_numbers: bool = False  # clusters keep the numbers of the last finished run's
    merge_figures: bool = False  # mean and deviation from stored figures of the months
    time_zone: str = "UTC"  # of the instants in the file, and where a month begins

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


@dataclass(frozen=True)
class Stage:
    """``budget_seconds`` is the time after which it is stopped; 0 or less is no limit."""

    name: str
    work: Callable[[SparkSession, Config], int]
    budget_seconds: int


class StageFailed(RuntimeError):
    """A stage failed, and the ones after it did not run."""


def in_time_zone(
    work: Callable[[SparkSession, Config], int]
) -> Callable[[SparkSession, Config], int]:
    """Run a stage in the job's time zone and leave the session's as it was."""

    @functools.wraps(work)
    def stage(spark: SparkSession, cfg: Config) -> int:
        before = spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", cfg.time_zone)
        try:
            return work(spark, cfg)
        finally:
            spark.conf.set("spark.sql.session.timeZone", before)

    return stage


@in_time_zone
def ingest(spark: SparkSession, cfg: Config) -> int:
    """Replace bronze by the typed file, stamped with the load time."""
    malformed = gate.MALFORMED.column if cfg.keep_malformed else None
    rows = scan.read_typed_csv(spark, cfg.source, malformed_col=malformed)
    loaded = scan.stamp(rows, "_ingested_at")
    return tables.replace(loaded, cfg.path("bronze"), "ingest", allow_schema_change=True)


@in_time_zone
def clean(spark: SparkSession, cfg: Config) -> int:
    """Append failing rows to quarantine, upsert the others into silver.

    Bronze is scanned once: one write parts it by the gate's verdict, the failing side is
    the append, and the passing side goes on to silver. All counts come from the writes.
    With ``quarantine_once`` only failures that quarantine does not hold yet, in all
    columns but the load stamps, are added; bronze is then scanned once for either side.
    """
    bronze = tables.read(spark, cfg.path("bronze"))
    rules = cfg.rules
    if gate.MALFORMED.column in bronze.columns:
        rules = (gate.MALFORMED, *rules)
    names = [c for c in bronze.columns if c != gate.MALFORMED.column]
    stamps = ["_ingested_at", "_quarantined_at"]
    path = cfg.path("quarantine")
    if cfg.quarantine_once:
        passed, failed = gate.split(bronze, rules)
        tables.append_new(scan.stamp(failed, stamps[1]), path, stamps, "quarantine")
        return _into_silver(spark, cfg, passed.select(*names))
    judged = scan.stamp(gate.judged(bronze, rules), stamps[1])
    failing = F.col("quarantine_reason").isNotNull()
    with tables.appending(judged, path, failing, "quarantine") as (_, passed):
        return _into_silver(spark, cfg, passed.select(*names))


def _into_silver(spark: SparkSession, cfg: Config, passed: DataFrame) -> int:
    unique = dedupe.one_per_key(passed, [KEY])
    return tables.upsert(
        unique, cfg.path("silver"), [KEY], cfg.silver_period, unique_source=True
    )


def stored_features(spark: SparkSession, cfg: Config) -> DataFrame:
    """The feature table of the newest silver version, built on first use.

    Training reads it several times and scoring once more, so the window work is done and
    written once per silver version, as told by when it was written, and time zone, which
    says where months begin.

    Windows restart each month, so where silver keeps its files by month and an earlier
    version's features are stored, only the months whose silver files changed since then
    are read and built again; the other months' features are taken over.
    """
    silver, path = cfg.path("silver"), cfg.path("features")
    origin = _origin(tables.fingerprint(spark, silver), cfg)
    done = None
    if tables.exists(spark, path):
        done = tables.history(spark, path).first()["operation"]
        if done == origin:
            return tables.read(spark, path)
    months = None if done is None else _changed_months(spark, cfg, done)
    if months is None:
        rows = tables.read(spark, silver)
        cuts = _cuts(spark, cfg, rows)
        split = tables.Split(KEY, "month", local=True, gather=bool(cuts))
        built = features.build(rows, cuts=cuts)
        tables.replace(built, path, origin, split=split)
    else:
        _rebuild(spark, cfg, months, origin)
    return tables.read(spark, path)


def _origin(fingerprint: str, cfg: Config) -> str:
    return f"features of silver {fingerprint}, months of {cfg.time_zone}"


def _cuts(spark: SparkSession, cfg: Config, rows: DataFrame) -> Sequence[int]:
    if tables.row_count(spark, cfg.path("silver")) <= cfg.rows_per_chunk:
        return ()
    return features.cut_points(rows, rows_per_chunk=cfg.rows_per_chunk)


def _changed_months(spark: SparkSession, cfg: Config, done: str) -> list[str] | None:
    """First days, in the job's zone, of the months that may differ from those of the
    stored features; None if these are not of an earlier state of this very silver."""
    silver, path = cfg.path("silver"), cfg.path("features")
    version = re.match(r"features of silver version (\d+) in ", done)
    if version is None or cfg.silver_period != "month":
        return None
    since = int(version[1])
    try:
        if done != _origin(tables.fingerprint(spark, silver, since), cfg):
            return None
    except LookupError:
        return None
    stored = tables.changed_parts(
        spark, path, tables.latest_version(spark, path), tables.Split(KEY, "month", local=True)
    )
    changed = tables.changed_parts(spark, silver, since, tables.Split(KEY, "month"))
    if stored is None or changed is None:
        return None
    return _overlapping(spark, changed, "UTC", cfg.time_zone)


def _rebuild(spark: SparkSession, cfg: Config, months: Sequence[str], origin: str) -> None:
    """Replace the features of some months of the job's zone."""
    # Silver's files are by month of UTC: those that hold rows of the wanted months.
    parts = _overlapping(spark, months, cfg.time_zone, "UTC")
    month = F.trunc(F.col(KEY).cast("date"), "month").cast("string")
    rows = tables.read_parts(
        spark, cfg.path("silver"), tables.Split(KEY, "month"), parts
    ).filter(month.isin(list(months)))
    cuts = _cuts(spark, cfg, rows)
    split = tables.Split(KEY, "month", local=True, gather=bool(cuts))
    built = features.build(rows, cuts=cuts)
    tables.replace_parts(built, cfg.path("features"), split, months, origin)


def _overlapping(
    spark: SparkSession, months: Sequence[str], zone: str, other: str
) -> list[str]:
    """First days of the months of the other zone that share an instant with these."""
    if zone == other:
        return list(months)
    time_ = spark._jvm.java.time
    here, there = time_.ZoneId.of(zone), time_.ZoneId.of(other)
    found = set()
    for month in months:
        if not re.match(r"\d{4}-\d\d-01$", month):  # rows without an instant have no month
            continue
        first = time_.LocalDate.parse(month)
        ends = first.atStartOfDay(here), first.plusMonths(1).atStartOfDay(here).minusNanos(1000)
        for end in ends:
            found.add(end.withZoneSameInstant(there).toLocalDate().withDayOfMonth(1).toString())
    return sorted(found)


@in_time_zone
def train(spark: SparkSession, cfg: Config) -> int:
    """Fit and evaluate a model, record the run, write the evaluation table."""
    run = {
        "run_id": runs.new_run_id(),
        "experiment": cfg.experiment,
        "run_name": cfg.run_name,
        "start_time": datetime.now(timezone.utc),
        # Names of parameters and metrics.
        "params": {
            "k_clusters": cfg.clusters,
            "seed": cfg.seed,
            "feature_columns": list(features.FEATURE_COLS),
        },
    }
    runs.record(spark, cfg.path("runs"), **run, status=runs.RUNNING)
    try:
        rows = stored_features(spark, cfg)
        scaler = _scaler(spark, cfg, rows) if cfg.merge_figures else None
        earlier = _earlier_model(spark, cfg) if cfg.keep_numbers else None
        trained = model.train(rows, cfg.clusters, cfg.seed, scaler, earlier)
        saved = runs.save_model(trained.model, f"{cfg.path('models')}/{run['run_id']}")
    except Exception:
        runs.record(spark, cfg.path("runs"), **run, status=runs.FAILED)
        raise
    runs.record(
        spark,
        cfg.path("runs"),
        **run,
        metrics={"silhouette_score": trained.silhouette},
        model_path=saved,
    )
    return tables.replace(model.score(trained.model, rows), cfg.path("training_eval"))


def _earlier_model(spark: SparkSession, cfg: Config) -> PipelineModel | None:
    found = runs.latest(runs.read(spark, cfg.path("runs")), cfg.experiment).first()
    path = None if found is None else found["model_path"]
    return None if path is None else PipelineModel.load(path)


def _scaler(spark: SparkSession, cfg: Config, rows: DataFrame) -> StandardScalerModel:
    """The scaler of the stored features, from figures kept per month: only months whose
    features changed since the figures were stored are read."""
    path = cfg.path("features")
    split = tables.Split(KEY, "month", local=True)
    month = F.trunc(F.col(KEY).cast("date"), "month")
    kept = cfg.path("feature_figures")
    origin = f"figures of features {tables.fingerprint(spark, path)}"
    done = tables.history(spark, kept).first()["operation"] if tables.exists(spark, kept) else ""
    if done != origin:
        months = _months_since(spark, path, done, split)
        if months is None:
            found = figures.by_part(rows, features.FEATURE_COLS, month)
        else:
            changed = tables.read_parts(spark, path, split, months)
            others = tables.read(spark, kept).filter(~F.col("part").isin(months))
            found = others.unionByName(figures.by_part(changed, features.FEATURE_COLS, month))
        tables.replace(found.coalesce(1), kept, origin)  # a row per month
    return figures.scaler(figures.merged(tables.read(spark, kept)), rows)


def _months_since(
    spark: SparkSession, path: str, done: str, split: tables.Split
) -> list[str] | None:
    """Months of the features that changed since those that ``done`` names."""
    version = re.match(r"figures of features version (\d+) in ", done)
    if version is None:
        return None
    try:
        since = int(version[1])
        if done != f"figures of features {tables.fingerprint(spark, path, since)}":
            return None
    except LookupError:
        return None
    return tables.changed_parts(spark, path, since, split)


@in_time_zone
def score(spark: SparkSession, cfg: Config) -> int:
    """Score with the latest run's model, lay gold out by time, note its row counts."""
    fitted = runs.load_model(spark, cfg.path("runs"), cfg.experiment)
    gold = cfg.path("gold")
    tables.replace(model.score(fitted, stored_features(spark, cfg)), gold)
    n_rows = tables.cluster_by(spark, gold, KEY, rows_per_file=cfg.rows_per_file)
    tables.audit(spark, gold).write.mode("append").parquet(cfg.path("gold_audit"))
    return n_rows


# Order of the stages and seconds allowed for each.
STAGES = (
    Stage("ingest", ingest, 600),
    Stage("clean", clean, 600),
    Stage("train", train, 1200),
    Stage("score", score, 900),
)

STAGE_LOG = (
    "run_id string, stage string, status string, seconds double, budget_seconds int, "
    "over_budget boolean, n_rows long, error string"
)


def run(
    spark: SparkSession,
    cfg: Config,
    stages: Sequence[Stage] = STAGES,
    enforce: bool = True,
    grace: float = limits.GRACE_SECONDS,
) -> DataFrame:
    """Run the stages in order and return this run's part of the stage log.

    The first failure is logged and raised as :class:`StageFailed`, and the
    rest does not run. A stage over its budget is stopped, its Spark jobs with it, and
    fails; see :func:`limits.within` for ``grace``. What it had half written has no
    commit, so its tables are as before. With ``enforce`` off, budgets are only noted.
    """
    run_id = uuid.uuid4().hex
    for stage in stages:
        begun = time.monotonic()
        n_rows = failure = None
        try:
            call = functools.partial(stage.work, spark, cfg)
            limit = stage.budget_seconds if enforce else 0
            n_rows = limits.within(spark, limit, call, grace)
        except Exception as error:
            failure = error
        seconds = round(time.monotonic() - begun, 2)
        entry = (
            run_id,
            stage.name,
            runs.FINISHED if failure is None else runs.FAILED,
            seconds,
            stage.budget_seconds,
            seconds > stage.budget_seconds,
            n_rows,
            None if failure is None else str(failure),
        )
        records.add(spark, cfg.path("stage_log"), STAGE_LOG, entry)
        if failure is not None:
            raise StageFailed(f"stage {stage.name!r} failed after {seconds} s") from failure
    return stage_log(spark, cfg).filter(f"run_id = '{run_id}'")


def stage_log(spark: SparkSession, cfg: Config) -> DataFrame:
    """All runs' stages."""
    return records.stored(spark, cfg.path("stage_log"), STAGE_LOG)

"""Training runs: rows of small files, and the models they saved.

A run has a row when it starts and another when it ends; the later one counts.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.sources import records

RUNS = (
    "run_id string, experiment string, run_name string, start_time timestamp, status string, "
    "params map<string,string>, metrics map<string,double>, model_path string"
)
RUNNING, FINISHED, FAILED = "RUNNING", "FINISHED", "FAILED"


def new_run_id() -> str:
    return uuid.uuid4().hex


def record(
    spark: SparkSession,
    path: str,
    *,
    run_id: str,
    experiment: str,
    run_name: str,
    start_time: datetime,
    status: str = FINISHED,
    params: Mapping[str, object] | None = None,
    metrics: Mapping[str, float] | None = None,
    model_path: str | None = None,
) -> None:
    """Append one run. Parameters that are not text are stored as JSON."""
    texts = {k: v if isinstance(v, str) else json.dumps(v) for k, v in (params or {}).items()}
    row = (
        run_id, experiment, run_name, start_time, status, texts, dict(metrics or {}), model_path,
    )
    records.add(spark, path, RUNS, row)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per run: how it ended, or that it has not."""
    rows = records.stored(spark, path, RUNS)
    ended = F.max_by(F.struct(*rows.columns), F.col("status") != RUNNING).alias("run")
    return rows.groupBy("run_id").agg(ended).select("run.*")


def latest(runs: DataFrame, experiment: str, finished_only: bool = True) -> DataFrame:
    """The newest run of an experiment by start time (then run id): one row or none.

    ``finished_only=False`` also takes a run that failed before it had a model, or that
    still runs.
    """
    wanted = runs.filter(F.col("experiment") == experiment)
    if finished_only:
        wanted = wanted.filter(F.col("status") == FINISHED)
    return wanted.orderBy(F.desc("start_time"), "run_id").limit(1)


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(
    spark: SparkSession, path: str, experiment: str, finished_only: bool = True
) -> PipelineModel:
    """Model of the latest run in the table at ``path``."""
    found = latest(read(spark, path), experiment, finished_only).first()
    if found is None or found["model_path"] is None:
        raise LookupError(f"no run with a model for experiment {experiment!r} at {path}")
    return PipelineModel.load(found["model_path"])

"""Time limits end Spark work, and only that of the one stage."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from strandline import medallion, runs, shared, tables
from strandline.plans import limits

WAIT = "java_method('java.util.concurrent.locks.LockSupport', 'parkNanos', 20000000L)"


def crawl(spark, n=20_000):
    """Hours of work, a row at a time."""
    return spark.range(0, n, 1, 4).filter(F.expr(WAIT).isNotNull()).count()


def active(spark):
    return list(spark.sparkContext.statusTracker().getActiveJobsIds())


def test_result_and_error_come_through(spark):
    assert limits.within(spark, 60, lambda: spark.range(7).count()) == 7
    assert limits.within(spark, 0, lambda: 5) == limits.within(spark, -1, lambda: 5) == 5
    with pytest.raises(KeyError):
        limits.within(spark, 60, lambda: {}["x"])


def test_spark_work_is_stopped(spark):
    begun = time.monotonic()
    with pytest.raises(limits.OverLimit, match="over budget: stopped after") as caught:
        limits.within(spark, 1, lambda: crawl(spark))
    assert time.monotonic() - begun < 10
    assert caught.value.__cause__ is not None  # the action's own error
    assert active(spark) == []
    assert spark.range(3).count() == 3


def test_other_threads_go_on(spark):
    found = []
    other = threading.Thread(target=lambda: found.append(crawl(spark, 400)))
    other.start()
    with pytest.raises(limits.OverLimit):
        limits.within(spark, 0.5, lambda: crawl(spark))
    other.join()
    assert found == [400]


def test_work_that_catches_its_error_cannot_go_on(spark):
    calls, stop, ended = [], threading.Event(), threading.Event()

    def stubborn():
        while not stop.is_set():
            try:
                crawl(spark)
            except Exception:
                calls.append(time.monotonic())
        ended.set()

    with pytest.raises(limits.OverLimit):
        limits.within(spark, 0.5, stubborn, grace=1)
    deadline = time.monotonic() + 60
    while len(calls) < 3 and time.monotonic() < deadline:
        time.sleep(0.1)
    assert len(calls) >= 3  # each further job was ended too
    stop.set()
    assert ended.wait(60)


def test_work_outside_of_spark_is_left(spark):
    woken = threading.Event()
    begun = time.monotonic()
    with pytest.raises(limits.OverLimit):
        limits.within(spark, 0.2, lambda: woken.wait(60), grace=0.3)
    assert time.monotonic() - begun < 5
    woken.set()


def test_stage_over_its_limit_fails_and_halts_the_job(spark):
    cfg = medallion.Config(source="", root=shared.work_folder(spark, "limited"))
    ran = []
    stages = [
        medallion.Stage("quick", lambda s, c: s.range(4).count(), 60),
        medallion.Stage("slow", lambda s, c: crawl(s), 1),
        medallion.Stage("later", lambda s, c: ran.append(1), 60),
    ]
    with pytest.raises(medallion.StageFailed, match="'slow'"):
        medallion.run(spark, cfg, stages)
    assert active(spark) == [] and ran == []
    log = {r["stage"]: r for r in medallion.stage_log(spark, cfg).collect()}
    assert set(log) == {"quick", "slow"}
    assert (log["quick"]["status"], log["quick"]["n_rows"]) == (runs.FINISHED, 4)
    assert (log["slow"]["status"], log["slow"]["over_budget"]) == (runs.FAILED, True)
    assert log["slow"]["error"].startswith("over budget: stopped after")


def test_stopped_write_leaves_the_table_and_the_run_record(spark, monkeypatch):
    """A write cut short has no commit; a fit cut short is recorded as failed."""
    path = f"{shared.work_folder(spark, 'limited')}/t"
    tables.replace(spark.range(5), path)
    slow = spark.range(0, 20_000, 1, 4).filter(F.expr(WAIT).isNotNull())
    with pytest.raises(limits.OverLimit):
        limits.within(spark, 1, lambda: tables.replace(slow, path))
    assert tables.latest_version(spark, path) == 0
    assert tables.read(spark, path).count() == 5
    tables.replace(spark.range(6), path)
    assert tables.read(spark, path).count() == 6

    cfg = medallion.Config(source="", root=shared.work_folder(spark, "limited"))
    monkeypatch.setattr(medallion, "stored_features", lambda s, c: crawl(s))
    with pytest.raises(limits.OverLimit):
        limits.within(spark, 2, lambda: medallion.train(spark, cfg))
    record = runs.read(spark, cfg.path("runs")).first()
    assert (record["status"], record["model_path"]) == (runs.FAILED, None)


def test_limits_can_be_only_noted(spark):
    cfg = medallion.Config(source="", root=shared.work_folder(spark, "noted"))
    stages = [medallion.Stage("slow", lambda s, c: crawl(s, 300), 1)]
    log = medallion.run(spark, cfg, stages, enforce=False).first()
    assert (log["status"], log["over_budget"], log["n_rows"]) == (runs.FINISHED, True, 300)

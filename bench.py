"""Seconds per headline operator on the driver's tables; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores. Each figure is the
median of BENCH_RUNS runs (default 5) in a warm session. Results go to a sink
that evaluates every row and column and keeps none.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import queries as q  # noqa: E402
from strandline import dedupe, features, gate, medallion  # noqa: E402
from strandline import model, scan, shared, tables, upsert  # noqa: E402
from strandline.sources.schemas import KEY, MEASURES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
MONTH_ROWS = int(os.environ.get("BENCH_MONTH_ROWS", "2000000"))
RUNS = int(os.environ.get("BENCH_RUNS", "5"))


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def exchanges(df: DataFrame) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString()
    kinds = ("Exchange hash", "Exchange range", "Exchange Single")
    return sum(any(kind in line for kind in kinds) for line in plan.splitlines())


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = shared.work_folder(spark, "bench")

    # What each stage finds stored. The readings are derived from the events.
    bronze, silver = f"{root}/bronze", f"{root}/silver"
    stored, gold = f"{root}/features", f"{root}/gold"
    tables.replace(q.telemetry(spark, SF_DIR), bronze)
    readings = tables.read(spark, bronze)
    tables.replace(q.silver(spark, SF_DIR), silver)
    clean = tables.read(spark, silver)
    tables.replace(features.build(clean), stored)
    rows = tables.read(spark, stored)
    trained = model.train(rows)
    tables.replace(model.score(trained.model, rows), gold)
    source = q._as_csv(spark, SF_DIR, "source")

    def gate_and_quarantine() -> None:
        for side in gate.split(readings):
            drain(side)

    def deduped() -> DataFrame:
        return dedupe.one_per_key(readings.filter(gate.valid()), ["time_tag"], ["event_id"])

    def whole_job() -> None:
        medallion.run(
            spark, medallion.Config(source=source, root=shared.work_folder(spark, "medallion"))
        )

    # One month with many rows, laid out by time, and a late load for it.
    month, hot = f"{root}/month", spark.range(MONTH_ROWS).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * (2_592_000 / MONTH_ROWS)).alias(KEY),
        *[(F.col("id") * (i + 3) % 1009).cast("double").alias(c) for i, c in enumerate(MEASURES)],
    )
    tables.replace(hot, month)
    tables.cluster_by(spark, month, KEY, files=16)
    month_rows = tables.read(spark, month)
    late = month_rows.filter(F.col(KEY) >= "2024-01-30 12:00:00")
    month_cuts = features.cut_points(month_rows, rows_per_chunk=MONTH_ROWS // 32)
    loads = iter(range(10**6))

    def month_upsert() -> None:
        target = f"{root}/month-{next(loads)}"
        tables.replace(month_rows, target)
        tables.cluster_by(spark, target, KEY, files=16)
        begun = time.perf_counter()
        tables.upsert(late, target, [KEY])
        taken_by_itself.append(time.perf_counter() - begun)

    taken_by_itself: list[float] = []
    small_cuts = features.cut_points(clean, rows_per_chunk=q.SMALL_CHUNK)
    work = {
        "typed_csv": lambda: drain(scan.read_typed_csv(spark, source)),
        "gate_quarantine": gate_and_quarantine,
        "dedupe": lambda: drain(deduped()),
        "upsert": lambda: drain(q.upsert_orders(spark, SF_DIR)),
        "table_upsert": lambda: drain(q.table_upsert(spark, SF_DIR)),
        "cut_points": lambda: features.cut_points(clean),
        "features": lambda: drain(features.build(clean, cuts=())),
        "features_chunked": lambda: drain(features.build(clean, cuts=small_cuts)),
        "month_cut_points": lambda: features.cut_points(
            month_rows, rows_per_chunk=MONTH_ROWS // 32
        ),
        "month_features": lambda: drain(features.build(month_rows)),
        "month_features_chunked": lambda: drain(features.build(month_rows, cuts=month_cuts)),
        "month_upsert": month_upsert,
        "train": lambda: model.train(rows),
        "score": lambda: drain(model.score(trained.model, rows)),
        "cluster_layout": lambda: tables.cluster_by(spark, gold, "time_tag", files=4),
        "audit": lambda: drain(tables.audit(spark, gold)),
        "feature_table": lambda: drain(q.feature_table(spark, SF_DIR)),
        "whole_job": whole_job,
    }
    seconds = {}
    for name, once in work.items():
        once()
        taken = []
        for _ in range(RUNS):
            begun = time.perf_counter()
            once()
            taken.append(time.perf_counter() - begun)
        if name == "month_upsert":
            taken = taken_by_itself[1:]  # without making its table
        seconds[name] = round(statistics.median(taken), 3)

    plans = {
        "gate_quarantine": gate.quarantine(readings),
        "dedupe": deduped(),
        "upsert": q.upsert_orders(spark, SF_DIR),
        "features": features.build(clean, cuts=()),
        "features_chunked": features.build(clean, cuts=small_cuts),
        "feature_table": q.feature_table(spark, SF_DIR),
        "cluster_layout": clean.repartitionByRange(4, KEY),
        "table_upsert": upsert.unmatched(
            month_rows, late, [KEY], (F.lit("2024-01-30 12:00:00").cast("timestamp"),
                                      F.lit("2024-01-31").cast("timestamp"))
        ),
        "score": model.score(trained.model, rows),
        "audit": tables.audit(spark, gold),
    }
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR).removeprefix("sf"),
                "exchanges": {name: exchanges(df) for name, df in plans.items()},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

"""One query per operator, over whole tables.

Derived doubles are rounded to 6 places and timestamps returned without a zone,
so that both engines print the same values.
"""

from __future__ import annotations

from datetime import datetime, timezone
from itertools import permutations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, TimestampType

from strandline import columns, dedupe, features, figures, gate, medallion, model, runs, scan
from strandline import shared, tables, upsert
from strandline.sources.records import one_row
from strandline.sources.schemas import KEY, TELEMETRY

# Small enough to cut the months of the test tables into many chunks.
SMALL_CHUNK = 200
LOADED_AT = datetime(2024, 3, 1, 12, 0, tzinfo=timezone.utc)
URGENT = "1-URGENT"
CENTERS = tuple(tuple(c * (1 + i / 16) for i in range(16)) for c in (-0.5, 0.0, 0.5))


# ------------------------------------------------------------------ inputs


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as sensor readings with missing, negative and repeated ones."""
    event, user = F.col("event_id"), F.col("user_id")
    k = F.get_json_object("props", "$.k").cast("double")

    def unless(every: int, value):
        return F.when(event % every != 0, value)

    minute = (F.date_trunc("minute", "ts") + F.expr("INTERVAL 15 DAYS")).cast("timestamp")
    speed = F.when(event % 89 == 0, -F.col("value")).otherwise(F.lit(300.0) + F.col("value"))
    return load(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        unless(101, minute).alias(KEY),
        unless(97, speed).alias("solar_wind_speed"),
        unless(83, k / 10).alias("proton_density"),
        unless(79, (5 + user % 17).cast("double")).alias("magnetic_field_total"),
        unless(73, (user % 21 - 10).cast("double")).alias("magnetic_field_bz"),
        unless(71, (10000 + event % 13).cast("double") + 100 * k).alias("plasma_temperature"),
    )


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    passed = telemetry(spark, sf_dir).filter(gate.valid())
    return dedupe.one_per_key(passed, [KEY], order_by=["event_id"])


def cuts(spark: SparkSession, sf_dir: str, rows_per_chunk: int) -> list[int]:
    """Cut points of the raw readings: any cuts are right, and these need no dedupe."""
    return features.cut_points(telemetry(spark, sf_dir), rows_per_chunk=rows_per_chunk)


def order_changes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = load(spark, sf_dir, "orders")
    changed = orders.filter(F.col("o_orderkey") % 3 == 0)
    return (
        orders.filter(F.col("o_orderkey") % 2 == 0),
        changed.withColumn("o_totalprice", F.lit(0.0)),
    )


def printable(df: DataFrame) -> DataFrame:
    out = []
    for field in df.schema:
        col = F.col(field.name)
        if isinstance(field.dataType, DoubleType):
            col = F.round(col, 6) + F.lit(0.0)
        elif isinstance(field.dataType, TimestampType):
            col = col.cast("timestamp_ntz")
        out.append(col.alias(field.name))
    return df.select(*out)


def large_cuts(spark: SparkSession, sf_dir: str) -> list[int]:
    """Cut points at the size that production takes; none, by count, for fewer rows."""
    size = features.ROWS_PER_CHUNK
    few = load(spark, sf_dir, "events").count() <= size
    return [] if few else cuts(spark, sf_dir, size)


# ---------------------------------------------------------------- features


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return printable(features.build(silver(spark, sf_dir), cuts=large_cuts(spark, sf_dir)))


def feature_table_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table by way of the chunked plan that large months take."""
    small = cuts(spark, sf_dir, SMALL_CHUNK)
    return printable(features.build(silver(spark, sf_dir), cuts=small))


def feature_table_by_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series per user, on the chunked plan."""
    passed = telemetry(spark, sf_dir).filter(gate.valid())
    rows = dedupe.one_per_key(passed, ["user_id", KEY], order_by=["event_id"])
    series = columns.Series(entity_cols=("user_id",))
    return printable(features.build(rows, series, cuts(spark, sf_dir, SMALL_CHUNK)))


def feature_table_hot_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the users as one: that series is cut, the many small ones are not."""
    one = F.when(F.col("user_id") % 3 == 0, 0).otherwise(F.col("user_id"))
    passed = telemetry(spark, sf_dir).filter(gate.valid()).withColumn("user_id", one)
    rows = dedupe.one_per_key(passed, ["user_id", KEY], order_by=["event_id"])
    series = columns.Series(entity_cols=("user_id",))
    own = features.cut_points(passed, rows_per_chunk=SMALL_CHUNK, entity_cols=["user_id"])
    return printable(features.build(rows, series, own))


def feature_table_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings that are not numbers take the rows whose windows hold them with them."""
    nan = F.lit(float("nan"))
    holed = silver(spark, sf_dir)
    for every, name in ((61, "proton_density"), (53, "solar_wind_speed"), (47, "magnetic_field_bz")):
        holed = holed.withColumn(
            name, F.when(F.col("event_id") % every == 0, nan).otherwise(F.col(name))
        )
    return printable(features.build(holed, cuts=large_cuts(spark, sf_dir)))


def _some_features(spark: SparkSession, sf_dir: str, names) -> DataFrame:
    computed = features.compute(silver(spark, sf_dir), cuts=large_cuts(spark, sf_dir))
    return printable(computed.select(KEY, *names))


def rolling_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _some_features(spark, sf_dir, features.ROLLING_MEANS)


def rolling_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _some_features(spark, sf_dir, features.ROLLING_STDS)


def lag_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _some_features(spark, sf_dir, features.LAGS)


def delta_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _some_features(spark, sf_dir, features.DELTAS)


def month_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First row of each month, where every window has just restarted."""
    built = features.build(silver(spark, sf_dir), cuts=large_cuts(spark, sf_dir))
    row = F.min(F.struct(KEY, *features.FEATURE_COLS)).alias("row")
    month = F.date_trunc("month", KEY).alias("month")
    return printable(built.groupBy(month).agg(row).select("month", "row.*"))


def drop_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = telemetry(spark, sf_dir)
    not_a_number = F.when(F.col("event_id") % 61 == 0, F.lit(float("nan")))
    holed = rows.withColumn(
        "proton_density", F.coalesce(not_a_number, F.col("proton_density"))
    )
    return printable(features.drop_incomplete(holed))


def _later(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later load: the readings of the first month again, every third with more speed."""
    rows = silver(spark, sf_dir)
    month = F.date_trunc("month", KEY)
    first = rows.agg(F.min(month).alias("_first"))  # one row
    faster = F.when(F.col("event_id") % 3 == 0, F.col("solar_wind_speed") + 50)
    return (
        rows.join(F.broadcast(first), month == F.col("_first"))
        .select(*rows.columns)
        .withColumn("solar_wind_speed", F.coalesce(faster, F.col("solar_wind_speed")))
    )


def _two_loads(spark: SparkSession, sf_dir: str, **options) -> medallion.Config:
    """Silver and features of all readings, then of the later load."""
    cfg = medallion.Config(source="", root=shared.work_folder(spark, "loads"), **options)
    for load_ in (silver(spark, sf_dir), _later(spark, sf_dir)):
        rows = load_.select(*TELEMETRY.names)
        tables.replace(rows, cfg.path("bronze"), allow_schema_change=True)
        medallion.clean(spark, cfg)
        medallion.stored_features(spark, cfg)
    return cfg


def feature_table_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features after a load of one month: that month is built again, the others stay."""
    cfg = _two_loads(spark, sf_dir)
    return printable(tables.read(spark, cfg.path("features")))


def merged_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and deviation of all features from figures per month."""
    rows = _stored_features(spark, sf_dir)
    by_month = figures.by_part(rows, features.FEATURE_COLS, F.date_trunc("month", KEY))
    whole = figures.merged(by_month)
    schema = "n long, " + ", ".join(
        f"{kind}_{c} double" for kind in ("mean", "std") for c in features.FEATURE_COLS
    )
    return printable(one_row(spark, schema, [whole.n, *whole.means, *whole.deviations]))


# -------------------------------------------------------------------- gate


def gate_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    passed, _ = gate.split(telemetry(spark, sf_dir))
    return printable(passed)


def gate_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, failed = gate.split(telemetry(spark, sf_dir))
    return printable(failed)


def quarantine_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = gate.quarantine(telemetry(spark, sf_dir))
    return failed.groupBy("quarantine_reason").agg(F.count(F.lit(1)).alias("n_rows"))


def dedupe_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return printable(silver(spark, sf_dir))


def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest order of each customer, the higher key on equal dates."""
    orders = load(spark, sf_dir, "orders")
    return dedupe.one_per_key(
        orders, ["o_custkey"], order_by=["o_orderdate", "o_orderkey"], keep="last"
    )


# ----------------------------------------------------------- scan and stamp


def _as_csv(spark: SparkSession, sf_dir: str, name: str) -> str:
    folder = shared.work_folder(spark, name)
    telemetry(spark, sf_dir).select(*TELEMETRY.names).write.csv(folder, header=True)
    return folder


def typed_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return printable(scan.read_typed_csv(spark, _as_csv(spark, sf_dir, "csv")))


def typed_csv_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that do not parse, planted in the file, are told from empty ones."""
    folder = shared.work_folder(spark, "malformed")
    event = F.col("event_id")
    texts = telemetry(spark, sf_dir).select(
        "event_id", *[F.col(c).cast("string").alias(c) for c in TELEMETRY.names]
    )
    texts = texts.withColumns(
        {
            KEY: F.when(event % 67 == 0, "soon").otherwise(F.col(KEY)),
            "proton_density": F.when(event % 59 == 0, "n/a").otherwise(F.col("proton_density")),
        }
    )
    texts.select(*TELEMETRY.names).write.csv(f"{folder}/file", header=True)
    malformed = gate.MALFORMED.column
    rows = scan.read_typed_csv(spark, f"{folder}/file", malformed_col=malformed)
    tables.replace(rows, f"{folder}/bronze")
    stored = tables.read(spark, f"{folder}/bronze")
    return printable(gate.judged(stored, (gate.MALFORMED, *gate.RULES)).drop(malformed))


def load_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return printable(scan.stamp(load(spark, sf_dir, "orders"), "_ingested_at", LOADED_AT))


# ------------------------------------------------------------------ tables


def upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = order_changes(spark, sf_dir)
    return upsert.upsert_rows(target, source, ["o_orderkey"])


def upsert_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = order_changes(spark, sf_dir)
    return upsert.upsert_stats(target, source, ["o_orderkey"])


def _versioned_orders(spark: SparkSession, sf_dir: str) -> str:
    """Four versions: created, appended to, upserted, laid out by date.

    An append without rows comes in between and makes none.
    """
    even, changed = order_changes(spark, sf_dir)
    odd = load(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 2 == 1)
    path = f"{shared.work_folder(spark, 'tables')}/orders"
    tables.replace(even, path)
    tables.append(odd, path)
    tables.append(odd.filter(F.col("o_orderkey") < 0), path)
    tables.upsert(changed, path, ["o_orderkey"])
    tables.cluster_by(spark, path, "o_orderdate", files=4)
    return path


def table_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    even, changed = order_changes(spark, sf_dir)
    path = f"{shared.work_folder(spark, 'tables')}/orders"
    tables.upsert(even, path, ["o_orderkey"])
    tables.upsert(changed, path, ["o_orderkey"])
    return tables.read(spark, path)


def table_upsert_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files kept by month of the order date; months without changes are taken over."""
    even, changed = order_changes(spark, sf_dir)
    path = f"{shared.work_folder(spark, 'tables')}/orders"
    keys = ["o_orderdate", "o_orderkey"]
    tables.upsert(even, path, keys, "month")
    tables.upsert(changed, path, keys, "month")
    return tables.read(spark, path)


def upsert_touched_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small late load without a period: files kept as they were, and the table's rows."""
    orders = load(spark, sf_dir, "orders")
    path = f"{shared.work_folder(spark, 'tables')}/orders"
    tables.replace(orders, path)
    tables.cluster_by(spark, path, "o_orderkey", files=8)
    before = [r[0] for r in tables.read(spark, path).select(F.input_file_name()).distinct().collect()]
    least = F.col("o_orderkey") == orders.agg(F.min("o_orderkey")).first()[0]
    changed = orders.filter(least).withColumn("o_totalprice", F.lit(0.0))
    late = orders.filter(least).withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    tables.upsert(changed.unionByName(late), path, ["o_orderkey"])
    return tables.read(spark, path).withColumn("file", F.input_file_name()).agg(
        F.count_distinct(F.when(F.col("file").isin(before), F.col("file"))).alias("n_kept"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("o_totalprice") == 0).alias("n_changed"),
        F.count_if(F.col("o_orderkey") < 0).alias("n_new"),
    )


def table_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second version replaces the first, with another schema."""
    orders = load(spark, sf_dir, "orders")
    path = f"{shared.work_folder(spark, 'tables')}/orders"
    tables.replace(orders, path)
    narrow = tables.read(spark, path).select("o_orderkey", "o_orderpriority")
    tables.replace(narrow, path, allow_schema_change=True)
    return tables.read(spark, path)


def table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read(spark, _versioned_orders(spark, sf_dir), version=1)


def time_travel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read(spark, _versioned_orders(spark, sf_dir), version=0)


def table_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored version under a name, for SQL users."""
    path = f"{shared.work_folder(spark, 'tables')}/orders"
    tables.replace(load(spark, sf_dir, "orders"), path)
    tables.view(spark, path, "stored_orders")
    return spark.sql(
        "SELECT o_orderstatus, count(*) AS n_rows FROM stored_orders GROUP BY o_orderstatus"
    )


def table_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _versioned_orders(spark, sf_dir)
    return tables.history(spark, path).select("table_name", "version", "operation", "n_rows")


def cluster_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared.work_folder(spark, 'tables')}/lineitem"
    tables.replace(load(spark, sf_dir, "lineitem"), path)
    tables.cluster_by(spark, path, "l_shipdate", files=8)
    return tables.read(spark, path)


def cluster_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a laid-out table, and how many reach back into the range of another."""
    path = f"{shared.work_folder(spark, 'tables')}/lineitem"
    tables.replace(load(spark, sf_dir, "lineitem"), path)
    tables.cluster_by(spark, path, "l_shipdate", files=8)
    files = tables.read(spark, path).groupBy(F.input_file_name().alias("file")).agg(
        F.min("l_shipdate").alias("low"), F.max("l_shipdate").alias("high")
    )
    # Eight rows: one window is enough.
    in_order = Window.orderBy("low", "high")
    before = F.max("high").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    return files.select((F.col("low") < before).alias("back")).agg(
        F.count(F.lit(1)).alias("n_files"), F.count_if("back").alias("n_overlaps")
    )


def cluster_two_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layout along two columns: how many files a filter on either must open."""
    path = f"{shared.work_folder(spark, 'tables')}/lineitem"
    tables.replace(load(spark, sf_dir, "lineitem"), path)
    tables.cluster_by(spark, path, ["l_shipdate", "l_partkey"], files=16)
    stored = tables.read(spark, path)
    middle = stored.agg(
        *[F.percentile_approx(c, 0.5).alias(c) for c in ("l_partkey",)],
        F.date_from_unix_date(
            F.percentile_approx(F.unix_date(F.col("l_shipdate").cast("date")), 0.5)
        ).alias("l_shipdate"),
    ).first()
    ranges = stored.groupBy(F.input_file_name().alias("file")).agg(
        F.count(F.lit(1)).alias("n"),
        *[
            F.expr(f"min({c}) <= X AND max({c}) >= X".replace("X", f"'{middle[c]}'")).alias(c)
            for c in ("l_shipdate", "l_partkey")
        ],
    )
    return ranges.agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("n").alias("n_rows"),
        (F.count_if("l_shipdate") <= 10).alias("skips_by_date"),
        (F.count_if("l_partkey") <= 10).alias("skips_by_part"),
    )


def audit_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audits after a layout, a change of values at equal counts, and an append."""
    orders = load(spark, sf_dir, "orders")
    path = f"{shared.work_folder(spark, 'tables')}/orders"
    tables.replace(orders, path)
    steps = {
        "layout": lambda: tables.cluster_by(spark, path, "o_orderdate", files=4),
        "change": lambda: tables.upsert(order_changes(spark, sf_dir)[1], path, ["o_orderkey"]),
        "append": lambda: tables.append(orders.limit(1), path),
    }
    found = None
    for name, step in steps.items():
        step()
        row = tables.audit(spark, path, contents=True).select(
            F.lit(name).alias("step"), "n_rows", "difference", "same_contents"
        )
        found = row if found is None else found.unionByName(row)
    return found


def snapshot_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.audit(spark, _versioned_orders(spark, sf_dir))


def snapshot_audit_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Against the last version that changed rows, passing over the layout."""
    return tables.audit(spark, _versioned_orders(spark, sf_dir), skip_operations=["cluster"])


def snapshot_audit_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table's first version has none before it."""
    path = f"{shared.work_folder(spark, 'tables')}/lineitem"
    tables.replace(load(spark, sf_dir, "lineitem"), path)
    return tables.audit(spark, path)


def quarantine_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of the same readings: quarantine holds their failures twice."""
    path = f"{shared.work_folder(spark, 'tables')}/quarantine"
    for _ in range(2):
        tables.append(gate.quarantine(telemetry(spark, sf_dir)), path, "quarantine")
    return printable(tables.read(spark, path))


def quarantine_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of the same readings, at other times: each failure is held once."""
    path = f"{shared.work_folder(spark, 'tables')}/quarantine"
    for day in (1, 2):
        failed = gate.quarantine(telemetry(spark, sf_dir))
        stamped = scan.stamp(failed, "_quarantined_at", datetime(2024, 3, day, tzinfo=timezone.utc))
        tables.append_new(stamped, path, ["_quarantined_at"], "quarantine")
    return printable(tables.read(spark, path))


# ------------------------------------------------------------------- model


def zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return printable(model.zscore(orders, ["o_totalprice"]))


def scaled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assembler and fitted scaler, the vector taken apart again."""
    assembled = model.assemble(_stored_features(spark, sf_dir))
    scaled = model.fit_scaler(assembled).transform(assembled)
    values = scaled.select(KEY, vector_to_array(model.SCALED).alias("values"))
    return printable(
        values.select(
            KEY, *[F.col("values")[i].alias(c) for i, c in enumerate(features.FEATURE_COLS)]
        )
    )


def nearest_center(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = model.zscore(_stored_features(spark, sf_dir), features.FEATURE_COLS)
    found = model.nearest_center(scaled, features.FEATURE_COLS, CENTERS)
    return printable(found.select(KEY, model.CLUSTER_COL))


def silhouette_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = load(spark, sf_dir, "embeddings").select(
        array_to_vector("embedding").alias(model.SCALED), "label"
    )
    value = model.silhouette(vectors, cluster_col="label")
    return printable(one_row(spark, "silhouette double", [value]))


def _stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitting passes over the rows many times: write them once."""
    path = f"{shared.work_folder(spark, 'tables')}/features"
    built = features.build(silver(spark, sf_dir), cuts=large_cuts(spark, sf_dir))
    tables.replace(built, path)
    return tables.read(spark, path)


def kmeans_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds for any fit: used clusters, scored rows, a silhouette above 0."""
    rows = _stored_features(spark, sf_dir)
    trained = model.train(rows)
    return model.score(trained.model, rows).agg(
        F.count_distinct(model.CLUSTER_COL).alias("n_clusters"),
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(0.0 < trained.silhouette <= 1.0).alias("separated"),
    )


def score_latest_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit, record, find, load, score; each row against the model's own centres.

    Cluster numbers differ from fit to fit, so the row says whether it went to
    the closest centre.
    """
    rows = _stored_features(spark, sf_dir)
    root = shared.work_folder(spark, "runs")
    trained = model.train(rows)
    runs.record(
        spark,
        f"{root}/runs",
        run_id="first",
        experiment="check",
        run_name="check",
        start_time=LOADED_AT,
        metrics={"silhouette_score": trained.silhouette},
        model_path=runs.save_model(trained.model, f"{root}/models/first"),
    )
    loaded = runs.load_model(spark, f"{root}/runs", "check")
    scaler, clusters = loaded.stages
    # A centre of the scaled space, in the units of the columns.
    mean, std = scaler.mean.toArray(), scaler.std.toArray()
    weighted = [F.col(c) / float(s or 1.0) for c, s in zip(features.FEATURE_COLS, std)]
    scored = model.score(loaded, rows)
    names = [f"_scaled_{c}" for c in features.FEATURE_COLS]
    scaled = scored.select(
        "*",
        *[
            (w - F.lit(float(m / (s or 1.0)))).alias(n)
            for w, m, s, n in zip(weighted, mean, std, names)
        ],
    )
    closest = columns.nearest_center(names, [c.tolist() for c in clusters.clusterCenters()])
    checked = scaled.withColumn("closest", F.col(model.CLUSTER_COL) == closest)
    return printable(checked.select(KEY, *features.FEATURE_COLS, "closest"))


def cluster_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fit with another seed over other partitions, numbered as the first fit's.

    Fits differ, so the row says whether the pairing of centres is the least of all.
    """
    rows = _stored_features(spark, sf_dir)
    first = model.train(rows)
    again = model.train(rows.repartition(5, KEY), seed=7, earlier=first.model)
    old, new = model.centers(first.model), model.centers(again.model)
    std = [s or 1.0 for s in first.model.stages[0].std.toArray()]

    def total(order):
        return sum(
            ((a - b) / s) ** 2
            for n, c in enumerate(order)
            for a, b, s in zip(new[c], old[n], std, strict=True)
        )

    kept = total((0, 1, 2))
    least = all(kept <= total(order) + 1e-9 for order in permutations(range(3)))
    return model.score(again.model, rows).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max(model.CLUSTER_COL).alias("highest"),
        F.lit(least).alias("least"),
    )


def run_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run's parameters and metrics, as recorded at its start and its end and read back."""
    path = f"{shared.work_folder(spark, 'runs')}/runs"
    figures = load(spark, sf_dir, "orders").agg(
        F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top")
    ).first()
    run = {"run_id": "r", "experiment": "check", "run_name": "n", "start_time": LOADED_AT}
    params = {"k_clusters": figures["n"], "feature_columns": ["a", "b"], "note": "text"}
    runs.record(spark, path, **run, params=params, status=runs.RUNNING)
    runs.record(spark, path, **run, params=params, metrics={"top": figures["top"]})
    return printable(
        runs.read(spark, path).select(
            "run_id",
            "status",
            *[F.col("params")[name].alias(name) for name in params],
            F.col("metrics")["top"].alias("top"),
            F.size("metrics").alias("n_metrics"),
        )
    )


def _order_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders read as run records, one experiment per priority."""
    records = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.col("o_orderpriority").alias("experiment"),
        F.col("o_orderdate").alias("start_time"),
        F.when(F.col("o_orderstatus") == "F", runs.FINISHED)
        .otherwise(runs.FAILED)
        .alias("status"),
    )
    return records


def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.latest(_order_runs(spark, sf_dir), URGENT)


def latest_run_any_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.latest(_order_runs(spark, sf_dir), URGENT, finished_only=False)


# --------------------------------------------------------------- whole job


def medallion_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the whole job over one file: rows of every table."""
    cfg = medallion.Config(
        source=_as_csv(spark, sf_dir, "source"), root=shared.work_folder(spark, "medallion")
    )
    medallion.run(spark, cfg)
    medallion.run(spark, cfg)
    names = ("bronze", "silver", "quarantine", "features", "training_eval", "gold")
    counts = None
    for name in names:
        stored = tables.read(spark, cfg.path(name)).select(F.lit(name).alias("table_name"))
        counts = stored if counts is None else counts.unionByName(stored)
    return counts.groupBy("table_name").agg(F.count(F.lit(1)).alias("n_rows"))


def stage_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run of the whole job: rows each stage wrote."""
    cfg = medallion.Config(
        source=_as_csv(spark, sf_dir, "source"), root=shared.work_folder(spark, "medallion")
    )
    log = medallion.run(spark, cfg)
    return log.select("stage", "status", "budget_seconds", "n_rows", "error")


def _crawl(rows: DataFrame) -> DataFrame:
    """The rows, each after some milliseconds."""
    wait = "java_method('java.util.concurrent.locks.LockSupport', 'parkNanos', 20000000L)"
    return rows.select(F.expr(wait).alias("waited")).filter("waited IS NOT NULL")


def stage_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job whose second stage is too slow: it is stopped, and the third never runs."""
    orders = load(spark, sf_dir, "orders")
    cfg = medallion.Config(source="", root=shared.work_folder(spark, "limited"))
    stages = [
        medallion.Stage("count", lambda s, c: orders.count(), 600),
        medallion.Stage("crawl", lambda s, c: _crawl(orders).count(), 2),
        medallion.Stage("after", lambda s, c: orders.count(), 600),
    ]
    try:
        medallion.run(spark, cfg, stages)
    except medallion.StageFailed:
        pass
    told = F.substring_index("error", ":", 1).alias("error")
    return medallion.stage_log(spark, cfg).select(
        "stage", "status", "over_budget", "n_rows", told
    )


ALL = {
    f.__name__: f
    for f in (
        feature_table,
        feature_table_chunked,
        feature_table_by_entity,
        feature_table_hot_entity,
        feature_table_nan,
        feature_table_incremental,
        merged_figures,
        rolling_mean,
        rolling_std,
        lag_features,
        delta_features,
        month_boundary,
        drop_incomplete,
        gate_valid,
        gate_quarantine,
        quarantine_reason_counts,
        dedupe_keyed,
        dedupe_latest,
        typed_csv_roundtrip,
        typed_csv_malformed,
        load_stamp,
        upsert_orders,
        upsert_stats,
        table_upsert,
        table_upsert_by_month,
        upsert_touched_files,
        table_replace,
        table_append,
        time_travel,
        table_view,
        table_history,
        cluster_layout,
        cluster_overlaps,
        cluster_two_columns,
        audit_contents,
        snapshot_audit,
        snapshot_audit_data,
        snapshot_audit_first,
        quarantine_append,
        quarantine_once,
        zscore,
        scaled_features,
        nearest_center,
        silhouette_labels,
        kmeans_train,
        score_latest_model,
        cluster_numbers,
        run_record,
        latest_run,
        latest_run_any_status,
        medallion_tables,
        stage_log,
        stage_limit,
    )
}

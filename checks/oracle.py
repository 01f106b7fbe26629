"""The same results in DuckDB SQL."""

from __future__ import annotations

from checks.queries import CENTERS, URGENT
from strandline.operators import features
from strandline.operators.gate import RULES
from strandline.sources.schemas import MEASURES

TELEMETRY = """
telemetry AS (
  SELECT
    event_id,
    user_id,
    CASE WHEN event_id % 101 <> 0
         THEN date_trunc('minute', ts) + INTERVAL 15 DAY END AS time_tag,
    CASE WHEN event_id % 97 <> 0
         THEN CASE WHEN event_id % 89 = 0 THEN -value ELSE 300.0::DOUBLE + value END
         END AS solar_wind_speed,
    CASE WHEN event_id % 83 <> 0
         THEN json_extract_string(props, '$.k')::DOUBLE / 10 END AS proton_density,
    CASE WHEN event_id % 79 <> 0 THEN (5 + user_id % 17)::DOUBLE END AS magnetic_field_total,
    CASE WHEN event_id % 73 <> 0 THEN (user_id % 21 - 10)::DOUBLE END AS magnetic_field_bz,
    CASE WHEN event_id % 71 <> 0
         THEN (10000 + event_id % 13)::DOUBLE + 100 * json_extract_string(props, '$.k')::DOUBLE
         END AS plasma_temperature
  FROM events
)"""

VALID = """
valid AS (
  SELECT * FROM telemetry
  WHERE time_tag IS NOT NULL
    AND proton_density IS NOT NULL
    AND magnetic_field_total IS NOT NULL
    AND magnetic_field_bz IS NOT NULL
    AND plasma_temperature IS NOT NULL
    AND solar_wind_speed >= 0
)"""

SILVER = """
silver AS (
  SELECT * FROM valid
  QUALIFY row_number() OVER (PARTITION BY time_tag ORDER BY event_id) = 1
)"""


def rounded(names, prefix: str = "") -> str:
    return ", ".join(f"round({prefix}{n}, 6) + 0::DOUBLE AS {n}" for n in names)


def _feature_ctes(source: str, entity: str = "") -> str:
    by = f"PARTITION BY {entity} date_trunc('month', time_tag) ORDER BY time_tag"
    parts = ["time_tag", *MEASURES]
    parts += [f"avg({c}) OVER f AS {n}" for n, c in features.ROLLING_MEANS.items()]
    parts += [
        f"coalesce(stddev_samp({c}) OVER f, 0.0) AS {n}" for n, c in features.ROLLING_STDS.items()
    ]
    parts += [f"coalesce(lag({c}) OVER s, {c}) AS {n}" for n, c in features.LAGS.items()]
    parts += [f"coalesce({c} - lag({c}) OVER s, 0.0) AS {n}" for n, c in features.DELTAS.items()]
    return f"""
features AS (
  SELECT {entity} {", ".join(parts)} FROM {source}
  WINDOW s AS ({by}), f AS ({by} ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)
)"""


READINGS = f"WITH {TELEMETRY}"
GATED = f"WITH {TELEMETRY}, {VALID}"
CLEAN = f"WITH {TELEMETRY}, {VALID}, {SILVER}"
FEATURES = f"{CLEAN}, {_feature_ctes('silver')}"
ENTITY_FEATURES = f"""{GATED},
entity_rows AS (
  SELECT * FROM valid
  QUALIFY row_number() OVER (PARTITION BY user_id, time_tag ORDER BY event_id) = 1
), {_feature_ctes('entity_rows', 'user_id,')}"""

COLS = ("time_tag", *features.FEATURE_COLS)
FEATURE_ROWS = f"{FEATURES} SELECT time_tag, {rounded(features.FEATURE_COLS)} FROM features"


def _some(names) -> str:
    return f"{FEATURES} SELECT time_tag, {rounded(names)} FROM features"


BROKEN = {
    "not_null": "{} IS NULL",
    "not_negative": "{} < 0",
}
REASON = (
    "CASE "
    + " ".join(f"WHEN {BROKEN[r.check].format(r.column)} THEN '{r.reason}'" for r in RULES)
    + " END"
)
QUARANTINE = f"""{GATED},
quarantine AS (
  SELECT *, {REASON} AS quarantine_reason FROM telemetry
  WHERE event_id NOT IN (SELECT event_id FROM valid)
)"""

# The first month again, every third reading with more speed.
RELOADED = f"""{CLEAN},
reloaded AS (
  SELECT * REPLACE (
    CASE WHEN event_id % 3 = 0
          AND date_trunc('month', time_tag) = (SELECT min(date_trunc('month', time_tag)) FROM silver)
         THEN solar_wind_speed + 50 ELSE solar_wind_speed END AS solar_wind_speed) FROM silver
), {_feature_ctes('reloaded')}"""

# Cells that do not parse: NULL, with a reason that comes first.
MALFORMED = f"""WITH {TELEMETRY},
planted AS (
  SELECT * REPLACE (
    CASE WHEN event_id % 67 <> 0 THEN time_tag END AS time_tag,
    CASE WHEN event_id % 59 <> 0 THEN proton_density END AS proton_density)
  FROM telemetry
)
SELECT time_tag, {rounded(MEASURES)},
  CASE WHEN event_id % 67 = 0 OR event_id % 59 = 0 THEN 'Malformed Row' ELSE {REASON} END
    AS quarantine_reason
FROM planted"""

_FIGURES = ", ".join(
    f"round(avg({c}), 6) + 0::DOUBLE AS mean_{c}, round(stddev_samp({c}), 6) + 0::DOUBLE AS std_{c}"
    for c in features.FEATURE_COLS
)

UPSERTED = """
SELECT * FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey % 3 <> 0
UNION ALL
SELECT * REPLACE (0.0::DOUBLE AS o_totalprice) FROM orders WHERE o_orderkey % 3 = 0"""

# Even keys; then the odd ones; then every third changed; then the same rows again.
EVEN = "(SELECT count(*) FROM orders WHERE o_orderkey % 2 = 0)"
EVERY = "(SELECT count(*) FROM orders)"


def _scaled_ctes() -> str:
    figures = ", ".join(
        f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in features.FEATURE_COLS
    )
    scaled = ", ".join(
        f"CASE WHEN s_{c} = 0 THEN 0 ELSE ({c} - m_{c}) / s_{c} END AS {c}"
        for c in features.FEATURE_COLS
    )
    return f"""{FEATURES},
figures AS (SELECT {figures} FROM features),
scaled AS (SELECT time_tag, {scaled} FROM features, figures)"""


def _nearest() -> str:
    distances = ", ".join(
        " + ".join(f"({c} - ({x!r}))^2" for c, x in zip(features.FEATURE_COLS, center))
        + f" AS d{i}"
        for i, center in enumerate(CENTERS)
    )
    return f"""{_scaled_ctes()},
distances AS (SELECT time_tag, {distances} FROM scaled)
SELECT time_tag,
       CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS anomaly_cluster
FROM distances"""


# Sums of squared distances to a cluster's members follow from the cluster's
# size, the sum of its vectors and the sum of their squared lengths.
SILHOUETTE = """
WITH cells AS (
  SELECT vec_id, label, unnest(embedding)::DOUBLE AS x,
         generate_subscripts(embedding, 1) AS i
  FROM embeddings
),
points AS (SELECT vec_id, label, sum(x * x) AS sq FROM cells GROUP BY ALL),
clusters AS (SELECT label AS other, count(*) AS n, sum(sq) AS sq FROM points GROUP BY ALL),
centers AS (SELECT label AS other, i, sum(x) AS x FROM cells GROUP BY ALL),
dots AS (
  SELECT vec_id, other, sum(cells.x * centers.x) AS dot
  FROM cells JOIN centers USING (i) GROUP BY ALL
),
sums AS (
  SELECT vec_id, label, other, n,
         n * points.sq + clusters.sq - 2 * dot AS total
  FROM dots JOIN points USING (vec_id) JOIN clusters USING (other)
),
sides AS (
  SELECT vec_id,
         max(n) FILTER (other = label) AS own_n,
         max(total / (n - 1)) FILTER (other = label AND n > 1) AS a,
         min(total / n) FILTER (other <> label) AS b
  FROM sums GROUP BY vec_id
)
SELECT round(avg(CASE WHEN own_n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6)
       + 0::DOUBLE AS silhouette
FROM sides"""


def _latest(wanted: str = "") -> str:
    return f"""
        SELECT o_orderkey::VARCHAR AS run_id, o_orderpriority AS experiment,
               o_orderdate AS start_time,
               CASE o_orderstatus WHEN 'F' THEN 'FINISHED' ELSE 'FAILED' END AS status
        FROM orders WHERE o_orderpriority = '{URGENT}' {wanted}
        ORDER BY o_orderdate DESC, o_orderkey::VARCHAR LIMIT 1"""


SQL = {
    "feature_table": FEATURE_ROWS,
    "feature_table_chunked": FEATURE_ROWS,
    "feature_table_by_entity": f"""{ENTITY_FEATURES}
        SELECT user_id, time_tag, {rounded(features.FEATURE_COLS)} FROM features""",
    "feature_table_hot_entity": f"""{GATED},
        renamed AS (
          SELECT * REPLACE (CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS user_id)
          FROM valid
        ),
        entity_rows AS (
          SELECT * FROM renamed
          QUALIFY row_number() OVER (PARTITION BY user_id, time_tag ORDER BY event_id) = 1
        ), {_feature_ctes('entity_rows', 'user_id,')}
        SELECT user_id, time_tag, {rounded(features.FEATURE_COLS)} FROM features""",
    "feature_table_nan": f"""{FEATURES},
        holes AS (
          SELECT time_tag, max(
            CASE WHEN event_id % 61 = 0 OR event_id % 53 = 0 OR event_id % 47 = 0 THEN 1 ELSE 0 END
          ) OVER (PARTITION BY date_trunc('month', time_tag) ORDER BY time_tag
                  ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS holed
          FROM silver
        )
        SELECT time_tag, {rounded(features.FEATURE_COLS)}
        FROM features JOIN holes USING (time_tag) WHERE holed = 0""",
    "rolling_mean": _some(features.ROLLING_MEANS),
    "rolling_std": _some(features.ROLLING_STDS),
    "lag_features": _some(features.LAGS),
    "delta_features": _some(features.DELTAS),
    "month_boundary": f"""{FEATURES}
        SELECT date_trunc('month', time_tag) AS month, time_tag, {rounded(features.FEATURE_COLS)}
        FROM features
        QUALIFY row_number() OVER (PARTITION BY date_trunc('month', time_tag)
                                   ORDER BY time_tag) = 1""",
    "drop_incomplete": f"""{READINGS},
        holed AS (
          SELECT * REPLACE (CASE WHEN event_id % 61 = 0 THEN 'NaN'::DOUBLE
                                 ELSE proton_density END AS proton_density)
          FROM telemetry
        )
        SELECT event_id, user_id, time_tag, {rounded(MEASURES)} FROM holed
        WHERE time_tag IS NOT NULL
          AND {" AND ".join(f"{m} IS NOT NULL AND NOT isnan({m})" for m in MEASURES)}""",
    "gate_valid": f"{GATED} SELECT event_id, user_id, time_tag, {rounded(MEASURES)} FROM valid",
    "gate_quarantine": f"""{QUARANTINE}
        SELECT event_id, user_id, time_tag, {rounded(MEASURES)}, quarantine_reason
        FROM quarantine""",
    "quarantine_reason_counts": f"""{QUARANTINE}
        SELECT quarantine_reason, count(*) AS n_rows FROM quarantine GROUP BY ALL""",
    "dedupe_keyed": f"{CLEAN} SELECT event_id, user_id, time_tag, {rounded(MEASURES)} FROM silver",
    "dedupe_latest": """
        SELECT * FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey
                                   ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "typed_csv_roundtrip": f"{READINGS} SELECT time_tag, {rounded(MEASURES)} FROM telemetry",
    "load_stamp": """
        SELECT * REPLACE (round(o_totalprice, 6) + 0::DOUBLE AS o_totalprice),
               TIMESTAMP '2024-03-01 12:00:00' AS _ingested_at
        FROM orders""",
    "upsert_orders": UPSERTED,
    "upsert_stats": """
        SELECT CASE WHEN s.o_orderkey IS NULL THEN 'kept'
                    WHEN t.o_orderkey IS NULL THEN 'inserted'
                    ELSE 'updated' END AS outcome,
               count(*) AS n_rows
        FROM (SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0) t
        FULL JOIN (SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0) s
          ON t.o_orderkey = s.o_orderkey
        GROUP BY ALL""",
    "table_upsert": UPSERTED,
    "table_upsert_by_month": UPSERTED,
    "table_replace": "SELECT o_orderkey, o_orderpriority FROM orders",
    "table_append": "SELECT * FROM orders",
    "time_travel": "SELECT * FROM orders WHERE o_orderkey % 2 = 0",
    "table_view": "SELECT o_orderstatus, count(*) AS n_rows FROM orders GROUP BY ALL",
    "table_history": f"""
        SELECT 'orders' AS table_name, version, operation, n_rows FROM (
          SELECT 0 AS version, 'replace' AS operation, {EVEN} AS n_rows UNION ALL
          SELECT 1, 'append', {EVERY} UNION ALL
          SELECT 2, 'upsert', {EVERY} UNION ALL
          SELECT 3, 'cluster', {EVERY})""",
    "cluster_layout": "SELECT * FROM lineitem",
    "cluster_overlaps": "SELECT 8 AS n_files, 0 AS n_overlaps",
    "snapshot_audit": f"""
        SELECT 3 AS version, {EVERY} AS n_rows, 2 AS previous_version, {EVERY} AS previous_rows,
               0::BIGINT AS difference""",
    "snapshot_audit_data": f"""
        SELECT 3 AS version, {EVERY} AS n_rows, 1 AS previous_version, {EVERY} AS previous_rows,
               0::BIGINT AS difference""",
    "snapshot_audit_first": """
        SELECT 0 AS version, count(*) AS n_rows, NULL::INTEGER AS previous_version,
               NULL::BIGINT AS previous_rows, NULL::BIGINT AS difference
        FROM lineitem""",
    "quarantine_append": f"""{QUARANTINE}
        SELECT event_id, user_id, time_tag, {rounded(MEASURES)}, quarantine_reason
        FROM quarantine, (VALUES (1), (2)) AS loads(load)""",
    "zscore": """
        SELECT o_orderkey,
               round((o_totalprice - avg(o_totalprice) OVER ())
                     / stddev_samp(o_totalprice) OVER (), 6) + 0::DOUBLE AS o_totalprice
        FROM orders""",
    "scaled_features": f"""{_scaled_ctes()}
        SELECT time_tag, {rounded(features.FEATURE_COLS)} FROM scaled""",
    "nearest_center": _nearest(),
    "silhouette_labels": SILHOUETTE,
    "kmeans_train": f"""{FEATURES}
        SELECT 3::BIGINT AS n_clusters, count(*) AS n_rows, TRUE AS separated FROM features""",
    "score_latest_model": f"""{FEATURES}
        SELECT time_tag, {rounded(features.FEATURE_COLS)}, TRUE AS closest FROM features""",
    "run_record": """
        SELECT 'r' AS run_id, 'FINISHED' AS status, count(*)::VARCHAR AS k_clusters,
               '["a", "b"]' AS feature_columns, 'text' AS note,
               round(max(o_totalprice), 6) + 0::DOUBLE AS top, 1 AS n_metrics
        FROM orders""",
    "latest_run": _latest("AND o_orderstatus = 'F'"),
    "latest_run_any_status": _latest(),
    "medallion_tables": f"""{CLEAN},
        sizes AS (
          SELECT (SELECT count(*) FROM telemetry) AS every,
                 (SELECT count(*) FROM valid) AS passed,
                 (SELECT count(*) FROM silver) AS kept
        )
        SELECT unnest(['bronze', 'silver', 'quarantine', 'features', 'training_eval', 'gold'])
                 AS table_name,
               unnest([every, kept, 2 * (every - passed), kept, kept, kept]) AS n_rows
        FROM sizes""",
    "stage_log": f"""{CLEAN}
        SELECT unnest(['ingest', 'clean', 'train', 'score']) AS stage, 'FINISHED' AS status,
               unnest([600, 600, 1200, 900]) AS budget_seconds,
               unnest([every, kept, kept, kept]) AS n_rows, NULL::VARCHAR AS error
        FROM (SELECT (SELECT count(*) FROM telemetry) AS every,
                     (SELECT count(*) FROM silver) AS kept)""",
    "feature_table_incremental": f"""{RELOADED}
        SELECT time_tag, {rounded(features.FEATURE_COLS)} FROM features""",
    "merged_figures": f"{FEATURES} SELECT count(*) AS n, {_FIGURES} FROM features",
    "typed_csv_malformed": MALFORMED,
    "upsert_touched_files": """
        SELECT 7::BIGINT AS n_kept, count(*) + 1 AS n_rows, 1::BIGINT AS n_changed,
               1::BIGINT AS n_new FROM orders""",
    "cluster_two_columns": """
        SELECT 16::BIGINT AS n_files, count(*) AS n_rows, TRUE AS skips_by_date,
               TRUE AS skips_by_part FROM lineitem""",
    "audit_contents": """
        SELECT unnest(['layout', 'change', 'append']) AS step, unnest([n, n, n + 1]) AS n_rows,
               unnest([0, 0, 1])::BIGINT AS difference,
               unnest([TRUE, FALSE, FALSE]) AS same_contents
        FROM (SELECT count(*) AS n FROM orders)""",
    "quarantine_once": f"""{QUARANTINE}
        SELECT event_id, user_id, time_tag, {rounded(MEASURES)}, quarantine_reason,
               TIMESTAMP '2024-03-01' AS _quarantined_at
        FROM quarantine""",
    "cluster_numbers": f"""{FEATURES}
        SELECT count(*) AS n_rows, 2 AS highest, TRUE AS least FROM features""",
    "stage_limit": """
        SELECT 'count' AS stage, 'FINISHED' AS status, FALSE AS over_budget,
               count(*) AS n_rows, NULL::VARCHAR AS error FROM orders
        UNION ALL SELECT 'crawl', 'FAILED', TRUE, NULL, 'over budget'""",
}

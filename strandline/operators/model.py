"""Standardise, cluster, score and evaluate, on ``pyspark.ml``."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import (
    SQLTransformer,
    StandardScaler,
    StandardScalerModel,
    VectorAssembler,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions import columns
from strandline.operators.features import FEATURE_COLS
from strandline.sources.schemas import KEY

# Clusters and seed of the fit, name of the result.
CLUSTERS = 3
SEED = 25
CLUSTER_COL = "anomaly_cluster"

RAW, SCALED = "raw_features", "features"


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    silhouette: float

    @property
    def clusters(self) -> KMeansModel:
        return self.model.stages[1]


def assemble(df: DataFrame, cols: Sequence[str] = FEATURE_COLS, output: str = RAW) -> DataFrame:
    """Columns into one vector. A NULL or NaN is an error, Infinity is not.

    The vector's column metadata is cleared, or it would travel with each plan.
    """
    return (
        VectorAssembler(inputCols=list(cols), outputCol=output)
        .transform(df)
        .withMetadata(output, {})
    )


def fit_scaler(assembled: DataFrame) -> StandardScalerModel:
    """Mean and sample deviation of each element; no spread scales to 0."""
    return StandardScaler(inputCol=RAW, outputCol=SCALED, withMean=True, withStd=True).fit(
        assembled
    )


def fit_kmeans(scaled: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> KMeansModel:
    """The other parameters are Spark's: k-means||, 20 iterations, tol 1e-4.

    The fit follows the partition layout of its input. KMeans itself keeps its
    input in memory or on disk between iterations; only k centres travel.
    """
    return KMeans(k=k, seed=seed, featuresCol=SCALED, predictionCol=CLUSTER_COL).fit(
        scaled.select(SCALED)
    )


def bundle(scaler: StandardScalerModel, clusters: KMeansModel) -> PipelineModel:
    return PipelineModel(stages=[scaler, clusters])


def train(
    features: DataFrame,
    k: int = CLUSTERS,
    seed: int = SEED,
    scaler: StandardScalerModel | None = None,
    earlier: PipelineModel | None = None,
) -> Trained:
    """Fit scaler and clusters, and evaluate them on the same rows.

    Makes several passes: give it a stored feature table, not a window plan. A fitted
    ``scaler`` saves the pass for it. With an ``earlier`` model, clusters keep its numbers.
    """
    assembled = assemble(features).select(RAW)
    scaler = scaler or fit_scaler(assembled)
    scaled = scaler.transform(assembled).withMetadata(SCALED, {})
    fitted = bundle(scaler, fit_kmeans(scaled, k, seed))
    if earlier is not None:
        fitted = keep_numbers(fitted, earlier)
    return Trained(fitted, silhouette(fitted.transform(assembled)))


# ---------------------------------------------------------------- numbers that last


def numbers(model: PipelineModel) -> list[int]:
    """The number that the model gives to each centre, in the order of the fit."""
    given = model.stages[2].getStatement() if len(model.stages) > 2 else ""
    listed = re.search(r"array\(([0-9, ]+)\)", given)
    return (
        [int(n) for n in listed[1].split(",")]
        if listed
        else list(range(len(model.stages[1].clusterCenters())))
    )


def centers(model: PipelineModel) -> dict[int, list[float]]:
    """Each number's centre, in the units of the columns."""
    scaler, clusters = model.stages[:2]
    found = {}
    for number, center in zip(numbers(model), clusters.clusterCenters(), strict=True):
        spread = zip(center, scaler.std.toArray(), scaler.mean.toArray(), strict=True)
        found[number] = [float(x * s + m) for x, s, m in spread]
    return found


def keep_numbers(fitted: PipelineModel, earlier: PipelineModel) -> PipelineModel:
    """The model with its clusters numbered as the earlier model's nearest ones.

    Centres are paired one to one so that the sum of their squared distances, in the
    earlier model's scale, is least. With more clusters than before, the others get the
    least free numbers; with fewer, some numbers are not used. The new numbers are a stage
    of the model, saved and loaded with it.
    """
    std = [s or 1.0 for s in earlier.stages[0].std.toArray()]
    old, new = centers(earlier), centers(fitted)
    places = sorted(old)
    costs = [
        [
            sum(((a - b) / s) ** 2 for a, b, s in zip(new[c], old[n], std, strict=True))
            for n in places
        ]
        for c in sorted(new)
    ]
    pairs = least_pairs(costs)
    free = iter(n for n in range(len(new) + len(old)) if n not in old)
    given = [places[pairs[c]] if c in pairs else next(free) for c in range(len(new))]
    stages = fitted.stages[:2]
    if given != list(range(len(given))):
        listed = ", ".join(map(str, given))
        stages.append(
            SQLTransformer(
                statement=f"SELECT * EXCEPT ({CLUSTER_COL}), "
                f"element_at(array({listed}), {CLUSTER_COL} + 1) AS {CLUSTER_COL} FROM __THIS__"
            )
        )
    return PipelineModel(stages=stages)


def least_pairs(costs: Sequence[Sequence[float]]) -> dict[int, int]:
    """Rows paired with columns, as many as can be, at the least total cost.

    A row at a time is added by the cheapest chain of re-pairings. Such a chain is a
    cheapest path on which taking a pair apart gives its cost back.
    """
    n_rows, n_cols = len(costs), len(costs[0]) if costs else 0
    if n_rows > n_cols:
        turned = [[costs[r][c] for r in range(n_rows)] for c in range(n_cols)]
        return {row: col for col, row in least_pairs(turned).items()}
    of_col: dict[int, int] = {}
    for start in range(n_rows):
        reach = {c: costs[start][c] for c in range(n_cols)}
        before: dict[int, int] = {}
        changed = True
        while changed:
            changed = False
            for col, row in of_col.items():
                for other in range(n_cols):
                    cost = reach[col] - costs[row][col] + costs[row][other]
                    if other != col and cost < reach[other] - 1e-12:
                        reach[other], before[other], changed = cost, col, True
        col = min((c for c in range(n_cols) if c not in of_col), key=reach.__getitem__)
        while col in before:
            of_col[col] = of_col[before[col]]
            col = before[col]
        of_col[col] = start
    return {row: col for col, row in of_col.items()}


def score(
    model: PipelineModel, features: DataFrame, keys: Sequence[str] = (KEY,)
) -> DataFrame:
    """Key, features and cluster of each row; no shuffle."""
    return output_columns(model.transform(assemble(features)), keys)


def output_columns(scored: DataFrame, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """The scored table without its vectors."""
    return scored.select(*keys, *FEATURE_COLS, CLUSTER_COL)


def silhouette(
    scored: DataFrame, features_col: str = SCALED, cluster_col: str = CLUSTER_COL
) -> float:
    """Mean silhouette with squared Euclidean distance.

    One pass for the cluster sums and one against them; no row meets another.
    """
    return ClusteringEvaluator(
        featuresCol=features_col, predictionCol=cluster_col, metricName="silhouette"
    ).evaluate(scored)


def zscore(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Standardise plain columns: one aggregate for the figures, then a projection."""
    figures = df.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in cols],
        *[F.stddev_samp(c).alias(f"std_{c}") for c in cols],
    ).first()
    scaled = {
        c: columns.zscore(c, figures[f"mean_{c}"], figures[f"std_{c}"] or 0.0)
        for c in cols
        if figures[f"mean_{c}"] is not None
    }
    return df.withColumns(scaled)


def nearest_center(
    df: DataFrame,
    cols: Sequence[str],
    centers: Sequence[Sequence[float]],
    output: str = CLUSTER_COL,
) -> DataFrame:
    """Scoring against given centres in plain columns."""
    return df.withColumn(output, columns.nearest_center(cols, centers))

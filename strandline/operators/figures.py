"""Counts, means and deviations of columns per part, which add up to those of the whole.

A part has for each column its mean and its sum of squared deviations from that mean
(M2). Those of several parts follow from them without a look at the rows, so a table that
changed in one month is read in that month only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import StandardScalerModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.operators import model

FIGURES = "part string, n long, means array<double>, squares array<double>"


def by_part(df: DataFrame, cols: Sequence[str], part: Column) -> DataFrame:
    """A row per part: n, and the means and M2 of the columns, in their order.

    Rows are combined before the shuffle. The columns hold no NULL; a NaN or an Infinity
    makes its column's figures NaN, as it does in a fit over all rows.
    """
    return (
        df.groupBy(part.cast("string").alias("part"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.array(*[F.avg(c) for c in cols]).alias("means"),
            F.array(*[F.var_pop(c) * F.count(c) for c in cols]).alias("squares"),
        )
        .select("part", "n", "means", "squares")
    )


@dataclass(frozen=True)
class Whole:
    n: int
    means: list[float]
    deviations: list[float]  # of a sample; 0.0 for a single row


def merged(figures: DataFrame) -> Whole:
    """The figures of all rows, from those of the parts. The driver gets a row per part."""
    parts = [r for r in figures.select("n", "means", "squares").collect() if r["n"]]
    if not parts:
        raise ValueError("no rows to take figures of")
    n = sum(r["n"] for r in parts)
    means, deviations = [], []
    for c in range(len(parts[0]["means"])):
        mean = math.fsum(r["n"] * r["means"][c] for r in parts) / n
        between = math.fsum(r["n"] * (r["means"][c] - mean) ** 2 for r in parts)
        within = math.fsum(r["squares"][c] for r in parts)
        means.append(mean)
        deviations.append(math.sqrt((within + between) / (n - 1)) if n > 1 else 0.0)
    return Whole(n, means, deviations)


def scaler(whole: Whole, df: DataFrame) -> StandardScalerModel:
    """The fitted scaler of these figures, as ``model.fit_scaler`` gives it: fitted on two
    rows that have them. ``df`` only tells the session."""
    step = [d / math.sqrt(2.0) for d in whole.deviations]
    two = [
        (Vectors.dense([m + sign * s for m, s in zip(whole.means, step, strict=True)]),)
        for sign in (-1.0, 1.0)
    ]
    return model.fit_scaler(df.sparkSession.createDataFrame(two, [model.RAW]))

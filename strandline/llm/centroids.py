"""Clustering around centroids in exact integers, with Orchard's search.

To find a vector's nearest centroid, walk the list of the centroids around the best one
so far, nearest first. When one is closer to the vector, go on with its list; no centroid
is measured twice. By the triangle inequality none beyond twice the current distance from
the best can be closer, nor as close, so the walk ends there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm import vectors
from strandline.llm.keep import keep

BLOCK = 2048  # vectors searched together


class Orchard:
    """Nearest centroids, with the lists of each centroid's neighbours."""

    def __init__(self, centroids: np.ndarray) -> None:
        """``centroids``: a row of integers each, one at least."""
        whole = centroids.astype(np.int64)
        self.centroids = vectors.exact(whole)
        self.apart = np.stack([((whole - c) ** 2).sum(axis=1) for c in whole])
        number = np.arange(len(whole))
        near = [np.lexsort((number, row)) for row in self.apart]
        self.near = np.stack([order[order != c] for c, order in zip(number, near, strict=True)])
        self.measured = 0  # distances computed so far

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's nearest centroid, the least number at ties, and the squared distance."""
        found = [self._nearest(rows[at : at + BLOCK]) for at in range(0, len(rows), BLOCK)]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(part) for part in zip(*found, strict=True))

    def _distance(self, rows: np.ndarray, number: np.ndarray) -> np.ndarray:
        self.measured += len(rows)
        away = rows - self.centroids[number]
        return np.einsum("ij,ij->i", away, away).astype(np.int64)

    def _nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows, self.centroids = vectors.alike(rows, self.centroids)
        n, k = len(rows), len(self.centroids)
        best = np.zeros(n, np.int64)
        distance = self._distance(rows, best)
        visited = np.zeros((n, k), bool)
        visited[:, 0] = True
        place = np.zeros(n, np.int64)
        live = np.arange(n)
        while True:
            live = live[place[live] < k - 1]
            if not len(live):
                return best, distance
            other = self.near[best[live], place[live]]
            near = self.apart[best[live], other] <= 4 * distance[live]
            live, other = live[near], other[near]
            place[live] += 1
            fresh = ~visited[live, other]
            at, other = live[fresh], other[fresh]
            visited[at, other] = True
            d = self._distance(rows[at], other)
            closer = (d < distance[at]) | ((d == distance[at]) & (other < best[at]))
            at = at[closer]
            best[at], distance[at], place[at] = other[closer], d[closer], 0


@dataclass(frozen=True)
class Clustering:
    rows: DataFrame  # id, cluster, distance
    centroids: list[list[int]]


def initial(kept: DataFrame, k: int, seed: int, id_col: str) -> list[list[int]]:
    """The ``k`` vectors of least hash of seed and id, in its order; rows without an id
    are none of them, and equal ids are ordered by their vectors."""
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256)
    first = kept.filter(F.col(id_col).isNotNull()).orderBy(place, F.hex("v")).limit(k)
    return [np.frombuffer(r.v, "<i4").tolist() for r in first.select("v").collect()]


def moved(kept: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Each centroid at the floor of the mean of its vectors; without any, as before.

    A task sends one row of sums per centroid, and the driver gets one per centroid.
    """
    k, dims = len(centroids), len(centroids[0])
    given = np.array(centroids)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Orchard(given)
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = vectors.matrix(batch.column(0), dims)
            cluster, _ = search.nearest(rows)
            counts += np.bincount(cluster, minlength=k)
            order = np.argsort(cluster, kind="stable")
            starts = np.flatnonzero(np.diff(cluster[order], prepend=-1))
            sums[cluster[order][starts]] += np.add.reduceat(
                rows[order].astype(np.int64), starts, axis=0
            )
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict(
            {
                "cluster": pa.array(some, pa.int32()),
                "n": pa.array(counts[some]),
                "sums": pa.array(sums[some].tolist(), pa.list_(pa.int64())),
            }
        )

    sums = [F.sum(F.col("sums")[d]).alias(f"s{d}") for d in range(dims)]
    found = (
        kept.select("v")
        .mapInArrow(task, "cluster int, n long, sums array<long>")
        .groupBy("cluster")
        .agg(F.sum("n").alias("n"), *sums)
        .collect()
    )
    out = list(centroids)
    for row in found:
        out[row["cluster"]] = [row[f"s{d}"] // row["n"] for d in range(dims)]
    return out


def assigned(kept: DataFrame, centroids: list[list[int]], id_col: str) -> DataFrame:
    """Each vector's id, cluster and squared distance."""
    given, dims = np.array(centroids), len(centroids[0])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Orchard(given)
        for batch in batches:
            cluster, distance = search.nearest(vectors.matrix(batch.column(1), dims))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cluster, pa.int32()), pa.array(distance)],
                names=[id_col, "cluster", "distance"],
            )

    kind = kept.schema[id_col].dataType.simpleString()
    return kept.select(id_col, "v").mapInArrow(
        task, f"`{id_col}` {kind}, cluster int, distance long"
    )


def cluster(
    table: DataFrame,
    k: int = 40,
    rounds: int = 5,
    seed: int = 2,
    dims: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> Clustering:
    """Cluster the vectors of ``dims`` components, none null or not finite, in integers
    floor(256 * x).

    Centroids start at the ``k`` vectors of least hash (fewer vectors: fewer centroids)
    and move ``rounds`` times; ties go to the least number. Repeated rows count each, and
    so do rows without an id. Vectors with a component beyond 2**19 take no part, as their
    squares would not fit 64 bits. No vectors: no rows, no centroids. Extra columns play
    no part. The vectors are written once as integers and read in each round; each round
    shuffles one row per task and centroid, and the driver holds ``k`` centroids.
    """
    kept = keep(vectors.integers(table, vector_col, [id_col], dims), "vectors")
    centroids = initial(kept, k, seed, id_col)
    if not centroids:
        empty = kept.limit(0).select(
            id_col, F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")
        )
        return Clustering(empty, [])
    for _ in range(rounds):
        centroids = moved(kept, centroids)
    return Clustering(assigned(kept, centroids, id_col), centroids)


def digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def with_inertia(found: Clustering) -> DataFrame:
    """The rows with cluster_inertia and inertia, their distances summed over the cluster
    and over all, and centroid_sha256. One figure per cluster reaches the driver."""
    rows = keep(found.rows, "assigned")
    sums = dict(rows.groupBy("cluster").agg(F.sum("distance")).collect())
    facts = [
        (number, sums.get(number, 0), sum(sums.values()), digest(centroid))
        for number, centroid in enumerate(found.centroids)
    ]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    return rows.join(F.broadcast(rows.sparkSession.createDataFrame(facts, schema)), "cluster")

"""Hard negatives and clustering against brute force."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.llm import centroids, hard_negatives, queries, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, score double, cluster string, v int"
NAN, INF = float("nan"), float("inf")


def frame(spark, rows):
    """Rows of (vec_id, vector, label), with extra columns whose names clash."""
    return spark.createDataFrame([(*r, 0.5, "x", 1) for r in rows], SCHEMA)


def vector_of(values):
    return np.floor(256 * np.array(values, np.float32).astype(np.float64)).astype(int).tolist()


def usable(rows, dims):
    return [
        (i, vector_of(v), label)
        for i, v, label in rows
        if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)
    ]


def spoiled(dims):
    """Rows that take no part."""
    one = [0.25] * dims
    return [
        (100, None, 1),
        (200, [], 1),
        (300, one[1:], 1),
        (400, [*one, 0.5], 1),
        (500, [NAN, *one[1:]], 1),
        (600, [*one[1:], INF], 1),
        (700, [None, *one[1:]], 1),
        (800, [3e38, *one[1:]], 1),
    ]


# ------------------------------------------------------------- hard negatives


def brute_negatives(rows, dims, every):
    held = [r for r in usable(rows, dims) if r[0] is not None and r[2] is not None]
    held = [r for r in held if max(map(abs, r[1])) <= vectors.MOST]
    out = []
    for a in sorted({r[0] for r in held if r[0] % every == 0}):
        _, x, label = min((r for r in held if r[0] == a), key=lambda r: (r[2], packed(r[1])))
        scored = sorted(
            (-int(np.dot(x, v)), i, other) for i, v, other in held if i != a
        )
        for s, p, _ in [r for r in scored if r[2] == label][:5]:
            inside = [r for r in scored if r[2] != label and -30 * s <= -100 * r[0] <= -90 * s]
            out += [(a, p, n + 1, i, -s, -t) for n, (t, i, _) in enumerate(inside[:10])]
    return sorted(out)


def packed(v):
    return np.array(v, "<i4").tobytes()


def mined(spark, rows, dims, every, **kw):
    found = hard_negatives.mine(frame(spark, rows), f"vec_id % {every} = 0", dims=dims, **kw)
    assert found.columns == [
        *("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    ]
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("kind", ["even", "clustered", "ties", "negative"])
@pytest.mark.parametrize("per_cell", [4, 1000])
def test_negatives_are_those_of_brute_force(spark, monkeypatch, kind, per_cell):
    """At any number of codes, with codebooks fitted on a few of the rows."""
    monkeypatch.setattr(hard_negatives, "ROWS_PER_CELL", per_cell)
    monkeypatch.setattr(hard_negatives, "SAMPLE", 50)
    monkeypatch.setattr(hard_negatives, "ROWS_AT_ONCE", 7)
    rng = np.random.default_rng(len(kind))
    x = rng.normal(size=(400, 8))
    if kind == "clustered":
        x = rng.normal(size=(6, 8))[rng.integers(0, 6, 400)] + 0.05 * x
    if kind == "ties":
        x = rng.integers(0, 2, size=(400, 8)) / 256
    if kind == "negative":
        x = -np.abs(x) * np.where(np.arange(400) % 2, 1, -1)[:, None]
    rows = [(i, v.tolist(), int(rng.integers(0, 3))) for i, v in enumerate(x)]
    want = brute_negatives(rows, 8, 20)
    assert want
    assert mined(spark, rows, 8, 20, tasks=3) == want


def test_negatives_of_odd_rows(spark):
    rng = np.random.default_rng(1)
    good = [(i, rng.normal(size=4).tolist(), i % 2) for i in range(0, 60, 5)]
    good += [(10, good[2][1], 0), (25, good[5][1], 1), (25, good[5][1], 1)]  # ids that repeat
    odd = [(None, good[0][1], 0), (65, good[1][1], None)]
    rows = [*good, *spoiled(4), *odd]
    assert mined(spark, rows, 4, 10) == brute_negatives(good, 4, 10) != []
    assert mined(spark, [], 4, 10) == []
    assert mined(spark, spoiled(4), 4, 10) == []
    assert mined(spark, [(10, [1.0] * 4, 1)], 4, 10) == []  # no positive
    assert mined(spark, [(11, [1.0] * 4, 1), (12, [1.0] * 4, 2)], 4, 10) == []  # no anchor


def test_large_components(spark):
    """Products beyond what doubles hold exactly."""
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=4) * 1e5).tolist(), i % 2) for i in range(40)]
    assert mined(spark, rows, 4, 5) == brute_negatives(rows, 4, 5) != []


def test_blocks_of_anchors(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ANCHORS", 5)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).tolist(), i % 3) for i in range(90)]
    assert mined(spark, rows, 4, 4) == brute_negatives(rows, 4, 4) != []


def test_cells_come_by_bound():
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=7), rng.normal(size=5)
    found = list(hard_negatives.by_bound(a, b))
    assert sorted((i, j) for _, i, j in found) == [(i, j) for i in range(7) for j in range(5)]
    assert [s for s, _, _ in found] == sorted((s for s, _, _ in found), reverse=True)
    assert all(abs(s - a[i] - b[j]) < 1e-12 for s, i, j in found)


def test_most_rows_stay_unseen_where_rows_are_clustered(spark):
    """The bounds do stop the search: of 40 groups apart, few are looked at."""
    rng = np.random.default_rng(5)
    groups = rng.normal(size=(40, 16))
    groups /= np.linalg.norm(groups, axis=1, keepdims=True)
    x = groups[np.arange(8000) % 40] + 0.005 * rng.normal(size=(8000, 16))
    whole = np.floor(256 * x).astype(np.int64)
    half = [hard_negatives.codebook(part, 40) for part in (whole[:, :8], whole[:, 8:])]
    import pyarrow as pa

    cell = hard_negatives.nearest(whole[:, :8], half[0]) * 40
    cell += hard_negatives.nearest(whole[:, 8:], half[1])
    batch = pa.RecordBatch.from_pydict(
        {
            "id": np.arange(8000),
            "label": pa.array(np.arange(8000) % 2, pa.int32()),
            "v": [row.astype("<i4").tobytes() for row in whole],
            "cell": pa.array(cell, pa.int32()),
        }
    )
    cells = hard_negatives.Cells(batch, tuple(half))
    wide = np.full((20, 1), hard_negatives.ANY)
    anchors = hard_negatives.Anchors(
        np.arange(20), np.arange(20) % 2, whole[:20].astype(float), -wide, wide
    )
    low, high = cells.bounds(anchors.rows)
    seen = 0
    for at in range(20):
        best = hard_negatives.Best(-wide[at], wide[at], 5)
        seen += hard_negatives.visit(cells, at, anchors, best, True, low, high)
        scores = whole @ whole[at]
        same = [i for i in range(8000) if i % 2 == at % 2 and i != at]
        want = sorted(same, key=lambda i: (-scores[i], i))[:5]
        assert best.ids[0].tolist() == want
    assert seen < 20 * 8000 / 3


# ----------------------------------------------------------------- clustering


def brute_clusters(rows, dims, k, rounds):
    held = [(i, v) for i, v, _ in usable(rows, dims) if max(map(abs, v)) <= vectors.MOST]
    order = lambda r: (hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), packed(r[1]).hex())
    centres = [v for _, v in sorted((r for r in held if r[0] is not None), key=order)[:k]]

    def assign():
        return [
            min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centres))
            for _, v in held
        ]

    for _ in range(rounds):
        found = assign()
        for n in range(len(centres)):
            own = [v for (_, v), (_, m) in zip(held, found, strict=True) if m == n]
            if own:
                centres[n] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    return sorted(
        (str(i), n, d, hashlib.sha256(",".join(map(str, centres[n])).encode()).hexdigest())
        for (i, _), (d, n) in zip(held, assign(), strict=True)
    )


def clustered(spark, rows, dims, **kw):
    found = centroids.with_inertia(centroids.cluster(frame(spark, rows), dims=dims, **kw))
    got = found.collect()
    total = sum(r.distance for r in got)
    for r in got:
        assert r.inertia == total
        assert r.cluster_inertia == sum(x.distance for x in got if x.cluster == r.cluster)
    return sorted((str(r.vec_id), r.cluster, r.distance, r.centroid_sha256) for r in got)


@pytest.mark.parametrize("kind", ["even", "clustered", "ties", "large"])
def test_clusters_are_those_of_brute_force(spark, kind):
    rng = np.random.default_rng(len(kind))
    x = rng.normal(size=(150, 6))
    if kind == "clustered":
        x = rng.normal(size=(5, 6))[rng.integers(0, 5, 150)] + 0.02 * x
    if kind == "ties":
        x = rng.integers(-1, 2, size=(150, 6)) / 256
    if kind == "large":
        x = x * 1e5
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    want = brute_clusters(rows, 6, 12, 3)
    assert clustered(spark, rows, 6, k=12, rounds=3) == want


def test_clusters_of_odd_rows(spark):
    rng = np.random.default_rng(1)
    good = [(i, rng.normal(size=4).tolist(), None) for i in range(9)]
    good += [good[3], good[3], (4, [0.0] * 4, 1), (None, [1.0] * 4, 1)]
    rows = [*good, *spoiled(4)]
    assert clustered(spark, rows, 4, k=3) == brute_clusters(good, 4, 3, 5)
    # More centroids than vectors, and several in one place.
    assert clustered(spark, rows, 4, k=40) == brute_clusters(good, 4, 40, 5)
    assert clustered(spark, [], 4) == clustered(spark, spoiled(4), 4) == []


def test_orchard_measures_few_distances():
    rng = np.random.default_rng(2)
    centres = rng.integers(-1000, 1000, size=(40, 3))
    rows = (centres[rng.integers(0, 40, 5000)] + rng.integers(-9, 10, size=(5000, 3))).astype(float)
    search = centroids.Orchard(centres)
    found, distance = search.nearest(rows)
    every = ((rows[:, None] - centres[None]) ** 2).sum(axis=2)
    assert found.tolist() == every.argmin(axis=1).tolist()
    assert distance.tolist() == every.min(axis=1).astype(int).tolist()
    assert search.measured < 5000 * 40 / 3


def test_queries_ignore_partitioning(spark, tmp_path):
    """More files, in another order: the same rows."""
    rows = queries.table(spark, "/root/testdata/sf0.001", "embeddings")
    rows.orderBy(F.hash("vec_id")).repartition(5).write.parquet(f"{tmp_path}/embeddings.parquet")
    for name in ("op12_hard_negatives", "op13_centroid_clustering"):
        query = queries.ALL[name]
        a, b = query(spark, "/root/testdata/sf0.001"), query(spark, str(tmp_path))
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))

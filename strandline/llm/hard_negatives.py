"""Hard negatives: for an anchor and a row of its label, rows of other labels that score
a little lower.

The rows are indexed by an inverted multi-index: a codebook for either half of the
vector, and a cell for each pair of codes. The inner product with an anchor is the sum of
two half scores, and a half score is at most that of the code plus the anchor's length
times the code's radius. A heap goes through the cells in order of the summed bounds
(multi-sequence search) and stops once no cell left can add to any of the anchor's score
windows, so results are exact.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm import vectors
from strandline.llm.keep import keep

SAMPLE = 16_384  # rows that codebooks are fitted on, at most
ROWS_PER_CELL = 128  # aimed at
MOST_CODES = 256  # of either half
FIT_ROUNDS = 8
ANCHORS = 16_384  # searched at a time: some 8 MB
ROWS_AT_ONCE = 1024  # scored before the windows are looked at again
SLACK = 1e-3  # of a bound, for rounding; scores are integers
ANY = 1 << 62


# ---------------------------------------------------------------- index


def codebook(rows: np.ndarray, k: int) -> np.ndarray:
    """``k`` centres of the rows by Lloyd's rounds, from evenly spaced rows."""
    centres = rows[np.linspace(0, len(rows) - 1, k).astype(int)].astype(np.float64)
    for _ in range(FIT_ROUNDS):
        code = nearest(rows, centres)
        counts = np.bincount(code, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, code, rows)
        some = counts > 0
        centres[some] = sums[some] / counts[some, None]
    return centres


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres * centres).sum(axis=1) - 2 * (rows @ centres.T), axis=1)


def books_for(rows: DataFrame, n_rows: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """A codebook of either half, fitted on the SAMPLE rows of least hash."""
    sample = rows.orderBy(F.xxhash64("id", "v"), "id").limit(SAMPLE).select("v")
    found = vectors.matrix(sample.toArrow().column(0).combine_chunks(), dims).astype(np.float64)
    codes = math.ceil(math.sqrt(n_rows / ROWS_PER_CELL))
    k = max(1, min(MOST_CODES, codes, len(found)))
    half = dims // 2
    return codebook(found[:, :half], k), codebook(found[:, half:], k)


def in_cells(rows: DataFrame, books: tuple[np.ndarray, np.ndarray], tasks: int) -> DataFrame:
    """The rows with the ``cell`` of their halves' codes, dealt to tasks by cell. A large
    cell is dealt over several by the rows' hash."""
    dims = books[0].shape[1] + books[1].shape[1]
    half = books[0].shape[1]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = vectors.matrix(batch.column("v"), dims).astype(np.float64)
            cell = nearest(x[:, :half], books[0]) * len(books[1]) + nearest(x[:, half:], books[1])
            yield batch.append_column("cell", pa.array(cell, pa.int32()))

    coded = rows.mapInArrow(task, "id long, label int, v binary, cell int")
    dealt = coded.repartitionByRange(tasks, "cell", F.xxhash64("id", "v"))
    return dealt.sortWithinPartitions("cell")


class Cells:
    """Some rows by cell, with the radius of each code among them."""

    def __init__(self, batch: pa.RecordBatch, books: tuple[np.ndarray, np.ndarray]) -> None:
        dims, half = books[0].shape[1] + books[1].shape[1], books[0].shape[1]
        cell = batch.column("cell").to_numpy()
        order = np.argsort(cell, kind="stable")
        cell = cell[order]
        self.rows = vectors.matrix(batch.column("v"), dims)[order]
        self.ids = batch.column("id").to_numpy()[order]
        self.labels = batch.column("label").to_numpy()[order]
        codes = cell // len(books[1]), cell % len(books[1])
        self.codes, self.centres, self.radii = [], [], []
        for side, (code, book) in enumerate(zip(codes, books, strict=True)):
            part = self.rows[:, half:] if side else self.rows[:, :half]
            away = np.sqrt(((part - book[code]) ** 2).sum(axis=1))
            radius = np.zeros(len(book))
            np.maximum.at(radius, code, away)
            present = np.unique(code)
            self.codes.append(present)
            self.centres.append(book[present])
            self.radii.append(radius[present])
        firsts = np.flatnonzero(np.diff(cell, prepend=-1))
        lasts = np.append(firsts[1:], len(cell))
        of = {int(c): i for i, c in enumerate(self.codes[0])}, {
            int(c): i for i, c in enumerate(self.codes[1])
        }
        self.span = {
            (of[0][c // len(books[1])], of[1][c % len(books[1])]): (a, b)
            for c, a, b in zip(
                cell[firsts].tolist(), firsts.tolist(), lasts.tolist(), strict=True
            )
        }

    def bounds(self, anchors: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Of either half: for each anchor and code, the least and the largest score that
        a row with that code can have."""
        half = self.centres[0].shape[1]
        low, high = [], []
        for side, part in enumerate((anchors[:, :half], anchors[:, half:])):
            part = part.astype(np.float64)
            score = part @ self.centres[side].T
            reach = np.sqrt((part * part).sum(axis=1))[:, None] * self.radii[side]
            low.append(score - reach - SLACK)
            high.append(score + reach + SLACK)
        return low, high


def by_bound(
    first: np.ndarray, second: np.ndarray
) -> Iterator[tuple[float, int, int]]:
    """All pairs of places of two rows of bounds with their sums, largest first."""
    a, b = np.argsort(-first).tolist(), np.argsort(-second).tolist()
    x, y = first[a].tolist(), second[b].tolist()
    heap = [(-x[0] - y[0], 0, 0)]
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield -bound, a[i], b[j]
        if j + 1 < len(y):
            heapq.heappush(heap, (-x[i] - y[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (-x[i + 1] - y[0], i + 1, 0))


# ---------------------------------------------------------------- search


@dataclass(frozen=True)
class Anchors:
    ids: np.ndarray
    labels: np.ndarray
    rows: np.ndarray
    # Of each anchor the windows' least and largest scores; a window may be empty.
    low: np.ndarray
    high: np.ndarray


class Best:
    """The ``k`` best rows seen of one anchor in each of its windows."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int) -> None:
        self.high, self.k = high, k
        self.ids = [np.zeros(0, np.int64)] * len(low)
        self.scores = [np.zeros(0, np.int64)] * len(low)
        # Scores below these add nothing to a window.
        self.floor = np.where(low <= high, low, ANY)
        self.top = int(high[low <= high].max(initial=-ANY))

    def see(self, ids: np.ndarray, scores: np.ndarray) -> None:
        for w in np.flatnonzero(self.floor < ANY).tolist():
            some = (scores >= self.floor[w]) & (scores <= self.high[w])
            if not some.any():
                continue
            i = np.concatenate([self.ids[w], ids[some]])
            s = np.concatenate([self.scores[w], scores[some]])
            order = np.lexsort((i, -s))[: self.k]
            self.ids[w], self.scores[w] = i[order], s[order]
            if len(order) == self.k:
                self.floor[w] = s[order[-1]]


def visit(cells: Cells, at: int, anchors: Anchors, best: Best, same: bool, low, high) -> int:
    """Show ``best`` the rows that may matter to anchor ``at``; returns how many rows."""
    anchor, n_seen = anchors.rows[at], 0
    ids, scores, waiting = [], [], 0

    def show() -> None:
        i, s = np.concatenate(ids), np.concatenate(scores)
        some = i != anchors.ids[at]
        best.see(i[some], s[some])
        ids.clear()
        scores.clear()

    for bound, i, j in by_bound(high[0][at], high[1][at]):
        if bound < best.floor.min(initial=ANY):
            break  # no window can gain from this cell, nor from any after it
        span = cells.span.get((i, j))
        if span is None or low[0][at, i] + low[1][at, j] > best.top:
            continue  # empty, or above all windows
        rows = slice(*span)
        score = (cells.rows[rows] @ anchor).astype(np.int64)
        wanted = (cells.labels[rows] == anchors.labels[at]) == same
        ids.append(cells.ids[rows][wanted])
        scores.append(score[wanted])
        waiting += len(score)
        if waiting >= ROWS_AT_ONCE:
            show()
            n_seen, waiting = n_seen + waiting, 0
    if ids:
        show()
    return n_seen + waiting


def search(
    index: DataFrame,
    books: tuple[np.ndarray, np.ndarray],
    anchors: Anchors,
    k: int,
    same: bool,
    tasks: int,
) -> DataFrame:
    """The ``k`` best rows of each anchor and window, of the anchor's label (``same``) or
    of others: anchor and window (their numbers), id, score, rank. A task keeps its best
    over all it reads, so it sends ``k`` rows per window at most."""
    shared = index.sparkSession.sparkContext.broadcast(anchors)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        best = [Best(a, b, k) for a, b in zip(held.low, held.high, strict=True)]
        for batch in batches:
            if not batch.num_rows:
                continue
            cells = Cells(batch, books)
            rows, cells.rows = vectors.alike(held.rows, cells.rows)
            use = Anchors(held.ids, held.labels, rows, held.low, held.high)
            for start in range(0, len(rows), 1024):
                low, high = cells.bounds(rows[start : start + 1024])
                part = Anchors(*(x[start : start + 1024] for x in vars(use).values()))
                for at in range(len(part.ids)):
                    visit(cells, at, part, best[start + at], same, low, high)
        for at, found in enumerate(best):
            sizes = [len(i) for i in found.ids]
            if sum(sizes):
                yield pa.RecordBatch.from_pydict(
                    {
                        "anchor": pa.array(np.full(sum(sizes), at, np.int32)),
                        "window": pa.array(np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)),
                        "id": pa.array(np.concatenate(found.ids)),
                        "score": pa.array(np.concatenate(found.scores)),
                    }
                )

    found = index.coalesce(tasks).mapInArrow(task, "anchor int, window int, id long, score long")
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    rows: DataFrame,
    is_anchor: str,
    n_positives: int = 5,
    n_negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
    dims: int = 64,
    tasks: int | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """For each anchor and each of its positives, the best negatives in the window.

    Vectors count as integers floor(256 * x); a row's score is its inner product with the
    anchor, higher first, ties by smaller id. An anchor's positives are its best
    ``n_positives`` other rows of the same label. Negatives are rows of other labels with
    low_percent * positive <= 100 * score <= high_percent * positive. Fewer are returned
    where there are fewer. Columns: anchor_id, positive_id, rank (from 1), negative_id,
    positive_score, negative_score.

    ``is_anchor`` is an SQL condition on the id column. Rows with a null id, label or
    vector, with other than ``dims`` components, or with one that is null, not finite or
    beyond 2**19, take no part; other rows than the anchor are those of another id. Rows
    that repeat count each; an anchor's id that repeats is searched once, with its least
    label and vector. Extra columns play no part. An empty table gives no rows.

    The rows are shuffled once, into the order of their cells. Anchors reach the tasks in
    blocks of about ANCHORS; a block costs two passes over the index, one for the
    positives and one for the windows they open. Results are exact at any number of codes,
    whatever rows the codebooks were fitted on.
    """
    spark = rows.sparkSession
    tasks = tasks or spark.sparkContext.defaultParallelism
    named = rows.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("int").alias("label"),
        F.col(vector_col).alias("vector"),
        F.expr(is_anchor).alias("anchor"),
    )
    stored = keep(vectors.integers(named, "vector", ["id", "label", "anchor"], dims), "vectors")
    plain = stored.select("id", "label", "v")
    empty = spark.createDataFrame(
        [],
        "anchor_id long, positive_id long, rank int, negative_id long, "
        "positive_score long, negative_score long",
    )
    n_rows = stored.count()
    if not n_rows:
        return empty
    books = books_for(plain, n_rows, dims)
    index = keep(in_cells(plain, books, tasks), "index")
    anchors = keep(
        stored.filter("anchor").groupBy("id").agg(F.min(F.struct("label", "v")).alias("least")),
        "anchors",
    )
    blocks = math.ceil(anchors.count() / ANCHORS)
    out = empty
    for block in range(blocks):
        some = anchors.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block)
        found = _mine(
            index, books, some, n_positives, n_negatives, low_percent, high_percent, dims, tasks
        )
        out = found if blocks == 1 else out.unionByName(keep(found, "negatives"))
    return out


def _mine(
    index: DataFrame,
    books: tuple[np.ndarray, np.ndarray],
    anchors: DataFrame,
    n_positives: int,
    n_negatives: int,
    low_percent: int,
    high_percent: int,
    dims: int,
    tasks: int,
) -> DataFrame:
    """``mine`` for one block of anchors."""
    given = anchors.select("id", "least.label", "least.v").toArrow().sort_by("id").combine_chunks()
    ids, labels = given.column("id").to_numpy(), given.column("label").to_numpy()
    x = vectors.unpack(b"".join(given.column("v").to_pylist()), dims)
    all_scores = np.full((len(ids), 1), ANY)
    open_ended = Anchors(ids, labels, x, -all_scores, all_scores)
    # A row per anchor and positive: some n_positives * ANCHORS.
    positives = search(index, books, open_ended, n_positives, True, tasks).toArrow()
    anchor, place = positives.column("anchor").to_numpy(), positives.column("rank").to_numpy() - 1
    # Without a positive a window is empty.
    low = np.ones((len(ids), n_positives), np.int64)
    high, score, of = np.zeros_like(low), np.zeros_like(low), np.zeros_like(low)
    score[anchor, place] = positives.column("score").to_numpy()
    of[anchor, place] = positives.column("id").to_numpy()
    # The least and largest whole scores inside.
    low[anchor, place] = -(-low_percent * score[anchor, place] // 100)
    high[anchor, place] = high_percent * score[anchor, place] // 100
    windows = Anchors(ids, labels, x, low, high)
    found = search(index, books, windows, n_negatives, False, tasks)
    facts = pa.table(
        {
            "anchor": pa.array(anchor, pa.int32()),
            "window": pa.array(place, pa.int32()),
            "anchor_id": pa.array(ids[anchor]),
            "positive_id": pa.array(of[anchor, place]),
            "positive_score": pa.array(score[anchor, place]),
        }
    )
    named = index.sparkSession.createDataFrame(facts)
    return found.join(F.broadcast(named), ["anchor", "window"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )

"""Text quality by a vote of the nearest labelled texts in a latent space."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm import ngrams, tokens

# Bins: byte trigrams of the text's form, figures of its words, and the words by hash.
FORM_BINS = 2048
WORD_BINS = 8
LAYOUT = FORM_BINS + WORD_BINS
SIZE = 4096
WORD_SHARE = 0.5  # length of a text's word part, its layout part having 1


def _form() -> np.ndarray:
    """Bytes by kind: capital, small, digit, white space; other signs as they are."""
    form = np.arange(256, dtype=np.uint8)
    form[65:91] = ord("A")
    form[97:123] = ord("a")
    form[128:] = ord("a")
    form[48:58] = ord("0")
    form[[9, 11, 12, 13]] = 32
    return form


FORM = _form()
TRIGRAMS = ngrams.tables_for(9, 3, FORM_BINS)


def counts_of(column: pa.Array) -> np.ndarray:
    """Term counts per text: trigrams of forms, and repeated words as terms of their
    own (a word like the one before; distinct words; pairs met before)."""
    data, offsets = tokens.utf8(column)
    out = np.zeros((len(column), SIZE), np.float32)
    forms = FORM[data]
    for i in range(len(column)):
        out[i, :FORM_BINS] = ngrams.byte_counts(
            forms[offsets[i] : offsets[i + 1]], TRIGRAMS, FORM_BINS
        )
    hashes, rows = tokens.words(column)
    same = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
    out[:, FORM_BINS] = np.bincount(rows[1:][same], minlength=len(column))
    pairs, pair_rows = tokens.shingles(hashes, rows, 2)
    for bin_, (values, of) in enumerate(((hashes, rows), (pairs, pair_rows)), FORM_BINS + 1):
        order = np.lexsort((values, of))
        v, r = values[order], of[order]
        again = (v[1:] == v[:-1]) & (r[1:] == r[:-1])
        out[:, bin_] = np.bincount(r[1:][again], minlength=len(column))
    words = SIZE - LAYOUT
    bins = rows * words + (hashes % np.uint64(words)).astype(np.int64)
    out[:, LAYOUT:] = np.bincount(bins, minlength=len(column) * words).reshape(-1, words)
    return out


def terms_of(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted unit vectors; layout and words count for themselves, whatever their sizes."""
    terms = np.sqrt(counts) * weights
    terms[:, :LAYOUT] = ngrams.unit(terms[:, :LAYOUT])
    terms[:, LAYOUT:] = WORD_SHARE * ngrams.unit(terms[:, LAYOUT:])
    return ngrams.unit(terms)


def leading(blocks: Callable[[], Iterable[np.ndarray]], n: int, rounds: int = 8) -> np.ndarray:
    """The leading right singular vectors of a matrix given in blocks of rows, by subspace
    iteration from a fixed start; a few more than ``n`` are carried along, which speeds
    it up. No more than a block is held beside the vectors."""
    start = tokens.mix(np.arange(SIZE * (n + 16), dtype=np.uint64) + np.uint64(9 << 40))
    basis = (start.view(np.int64) / 2.0**63).reshape(SIZE, -1).astype(np.float32)
    for _ in range(rounds):
        basis, _ = np.linalg.qr(sum(rows.T @ (rows @ basis) for rows in blocks()))
    inner = sum((rows @ basis).T @ (rows @ basis) for rows in blocks())
    _, turn = np.linalg.eigh(inner)
    return np.ascontiguousarray((basis @ turn[:, ::-1])[:, :n], dtype=np.float32)


@dataclass(frozen=True)
class Model:
    """Weights per bin, the map into the latent space, labelled unit vectors there."""

    weights: np.ndarray
    space: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int
    sharpness: float

    def place(self, counts: np.ndarray) -> np.ndarray:
        return ngrams.unit(terms_of(counts, self.weights) @ self.space)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest vectors; all labels'
        share for a text without terms."""
        if not len(self.labels):
            return np.ones(len(counts))
        placed = self.place(counts)
        near = placed @ self.vectors.T
        k = min(self.neighbours, near.shape[1])
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        close = np.clip(np.take_along_axis(near, best, axis=1), 0, 1).astype(np.float64)
        votes = close**self.sharpness
        sums = votes.sum(axis=1)
        share = (votes * self.labels[best]).sum(axis=1) / np.where(sums > 0, sums, 1)
        return np.clip(np.where(sums > 0, share, self.labels.mean()), 0, 1)


def sample(
    docs: DataFrame, labels: DataFrame, max_labelled: int, id_col: str, text_col: str, label_col: str
) -> DataFrame:
    """At most ``max_labelled`` labelled texts, those with the least id hashes. A
    document with several labels has their mean; null labels and texts are left out."""
    few = (
        labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.avg(label_col).alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(max_labelled)
    )
    # Of a proven size: max_labelled rows of two numbers.
    return (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .filter(F.col("text").isNotNull())
        .join(F.broadcast(few), "id")
        .select("text", "label")
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    max_labelled: int = 4096,
    dimensions: int = 48,
    neighbours: int = 15,
    sharpness: float = 8.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> Model:
    """Bin weights from all ``docs``; space and neighbours from a bounded sample.

    ``max_labelled`` bounds what the driver gets: that many rows of terms, at two bytes
    each (33 MB), once. Without any labelled text, all texts score 1: nothing speaks
    against them.
    """
    found, n_docs = ngrams.document_frequencies(docs, counts_of, SIZE, text_col)
    weights = ngrams.idf(found, n_docs)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ngrams.BLOCK):
                part = batch.slice(at, ngrams.BLOCK)
                terms = terms_of(counts_of(part.column(0)), weights).astype(np.float16)
                yield pa.RecordBatch.from_pydict(
                    {"terms": [row.tobytes() for row in terms], "label": part.column(1)}
                )

    # In an order of their own, so that the fit does not depend on the rows'.
    chosen = sample(docs, labels, max_labelled, id_col, text_col, label_col)
    chosen = chosen.orderBy(F.xxhash64("text"), "label")
    rows = chosen.mapInArrow(task, "terms binary, label double").toArrow()
    if not rows.num_rows:
        none = np.zeros((0, dimensions), np.float32)
        return Model(weights, np.zeros((SIZE, dimensions)), none, np.ones(0), neighbours, sharpness)
    column = rows.column("terms")

    def blocks() -> Iterator[np.ndarray]:
        for at in range(0, len(column), ngrams.BLOCK):
            raw = b"".join(column.slice(at, ngrams.BLOCK).to_pylist())
            yield np.frombuffer(raw, np.float16).reshape(-1, SIZE).astype(np.float32)

    space = leading(blocks, dimensions)
    placed = np.concatenate([ngrams.unit(terms @ space) for terms in blocks()])
    marks = rows.column("label").to_numpy().astype(np.float64)
    return Model(weights, space, placed, marks, neighbours, sharpness)


def score(
    docs: DataFrame,
    model: Model,
    threshold: float = 0.7,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: id, score in 0..1, predicted (score >= ``threshold``).

    The model, bounded by its sample, is broadcast; each block of documents is
    compared with all labelled vectors in one product. Null and empty texts have no
    terms and get the labels' mean. Repeated rows give as many rows; other columns
    are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ngrams.BLOCK):
                part = batch.slice(at, ngrams.BLOCK)
                found = shared.value.score(counts_of(part.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(found)], names=["id", "score"]
                )

    kind = docs.schema[id_col].dataType.simpleString()
    scored = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        task, f"id {kind}, score double"
    )
    return scored.select(
        F.col("id").alias(id_col),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def accept(
    docs: DataFrame, model: Model, threshold: float = 0.7, text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is ``threshold`` or more. Rows are
    judged where they are read, so that no text is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ngrams.BLOCK):
                part = batch.slice(first, ngrams.BLOCK)
                found = shared.value.score(counts_of(part.column(at)))
                yield part.filter(pa.array(found >= threshold))

    return docs.mapInArrow(task, docs.schema)

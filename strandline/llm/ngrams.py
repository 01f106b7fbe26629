"""Counts of hashed n-grams per text, and what both classifiers share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm import tokens

PIECE = 1 << 20
BLOCK = 256


def tables_for(seed: int, n: int, size: int) -> np.ndarray:
    """For each place of an n-gram, a random value below ``size`` (a power of two)
    per byte; their XOR is the n-gram's bin."""
    at = np.arange(n * 256, dtype=np.uint64) + np.uint64(seed << 32)
    return (tokens.mix(at) & np.uint64(size - 1)).astype(np.int32).reshape(n, 256)


def byte_counts(data: np.ndarray, table: np.ndarray, size: int) -> np.ndarray:
    """Bin counts of all byte n-grams of one text, a piece at a time."""
    n = len(table)
    total = np.zeros(size, np.int64)
    for at in range(0, max(len(data) - n + 1, 0), PIECE):
        part = data[at : at + PIECE + n - 1]
        bins = table[0][part[: len(part) - n + 1]]
        for k in range(1, n):
            bins = bins ^ table[k][part[k : len(part) - n + 1 + k]]
        total += np.bincount(bins, minlength=size)
    return total


def in_rows(column: pa.Array, block: int = BLOCK) -> Iterator[pa.Array]:
    """The column in blocks of rows."""
    for at in range(0, len(column), block):
        yield column.slice(at, block)


def lower_utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return tokens.utf8(pc.utf8_lower(column.cast(pa.large_string())))


def document_frequencies(
    docs: DataFrame, counts_of: Callable[[pa.Array], np.ndarray], size: int, text_col: str
) -> tuple[np.ndarray, int]:
    """In how many texts each bin occurs, and the number of texts. Each task sums
    what it reads, so it sends ``size`` + 1 rows; the driver gets as many."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, np.int64)
        for batch in batches:
            for part in in_rows(batch.column(0)):
                total[:size] += (counts_of(part) > 0).sum(axis=0)
                total[size] += len(part)
        yield pa.RecordBatch.from_pydict({"bin": np.arange(size + 1), "n": total})

    rows = (
        docs.select(F.col(text_col))
        .mapInArrow(task, "bin long, n long")
        .groupBy("bin")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    found = np.zeros(size + 1, np.int64)
    for bin_, n in rows:
        found[bin_] = n
    return found[:size], int(found[size])


def idf(frequencies: np.ndarray, n_docs: int) -> np.ndarray:
    """Smoothed inverse document frequencies; 0 for bins that never occur."""
    weights = np.log((1 + n_docs) / (1 + frequencies)) + 1
    return np.where(frequencies > 0, weights, 0).astype(np.float32)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; zero rows stay zero."""
    norms = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(norms > 0, norms, 1)


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; 0 for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % parts, F.lit(0))

"""Columns of vectors as integers, in binary."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST = 1 << 27  # of a component: products and squares of 64 then fit 64 bits
EXACT = 1 << 52  # below it, sums of products are exact in doubles


def integers(
    df: DataFrame, vector_col: str, others: Sequence[str], dims: int, scale: int = 256
) -> DataFrame:
    """The columns ``others`` and ``v``: floor(scale * x) of each component x as a double,
    as little-endian 32-bit integers. Rows whose vector is null, has not ``dims``
    components, or has one that is null, not finite or beyond 2**27 as an integer, go."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            fits = pc.fill_null(pc.equal(pc.list_value_length(column), dims), False)
            batch = batch.filter(fits)
            parts = batch.column(0).flatten()
            gaps = parts.is_null().to_numpy(zero_copy_only=False).reshape(-1, dims)
            values = parts.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
            with np.errstate(invalid="ignore", over="ignore"):
                whole = np.floor(scale * values.reshape(-1, dims))
                good = ~gaps.any(axis=1) & (np.abs(whole) <= MOST).all(axis=1)
            batch = batch.filter(pa.array(good))
            found = np.ascontiguousarray(whole[good].astype("<i4"))
            edges = np.arange(len(found) + 1, dtype=np.int32) * (4 * dims)
            v = pa.BinaryArray.from_buffers(
                pa.binary(), len(found), [None, pa.py_buffer(edges), pa.py_buffer(found)]
            )
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], v], names=names)

    rows = df.select(F.col(vector_col).alias("_vector"), *others)
    names = [*others, "v"]
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in others)
    return rows.mapInArrow(task, f"{schema}, v binary")


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A column of such vectors as a matrix: doubles where that is exact, else integers."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data or b"", np.uint8)[at[0] : at[-1]] if len(column) else b""
    return unpack(raw, dims)


def unpack(raw: bytes | np.ndarray, dims: int) -> np.ndarray:
    return exact(np.frombuffer(raw, "<i4").reshape(-1, dims).astype(np.int64))


def exact(values: np.ndarray) -> np.ndarray:
    """Doubles, if sums of products of these values are exact in doubles."""
    peak = int(np.abs(values).max(initial=0))
    return values.astype(np.float64) if 4 * values.shape[1] * peak * peak < EXACT else values


def alike(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles or both as integers."""
    if a.dtype == b.dtype:
        return a, b
    return a.astype(np.int64), b.astype(np.int64)

"""What vector operators share: which rows take part, and seeded rotations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def marked(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector, usable) of all rows.

    Vectors that are null, empty, zero, or hold null or non-finite components take no part. Those of
    different lengths take part, each among its own.
    """
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fine = F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    return rows.withColumn("usable", fine)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) of the rows that take part."""
    return marked(vectors, id_col, vector_col).where("usable").drop("usable")


def by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """Places of the vectors of each length, and those vectors."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        yield at, column.take(pa.array(at))


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """Rows of an array column of equal lengths, in double precision."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), dimension)


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of each row, whose length is a power of two; keeps lengths."""
    n, width = rows.shape
    half = 1
    while half < width:
        pairs = rows.reshape(n, -1, 2, half)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2)
        rows = rows.reshape(n, width)
        half *= 2
    return rows / np.sqrt(width)


def rotated(rows: np.ndarray, seed: int) -> np.ndarray:
    """Random rotation: three rounds of random signs and a Hadamard transform, padded with 0.

    In few dimensions such rounds give few different rotations, so there are 64 at least.
    """
    width = max(64, 1 << max(0, rows.shape[1] - 1).bit_length())
    signs = np.random.default_rng(seed)
    out = np.zeros((len(rows), width))
    out[:, : rows.shape[1]] = rows
    for _ in range(3):
        out = hadamard(out * signs.choice([-1.0, 1.0], width))
    return out

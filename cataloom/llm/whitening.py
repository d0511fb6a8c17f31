"""Whitening of vectors by an exact covariance, through the polarisation identity.

Entries become whole numbers. Each distinct whole vector of a length is in the fit list once: n
vectors x with sums S. Their centred values y = n*x - S are whole numbers too, so the squares
summed over the list, of every y_i and of every y_i + y_j, are exact. A cross sum is then half of
what the square of the pair sum has beyond the two single squares,

    2 * sum(y_i * y_j) = sum((y_i + y_j)^2) - sum(y_i^2) - sum(y_j^2)

and the covariance, n^3 times smaller, is rounded once, when it becomes a double for ``eigh``.
Tasks add up what they read and send one row per sum; the driver gets the sums and holds one
dimension-by-dimension matrix for each vector length, whatever the number of rows.

Defined cases: rows whose vector is null or holds null or non-finite entries drop out; vectors of
another length are a list of their own; copies count once in the fit and all get results; a null
id stays as it is; components without variance cannot be whitened and give no rows, so one vector
alone gives none. Entries must stay below ``2**40`` once scaled, else the job fails.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cataloom.storage import materialize

SUM = T.DecimalType(38, 0)
_SUMS = "dimension int, a int, b int, total decimal(38,0)"
_MOMENTS = "dimension int, a int, b int, total double"
_ROWS = 4096  # rows whose squares are summed at once


@dataclass(frozen=True)
class Settings:
    scale: int = 64
    offset: int = 1_000_000
    components: int = 16
    largest: int = 1 << 40  # of a scaled entry


@dataclass(frozen=True)
class Model:
    """What one vector length teaches: whitened = (x - sums / n) @ axes."""

    n: int
    sums: list[int]
    directions: np.ndarray  # unit eigenvectors as columns, by falling eigenvalue
    values: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def axes(self) -> np.ndarray:
        return self.directions / np.sqrt(self.values)


def whole(vector: Column, settings: Settings) -> Column:
    """Entries as whole numbers."""

    def entry(c: Column) -> Column:
        scaled = c.cast("double") * settings.scale
        fits = F.abs(scaled) < float(settings.largest)
        failed = F.raise_error(F.lit("a vector entry is too large to be whitened")).cast("bigint")
        return F.when(fits, F.floor(scaled) + F.lit(settings.offset).cast("bigint")).otherwise(failed)

    return F.transform(vector, entry)


def whole_rows(vectors: DataFrame, id_col: str, vector_col: str, settings: Settings) -> DataFrame:
    """(id, x) of the rows that take part."""
    v = F.col("vector")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    rows = rows.where(v.isNotNull() & finite & (F.size(v) > 0))
    return rows.select("id", whole(v, settings).alias("x"))


def by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the vectors of each length, and those vectors as rows."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    for dimension in np.unique(lengths):
        at = np.flatnonzero(lengths == dimension)
        values = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        yield at, values.astype(np.int64).reshape(len(at), dimension)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n*x - S, exact: as 64-bit numbers where they fit, else as Python's."""
    mean = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)
    near = x - mean
    if (int(np.abs(near).max(initial=0)) + 1) * n < 1 << 62:
        return near * n - rest
    return near.astype(object) * n - rest.astype(object)


def squares(z: np.ndarray) -> list[int]:
    """Exact sum of squares of each column."""
    if z.dtype == object:
        return list((z * z).sum(axis=0))
    largest = int(np.abs(z).max(initial=0))
    if largest * largest * len(z) < 1 << 62:
        return np.einsum("ij,ij->j", z, z).tolist()
    if largest >= 1 << 47 or len(z) > 1 << 14:
        return list((z.astype(object) ** 2).sum(axis=0))
    high, low = z >> 24, z & ((1 << 24) - 1)
    parts = [np.einsum("ij,ij->j", a, b).tolist() for a, b in ((high, high), (high, low), (low, low))]
    return [(hh << 48) + (hl << 25) + ll for hh, hl, ll in zip(*parts, strict=True)]


def _sent(totals: dict[tuple[int, int, int], int]) -> pa.RecordBatch:
    """One row for each sum of a task."""
    dimension, a, b = zip(*totals, strict=True) if totals else ((), (), ())
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.decimal128(38, 0))
    columns = (dimension, a, b, [Decimal(int(t)) for t in totals.values()])
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
        names=["dimension", "a", "b", "total"],
    )


def plain_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n, at place (-1, -1), and the sum of each dimension, at (i, i)."""
    totals: dict = defaultdict(int)
    for batch in batches:
        for _, x in by_length(batch.column("x")):
            d = x.shape[1]
            totals[d, -1, -1] += len(x)
            for i, s in enumerate(x.sum(axis=0).tolist()):
                totals[d, i, i] += s
    yield _sent(totals)


def square_sums(lists: dict[int, tuple[int, list[int]]]):
    """Sums of (y_i)^2, at place (i, i), and of (y_i + y_j)^2, at (i, j)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict = defaultdict(int)
        for batch in batches:
            for _, x in by_length(batch.column("x")):
                d = x.shape[1]
                for lo in range(0, len(x), _ROWS):
                    y = centred(x[lo : lo + _ROWS], *lists[d])
                    for i, q in enumerate(squares(y)):
                        totals[d, i, i] += q
                    for i in range(d - 1):
                        pairs = squares(y[:, i : i + 1] + y[:, i + 1 :])
                        for j, q in enumerate(pairs, i + 1):
                            totals[d, i, j] += q
        yield _sent(totals)

    return add


def covariance(n: int, dimension: int, q: dict[tuple[int, int], int]) -> np.ndarray:
    """V from the sums of squares: whole numbers up to the one division."""
    v = np.empty((dimension, dimension))
    for i in range(dimension):
        v[i, i] = q[i, i] / n**3
        for j in range(i + 1, dimension):
            v[i, j] = v[j, i] = (q[i, j] - q[i, i] - q[j, j]) // 2 / n**3
    return v


def axes_of(n: int, sums: list[int], v: np.ndarray, components: int) -> Model:
    """The first components with variance; the largest entry of each direction is positive."""
    values, directions = np.linalg.eigh(v)
    values, directions = values[::-1], directions[:, ::-1]
    noise = 8 * len(v) * np.finfo(float).eps * max(values[0], 0)
    k = min(components, int((values > noise).sum()))
    values, directions = values[:k].copy(), directions[:, :k].copy()
    if k:
        top = directions[np.abs(directions).argmax(axis=0), np.arange(k)]
        directions *= np.where(top < 0, -1.0, 1.0)
    return Model(n, sums, directions, values, float(np.trace(v)))


def project(x: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The centred values, and the whitened ones."""
    y = centred(x, model.n, model.sums)
    return y, (y.astype(np.float64) / model.n) @ model.axes


def _collected(fit_list: DataFrame, add) -> dict[int, dict[tuple[int, int], int]]:
    found: dict = defaultdict(dict)
    sums = fit_list.mapInArrow(add, _SUMS).groupBy("dimension", "a", "b")
    for r in sums.agg(F.sum("total").cast(SUM).alias("total")).collect():
        found[r["dimension"]][r["a"], r["b"]] = int(r["total"])
    return found


def fit(rows: DataFrame, settings: Settings) -> dict[int, Model]:
    """A model for each vector length, from the distinct ``x`` of the rows."""
    spark = rows.sparkSession
    fit_list = materialize(rows.select("x").distinct(), "fit-list")
    lists = {
        d: (s[-1, -1], [s[i, i] for i in range(d)]) for d, s in _collected(fit_list, plain_sums).items()
    }
    models = {
        d: axes_of(*lists[d], covariance(lists[d][0], d, q), settings.components)
        for d, q in _collected(fit_list, square_sums(lists)).items()
    }
    held = spark.sparkContext.broadcast(models)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: dict = defaultdict(float)
        second: dict = defaultdict(float)
        for batch in batches:
            for _, x in by_length(batch.column("x")):
                white = project(x, held.value[x.shape[1]])[1]
                first[x.shape[1]] += white.sum(axis=0)
                second[x.shape[1]] += white.T @ white
        out = [(d, -1, b, t) for d, v in first.items() for b, t in enumerate(v.tolist())]
        for d, m in second.items():
            out += [(d, a, b, t) for a, v in enumerate(m.tolist()) for b, t in enumerate(v)]
        columns = zip(*out, strict=True) if out else ((), (), (), ())
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.float64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["dimension", "a", "b", "total"],
        )

    total: dict = defaultdict(dict)
    sums = fit_list.mapInArrow(moments, _MOMENTS).groupBy("dimension", "a", "b")
    for r in sums.agg(F.sum("total").alias("total")).collect():
        total[r["dimension"]][r["a"], r["b"]] = r["total"]
    done = {}
    for d, model in models.items():
        k = len(model.values)
        mean = np.array([total[d][-1, b] for b in range(k)]) / model.n
        second = np.array([[total[d][a, b] for b in range(k)] for a in range(k)]).reshape(k, k)
        apart = second / model.n - np.outer(mean, mean) - np.eye(k)
        error = float(np.abs(apart).max(initial=0.0))
        done[d] = Model(model.n, model.sums, model.directions, model.values, model.trace, error)
    return done


def whiten(
    vectors: DataFrame,
    settings: Settings | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """A row for each remaining vector and component: the id, component, n, deviation (an exact
    decimal), whitened, explained, identity_error. Other columns do not matter."""
    settings = settings or Settings()
    rows = whole_rows(vectors, id_col, vector_col, settings)
    held = vectors.sparkSession.sparkContext.broadcast(fit(rows, settings))
    added = T.StructType.fromDDL(
        "component int, n bigint, deviation decimal(38,0), whitened double, explained double,"
        " identity_error double"
    )
    schema = T.StructType([rows.schema["id"], *added.fields])

    def white(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in by_length(batch.column("x")):
                model = held.value[x.shape[1]]
                y, values = project(x, model)
                count, k = values.shape
                if not k:
                    continue
                away = [Decimal(d) for d in squares(np.ascontiguousarray(y.T))]
                take = pa.array(np.repeat(at, k))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(take),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                        pa.array(np.full(count * k, model.n, np.int64)),
                        pa.array(away, pa.decimal128(38, 0)).take(
                            pa.array(np.repeat(np.arange(count), k))
                        ),
                        pa.array(values.ravel()),
                        pa.array(np.tile(model.values / model.trace, count)),
                        pa.array(np.full(count * k, model.identity_error)),
                    ],
                    names=schema.names,
                )

    return rows.mapInArrow(white, schema).withColumnRenamed("id", id_col)

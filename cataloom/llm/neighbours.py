"""Nearest neighbours by greatest inner product: inverted lists and adaptive dimension scan.

A vector gets one more component that makes all candidates equally long, which turns the
greatest inner product into the least distance. Vectors are rotated at random and kept in
blocks of columns. In the lists that a query probes, distances grow block by block; after each
block a hypothesis test abandons the candidates whose partial distance says that the whole one
is, but for a small chance, beyond the query's bound. The bound starts as the distance of the
k-th nearest of the sampled rows in the probed lists, which are results themselves until
nearer ones are found, and shrinks with what the list itself offers.

The lists' centres are fitted on a bounded sample (``Settings.sample`` rows, in the order of a
hash); every row is indexed. Lists and their queries are split into cells of bounded size, so a
list with a third of all rows, or of all queries, is many tasks. What survives is measured on
the original vectors in double precision.

Candidates that repeat an id count once, with their best score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cataloom.llm.vectors import matrix, rotated, usable
from cataloom.storage import materialize

RESULT = "query_id bigint, rank int, vec_id bigint, score double"


@dataclass(frozen=True)
class Settings:
    sample: int = 16384  # rows to fit centres on
    bounding: int = 4096  # of these, rows to take first bounds from
    list_rows: int = 256  # rows per list that the number of lists aims at
    most_lists: int = 2048
    probed: float = 0.72  # share of the lists that a query looks into
    block: int = 16  # columns added between two tests
    doubt: float = 2.1  # the greater, the fewer candidates are abandoned wrongly
    cell: int = 2048  # candidates and queries in a task's unit of work


@dataclass(frozen=True)
class Index:
    dimension: int
    longest: float  # squared length of the longest vector
    centres: np.ndarray
    sample: np.ndarray  # rows to take first bounds from
    sample_ids: np.ndarray

    def lists(self, turned: np.ndarray) -> np.ndarray:
        """The list of each rotated row."""
        return np.concatenate(
            [
                distances(turned[i : i + 512], self.centres).argmin(axis=1)
                for i in range(0, len(turned), 512)
            ]
            or [np.empty(0, np.int64)]
        )

    def candidates(self, rows: np.ndarray) -> np.ndarray:
        extra = np.sqrt(np.maximum(0, self.longest - (rows * rows).sum(axis=1)))
        return rotated(np.column_stack([rows, extra]), seed=1)

    def queries(self, rows: np.ndarray) -> np.ndarray:
        return rotated(np.column_stack([rows, np.zeros(len(rows))]), seed=1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared, of all rows of one to all rows of the other."""
    both = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)
    return np.maximum(both, 0)


def centres_of(rows: np.ndarray, n: int, rounds: int = 8) -> np.ndarray:
    """k-means from evenly spaced rows; a centre that loses all its rows stays where it is."""
    centres = rows[np.linspace(0, len(rows) - 1, n).astype(int)]
    for _ in range(rounds):
        owner = np.concatenate(
            [distances(rows[i : i + 1024], centres).argmin(axis=1) for i in range(0, len(rows), 1024)]
        )
        sums = np.zeros_like(centres)
        np.add.at(sums, owner, rows)
        counts = np.bincount(owner, minlength=n)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def fit(rows: DataFrame, dimension: int, settings: Settings) -> Index | None:
    """Centres and first bounds from a sample; None without rows."""
    length = F.aggregate(
        "vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")
    )
    total = rows.agg(F.count("*").alias("n"), F.max(length).alias("longest")).first()
    if not total["n"]:
        return None
    # Tasks send little more than the sample between them, not as much each.
    place = F.xxhash64("id", "vector")
    below = int((4 * settings.sample / total["n"] - 1) * 2**63)
    few = rows if below >= 2**63 else rows.where(place < below)
    picked = few.orderBy(place, "id").limit(settings.sample).collect()
    sample = np.array([r["vector"] for r in picked], np.float64)
    ids = np.array([r["id"] for r in picked], np.int64)
    n = max(1, min(settings.most_lists, total["n"] // settings.list_rows, len(sample) // 8))
    few = slice(settings.bounding)
    bare = Index(dimension, total["longest"], np.empty((0, 0)), sample[few], ids[few])
    return replace(bare, centres=centres_of(bare.candidates(sample), n))


def scan(
    queries: np.ndarray, bounds: np.ndarray, rows: np.ndarray, k: int, settings: Settings
) -> tuple[np.ndarray, np.ndarray]:
    """Positions (query, row) of pairs that may be within the queries' k nearest."""
    width = rows.shape[1]
    if len(rows) > k:
        # The k-th nearest of the first rows is a bound too.
        first = distances(queries, rows[: 4 * k])
        # One more, as the query itself may be among them.
        own = np.partition(first, k, axis=1)[:, k] if first.shape[1] > k else np.inf
        bounds = np.minimum(bounds, own)
    bounds = bounds * (1 + 1e-9) + 1e-9
    partial = np.zeros((len(queries), len(rows)))
    at = 0
    while at < width:
        to = min(at + settings.block, width)
        partial += distances(queries[:, at:to], rows[:, at:to])
        at = to
        allowed = bounds
        if at < width:
            allowed = bounds * (at / width) * (1 + settings.doubt / np.sqrt(at)) ** 2
        alive = partial <= allowed[:, None]
        if alive.sum() * 4 < alive.size:
            break
    q, r = np.nonzero(alive)
    found = partial[q, r]
    while at < width:  # few are left: only they go on
        to = min(at + settings.block, width)
        gap = queries[q, at:to] - rows[r, at:to]
        found = found + (gap * gap).sum(axis=1)
        at = to
        allowed = bounds[q]
        if at < width:
            allowed = allowed * (at / width) * (1 + settings.doubt / np.sqrt(at)) ** 2
        keep = found <= allowed
        q, r, found = q[keep], r[keep], found[keep]
    return q, r


def nearest(
    vectors: DataFrame,
    k: int = 20,
    settings: Settings | None = None,
    queries: DataFrame | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The k nearest found of every query row (all rows): query_id, rank, vec_id, score.

    Fewer than k only if there are no more candidates. Ties go to the smaller id. Rows with a
    null id take no part; vectors of different lengths are searched each among its own.
    """
    settings = settings or Settings()
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col).where(F.col("id").isNotNull())
    asked = usable(queries if queries is not None else vectors, id_col, vector_col)
    asked = asked.where(F.col("id").isNotNull()).dropDuplicates(["id"])
    lengths = [r[0] for r in asked.select(F.size("vector")).distinct().collect()]
    found = [
        _nearest(*(df.where(F.size("vector") == n) for df in (rows, asked)), n, k, settings)
        for n in sorted(lengths)
    ]
    parts = [df for df in found if df is not None]
    return reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], RESULT)


def _nearest(
    rows: DataFrame, asked: DataFrame, dimension: int, k: int, settings: Settings
) -> DataFrame | None:
    """Of the rows of one length, which have an index of their own; None without rows."""
    spark = rows.sparkSession
    index = fit(rows, dimension, settings)
    if index is None:
        return None
    held = spark.sparkContext.broadcast(index)
    vector = rows.schema["vector"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = held.value
        for batch in batches:
            turned = at.candidates(matrix(batch.column("vector"), dimension))
            yield pa.RecordBatch.from_arrays(
                [pa.array(at.lists(turned).astype(np.int32)), *batch.columns],
                names=["list", "id", "vector"],
            )

    placed = materialize(
        rows.mapInArrow(
            place, T.StructType([T.StructField("list", T.IntegerType()), rows.schema["id"], vector])
        ),
        "lists",
    )
    sizes = np.zeros(len(index.centres), np.int64)
    for r in placed.groupBy("list").count().collect():  # one row per list
        sizes[r["list"]] = r["count"]

    seed = pa.struct([("vec_id", pa.int64()), ("score", pa.float64())])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = held.value
        least = int(np.ceil(settings.probed * len(at.centres)))
        sample = at.candidates(at.sample)
        sample_lists = at.lists(sample)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                original = matrix(part.column("vector"), dimension)
                turned = at.queries(original)
                order = distances(turned, at.centres).argsort(axis=1, kind="stable")
                # Enough lists for k candidates besides the query.
                met = np.cumsum(sizes[order], axis=1)
                n = np.maximum(least, (met < min(k + 1, sizes.sum())).sum(axis=1) + 1)
                probed = np.zeros(order.shape, bool)
                np.put_along_axis(probed, order, np.arange(order.shape[1]) < n[:, None], axis=1)
                apart = distances(turned, sample)
                apart[~probed[:, sample_lists]] = np.inf
                apart[part.column("id").to_numpy()[:, None] == at.sample_ids] = np.inf
                best = np.argsort(apart, axis=1, kind="stable")[:, :k]
                far = np.take_along_axis(apart, best, axis=1)
                bound = far[:, -1] if best.shape[1] == k else np.full(len(turned), np.inf)
                seeds: list = [None] * int(n.sum())
                for i, first in enumerate(np.cumsum(n) - n):
                    of = best[i][np.isfinite(far[i])]
                    scores = (original[i] * at.sample[of]).sum(axis=1)
                    seeds[first] = [
                        {"vec_id": v, "score": x}
                        for v, x in zip(at.sample_ids[of].tolist(), scores.tolist(), strict=True)
                    ]
                owner = np.repeat(np.arange(len(turned)), n)
                lists = np.concatenate([order[i, :m] for i, m in enumerate(n)])
                take = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(lists.astype(np.int32)),
                        part.column("id").take(take),
                        part.column("vector").take(take),
                        pa.array(bound[owner]),
                        pa.array(seeds, pa.list_(seed)),
                    ],
                    names=["list", "id", "vector", "bound", "seeds"],
                )

    probes = materialize(
        asked.mapInArrow(
            probe,
            T.StructType(
                [
                    T.StructField("list", T.IntegerType()),
                    rows.schema["id"],
                    vector,
                    *T.StructType.fromDDL(
                        "bound double, seeds array<struct<vec_id: bigint, score: double>>"
                    ),
                ]
            ),
        ),
        "probes",
    )
    # Each list's rows and queries in parts; a cell is one part of either.
    row_parts, query_parts = (
        table.groupBy("list").agg(
            F.ceil(F.count("*") / settings.cell).cast("int").alias(name)
        )
        for table, name in ((placed, "row_parts"), (probes, "query_parts"))
    )
    parts = materialize(row_parts.join(query_parts, "list"), "parts")
    split = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = (
        probes.join(F.broadcast(parts), "list")
        .withColumn("query_part", split("query_parts"))
        .withColumn("row_part", every("row_parts"))
    )
    right = (
        placed.join(F.broadcast(parts), "list")
        .withColumn("row_part", split("row_parts"))
        .withColumn("query_part", every("query_parts"))
    )
    cell = ["list", "row_part", "query_part"]
    found = "query_id bigint, vec_id bigint, score double"

    def search(asked_: pa.Table, rows_: pa.Table) -> pa.Table:
        at = held.value
        ids, query_ids = (t["id"].combine_chunks().to_numpy() for t in (rows_, asked_))
        original = matrix(rows_["vector"].combine_chunks(), dimension)
        wanted = matrix(asked_["vector"].combine_chunks(), dimension)
        turned, turned_queries = at.candidates(original), at.queries(wanted)
        bounds = asked_["bound"].to_numpy()
        out: list[tuple[np.ndarray, ...]] = []
        for lo in range(0, len(wanted), 256):
            q, r = scan(turned_queries[lo : lo + 256], bounds[lo : lo + 256], turned, k, settings)
            q = q + lo
            other = ids[r] != query_ids[q]
            q, r = q[other], r[other]
            for i in range(0, len(q), 1 << 16):
                a, b = q[i : i + (1 << 16)], r[i : i + (1 << 16)]
                out.append((a, ids[b], (wanted[a] * original[b]).sum(axis=1)))
        q, near, scores = (
            np.concatenate(x) if out else np.empty(0) for x in (zip(*out, strict=True) if out else [()] * 3)
        )
        order = np.lexsort((near, -scores, q))
        q, near, scores = q[order].astype(np.int64), near[order], scores[order]
        begin = np.searchsorted(q, q)
        best = np.arange(len(q)) - begin < k
        return pa.table(
            {
                "query_id": pa.array(query_ids[q[best]], pa.int64()),
                "vec_id": pa.array(near[best], pa.int64()),
                "score": pa.array(scores[best], pa.float64()),
            }
        )

    pairs = (
        left.select(*cell, "id", "vector", "bound")
        .groupBy(*cell)
        .cogroup(right.select(*cell, "id", "vector").groupBy(*cell))
        .applyInArrow(search, found)
    )
    seeds = probes.select(F.col("id").alias("query_id"), F.inline("seeds"))
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        pairs.union(seeds)
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(rank))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

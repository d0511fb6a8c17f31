"""Near-duplicate vectors: cross-polytope hashing with multiprobe buckets, pairs verified.

A table rotates vectors at random with fast Hadamard transforms, twice, and hashes each
rotation to the axis, of either sign, that it is nearest to; the two axes name the bucket. A
vector also probes the buckets that the next nearest axes would name. With 12 tables and 2
probes a pair at the threshold is missed about once in 10^7 (64 dimensions, by simulation).

Vectors equal in all components stand in for each other. Buckets are split into cells of
bounded size; a cell verifies its pairs as a matrix product. A pair that meets in several
buckets counts in the first one only, which each cell can tell from both vectors' hashes, so
pairs are counted and never emitted: a cell returns for each vector its links there, and links
that keep the cell's components together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cataloom.llm.graph import components
from cataloom.llm.vectors import by_length, marked, matrix, rotated
from cataloom.storage import materialize


@dataclass(frozen=True)
class Settings:
    least: float = 0.95  # cosine of a link
    tables: int = 12
    probes: int = 2
    near: int = 3  # axes of each rotation that probes choose from
    cell: int = 1024  # rows of a bucket's part
    slot: int = 8192  # rows that a task's group aims at


def hashes(unit: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each row, one per table, and the further buckets it probes."""
    main, more = [], []
    for table in range(settings.tables):
        axes, sizes = [], []
        for turn in range(2):
            turned = rotated(unit, seed=1000 * table + turn + 7)
            n = min(settings.near, turned.shape[1])
            size = np.abs(turned)
            at = np.argsort(-size, axis=1, kind="stable")[:, :n]
            axes.append(2 * at + (np.take_along_axis(turned, at, 1) < 0))
            sizes.append(np.take_along_axis(size, at, 1))
        width = 2 * turned.shape[1]
        pairs = axes[0][:, :, None] * width + axes[1][:, None, :]
        loss = (sizes[0][:, :1] - sizes[0])[:, :, None] ** 2
        loss = loss + ((sizes[1][:, :1] - sizes[1]) ** 2)[:, None, :]
        pairs, loss = (x.reshape(len(unit), n * n) for x in (pairs, loss))
        order = np.argsort(loss[:, 1:], axis=1, kind="stable")[:, : settings.probes] + 1
        main.append(pairs[:, 0])
        more.append(np.take_along_axis(pairs, order, 1))
    return np.stack(main, axis=1), np.stack(more, axis=1)


def meetings(
    x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each pair of rows and each table: same bucket, y probes x's, x probes y's."""
    (main_x, more_x), (main_y, more_y) = x, y
    return (
        main_x == main_y,
        (more_y == main_x[:, :, None]).any(axis=2),
        (more_x == main_y[:, :, None]).any(axis=2),
    )


def units(column: pa.Array, dimension: int) -> np.ndarray:
    rows = matrix(column, dimension)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # squares stay in range
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def cell_pairs(unit: np.ndarray, left: np.ndarray, right: np.ndarray, least: float):
    """Pairs of a left and a right row whose cosine is at least ``least``."""
    x, y = np.nonzero(unit[left] @ unit[right].T >= least)
    return left[x], right[y]


def linked(
    vectors: DataFrame,
    settings: Settings | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``id_col``, ``n_links``, ``component_id`` and ``kept`` of every row.

    Rows that take no part have no links and are their own component. Of rows that repeat an
    id each counts by its own vector; a null id is never a component's least unless all are.
    """
    settings = settings or Settings()
    marked_ = marked(vectors, id_col, vector_col)
    distinct = materialize(
        marked_.where("usable")
        .groupBy("vector")
        .agg(F.count("*").alias("copies"), F.min("id").alias("low"))
        .withColumn("node", F.monotonically_increasing_id()),
        "distinct-vectors",
    )

    def hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                for at, some in by_length(part.column("vector")):
                    dimension = len(some[0])
                    main, more = hashes(units(some, dimension), settings)
                    # Vectors of different lengths have no bucket in common.
                    buckets = np.concatenate([main[:, :, None], more], axis=2) + (dimension << 36)
                    n, tables, each = buckets.shape
                    owner = pa.array(np.repeat(at, tables * each))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.tile(np.repeat(np.arange(tables), each), n), pa.int32()),
                            pa.array(buckets.reshape(-1), pa.int64()),
                            pa.array(np.tile(np.arange(each) > 0, n * tables)),
                            part.column("node").take(owner),
                        ],
                        names=["tab", "bucket", "probing", "node"],
                    )

    entries = materialize(
        distinct.select("node", "vector").mapInArrow(
            hash_rows, "tab int, bucket bigint, probing boolean, node bigint"
        ),
        "buckets",
    )
    # Buckets in which a pair can meet, and into how many parts their own rows and the rows
    # that probe them are dealt.
    own, guests = (F.count(F.when(F.col("probing") == x, 1)) for x in (False, True))
    parts = materialize(
        entries.groupBy("tab", "bucket")
        .agg(own.alias("own"), guests.alias("guests"))
        .where("own > 0 and own + guests > 1")
        .select(
            "tab",
            "bucket",
            *(F.ceil(F.col(c) / settings.cell).cast("int").alias(c) for c in ("own", "guests")),
        ),
        "bucket-parts",
    )
    # Parts 0, 1, ... are the bucket's own, the others its guests'. Cell (i, j), i <= j, holds
    # parts i and j; no cell is for guests only.
    dealt = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    cells = F.when(
        F.col("probing"),
        F.transform(
            F.sequence(F.lit(0), F.col("own") - 1),
            lambda i: F.struct(i.alias("i"), F.col("part").alias("j")),
        ),
    ).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.col("own") + F.col("guests") - 1),
            lambda j: F.struct(F.least("part", j).alias("i"), F.greatest("part", j).alias("j")),
        )
    )
    seats = materialize(
        entries.join(parts, ["tab", "bucket"])
        .withColumn(
            "part", F.when(F.col("probing"), F.col("own") + dealt("guests")).otherwise(dealt("own"))
        )
        .withColumn("cell", F.explode(cells))
        .select("tab", "bucket", "part", "probing", "node", "cell.i", "cell.j"),
        "seats",
    )
    slots = 1 + seats.count() // settings.slot
    place = ["tab", "bucket", "i", "j"]
    seated = seats.join(distinct.select("node", "copies", "vector"), "node").select(
        F.size("vector").alias("dimension"),
        F.pmod(F.xxhash64(*place), F.lit(slots)).alias("slot"),
        *place,
        "part",
        "probing",
        "node",
        "copies",
        "vector",
    )

    def verify(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in [*place, "part", "node"]])
        column = {
            c: table[c].to_numpy() for c in [*place, "part", "probing", "node", "copies"]
        }
        unit = units(table["vector"].combine_chunks(), table["dimension"][0].as_py())
        node, tab, part = column["node"], column["tab"], column["part"]
        new = np.zeros(len(node), bool)
        new[0] = True
        for c in place:
            new[1:] |= column[c][1:] != column[c][:-1]
        starts = np.flatnonzero(new)
        xs, ys = [], []
        for lo, hi in zip(starts, np.append(starts[1:], len(node)), strict=True):
            at = np.arange(lo, hi)
            if column["i"][lo] == column["j"][lo]:
                x, y = cell_pairs(unit, at, at, settings.least)
                x, y = x[x < y], y[x < y]
            else:
                first = part[lo:hi] == column["i"][lo]
                if first.all() or not first.any():
                    continue
                x, y = cell_pairs(unit, at[first], at[~first], settings.least)
            xs.append(x)
            ys.append(y)
        x, y = (np.concatenate([*a, np.empty(0, np.int64)]).astype(np.int64) for a in (xs, ys))
        links = np.zeros(len(node), np.int64)
        root = node.copy()
        used, where = np.unique(node[np.concatenate([x, y])], return_inverse=True)
        firsts = np.zeros(len(used), np.int64)
        firsts[where] = np.concatenate([x, y])
        if len(used):
            main, more = hashes(unit[firsts], settings)
        for lo in range(0, len(x), 1 << 14):
            a, b = x[lo : lo + (1 << 14)], y[lo : lo + (1 << 14)]
            of_a, of_b = (np.searchsorted(used, node[k]) for k in (a, b))
            same, b_probes, a_probes = meetings((main[of_a], more[of_a]), (main[of_b], more[of_b]))
            first = (same | b_probes | a_probes).argmax(axis=1) == tab[a]
            # Where both probe the other's bucket, the bucket of the smaller node counts.
            row = np.arange(len(a))
            first &= ~(column["probing"][b] & a_probes[row, tab[a]] & (node[a] > node[b]))
            np.add.at(links, a[first], column["copies"][b[first]])
            np.add.at(links, b[first], column["copies"][a[first]])
        while len(x):  # the least node that links lead to, inside the cells
            before = root.copy()
            low = np.minimum(root[x], root[y])
            np.minimum.at(root, x, low)
            np.minimum.at(root, y, low)
            if np.array_equal(before, root):
                break
        rows_ = np.unique(np.concatenate([x, y]))
        return pa.table({"node": node[rows_], "links": links[rows_], "root": root[rows_]})

    found = materialize(
        seated.groupBy("dimension", "slot").applyInArrow(verify, "node bigint, links bigint, root bigint"),
        "verified",
    )
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    parts_of = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = materialize(
        distinct.select("node", "low", "copies")
        .join(counted, "node", "left")
        .join(parts_of, "node", "left")
        .select(
            "node",
            "low",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        ),
        "named",
    )
    least = materialize(named.groupBy("component").agg(F.min("low").alias("least")), "least-ids")
    answer = materialize(
        named.join(least, "component")
        .join(distinct.select("node", "vector"), "node")
        .select("vector", "n_links", "least"),
        "answers",
    )
    found = (
        marked_.where("usable")
        .join(answer, "vector")
        .select("id", "n_links", F.col("least").alias("component"))
        .union(
            marked_.where("not usable").select(
                "id", F.lit(0).cast("bigint"), F.col("id").alias("component")
            )
        )
    )
    return found.select(
        F.col("id").alias(id_col),
        "n_links",
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )

"""Hard negatives by Fagin's threshold algorithm over sorted lists.

Vectors become whole numbers, so scores (inner products) are exact. The candidates lie in segments
of bounded size; each segment keeps, for every dimension, the list of its rows in the order of that
dimension. An anchor reads the lists from the end where its own entry has the same sign (sorted
access, all lists equally deep), scores every row met for the first time from its whole vector
(random access), and keeps the best rows of each of its windows, that is ranges of scores. No row
unmet can score more than the threshold: the anchor's product with the entries that the lists have
got to. Reading ends once the threshold is strictly below the k-th best score kept of every window
(equal scores go to the smaller id, so equality does not do), or below the window itself. What an
anchor keeps is carried from one segment of a task to the next.

Positives are the best rows of the anchor's label: one window without limits, over segments of
that label alone. Each positive opens a window for negatives, over segments of all rows, in which
rows of the anchor's label do not count. Anchors meet segments in cells of bounded size, so neither
a label with a third of all rows nor many anchors make a large task; the best of the cells are
merged by rank.

Defined cases: rows with a null id or label, a null vector, or null or non-finite entries take no
part; only vectors of one length are compared; rows that repeat id, label and length count once,
with their least vector, and a row with the anchor's id is none of its positives; an id under
several labels is a row under each, ties of score and id going to the lesser label (as text). The
job fails for entries that reach ``2**62`` once scaled and for scores beyond 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cataloom.operators.sizes import broadcast_if_small
from cataloom.storage import materialize

RESULT = (
    "anchor_id bigint, positive_id bigint, rank int, negative_id bigint,"
    " positive_score bigint, negative_score bigint"
)
_LISTS = (
    "dimension int, label string, part int, ids array<bigint>, labels array<string>,"
    " entries binary, kind string, sorted binary"
)
_FOUND = (
    "anchor_id bigint, anchor_label string, dimension int, window int, row_id bigint,"
    " row_label string, score bigint"
)


@dataclass(frozen=True)
class Settings:
    scale: int = 256
    positives: int = 5
    negatives: int = 3
    low: int = 50  # a negative's score is at least this many hundredths of the positive's
    high: int = 95  # and at most so many
    segment: int = 4096  # rows a segment aims at,
    numbers: int = 1 << 18  # and entries, which long vectors reach first
    segments: int = 8  # per cell
    anchors: int = 256  # per cell
    first: int = 32  # entries read of each list before the first test


@dataclass
class Range:
    """The k best rows with a score in a range: (-score, id, label), best first."""

    low: float
    high: float
    k: int
    best: list[tuple[int, int, str]] = field(default_factory=list)

    def floor(self) -> float:
        """Rows that score less do not matter."""
        return -self.best[-1][0] if len(self.best) == self.k else self.low

    def offer(self, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        at = np.flatnonzero((scores >= self.floor()) & (scores <= self.high))
        if len(at) > self.k:
            kth = np.partition(scores[at], len(at) - self.k)[len(at) - self.k]
            at = at[scores[at] >= kth]
        if len(at):
            new = [(-int(scores[i]), int(ids[i]), labels[i]) for i in at]
            self.best = sorted(self.best + new)[: self.k]


class Segment:
    """Rows with the sorted list of each dimension."""

    def __init__(self, row: dict):
        self.ids = np.array(row["ids"], np.int64)
        self.labels = np.array(row["labels"], object)
        self.codes = {label: code for code, label in enumerate(dict.fromkeys(row["labels"]))}
        self.coded = np.array([self.codes[label] for label in row["labels"]], np.int32)
        n = len(self.ids)
        self.entries = np.frombuffer(row["entries"], row["kind"]).reshape(n, -1)
        self.sorted = np.frombuffer(row["sorted"], np.int32).reshape(-1, n)
        self.largest = int(np.abs(self.entries.astype(np.int64)).max(initial=0))
        self.exact = self.entries.astype(np.float64)

    def fits(self, anchor: np.ndarray) -> bool:
        """Whether doubles hold every product with an anchor, and sums of them, exactly."""
        return self.largest * int(np.abs(anchor).max(initial=0)) * len(anchor) < 1 << 53

    def scores(self, at: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Exact inner products."""
        if self.fits(anchor):
            return (self.exact[at] @ anchor.astype(np.float64)).astype(np.int64)
        return self.entries[at].astype(object) @ anchor.astype(object)

    def of_label(self, label: str) -> np.ndarray:
        return self.coded == self.codes.get(label, -1)


def search(
    anchor: np.ndarray, segment: Segment, ranges: list[Range], counts: np.ndarray, first: int
) -> int:
    """Offer to the ranges all rows of a segment that matter and ``counts`` marks; how deep the
    lists were read."""
    n = len(segment.ids)
    used = np.flatnonzero(anchor) if anchor.any() else np.arange(1)
    up, down = used[anchor[used] > 0], used[anchor[used] <= 0]
    seen = np.zeros(n, bool)

    dims = np.concatenate([up, down])
    weights = anchor[dims] if segment.fits(anchor) else anchor[dims].astype(object)

    def threshold(depth: int) -> int:
        """The most that a row can score that is not met in the first entries of the lists."""
        rows = np.concatenate([segment.sorted[up, n - 1 - depth], segment.sorted[down, depth]])
        return int((weights * segment.entries[rows, dims]).sum())

    depth, step = 0, first
    while depth < n and threshold(depth) >= min((r.floor() for r in ranges), default=np.inf):
        to = min(n, depth + step)
        met = np.zeros(n, bool)
        met[segment.sorted[up, n - to : n - depth]] = True
        met[segment.sorted[down, depth:to]] = True
        new = np.flatnonzero(met & ~seen & counts)
        seen |= met
        if len(new):
            scores = segment.scores(new, anchor)
            for r in ranges:
                r.offer(scores, segment.ids[new], segment.labels[new])
        depth, step = to, 2 * step
    return depth


def pack(table: pa.Table) -> pa.Table:
    """A group of rows as one segment."""
    ids, labels = table["id"].to_pylist(), table["of"].to_pylist()
    dimension = table["dimension"][0].as_py()
    column = table["x"].combine_chunks()
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(ids), dimension)
    if not dimension:
        x = np.zeros((len(ids), 1), np.int64)
    largest = int(np.abs(x).max(initial=0))
    kind = np.int16 if largest < 1 << 15 else np.int32 if largest < 1 << 31 else np.int64
    order = x.argsort(axis=0, kind="stable").T.astype(np.int32)
    row = {
        "dimension": dimension,
        "label": table["label"][0].as_py(),
        "part": table["part"][0].as_py(),
        "ids": ids,
        "labels": labels,
        "entries": x.astype(kind).tobytes(),
        "kind": np.dtype(kind).str,
        "sorted": np.ascontiguousarray(order).tobytes(),
    }
    types = (pa.int32(), pa.string(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.string()))
    types += (pa.binary(), pa.string(), pa.binary())
    return pa.table([pa.array([v], t) for v, t in zip(row.values(), types, strict=True)], names=list(row))


def segments(rows: DataFrame, by_label: bool, settings: Settings) -> DataFrame:
    """Sorted lists of all rows, or of each label's rows, in parts of bounded size."""
    key = F.col("label") if by_label else F.lit("")
    keyed = rows.select("dimension", key.alias("label"), "id", F.col("label").alias("of"), "x")
    rows_each = F.least(
        F.lit(settings.segment), F.greatest(F.lit(1), F.floor(settings.numbers / F.greatest("dimension", F.lit(1))))
    )
    parts = keyed.groupBy("dimension", "label").agg(F.count("*").alias("n"))
    parts = parts.select("dimension", "label", F.ceil(F.col("n") / rows_each).cast("int").alias("parts"))
    parts = broadcast_if_small(materialize(parts, "parts"))
    keyed = keyed.join(parts, ["dimension", "label"])
    keyed = keyed.withColumn("part", F.pmod(F.xxhash64("id", "of"), "parts").cast("int")).drop("parts")
    packed = keyed.groupBy("dimension", "label", "part").applyInArrow(pack, _LISTS)
    return materialize(packed, "sorted-lists")


def cells(
    anchors: DataFrame, lists: DataFrame, on: list[str], settings: Settings
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Anchors and segments dealt so that each pair meets in one cell of bounded size."""
    blocks = F.ceil(F.count("*") / settings.anchors).cast("int").alias("blocks")
    groups = (F.floor(F.max("part") / settings.segments) + 1).cast("int").alias("groups")
    sizes = anchors.groupBy(*on).agg(blocks).join(lists.groupBy(*on).agg(groups), on)
    sizes = broadcast_if_small(materialize(sizes, "cells"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = (
        anchors.join(sizes, on)
        .withColumn("block", F.pmod(F.xxhash64("id", "label"), "blocks").cast("int"))
        .withColumn("group", every("groups"))
    )
    right = (
        lists.join(sizes, on)
        .withColumn("group", F.floor(F.col("part") / settings.segments).cast("int"))
        .withColumn("block", every("blocks"))
    )
    return left.drop("blocks", "groups"), right.drop("blocks", "groups"), [*on, "block", "group"]


def _searched(ranges_of, same_label: bool, settings: Settings):
    """Search a cell: its anchors, each through all its segments."""

    def run(asked: pa.Table, lists: pa.Table) -> pa.Table:
        found = [
            Segment(row)
            for row in lists.select(["ids", "labels", "entries", "kind", "sorted"]).to_pylist()
        ]
        out: list[tuple] = []
        for row in asked.to_pylist():
            ranges = [(w, r) for w, r in enumerate(ranges_of(row)) if r.low <= r.high]
            anchor = np.array(row["x"] or [0], np.int64)
            for segment in found:
                same = segment.of_label(row["label"])
                counts = same & (segment.ids != row["id"]) if same_label else ~same
                search(anchor, segment, [r for _, r in ranges], counts, settings.first)
            out += [
                (row["id"], row["label"], row["dimension"], w, i, label, -s)
                for w, r in ranges
                for s, i, label in r.best
            ]
        types = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.int64())
        names = ["anchor_id", "anchor_label", "dimension", "window", "row_id", "row_label", "score"]
        columns = zip(*out, strict=True) if out else [()] * len(types)
        return pa.table(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
        )

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each anchor's window over all cells, ranked."""
    window = Window.partitionBy("anchor_id", "anchor_label", "dimension", "window")
    rank = F.row_number().over(window.orderBy(F.desc("score"), "row_id", "row_label"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    anchors: Column | None = None,
    settings: Settings | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """For each anchor (rows for which the condition holds; all rows) and each of its positives,
    its hardest negatives within the positive's window. Scores are of whole numbers."""
    settings = settings or Settings()
    v = F.col("vector")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))

    def entry(c: Column) -> Column:
        scaled = c.cast("double") * settings.scale
        failed = F.raise_error(F.lit("a vector entry is too large")).cast("bigint")
        return F.when(F.abs(scaled) < float(1 << 62), F.floor(scaled)).otherwise(failed)

    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).alias("vector"),
        (F.lit(True) if anchors is None else F.coalesce(anchors, F.lit(False))).alias("asked"),
    )
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & finite)
    rows = rows.select("id", "label", F.size(v).alias("dimension"), F.transform(v, entry).alias("x"), "asked")
    # Repeats merge in the map tasks, whatever their share.
    rows = rows.groupBy("id", "label", "dimension").agg(F.min("x").alias("x"), F.max("asked").alias("asked"))
    rows = materialize(rows, "rows")
    chosen = rows.where("asked").drop("asked")

    left, right, cell = cells(chosen, segments(rows, True, settings), ["dimension", "label"], settings)
    unlimited = lambda row: [Range(-np.inf, np.inf, settings.positives)]
    pairs = left.groupBy(*cell).cogroup(right.groupBy(*cell))
    near = _best(pairs.applyInArrow(_searched(unlimited, True, settings), _FOUND), settings.positives)
    pair = F.struct("rank", F.col("row_id").alias("id"), "score")
    positives = materialize(
        near.groupBy(
            F.col("anchor_id").alias("id"), F.col("anchor_label").alias("label"), "dimension"
        ).agg(F.sort_array(F.collect_list(pair)).alias("positives")),
        "positives",
    )

    def windows(row: dict) -> list[Range]:
        return [
            Range(
                -(-settings.low * p["score"] // 100),
                settings.high * p["score"] // 100,
                settings.negatives,
            )
            for p in row["positives"]
        ]

    ready = chosen.join(positives, ["id", "label", "dimension"])
    left, right, cell = cells(ready, segments(rows, False, settings).drop("label"), ["dimension"], settings)
    pairs = left.groupBy(*cell).cogroup(right.groupBy(*cell))
    hard = _best(pairs.applyInArrow(_searched(windows, False, settings), _FOUND), settings.negatives)
    keys = ["id", "label", "dimension"]
    renamed = hard.withColumnsRenamed({"anchor_id": "id", "anchor_label": "label"})
    positive = F.get("positives", F.col("window"))
    return renamed.join(positives, keys).select(
        F.col("id").alias("anchor_id"),
        positive["id"].alias("positive_id"),
        "rank",
        F.col("row_id").alias("negative_id"),
        positive["score"].alias("positive_score"),
        F.col("score").alias("negative_score"),
    )

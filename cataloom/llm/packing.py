"""Best-fit packing of token pieces into sequences under several capacities.

A piece asks for tokens, one document and attention cost (its length squared); a sequence
has a capacity for each. Pieces go longest first into the open sequence that a vector rule
prefers among those where every residual suffices: the least norm of the residuals that would
be left, or the greatest weighted dot product of the piece and the residuals.

What a piece asks for follows from its length, so the plan is made for the histogram of
lengths, whose size is bounded by the token capacity and not by the rows: sequences in equal
state are one range of numbers, and each step fills a range of pieces of one length into a
range of sequences at one offset. Pieces then only need their rank among the pieces of their
length. Ranks are counted per length and salt, so that no length is ranked in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cataloom.llm.bpe import codec
from cataloom.storage import materialize

RANKS = 44  # bits for a rank beside the length in a lookup key


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds. Weights scale the three residuals in the rule."""

    tokens: int = 2048
    documents: int = 2048
    cost: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0)
    rule: str = "norm"  # or "dot"


def plan(histogram: dict[int, int], capacity: Capacity) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), sorted; a row holds until the next.

    A piece of that length and rank r goes to sequence first + (r - first rank). Lengths must
    be 1 to ``capacity.tokens`` and fit an empty sequence.
    """
    whole = np.array([capacity.tokens, capacity.documents, capacity.cost], dtype=np.float64)
    weights = np.array(capacity.weights)
    if capacity.rule not in ("norm", "dot"):
        raise ValueError(f"no rule named {capacity.rule}")
    rest = np.empty((64, 3))  # residuals of each range of sequences in equal state
    first = np.empty(64, dtype=np.int64)
    size = np.empty(64, dtype=np.int64)
    used, sequences, steps = 0, 0, []

    def add(residual, begin, n) -> None:
        nonlocal rest, first, size, used
        if used == len(first):
            rest = np.concatenate([rest, np.empty_like(rest)])
            first, size = (np.concatenate([x, np.empty_like(x)]) for x in (first, size))
        rest[used], first[used], size[used] = residual, begin, n
        used += 1

    for length in sorted(histogram, reverse=True):
        asks = np.array([length, 1, length * length], dtype=np.float64)
        if length < 1 or (asks > whole).any():
            raise ValueError(f"a piece of {length} tokens does not fit an empty sequence")
        rank, left = 0, histogram[length]
        while left:
            after = rest[:used] - asks
            fits = (after >= 0).all(axis=1)
            if fits.any():
                if capacity.rule == "norm":
                    scores = -((weights * after / whole) ** 2).sum(axis=1)
                else:
                    scores = (weights * (asks / whole) * (rest[:used] / whole)).sum(axis=1)
                best = int(np.argmax(np.where(fits, scores, -np.inf)))
                n = min(left, int(size[best]))
                steps.append((length, rank, first[best], whole[0] - rest[best, 0]))
                if n < size[best]:  # the others of the range stay as they are
                    add(rest[best].copy(), first[best] + n, size[best] - n)
                    size[best] = n
                rest[best] -= asks
            else:
                # An opened sequence takes further pieces of this length until it is full.
                n = max(1, left // int((whole // asks).min()))
                steps.append((length, rank, sequences, 0))
                add(whole - asks, sequences, n)
                sequences += n
            rank += n
            left -= n
        open_ = rest[:used, 0] > 0
        kept = int(open_.sum())
        rest[:kept], first[:kept], size[:kept] = (x[:used][open_] for x in (rest, first, size))
        used = kept
    return np.array(sorted(steps), dtype=np.int64).reshape(-1, 4)


def token_pieces(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokens: int = 2048,
    end_id: int = 0,
    keep_ids: bool = False,
) -> DataFrame:
    """Pieces of every document's ids followed by ``end_id``.

    Only documents of more than ``tokens`` ids are cut; the first piece takes the remainder.
    Null text counts as empty. ``keep_ids`` adds the ids of each piece (little-endian
    unsigned 32 bit).
    """
    chosen = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    fields = "piece int, start bigint, length bigint, ids_crc32 bigint, ids binary"
    schema = T.StructType([chosen.schema["id"], *T.StructType.fromDDL(fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        for batch in batches:
            owners, rows = [], []
            for i, text in enumerate(batch.column(1)):
                ids = np.append(tool.encode(text.as_py()), np.uint32(end_id)).astype("<u4")
                head = (len(ids) - 1) % tokens + 1
                bounds = [0, *range(head, len(ids) + 1, tokens)]
                for piece, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    part = ids[a:b].tobytes()
                    owners.append(i)
                    rows.append((piece, a, b - a, zlib.crc32(part), part if keep_ids else None))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(owners, pa.int64())),
                    *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)),
                ],
                names=["id", "piece", "start", "length", "ids_crc32", "ids"],
            )

    made = chosen.mapInArrow(run, schema).withColumnRenamed("id", id_col)
    return made if keep_ids else made.drop("ids")


def pack(pieces: DataFrame, order_by: list[str], capacity: Capacity | None = None) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; offsets in a sequence leave no gap.

    ``length`` must be 1 to the token capacity. ``pieces`` is read several times and should be
    a written table. Pieces equal in length and ``order_by`` are interchangeable. An empty
    table gives an empty table.
    """
    capacity = capacity or Capacity()
    spark = pieces.sparkSession
    counts = pieces.groupBy("length").count().collect()  # at most capacity.tokens rows
    steps = plan({r["length"]: r["count"] for r in counts}, capacity)
    keys = (steps[:, 0] << RANKS) | steps[:, 1]
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = pieces.withColumn(
        "__salt", F.pmod(F.xxhash64(*order_by), F.lit(salts)).cast("int")
    )
    groups = salted.groupBy("length", "__salt").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("length").orderBy("__salt")
    bases = groups.select(
        "length",
        "__salt",
        (F.sum("__n").over(before) - F.col("__n")).alias("__base"),
    )
    within = Window.partitionBy("length", "__salt").orderBy(*order_by)
    ranked = salted.withColumn("__rank", F.row_number().over(within) - 1).join(
        bases, ["length", "__salt"]
    )
    ranked = ranked.select(
        *pieces.columns, (F.col("__base") + F.col("__rank")).alias("__rank")
    )
    result = T.StructType(
        [
            *pieces.schema.fields,
            *T.StructType.fromDDL("sequence_id bigint, offset bigint"),
        ]
    )
    spots = steps[:, 1:].copy()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column("__rank").to_numpy(zero_copy_only=False)
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.searchsorted(keys, (length << RANKS) | rank, side="right") - 1
            first_rank, first, offset = spots[at].T
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array(first + rank - first_rank, pa.int64()),
                    pa.array(offset, pa.int64()),
                ],
                names=[*batch.schema.names[:-1], "sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, result)


def sequences(packed: DataFrame, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per sequence: its ids, and for each piece its document, offset and length.

    A group holds one sequence, so its size is bounded by the capacity.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", id_col, ids_col)))
    joined = F.aggregate(
        F.col("parts"), F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p[ids_col])
    )
    inner = F.transform("parts", lambda p: F.struct(p[id_col], p["offset"], p["length"]))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", joined.alias("ids"), inner.alias("pieces")
    )


def pack_documents(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: Capacity | None = None,
    keep_ids: bool = False,
) -> DataFrame:
    """Tokenize, cut and pack all documents; pieces are written once to the shared folder."""
    capacity = capacity or Capacity()
    pieces = token_pieces(
        docs, path, id_col, text_col, tokens=capacity.tokens, keep_ids=keep_ids
    )
    return pack(materialize(pieces, "pieces"), [id_col, "piece", "ids_crc32"], capacity)

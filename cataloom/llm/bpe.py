"""Byte-level BPE encoding and decoding; long texts are encoded in pieces joined as a tree.

A text of more than ``piece_chars`` characters is cut into pieces that Spark deals out to
tasks. Neighbours are then joined pairwise, level by level: the tokens around each join are
decoded and encoded again in a window that grows until its first and last tokens are the ones
both sides already had. From there on the tokens outside the window cannot change: every pair
of neighbours was made by the same merges, and the split into words runs left to right.

Null text counts as empty. Repeated rows come back as often as they went in. Only the columns
asked for are read, so extra columns of any name do no harm.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: how this vocabulary's byte-level scheme splits text into words.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
AGREE = 2


class Codec:
    """A vocabulary file of the tokenizers library, with its byte-level scheme."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {chr(b): b for b in plain}
        shown |= {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*plain}))}
        ranks = {
            bytes(shown[c] for c in token): id_
            for token, id_ in spec["model"]["vocab"].items()
            if token not in special
        }
        self.special = list(special)
        self._engine = tiktoken.Encoding(
            path, pat_str=WORDS, mergeable_ranks=ranks, special_tokens=special
        )
        self._bytes = {id_: b for b, id_ in ranks.items()}
        self._bytes |= {id_: s.encode() for s, id_ in special.items()}

    def encode(self, text: str) -> np.ndarray:
        return self._engine.encode_to_numpy(text, allowed_special="all").astype("<u4")

    def to_bytes(self, ids) -> bytes:
        return b"".join(map(self._bytes.__getitem__, ids.tolist()))

    def decode(self, ids) -> str:
        return self.to_bytes(ids).decode("utf-8", "replace")

    def cuts(self, text: str, size: int) -> list[int]:
        """Where pieces start; a cut inside a special token moves to that token's start."""
        found = [0]
        for at in range(size, len(text), size):
            for token in self.special:
                near = text.find(token, max(0, at - len(token) + 1), at + len(token) - 1)
                if near >= 0:
                    at = near
            if at > found[-1]:
                found.append(at)
        return found

    def join(self, left: np.ndarray, right: np.ndarray, window: int = 8) -> np.ndarray:
        """The tokens of both texts together, from the tokens of each."""
        if not len(left) or not len(right):
            return np.concatenate([left, right])
        while True:
            lo, hi = max(0, len(left) - window), min(len(right), window)
            # Windows start and end between characters.
            while lo > 0 and self._inside(left[lo]):
                lo -= 1
            while hi < len(right) and self._inside(right[hi]):
                hi += 1
            old = np.concatenate([left[lo:], right[:hi]])
            new = self.encode(self.decode(old))
            begins = lo == 0 or (
                len(new) > AGREE and np.array_equal(new[:AGREE], left[lo:][:AGREE])
            )
            ends = hi == len(right) or (
                len(new) > AGREE and np.array_equal(new[-AGREE:], right[:hi][-AGREE:])
            )
            if begins and ends:
                return np.concatenate([left[:lo], new, right[hi:]])
            window *= 2

    def _inside(self, token: int) -> bool:
        return 0x80 <= self._bytes[int(token)][0] < 0xC0

    def join_all(self, pieces: list[np.ndarray]) -> np.ndarray:
        """Neighbours are joined pairwise until one is left."""
        while len(pieces) > 1:
            pairs = [self.join(*pieces[i : i + 2]) for i in range(0, len(pieces) - 1, 2)]
            pieces = pairs + pieces[2 * len(pairs) :]
        return pieces[0] if pieces else np.empty(0, "<u4")


@functools.lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


def ids_row(path: str, ids: np.ndarray) -> tuple:
    return ids.tobytes(), len(ids)


def digest_row(path: str, ids: np.ndarray) -> tuple:
    """Number of tokens, digest of the ids, digest of what they decode to."""
    text = codec(path).decode(ids)
    return (
        len(ids),
        hashlib.sha256(ids.tobytes()).hexdigest(),
        hashlib.sha256(text.encode()).hexdigest(),
    )


IDS = "ids binary, n_tokens bigint"
DIGEST = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _batches(keys: pa.Array | None, rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * (len(schema) - 1)
    made = [pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:], strict=True)]
    return pa.RecordBatch.from_arrays([keys, *made], schema=schema)


def encode(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    piece_chars: int = 16384,
    row: Callable[[str, np.ndarray], tuple] = ids_row,
    columns: str = IDS,
) -> DataFrame:
    """Token ids of every whole text, as little-endian unsigned 32-bit integers in ``ids``.

    ``row`` and ``columns`` say what is returned for a text's ids, so that digests need not
    carry the ids out of the task. Very long texts cost one shuffle of their pieces.
    """
    key = docs.schema[id_col].dataType
    result = T.StructType([T.StructField("id", key), *T.StructType.fromDDL(columns)])
    arrow = pa.schema([(f.name, _arrow_type(f.dataType)) for f in result])
    kind = arrow.field(0).type
    texts = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        for batch in batches:
            rows = [row(path, tool.encode(t.as_py())) for t in batch.column(1)]
            yield _batches(batch.column(0), rows, arrow)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        for batch in batches:
            for key_, text in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                name = hashlib.sha1(text.encode()).digest()
                starts = tool.cuts(text, piece_chars)
                for i in range(0, len(starts), 64):
                    some = starts[i : i + 65]
                    ends = [*some[1:], len(text)][: min(64, len(some))]
                    parts = [text[a:b] for a, b in zip(some, ends, strict=False)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([key_.as_py()] * len(parts), kind),
                            pa.array([name] * len(parts), pa.binary()),
                            pa.array(range(i, i + len(parts)), pa.int64()),
                            pa.array(parts, pa.string()),
                        ],
                        names=["id", "name", "piece", "text"],
                    )

    def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        for batch in batches:
            ids = [tool.encode(t.as_py()).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in ("id", "name", "piece")), pa.array(ids, pa.binary())],
                names=["id", "name", "piece", "ids"],
            )

    def tree(group: pa.Table) -> pa.Table:
        pieces: dict[int, np.ndarray] = {}
        copies = 0
        for n, ids in zip(group["piece"].to_pylist(), group["ids"].to_pylist(), strict=True):
            pieces[n] = np.frombuffer(ids, "<u4")
            copies += n == 0
        ids = codec(path).join_all([pieces[n] for n in sorted(pieces)])
        keys = group["id"].combine_chunks().slice(0, 1).take(pa.array([0] * copies))
        return pa.Table.from_batches([_batches(keys, [row(path, ids)] * copies, arrow)])

    long = F.length("text") > piece_chars
    pieces = T.StructType(
        [
            T.StructField("id", key),
            *T.StructType.fromDDL("name binary, piece bigint, text string"),
        ]
    )
    leaves = T.StructType([*pieces.fields[:3], T.StructField("ids", T.BinaryType())])
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    joined = (
        texts.where(long)
        .mapInArrow(cut, pieces)
        .repartition(spread, "id", "name", "piece")
        .mapInArrow(leaf, leaves)
        .groupBy("id", "name")
        .applyInArrow(tree, result)
    )
    return texts.where(~long).mapInArrow(whole, result).unionByName(joined).withColumnRenamed(
        "id", id_col
    )


def decode(
    encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids"
) -> DataFrame:
    """The text of each row's ids (null: empty); invalid UTF-8 becomes replacement characters."""
    chosen = encoded.select(
        F.col(id_col), F.coalesce(F.col(ids_col), F.lit(b"").cast("binary")).alias("ids")
    )
    result = T.StructType([chosen.schema[id_col], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        for batch in batches:
            texts = [tool.decode(np.frombuffer(x.as_py(), "<u4")) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"]
            )

    return chosen.mapInArrow(run, result)

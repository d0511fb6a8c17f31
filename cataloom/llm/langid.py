"""Language of a text by its nearest centroid among TF-IDF vectors of byte trigrams.

Every language has several centroids, found by clustering its training vectors by cosine.
A text takes the language of the nearest one; it is rejected if that is much further away than
the training texts of the language nearly ever are, or if it has no letters.

The classifier is fitted on a bounded sample: about ``per_lang`` texts of each language, taken
by a hash of the id. Texts are read whole, in chunks of bounded size. Null text counts as
empty and is ``und``, as is any text if there is nothing to learn from.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cataloom.operators.sizes import broadcast_if_small
from cataloom.storage import materialize

UNKNOWN = "und"
GRAMS = 1 << 24
CHUNK = 1 << 20
SLICES = 1_000_000
COUNTED = 1 << 22  # trigrams that a task holds before it sends their counts

_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)
)


@dataclass(frozen=True)
class Settings:
    per_lang: int = 1500
    vocabulary: int = 8192  # trigrams that count, dealt to the languages by turns
    clusters: int = 4
    #: Share of training texts that may be further from their centroid than the limit is
    #: set from, and how much less than their cosine still counts as near.
    outliers: float = 0.005
    slack: float = 0.25


@dataclass(frozen=True)
class Model:
    codes: np.ndarray  # the trigrams that count, ascending
    idf: np.ndarray
    centroids: np.ndarray  # one row each, of length 1
    langs: list[str]  # of each centroid
    least: np.ndarray  # cosine below which a centroid rejects


def trigrams(text: bytes) -> Iterator[np.ndarray]:
    """Codes of the trigrams of lower-case letters, with one space for all between words."""
    tail = np.array([32], np.uint8)
    for at in range(0, len(text) + 1, CHUNK):
        part = text[at : at + CHUNK].translate(_FOLD)
        if at + CHUNK > len(text):
            part += b" "
        both = np.concatenate([tail, np.frombuffer(part, np.uint8)])
        gap = both == 32
        keep = np.ones(len(both), bool)
        keep[len(tail) :] = ~(gap[len(tail) :] & gap[len(tail) - 1 : -1])
        b = both[keep].astype(np.uint32)
        yield (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
        tail = b[-2:].astype(np.uint8)


def has_letter(text: bytes) -> bool:
    if text.translate(_FOLD, bytes(range(128, 256))).strip():
        return True
    return not text.isascii() and any(c.isalpha() for c in text.decode("utf-8", "replace"))


class Vectors:
    """Length-1 TF-IDF vectors over a model's trigrams."""

    def __init__(self, codes: np.ndarray, idf: np.ndarray):
        self.slot = np.full(GRAMS, len(codes), np.int16 if len(codes) < 1 << 15 else np.int32)
        self.slot[codes] = np.arange(len(codes))
        self.idf = idf

    def of(self, text: bytes) -> tuple[np.ndarray, float]:
        """The vector, and the share of the text's trigrams that are in the vocabulary."""
        n = len(self.idf)
        counts = np.zeros(n + 1)
        for codes in trigrams(text):
            counts += np.bincount(self.slot[codes], minlength=n + 1)
        vector = np.log1p(counts[:n]) * self.idf
        length = np.sqrt(vector @ vector)
        known = 1 - counts[n] / max(1.0, counts.sum())
        return (vector / length if length else vector), known


def closeness(vector: np.ndarray, known: float, centroids: np.ndarray) -> np.ndarray:
    """Cosines with the parts of centroids that the vector could meet, times the known share.

    A short text meets few of a centroid's trigrams; this does not put it far away.
    """
    part = centroids * (vector > 0)
    reach = np.sqrt((part * part).sum(axis=1))
    return known * (centroids @ vector) / np.maximum(reach, 1e-12)


def training_rows(docs: DataFrame, id_col: str, lang_col: str) -> DataFrame:
    """Rows to learn from: crc32 of the id as text, modulo 4, is not 2, and there is a label."""
    return docs.where(F.col(lang_col).isNotNull() & ~held_out(id_col))


def held_out(id_col: str):
    """A null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def fit(
    docs: DataFrame,
    settings: Settings | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> Model | None:
    """A model of the labelled training rows; None if there are none.

    Every label is a language. The vocabulary takes each language's commonest trigram, then each
    one's second, and so on, so that rare languages have as many as others. Each language's
    centroids are found by a task of its own from its sample. To the driver come the trigrams of
    the vocabulary and the centroids.
    """
    settings = settings or Settings()
    rows = training_rows(docs, id_col, lang_col).where(F.length(text_col) > 0)
    rows = rows.select(
        F.col(lang_col).cast("string").alias("lang"),
        F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(SLICES)).alias("place"),
        F.col(text_col).alias("text"),
    )
    sizes = broadcast_if_small(materialize(rows.groupBy("lang").count(), "language-sizes"))
    share = settings.per_lang / F.col("count") * SLICES
    sample = materialize(
        rows.join(sizes, "lang").where(F.col("place") < share).select("lang", "text"), "language-sample"
    )

    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = defaultdict(list)
        number = 0
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for lang, text in zip(langs, batch.column("text").cast(pa.binary()), strict=True):
                own = np.unique(np.concatenate([np.unique(c) for c in trigrams(text.as_py())]))
                held[lang].append(own)
                number += len(own)
                if number > COUNTED:
                    yield from sent(held)
                    number = 0
        yield from sent(held)

    def sent(held: dict[str, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for lang, codes in held.items():
            code, texts = np.unique(np.concatenate(codes), return_counts=True)
            names = pa.array([lang] * len(code), pa.string())
            columns = [names, *(pa.array(c.astype(np.int64)) for c in (code, texts))]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "code", "texts"])
        held.clear()

    counted = sample.mapInArrow(presence, "lang string, code bigint, texts bigint")
    counted = counted.groupBy("lang", "code").agg(F.sum("texts").alias("texts"))
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("texts"), "code"))
    chosen = (
        counted.withColumn("turn", turn)
        .groupBy("code")
        .agg(F.min("turn").alias("turn"), F.sum("texts").alias("texts"))
        .orderBy("turn", F.desc("texts"), "code")
        .limit(settings.vocabulary)
        .collect()
    )
    if not chosen:
        return None
    total = sample.count()
    codes, texts = (np.array(c) for c in zip(*sorted((r["code"], r["texts"]) for r in chosen), strict=True))
    idf = np.log1p(total / texts.astype(np.float64))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Vectors(codes, idf)
        for batch in batches:
            slots, values, known = [], [], []
            for text in batch.column("text").cast(pa.binary()):
                v, share = tool.of(text.as_py())
                known.append(share)
                at = np.flatnonzero(v)
                slots.append(at.astype("<u4").tobytes())
                values.append(v[at].astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("lang"),
                    pa.array(slots, pa.binary()),
                    pa.array(values, pa.binary()),
                    pa.array(known, pa.float64()),
                ],
                names=["lang", "slots", "weights", "known"],
            )

    def learn(table: pa.Table) -> pa.Table:
        """The centroids of one language."""
        # In an order of their own, whatever order they came in.
        rows_ = sorted(table.to_pylist(), key=lambda r: (r["slots"], r["weights"]))
        dense = np.zeros((len(rows_), len(idf)), np.float32)
        for at, r in zip(dense, rows_, strict=True):
            at[np.frombuffer(r["slots"], "<u4")] = np.frombuffer(r["weights"], "<f4")
        means = cluster(dense, settings.clusters)
        nearest = [closeness(v, r["known"], means).max() for v, r in zip(dense, rows_, strict=True)]
        limit = settings.slack * float(np.quantile(nearest, settings.outliers))
        n = len(means)
        return pa.table(
            {
                "lang": pa.array([table["lang"][0].as_py()] * n, pa.string()),
                "number": pa.array(range(n), pa.int32()),
                "centroid": pa.array([m.astype("<f4").tobytes() for m in means], pa.binary()),
                "least": pa.array([limit] * n, pa.float64()),
            }
        )

    sparse = sample.mapInArrow(vectors, "lang string, slots binary, weights binary, known double")
    learned = sparse.where(F.length("slots") > 0).groupBy("lang")
    found = learned.applyInArrow(learn, "lang string, number int, centroid binary, least double").collect()
    if not found:
        return None
    found = sorted(found, key=lambda r: (r["lang"], r["number"]))
    centroids = np.array([np.frombuffer(r["centroid"], "<f4") for r in found], np.float64)
    return Model(codes, idf, centroids, [r["lang"] for r in found], np.array([r["least"] for r in found]))


def cluster(vectors: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """At most ``k`` centroids of length 1, by cosine; the first seed is the vector nearest to
    the mean, each further one the vector furthest from those taken."""
    mean = vectors.mean(axis=0)
    seeds = [int(np.argmax(vectors @ mean))]
    while len(seeds) < min(k, len(vectors)):
        seeds.append(int(np.argmin((vectors @ vectors[seeds].T).max(axis=1))))
    means = vectors[seeds]
    for _ in range(rounds):
        owner = np.argmax(vectors @ means.T, axis=1)
        kept = [vectors[owner == i].mean(axis=0) for i in range(len(means)) if (owner == i).any()]
        means = np.array([m / np.linalg.norm(m) for m in kept])
    return means


def predict(
    docs: DataFrame,
    model: Model | None,
    text_col: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """The ``keep`` columns of ``docs`` (all) besides ``lang_pred``, ``score`` (the cosine) and
    ``rejected``; columns that already have these names are replaced.

    Ties go to the language first in the alphabet. Without a model the language is unknown, and
    only documents without letters are rejected.
    """
    added = T.StructType.fromDDL("lang_pred string, score double, rejected boolean")
    kept = [c for c in keep or docs.columns if c not in added.names]
    # A kept text goes to the task once.
    extra = [] if text_col in kept else [F.col(text_col).alias("__text")]
    source = docs.select(*(F.col(f"`{c}`") for c in kept), *extra)
    # By number, as names with dots do not pass.
    source = source.toDF(*(f"c{i}" for i in range(len(source.columns))))
    result = T.StructType([*source.schema.fields[: len(kept)], *added.fields])
    text_at = len(kept) if extra else kept.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Vectors(model.codes, model.idf) if model else None
        for batch in batches:
            found = []
            for value in batch.column(text_at).cast(pa.binary()):
                text = value.as_py() or b""
                letters = has_letter(text)
                if not tool or not letters:
                    found.append((UNKNOWN, 0.0, not letters))
                    continue
                vector, known = tool.of(text)
                near = model.centroids @ vector
                best = int(np.argmax(near))
                score = float(min(1.0, max(0.0, near[best])))
                close = closeness(vector, known, model.centroids[best : best + 1])[0]
                found.append((model.langs[best], score, bool(close < model.least[best])))
            langs, scores, rejected = zip(*found, strict=True) if found else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(kept)],
                    pa.array(langs, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(rejected, pa.bool_()),
                ],
                names=result.names,
            )

    return source.mapInArrow(run, result).toDF(*kept, *added.names)

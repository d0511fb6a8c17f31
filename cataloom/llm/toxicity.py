"""Toxicity of a text by a subsequence-kernel support vector machine on Nyström landmarks.

The kernel of two strings adds up their common subsequences of three letters, each weighted
by ``decay`` to the length it spans in either, so letters put in between weaken a match and do
not break it. Landmarks are words and word beginnings tied to the label in the training
texts; where a word begins and ends counts as a letter. A word's value for a landmark is the
greatest normalised kernel of the landmark and any stretch of the word as long or ``slack``
letters longer, or 0 below ``least``. A text has two values for each landmark: the greatest of its
words, and their sum by the number of words. These, whitened by the landmarks' own kernel
matrix (Nyström), go to a linear support vector machine; a logistic curve turns its margin
into a score.

Words are what white space separates, without characters that are not letters (``st*pid`` is
``stpid``); runs of single letters (``i d i o t``) also count as one word. A word is compared
with a landmark if they share four subsequences of three letters within five, which any match
of note does.

Fitting reads a bounded sample of labelled texts (``Settings.texts``). Texts are scored whole.
Null text counts as empty; an empty text gets the score of no match.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cataloom.storage import materialize

LETTERS = 3  # length of the subsequences compared
WIDTH = 24  # longer words are taken in overlapping stretches
BEGIN, END = b"^^", b"$"  # a begin counts twice: word beginnings are what a stem has
SHARED = 4  # subsequences that a word and a landmark must share to be compared
SLICE, SLICE_BYTES = 2048, 8 << 20  # texts whose distinct words are compared at once
COUNTED = 200_000  # strings counted before the counts are sent on
PER_WORDS = 50  # a sum over words counts as if a text had this many
_DROP = bytes(b for b in range(128) if not (97 <= b <= 122 or b in b" \t\n\r\f\v"))
_SPACED = re.compile(r"(?:(?<![^\W\d_])[^\W\d_][\W\d_]{1,3}){3,}[^\W\d_](?![^\W\d_])")


def _code(byte: int) -> int:
    """Letters, word ends and bytes of other alphabets as 1 to 31; 0 pads."""
    if 97 <= byte <= 122:
        return byte - 96
    return {BEGIN[0]: 27, END[0]: 28}.get(byte, 29 + byte % 3 if byte >= 128 else 0)


_CODE = np.array([_code(b) for b in range(256)], np.uint8)
_SPANS = ((0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 2, 4))


@dataclass(frozen=True)
class Settings:
    texts: int = 8000  # most labelled texts to learn from
    landmarks: int = 48  # at most 63
    evidence: float = 12.0  # least log-likelihood ratio of a landmark
    share: float = 0.05  # and least share of the best landmark's
    decay: float = 0.75
    slack: int = 3
    least: float = 0.7
    penalty: float = 10.0


@dataclass(frozen=True)
class Model:
    landmarks: list[bytes]
    weights: np.ndarray  # on a text's values
    bias: float
    slope: float
    offset: float
    settings: Settings

    def scores(self, values: np.ndarray) -> np.ndarray:
        margin = values @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


def words(text: str) -> Counter:
    """Words of a whole text, with how often each occurs."""
    text = text.lower()
    found = Counter(text.encode("utf-8", "replace").translate(None, _DROP).split())
    if sum(len(w) == 1 for w in found) >= 2:
        for run in _SPACED.findall(text):
            found["".join(c for c in run if c.isalpha()).encode()] += 1
    return found


def stretches(word: bytes) -> list[bytes]:
    """The word with its begin and end marked, in stretches of at most ``WIDTH``."""
    word = BEGIN + word + END
    if len(word) <= WIDTH:
        return [word]
    half = WIDTH // 2
    return [word[i : i + WIDTH] for i in range(0, len(word) - half, half)]


def coded(strings: list[bytes], width: int = WIDTH) -> np.ndarray:
    """One row per string, padded with 0."""
    joined = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8)
    return _CODE[joined].reshape(len(strings), width)


def kernel(left: np.ndarray, right: np.ndarray, decay: float) -> np.ndarray:
    """Kernel of each row of ``left`` with the same (or the only) row of ``right``."""
    n, rows, columns = len(left), left.shape[1], right.shape[1]
    same = [[(left[:, i] == right[:, j]) & (left[:, i] > 0) for j in range(columns)] for i in range(rows)]
    # before[i][j]: weight of common subsequences of the first i and j letters, decayed to there
    decay = np.float32(decay)
    before = [[np.ones(n, np.float32)] * (columns + 1) for _ in range(rows + 1)]
    zero = np.zeros(n, np.float32)
    for _ in range(LETTERS - 1):
        now = [[zero] * (columns + 1) for _ in range(rows + 1)]
        for i in range(1, rows + 1):
            run = zero
            for j in range(1, columns + 1):
                run = decay * run + same[i - 1][j - 1] * (decay * decay * before[i - 1][j - 1])
                now[i][j] = decay * now[i - 1][j] + run
        before = now
    total = zero
    for i in range(rows):
        for j in range(columns):
            total = total + same[i][j] * (decay * decay * before[i][j])
    return total


class Matcher:
    """Values of words for landmarks."""

    def __init__(self, landmarks: list[bytes], settings: Settings):
        self.landmarks, self.settings = landmarks, settings
        self.rows = [coded([z], len(z)) for z in landmarks]
        self.own = [float(kernel(z, z, settings.decay)[0]) for z in self.rows]
        near = np.zeros(1 << 15, np.uint64)  # landmarks that have this subsequence within five
        solid = np.zeros(1 << 15, np.uint64)  # ... without a gap
        for i, z in enumerate(self.rows):
            for span in _SPANS:
                for code in self._codes(z, span)[0]:
                    near[code] |= np.uint64(1 << i)
                    if span == _SPANS[0]:
                        solid[code] |= np.uint64(1 << i)
        self.near, self.solid = near, solid

    @staticmethod
    def _codes(rows: np.ndarray, span: tuple[int, int, int]) -> np.ndarray:
        n = rows.shape[1] - span[2]
        a, b, c = (rows[:, s : s + max(0, n)].astype(np.int32) for s in span)
        return np.where((a > 0) & (b > 0) & (c > 0), (a << 10) | (b << 5) | c, 0)

    def values(self, strings: list[bytes]) -> dict[bytes, list[tuple[int, float]]]:
        """Landmarks that a word comes near, with its value; words without any are left out."""
        found: dict[bytes, list[tuple[int, float]]] = {}
        parts = [(w, part) for w in strings if len(w) > 2 for part in stretches(w)]
        owner = [w for w, _ in parts]
        rows = coded([part for _, part in parts])
        shared = [np.zeros(len(rows), np.uint64) for _ in range(SHARED)]  # once, twice, ...
        for span in _SPANS:
            table = self.near if span == _SPANS[0] else self.solid
            for codes in self._codes(rows, span).T:
                now = table[codes]
                for i in range(SHARED - 1, 0, -1):
                    shared[i] |= shared[i - 1] & now
                shared[0] |= now
        lengths = (rows > 0).sum(axis=1)
        for i, z in enumerate(self.rows):
            at = np.flatnonzero(shared[-1] & np.uint64(1 << i))
            if not len(at):
                continue
            best = self._best(rows[at], lengths[at], z, self.own[i])
            for k in np.flatnonzero(best >= self.settings.least):
                found.setdefault(owner[at[k]], []).append((i, float(best[k])))
        return found

    def _best(self, rows, lengths, z, own) -> np.ndarray:
        best = np.zeros(len(rows))
        size = z.shape[1]
        for span in sorted({min(WIDTH, size), min(WIDTH, size + self.settings.slack)}):
            for start in range(WIDTH - span + 1):
                # Stretches beyond the word's end add nothing to the last whole one.
                on = np.flatnonzero((lengths >= start + span) | (start == 0))
                if not len(on):
                    break
                part = rows[on, start : start + span]
                both = kernel(part, z, self.settings.decay)
                itself = kernel(part, part, self.settings.decay)
                value = both / np.sqrt(np.maximum(itself * own, 1e-12))
                best[on] = np.maximum(best[on], value)
        return best


def text_values(texts: Iterable[str], matcher: Matcher) -> np.ndarray:
    """Values of whole texts, one row each: the greatest for each landmark, then the sums."""
    own = [words(t) for t in texts]
    known = matcher.values(sorted(set().union(*own)))
    n = len(matcher.landmarks)
    values = np.zeros((len(own), 2 * n))
    for row, mine in zip(values, own, strict=True):
        for word in mine.keys() & known.keys():
            for i, value in known[word]:
                row[i] = max(row[i], value)
                row[n + i] += mine[word] * value
        row[n:] *= PER_WORDS / max(PER_WORDS, mine.total())
    return values


def held_out(id_col: str):
    """Rows never learned from: crc32 of the id as text, modulo 5, is 0. A null id is not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    settings: Settings | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Model | None:
    """A model of labelled rows that are not held out; None if a class has no text.

    At most ``settings.texts`` labels, in the order of a hash of the id, take part; an id
    labelled twice counts as toxic if one label says so.
    """
    settings = settings or Settings()
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
    chosen = (
        usable.select(id_col, F.col(label_col).cast("int").alias("__label"))
        .orderBy(F.xxhash64(F.col(id_col)), id_col)
        .limit(settings.texts)
        .groupBy(id_col)
        .agg(F.max("__label").alias("__label"))
    )
    sample = materialize(
        docs.select(id_col, F.col(text_col).alias("__text"))
        .join(F.broadcast(chosen), id_col)
        .where(F.col("__text").isNotNull())
        .select(F.col("__text").alias("text"), F.col("__label").alias("label")),
        "toxicity-sample",
    )
    classes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(classes) < 2:
        return None
    landmarks = choose_landmarks(sample, classes, settings)
    if not landmarks:
        return None

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(landmarks, settings)
        for batch in batches:
            for part, texts in slices(batch, batch.schema.get_field_index("text")):
                packed = [v.astype("<f8").tobytes() for v in text_values(texts, matcher)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("label"), pa.array(packed, pa.binary())],
                    names=["label", "measured"],
                )

    rows = sample.mapInArrow(measure, "label int, measured binary").collect()
    rows = sorted((r["label"], bytes(r["measured"])) for r in rows)
    values = np.array([np.frombuffer(v, "<f8") for _, v in rows])
    return train(values, np.array([y for y, _ in rows]), landmarks, settings)


def choose_landmarks(
    sample: DataFrame, classes: dict[int, int], settings: Settings
) -> list[bytes]:
    """Words and word beginnings with the greatest log-likelihood ratio for toxic texts; of two
    that begin alike only the better one, or the longer if they are equal."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = Counter(), Counter()
        for batch in batches:
            for text, label in zip(*batch.columns, strict=True):
                if len(seen[0]) + len(seen[1]) > COUNTED:
                    yield counts(seen)
                    seen = Counter(), Counter()
                own, label = words(text.as_py()), label.as_py()
                framed = [BEGIN + w + END for w in own if 4 <= len(w) <= WIDTH - 3]
                seen[label].update({w[:n] for w in framed for n in range(6, 10)} | {*framed})
        yield counts(seen)

    def counts(seen: tuple[Counter, Counter]) -> pa.RecordBatch:
        strings = sorted(seen[1])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([*strings, *seen[0]], pa.binary()),
                pa.array([seen[1][s] for s in strings] + [0] * len(seen[0]), pa.int64()),
                pa.array([0] * len(strings) + [*seen[0].values()], pa.int64()),
            ],
            names=["word", "toxic", "clean"],
        )

    def fitted(k, n):
        """Log-likelihood of k hits in n texts at their own rate."""
        term = lambda x: F.when(x > 0, x * F.log(x / n)).otherwise(0.0)
        return term(k) + term(n - k)

    n1, n0 = float(classes[1]), float(classes[0])
    a, b = F.col("toxic").cast("double"), F.col("clean").cast("double")
    total = F.lit(n1 + n0)
    ratio = 2 * (fitted(a, F.lit(n1)) + fitted(b, F.lit(n0)) - fitted(a + b, total))
    counted = (
        sample.mapInArrow(count, "word binary, toxic bigint, clean bigint")
        .groupBy("word")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(a / n1 > b / n0)
        .withColumn("ratio", F.round(ratio, 6))
        .where(F.col("ratio") >= settings.evidence)
        .orderBy(F.desc("ratio"), F.desc(F.length("word")), "word")
        .limit(settings.landmarks * 50)
        .collect()
    )
    taken: list[bytes] = []
    for r in counted:
        word = bytes(r["word"])
        if r["ratio"] < settings.share * counted[0]["ratio"]:
            break
        if len(taken) < settings.landmarks and not any(
            word.startswith(t) or t.startswith(word) for t in taken
        ):
            taken.append(word)
    return taken


def train(values: np.ndarray, labels: np.ndarray, landmarks: list[bytes], settings: Settings) -> Model:
    """Linear support vector machine (squared hinge, classes weighted alike) on whitened values."""
    decay = settings.decay
    rows = [coded([z], len(z)) for z in landmarks]
    gram = np.array([[float(kernel(a, b, decay)[0]) for b in rows] for a in rows])
    scale = np.sqrt(np.diag(gram))
    spectrum, basis = np.linalg.eigh(gram / scale[:, None] / scale)
    whiten = basis @ np.diag(1 / np.sqrt(np.maximum(spectrum, 1e-3))) @ basis.T
    whiten = np.kron(np.eye(2), whiten)  # alike for both kinds of value
    x = np.hstack([values @ whiten, np.ones((len(values), 1))])
    y = np.where(labels == 1, 1.0, -1.0)
    cost = settings.penalty * np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y < 0).sum()) * len(y)
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(50):  # Newton steps; the rows within the margin decide the next
        inside = y * (x @ w) < 1
        xa, ca = x[inside], cost[inside]
        new = np.linalg.solve(ridge + xa.T @ (ca[:, None] * xa), xa.T @ (ca * y[inside]))
        done = np.allclose(new, w, atol=1e-9)
        w = new if done else 0.5 * w + 0.5 * new
        if done:
            break
    margin = x @ w
    slope, offset = logistic(margin, labels)
    return Model(landmarks, whiten @ w[:-1], float(w[-1]), slope, offset, settings)


def logistic(margin: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through the margins, with smoothed labels."""
    n1, n0 = (labels == 1).sum(), (labels == 0).sum()
    goal = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.column_stack([margin, np.ones(len(margin))])
    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - goal) + 1e-6 * w
        curve = x.T @ ((p * (1 - p))[:, None] * x) + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        w -= np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def slices(batch: pa.RecordBatch, text_at: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of a batch of bounded size, each with its texts (null: empty)."""
    begin, texts, size = 0, [], 0
    for text in batch.column(text_at):
        texts.append(text.as_py() or "")
        size += len(texts[-1])
        if len(texts) == SLICE or size >= SLICE_BYTES:
            yield batch.slice(begin, len(texts)), texts
            begin, texts, size = begin + len(texts), [], 0
    if texts:
        yield batch.slice(begin), texts


def score(
    docs: DataFrame,
    model: Model | None,
    text_col: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """The ``keep`` columns of ``docs`` (all) besides ``score`` and ``predicted``; columns that
    already have these names are replaced. Without a model every score is 0."""
    added = T.StructType.fromDDL("score double, predicted int")
    kept = [c for c in keep or docs.columns if c not in added.names]
    # A kept text goes to the task once.
    extra = [] if text_col in kept else [F.col(text_col).alias("__text")]
    source = docs.select(*(F.col(f"`{c}`") for c in kept), *extra)
    # By number, as names with dots do not pass.
    source = source.toDF(*(f"c{i}" for i in range(len(source.columns))))
    result = T.StructType([*source.schema.fields[: len(kept)], *added.fields])
    text_at = len(kept) if extra else kept.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model.landmarks, model.settings) if model else None
        for batch in batches:
            for part, texts in slices(batch, text_at):
                if matcher:
                    found = model.scores(text_values(texts, matcher))
                else:
                    found = np.zeros(part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[: len(kept)],
                        pa.array(found, pa.float64()),
                        pa.array((found >= 0.5).astype(np.int32), pa.int32()),
                    ],
                    names=result.names,
                )

    return source.mapInArrow(run, result).toDF(*kept, *added.names)

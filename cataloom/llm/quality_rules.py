"""Quality rules whose cutoffs are chosen under a guarantee on false rejections.

Every text gets counts, from these values of rules (whole numbers, high is bad), and rejects a
document when one of them reaches its cutoff. Cutoffs belong to a stratum (rows equal in the
stratum columns) and come from labelled documents in two halves, split by a hash of the id:

1. Design half: for each stratum and rule the tightest cutoff worth having, that is the one with
   the most bad documents caught less ``weight`` times the good ones; none if that gains less than
   ``least``. Between it and no rule lie ``levels`` steps, each of which catches another equal
   share of those bad documents. Policy number l of a stratum takes all its rules at step l, so
   policies are nested: each rejects what the one before does, and more.
2. Holdout half, of which nothing has been seen: policies are tested in their order. With n good
   documents of a stratum, of which k are rejected, the hypothesis that more than ``limit`` of the
   good are rejected is given up if the exact binomial probability of k or fewer out of n at
   that rate (the Clopper-Pearson bound, turned round) is at most ``error`` over the number of
   strata. The first policy that fails ends its stratum, and the one before it holds.

Testing in a fixed order needs no correction within a stratum, and the Bonferroni share corrects
for the strata, so with probability 1 - error no stratum loses more than ``limit`` of its good
documents to its cutoffs, over all its rules together, whatever the design half suggested. A
stratum with too few labels for that proof has no cutoffs and keeps its documents. Base rules
with fixed cutoffs come first; what fails them is no part of the labelled halves.

Counting is one pass over the texts; the rest are aggregates, of histograms by stratum, rule and
value, and a join of documents with the cutoffs of their stratum.

Defined cases: a null text is empty, and an empty one fails the base rules; a null in a stratum
column is a stratum; labels count where all non-null ones of an id agree, and none without an
id; each row of a repeated id is a document.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cataloom.operators.sizes import broadcast_if_small
from cataloom.storage import materialize

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper",
    "n_marks", "n_digits",
)
#: Values in ten-thousandths: (name, counted, of what).
RULES = (
    ("symbols", "n_symbols", "word_chars"),
    ("upper", "n_upper", "word_chars"),
    ("marks", "n_marks", "word_chars"),
    ("digits", "n_digits", "word_chars"),
    ("dup_lines", "n_dup_lines", "n_lines"),
    ("repeats", "n_repeat_words", "n_words"),
    ("long_words", "word_chars", "n_words"),
    ("short_words", "n_words", "word_chars"),
)
_SPACE = b" \t\n\x0b\x0c\r"
_BREAK = re.compile(rb"[\x20\x09-\x0D]")
_PIECE = 1 << 20  # bytes split into words at once
WINDOW = 8


@dataclass(frozen=True)
class Settings:
    limit: float = 0.02  # most of a stratum's good documents that may be rejected
    error: float = 0.05  # probability that the limit is broken in any stratum
    weight: int = 20  # bad documents that must be caught for each good one lost
    least: int = 10  # gain, in bad documents, that a rule must bring
    levels: int = 16
    fewest_words: int = 20  # base rule
    most_repeats: int = 30  # base rule: repeated words in a hundred


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in lists of bounded size."""
    start = 0
    while start < len(text):
        found = _BREAK.search(text, start + _PIECE)
        end = found.start() if found else len(text)
        yield text[start:end].split()
        start = end


def repeated_words(text: bytes) -> tuple[int, int]:
    """Number of words, and of those in windows of ``WINDOW`` words that are found again."""
    known: dict[bytes, int] = {}
    number = count()  # a word has the number of its first place
    parts = [
        np.fromiter(map(known.setdefault, words, number), np.int64, len(words))
        for words in words_of(text)
    ]
    ids = np.concatenate(parts) if parts else np.empty(0, np.int64)
    n = len(ids) - WINDOW + 1
    if n < 2:
        return len(ids), 0
    # Runs of 2, 4 and 8 words by number: a run is a pair of two of half its length.
    runs, width = ids, 1
    while width < WINDOW:
        pairs = runs[:-width] * (int(runs.max()) + 1) + runs[width:]
        runs = np.unique(pairs, return_inverse=True)[1]
        width *= 2
    again = np.bincount(runs)[runs] > 1
    if not again.any():
        return len(ids), 0
    edges = np.zeros(len(ids) + 1, np.int64)
    starts = np.flatnonzero(again)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW, -1)
    return len(ids), int((np.cumsum(edges) > 0).sum())


def count_text(text: bytes) -> tuple[int, ...]:
    """The counts of one text, in the order of ``COUNTS``."""
    of = np.zeros(256, np.int64)
    for lo in range(0, len(text), _PIECE):
        of += np.bincount(np.frombuffer(text[lo : lo + _PIECE], np.uint8), minlength=256)
    pick = lambda chars: int(of[np.frombuffer(chars, np.uint8)].sum())
    points = len(text) - int(of[0x80:0xC0].sum())  # bytes that do not go on with a code point
    n_words, n_repeat = repeated_words(text)
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return (
        n_words,
        points - pick(_SPACE),
        pick(b"#*$%&|<>"),
        len(lines) - len(set(lines)),
        n_repeat,
        len(lines),
        int(of[ord("A") : ord("Z") + 1].sum()),
        pick(b"!?"),
        int(of[ord("0") : ord("9") + 1].sum()),
    )


def count_texts(docs: DataFrame, keep: Sequence[str], text_col: str = "text") -> DataFrame:
    """The kept columns as ``k0``, ``k1``, … and the counts of each row's text."""
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text_col).alias("text"))
    kept = [rows.schema[f"k{i}"] for i in range(len(keep))]
    schema = T.StructType([*kept, *[T.StructField(c, T.LongType()) for c in COUNTS]])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            found = [count_text(t.as_py() or b"") for t in texts]
            columns = np.array(found, np.int64).reshape(len(found), len(COUNTS))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(f.name) for f in kept),
                    *(pa.array(np.ascontiguousarray(c)) for c in columns.T),
                ],
                names=schema.names,
            )

    return rows.mapInArrow(counted, schema)


def value(rule: tuple[str, str, str]) -> Column:
    """A rule's value in ten-thousandths, 0 where there is nothing to count."""
    _, counted, of = rule
    parts = F.floor(F.col(counted) * 10000 / F.greatest(of, F.lit(1))).cast("bigint")
    return F.when(F.col(of) > 0, parts).otherwise(F.lit(0).cast("bigint"))


def tail(k: int, n: int, rate: float) -> float:
    """Probability of k or fewer out of n at a rate: terms are summed from k away from the middle."""
    if k >= n:
        return 1.0
    upper = k >= n * rate  # then all but the probability of more than k
    i, step = (k + 1, 1) if upper else (k, -1)
    log = math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
    log += i * math.log(rate) + (n - i) * math.log1p(-rate)
    term, total = 1.0, 0.0
    while 0 <= i <= n and term > total * 1e-17:
        total += term
        term *= (n - i) * rate / ((i + 1) * (1 - rate)) if upper else i * (1 - rate) / ((n - i + 1) * rate)
        i += step
    found = math.exp(log + math.log(total))
    return 1 - found if upper else found


def design(labelled: DataFrame, settings: Settings) -> DataFrame:
    """(stratum, rule, cutoffs): one cutoff per level, falling, for each rule worth having."""
    each = [F.struct(F.lit(i).alias("rule"), F.col(f"v{i}").alias("value")) for i in range(len(RULES))]
    histogram = (
        labelled.where("design")
        .select("stratum", "good", F.inline(F.array(*each)))
        .groupBy("stratum", "rule", "value")
        .agg(
            F.count_if("good").alias("good"),
            F.count_if(~F.col("good")).alias("bad"),
        )
    )
    # Values are at most some ten thousand for each stratum and rule, however many documents.
    falling = Window.partitionBy("stratum", "rule").orderBy(F.desc("value"))
    sums = histogram.select(
        "stratum", "rule", "value", "bad",
        F.sum("bad").over(falling).alias("caught"),
        F.sum("good").over(falling).alias("lost"),
    ).where("bad > 0")
    gain = F.col("caught") - settings.weight * F.col("lost")
    by_rule = Window.partitionBy("stratum", "rule")
    best = F.max(F.struct(gain.alias("gain"), "value")).over(by_rule)
    chosen = sums.withColumn("best", best).where(
        (F.col("best.gain") >= settings.least) & (F.col("value") >= F.col("best.value"))
    )
    chosen = chosen.withColumn("all", F.max("caught").over(by_rule))
    # The first value at which the l-th share of the bad documents is caught.
    level = F.explode(F.sequence(F.lit(1), F.lit(settings.levels)))
    steps = chosen.select("stratum", "rule", "value", "caught", "all", level.alias("level"))
    steps = steps.where(F.col("caught") * settings.levels >= F.col("all") * F.col("level"))
    steps = steps.groupBy("stratum", "rule", "level").agg(F.max("value").alias("cutoff"))
    pairs = F.sort_array(F.collect_list(F.struct("level", "cutoff")))
    return steps.groupBy("stratum", "rule").agg(F.transform(pairs, lambda p: p["cutoff"]).alias("cutoffs"))


def by_stratum(cutoffs: DataFrame) -> DataFrame:
    """(stratum, c0, c1, …): the cutoffs of each rule, null where there is none."""
    return cutoffs.groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == i, F.col("cutoffs"))).alias(f"c{i}") for i in range(len(RULES))]
    )


def certify(labelled: DataFrame, steps: DataFrame, settings: Settings) -> DataFrame:
    """(stratum, level, n_good, n_lost): the last policy of each stratum that passes its test."""
    beyond = settings.levels + 1

    def level(i: int) -> Column:
        """The first whose cutoff a rule's value reaches."""
        missed = F.size(F.filter(f"c{i}", lambda c: c > F.col(f"v{i}")))
        return F.when(F.col(f"c{i}").isNotNull(), missed + 1).otherwise(F.lit(beyond))

    at = [level(i) for i in range(len(RULES))]
    holdout = labelled.where(F.col("good") & ~F.col("design"))
    levels = (
        holdout.join(broadcast_if_small(steps), "stratum", "left")
        .groupBy("stratum", F.least(*at).alias("level"))
        .agg(F.count("*").alias("n"))
    )
    levels = materialize(levels, "levels")
    strata = levels.select("stratum").distinct().count()
    schema = "stratum string, level int, n_good bigint, n_lost bigint"

    def test(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        counts = dict(zip(rows["level"], rows["n"], strict=True))
        n, lost, passed = int(rows["n"].sum()), 0, (0, 0)
        for level in range(1, beyond):
            lost += int(counts.get(level, 0))
            if tail(lost, n, settings.limit) > settings.error / strata:
                break
            passed = (level, lost)
        return pd.DataFrame([(key[0], passed[0], n, passed[1])], columns=["stratum", "level", "n_good", "n_lost"])

    # At most one row per level in a group.
    return levels.groupBy("stratum").applyInPandas(test, schema)


def judge(
    docs: DataFrame,
    labels: DataFrame,
    strata: Sequence[str] = ("lang",),
    settings: Settings | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """Each row's id, counts and verdict: base_failed, kept, the failed rules, the stratum's level
    (0: no cutoffs). Labels: 1 is good, 0 is bad; their ids are those of the documents."""
    settings = settings or Settings()
    counted = count_texts(docs, [id_col, *strata], text_col)
    names = [f"k{i + 1}" for i in range(len(strata))]
    # Text that tells apart null, empty and values with any separator.
    stratum = F.to_json(F.array(*[F.col(c).cast("string") for c in names])) if names else F.lit("[]")
    repeats = F.col("n_repeat_words") * 100 > F.col("n_words") * settings.most_repeats
    rows = materialize(
        counted.select(
            F.col("k0").alias("id"),
            stratum.alias("stratum"),
            *COUNTS,
            ((F.col("n_words") < settings.fewest_words) | repeats).alias("base_failed"),
            *[value(rule).alias(f"v{i}") for i, rule in enumerate(RULES)],
        ),
        "counts",
    )
    said = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("said"))
    said = said.where("id IS NOT NULL AND said IN (0, 1)").groupBy("id")
    said = said.agg(F.min("said").alias("said"), F.max("said").alias("most")).where("said = most")
    labelled = (
        rows.where(~F.col("base_failed"))
        .join(said, "id")
        .select(
            "stratum",
            (F.col("said") == 1).alias("good"),
            (F.substring(F.md5(F.col("id").cast("string")), 1, 1) < "8").alias("design"),
            *[f"v{i}" for i in range(len(RULES))],
        )
    )
    labelled = materialize(labelled, "labelled")
    steps = materialize(by_stratum(design(labelled, settings)), "steps")
    passed = certify(labelled, steps, settings)
    held = materialize(steps.join(passed.where("level > 0"), "stratum"), "cutoffs")
    judged = rows.join(broadcast_if_small(held), "stratum", "left")
    reached = [
        F.when(F.col(f"v{i}") >= F.get(f"c{i}", F.col("level") - 1), F.lit(rule[0]))
        for i, rule in enumerate(RULES)
    ]
    failed = F.filter(F.array(*reached), lambda r: r.isNotNull())
    return judged.select(
        F.col("id").alias(id_col),
        *COUNTS[:5],
        "base_failed",
        (~F.col("base_failed") & (F.size(failed) == 0)).alias("kept"),
        F.array_join(failed, ",").alias("failed_rules"),
        F.coalesce("level", F.lit(0)).alias("level"),
    )

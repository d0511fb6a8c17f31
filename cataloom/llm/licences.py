"""Licence notices in texts, found word by word and, with a few errors, by fuzzy search.

Texts are lower-cased (A-Z) and read as words of ASCII digits, letters and all characters
beyond ASCII. A notice's words standing consecutively are a base place. Notices with an error
budget are also searched for with up to so many inserted, deleted or replaced characters: such
a match leaves at least one of budget + 1 pieces of the notice untouched (pigeonhole), so
places of exact pieces are the only candidates, and bounded-error matching of the regex
library checks the words around them. Words of up to three letters must be exact, as one
error makes another word of them.

Null text counts as empty. Texts are searched whole.
"""

from __future__ import annotations

import bisect
import functools
import heapq
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LETTERS_PER_ERROR = 6
SHORT = 3  # words of so many letters are never matched with errors
BLOCK = 512  # bytes by which the blocks of a long stretch follow each other

_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)
_WORD = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@dataclass(frozen=True)
class Notice:
    phrase: str
    label: str
    base: bool = False  # exact places count as base places

    @property
    def errors(self) -> int:
        """Error budget, by the letters of the words that may have errors."""
        return sum(len(w) for w in self.phrase.split() if len(w) > SHORT) // LETTERS_PER_ERROR


# The phrases and labels that count as base.
BASE = (
    Notice("gnu general public license", "gpl", True),
    Notice("apache license", "apache", True),
    Notice("cc by", "cc-by", True),
    Notice("mit license", "mit", True),
)
# Opening words of further notices.
MORE = (
    Notice("gnu lesser general public license", "lgpl"),
    Notice("gnu affero general public license", "agpl"),
    Notice("mozilla public license", "mpl"),
    Notice("creative commons attribution", "cc-by"),
    Notice("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    Notice("redistribution and use in source and binary forms", "bsd"),
)


class Search:
    """One notice in texts reduced to words with single spaces, as bytes."""

    def __init__(self, notice: Notice):
        self.notice = notice
        phrase = notice.phrase.encode()
        self.exact = b" " + phrase + b" "
        n = notice.errors + 1
        bounds = [len(phrase) * i // n for i in range(n + 1)]
        self.seeds = sorted({phrase[a:b] for a, b in zip(bounds, bounds[1:], strict=False)})
        parts, run = [], []
        for word in notice.phrase.split():
            if len(word) <= SHORT:
                parts += [self._fuzzy(run)] * bool(run) + [word]
                run = []
            else:
                run.append(word)
        parts += [self._fuzzy(run)] * bool(run)
        # One budget for the whole phrase is checked on the match; each run has it at most.
        self.pattern = regex.compile(
            rb"(?b)(?<![^ ])" + b" ".join(p.encode() for p in parts) + rb"(?![^ ])"
        )

    def _fuzzy(self, words: list[str]) -> str:
        return f"(?:{' '.join(words)}){{e<={self.notice.errors}}}"

    def matches(self, text: bytes) -> list[tuple[int, int, int]]:
        """(start, end, errors) in ``text``, which begins and ends with a space."""
        exact = [(at + 1, at - 1 + len(self.exact), 0) for at in places(text, self.exact)]
        if not self.notice.errors:
            return exact
        found = list(exact)
        hits = sorted({p for seed in self.seeds for p in places(text, seed)})
        if not hits:
            return exact
        starts = [s for s, _, _ in exact]
        reach = len(self.exact) + self.notice.errors
        spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
        for begin, end in self._windows(text, np.array(hits), reach, spaces):
            for m in self._best_first(text, begin, end, reach, spaces):
                errors = sum(m.fuzzy_counts)
                first = m.start() + len(m[0]) - len(m[0].lstrip(b" "))
                last = m.end() - len(m[0]) + len(m[0].rstrip(b" "))
                # What meets an exact place is that place with more or fewer words. These are
                # equally long, so the last that begins before the end is the only one to ask.
                before = bisect.bisect_left(starts, last) - 1
                if errors <= self.notice.errors and not (before >= 0 and exact[before][1] > first):
                    found.append((first, last, errors))
        return sorted(found)

    def _best_first(
        self, text: bytes, begin: int, end: int, reach: int, spaces: np.ndarray
    ) -> Iterator[regex.Match]:
        """The best match of a stretch (of equal ones the first), then those of what is left on
        both sides of it.

        A long stretch is searched in blocks that begin and end between words and overlap by more
        than a match. The best of all their matches is taken; only blocks that meet it
        are searched again, in what it leaves of them, so the work grows with the stretch.
        """
        # Nothing shorter than the phrase with all errors taken out can match.
        least = len(self.exact) - 2 - self.notice.errors
        queue: list[tuple[int, int, int, int, int, regex.Match]] = []
        meeting: dict[int, set[tuple[int, int]]] = defaultdict(set)

        def search(a: int, b: int) -> None:
            if b - a < least or (a, b) in meeting[a // BLOCK]:
                return
            if m := self.pattern.search(text, a, b):
                heapq.heappush(queue, (sum(m.fuzzy_counts), m.start(), m.end(), a, b, m))
                for place in range(a // BLOCK, b // BLOCK + 1):
                    meeting[place].add((a, b))

        for a, b in blocks(begin, end, reach, spaces):
            search(a, b)
        while queue:
            _, first, last, a, b, m = heapq.heappop(queue)
            if (a, b) not in meeting[a // BLOCK]:
                continue  # has been searched again
            yield m
            met = set().union(*(meeting[p] for p in range(first // BLOCK, last // BLOCK + 1)))
            again = set()
            for a, b in met:
                if a < last and first < b:
                    for place in range(a // BLOCK, b // BLOCK + 1):
                        meeting[place].discard((a, b))
                    again |= {(a, min(b, first)), (max(a, last), b)}
            for a, b in sorted(again):
                search(a, b)

    def _windows(
        self, text: bytes, at: np.ndarray, reach: int, spaces: np.ndarray
    ) -> list[tuple[int, int]]:
        """Stretches around exact pieces, from word to word, joined where they meet."""
        before = np.searchsorted(spaces, np.maximum(0, at - reach), "right") - 1
        after = np.searchsorted(spaces, np.minimum(len(text) - 1, at + reach))
        spans = zip(spaces[before].tolist(), (spaces[after] + 1).tolist(), strict=True)
        joined: list[tuple[int, int]] = []
        for begin, end in spans:
            if joined and begin < joined[-1][1]:
                joined[-1] = joined[-1][0], max(end, joined[-1][1])
            else:
                joined.append((begin, end))
        return joined


def blocks(begin: int, end: int, reach: int, spaces: np.ndarray) -> list[tuple[int, int]]:
    """Parts of a stretch, cut between words, in one of which at least any match lies whole."""
    if end - begin <= 2 * BLOCK:
        return [(begin, end)]
    starts = np.arange(begin, end, BLOCK)
    low = np.maximum(begin, spaces[np.maximum(0, np.searchsorted(spaces, starts, "right") - 1)])
    ends = np.minimum(end - 1, starts + BLOCK + 2 * reach)
    high = np.minimum(end, spaces[np.minimum(len(spaces) - 1, np.searchsorted(spaces, ends))] + 1)
    return sorted(set(zip(low.tolist(), high.tolist(), strict=True)))


def places(text: bytes, part: bytes) -> Iterator[int]:
    at = text.find(part)
    while at >= 0:
        yield at
        at = text.find(part, at + 1)


@functools.lru_cache(maxsize=8)
def searches(notices: tuple[Notice, ...]) -> list[Search]:
    return [Search(n) for n in notices]


def scan_text(text: bytes, notices: tuple[Notice, ...]) -> dict:
    """What is found in one text (UTF-8)."""
    words = text.translate(_WORDS).split()
    plain = b" " + b" ".join(words) + b" "
    base, spans = [], []
    for search in searches(notices):
        notice = search.notice
        at = first = 0  # words before a place, counted from the place before
        for begin, end, errors in search.matches(plain):
            first += plain.count(b" ", at, begin) - (at == 0)
            at = begin
            last = first + plain.count(b" ", begin, end)
            spans.append(
                {
                    "label": notice.label,
                    "phrase": notice.phrase,
                    "errors": errors,
                    "first_word": first,
                    "last_word": last,
                }
            )
            if notice.base and not errors:
                base.append((first, notice.label))
    likeness = [1 - s["errors"] / len(s["phrase"]) for s in spans]
    if spans:
        _locate(text.decode("utf-8", "replace"), spans)
    return {
        "n_words": len(words),
        "n_base": len(base),
        "first_word": min((at for at, _ in base), default=None),
        "last_word": max((at for at, _ in base), default=None),
        "base_labels": ",".join(sorted({label for _, label in base})),
        "labels": ",".join(sorted({s["label"] for s in spans})),
        "score": max(likeness, default=0.0),
        "spans": sorted(spans, key=lambda s: (s["first_word"], s["last_word"], s["phrase"])),
    }


def _locate(text: str, spans: list[dict]) -> None:
    """Adds where each span begins and ends in the text's characters."""
    wanted = {s[k] for s in spans for k in ("first_word", "last_word")}
    found = {}
    for i, m in enumerate(_WORD.finditer(regex.sub("[A-Z]", lambda m: m[0].lower(), text))):
        if i in wanted:
            found[i] = m.span()
    for s in spans:
        s["begin"], s["end"] = found[s["first_word"]][0], found[s["last_word"]][1]


SPAN = (
    "struct<label: string, phrase: string, errors: int, first_word: bigint, last_word: bigint, "
    "begin: bigint, end: bigint>"
)
RESULT = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
    f"labels string, score double, spans array<{SPAN}>"
)


def scan(
    docs: DataFrame,
    notices: tuple[Notice, ...] = BASE + MORE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col``, counts, labels and spans of every document.

    ``score`` is 1 for an exact notice, less by the share of errors in the best one, 0 without.
    Both label columns are distinct, sorted, and joined by commas; empty if there are none.
    """
    chosen = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col).cast("binary"), F.lit(b"").cast("binary")).alias("text"),
    )
    result = T.StructType([chosen.schema["id"], *T.StructType.fromDDL(RESULT)])
    span = pa.struct(
        [(n, pa.string()) for n in ("label", "phrase")]
        + [("errors", pa.int32())]
        + [(n, pa.int64()) for n in ("first_word", "last_word", "begin", "end")]
    )
    kinds = {
        **dict.fromkeys(("n_words", "n_base", "first_word", "last_word"), pa.int64()),
        **dict.fromkeys(("base_labels", "labels"), pa.string()),
        "score": pa.float64(),
        "spans": pa.list_(span),
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scan_text(t.as_py(), notices) for t in batch.column(1)]
            columns = [pa.array([r[n] for r in rows], kind) for n, kind in kinds.items()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=result.names)

    return chosen.mapInArrow(run, result).withColumnRenamed("id", id_col)

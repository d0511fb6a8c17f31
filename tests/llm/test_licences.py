import itertools
import re

import pytest

from cataloom.llm import licences

DOCS = "doc_id bigint, text string, id string, spans int, score int"
ALL = licences.BASE + licences.MORE


def labels(text):
    return licences.scan_text(text.encode(), ALL)["labels"]


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("Released under the MIT License.", "mit"),
        ("mit licence", "mit"),
        ("under the Apach Licence, v2", "apache"),
        ("GNU Genral Publc License", "gpl"),
        ("gnu general publiclicense", "gpl"),
        ("GNU Lesser General Public License", "lgpl"),
        ("creative comons attribution and mit license", "cc-by,mit"),
        ("limit license", ""),
        ("it license", ""),
        ("CC BX", ""),
        ("mit lizenz", ""),
        ("", ""),
    ],
)
def test_labels(text, found):
    assert labels(text) == found


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_one_error_anywhere_is_found_and_counted():
    phrase = "apache license"
    for at in range(len(phrase)):
        for change in ("", "x", phrase[at] + "x"):
            text = phrase[:at] + change + phrase[at + 1 :]
            spans = licences.scan_text(f"see {text} here".encode(), ALL)["spans"]
            if text.startswith(" ") or text.strip() != text:
                continue
            assert any(s["label"] == "apache" for s in spans), text
            assert all(s["errors"] <= max(1, distance(text, phrase)) for s in spans)


def best_places(text, phrase, budget):
    """(first word, last word, errors) of places that do not meet, the best first."""
    words = text.split()
    found = []
    for i in range(len(words)):
        for j in range(i, min(len(words), i + 4)):
            errors = distance(" ".join(words[i : j + 1]), phrase)
            if errors <= budget:
                found.append((errors, i, j))
    kept = []
    for errors, i, j in sorted(found):
        if all(j < a or b < i for a, b, _ in kept):
            kept.append((i, j, errors))
    return sorted(kept)


@pytest.mark.parametrize("between", [" ", " x ", " some words "])
def test_notices_close_to_each_other_are_all_found(between):
    forms = ["apache license", "apache licence", "apach licence", "apachelicense", "apache license"]
    for some in itertools.permutations(forms, 3):
        text = between.join(["a", *some, "z"])
        spans = licences.scan_text(text.encode(), ALL)["spans"]
        found = [(s["first_word"], s["last_word"], s["errors"]) for s in spans if s["label"] == "apache"]
        assert sorted(found) == best_places(text, "apache license", 2), text


def test_spans_are_places_in_the_text():
    text = "Été: under the  GNU General\nPublic-License, or the MIT Licence!"
    found = licences.scan_text(text.encode(), ALL)
    assert [(s["label"], text[s["begin"] : s["end"]]) for s in found["spans"]] == [
        ("gpl", "GNU General\nPublic-License"),
        ("mit", "MIT Licence"),
    ]
    assert (found["n_base"], found["first_word"], found["last_word"]) == (1, 3, 3)


def brute(text):
    words = re.findall(
        "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    )
    places = []
    for notice in licences.BASE:
        phrase = notice.phrase.split()
        places += [
            (i, notice.label)
            for i in range(len(words) - len(phrase) + 1)
            if words[i : i + len(phrase)] == phrase
        ]
    starts = [i for i, _ in places]
    return (
        len(words),
        len(places),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted({x for _, x in places})),
    )


BASE = ("n_words", "n_base", "first_word", "last_word", "base_labels")


def test_rows(spark):
    texts = [None, "", "cc by cc by CC-BY", "x " * 100000 + "Apache License", "MIT License, mit license"]
    rows = [(i, t, "a", 1, 2) for i, t in enumerate(texts)] + [(None, "cc by", "a", 1, 2)] * 2
    found = licences.scan(spark.createDataFrame(rows, DOCS)).collect()
    assert len(found) == len(rows)
    for r in found:
        text = "cc by" if r["doc_id"] is None else texts[r["doc_id"]]
        assert tuple(r[c] for c in BASE) == brute(text)
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
    assert licences.scan(spark.createDataFrame([], DOCS)).count() == 0


def test_base_of_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for r in licences.scan(docs).join(docs.select("doc_id", "text"), "doc_id").collect():
        assert tuple(r[c] for c in BASE) == brute(r["text"])
        assert r["score"] == 1.0 if r["n_base"] else r["score"] < 1.0


def naive_best_first(search, text, begin, end):
    """The best of a whole stretch, then of both sides, by searching all of it each time."""
    least = len(search.exact) - 2 - search.notice.errors
    stretches, found = [(begin, end)], []
    while stretches:
        begin, end = stretches.pop()
        if m := search.pattern.search(text, begin, end):
            found.append((*m.span(), sum(m.fuzzy_counts)))
            sides = (begin, m.start()), (m.end(), end)
            stretches += [(a, b) for a, b in sides if b - a >= least]
    return sorted(found)


@pytest.mark.parametrize("notice", [n for n in ALL if 0 < n.errors <= 4], ids=lambda n: n.phrase)
def test_blocks_find_what_a_search_of_the_whole_finds(notice, monkeypatch):
    import random

    rnd = random.Random(notice.phrase)
    search = licences.Search(notice)
    monkeypatch.setattr(licences, "BLOCK", 40)

    def spoilt():
        letters = list(notice.phrase)
        for _ in range(rnd.randint(0, notice.errors + 1)):
            at = rnd.randrange(len(letters))
            letters[at] = rnd.choice(["", "x", letters[at] + "y", letters[at]])
        return " ".join("".join(letters).split())

    for _ in range(6):
        words = [spoilt() if rnd.random() < 0.6 else rnd.choice(["a", "license", "w" * 90, "the"]) for _ in range(25)]
        text = f" {' '.join(words)} ".encode()
        spaces = licences.np.flatnonzero(licences.np.frombuffer(text, licences.np.uint8) == 32)
        reach = len(search.exact) + notice.errors
        found = [
            (*m.span(), sum(m.fuzzy_counts))
            for m in search._best_first(text, 0, len(text), reach, spaces)
        ]
        assert sorted(found) == naive_best_first(search, text, 0, len(text))


@pytest.mark.parametrize(
    "part", ["apache licence x ", "apache license ", "gnu genral public license ", "mitlicense", "apache", "cc by "]
)
def test_repeated_notices_take_linear_time(part):
    import time

    def seconds(n):
        start = time.perf_counter()
        found = licences.scan_text((part * n).encode(), ALL)
        return time.perf_counter() - start, found

    seconds(10)
    little, _ = seconds(2_000)
    much, found = seconds(16_000)
    assert much < 16 * little + 2
    if part.startswith(("apache ", "gnu")):
        assert len([s for s in found["spans"] if s["label"] in ("apache", "gpl")]) == 16_000

"""Counts of texts, exact bounds and the choice of cutoffs against plain versions."""

import math
import re
from fractions import Fraction
from hashlib import md5

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cataloom.llm import quality_rules
from cataloom.llm.quality_rules import RULES, Settings, certify, count_text, judge, tail

DOCS = "doc_id bigint, text string, lang string, stratum string, id int, level int, k0 string, good int"


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    places = set()
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    for i, window in enumerate(windows):
        if windows.count(window) > 1:
            places |= set(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    among = lambda chars: sum(c in chars for c in text)
    return (
        len(words), sum(map(len, words)), among("#*$%&|<>"),
        sum(x in lines[:i] for i, x in enumerate(lines)), len(places), len(lines),
        among("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), among("!?"), among("0123456789"),
    )


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab A\n\r\t\x0b\x0c\x1c\x85 é€😀#|!7"), max_size=120))
def test_counts(text):
    assert count_text(text.encode()) == brute_counts(text)


def test_words_of_long_texts(monkeypatch):
    text = " ".join(f"w{i % 40}" for i in range(300)) + "\n" + "x" * 50 + " end"
    monkeypatch.setattr(quality_rules, "_PIECE", 7)
    assert count_text(text.encode()) == brute_counts(text)
    monkeypatch.undo()
    # Ten megabytes of words and one word of as many bytes, in linear time.
    long = b"some words that come again and again for ever " * 200_000 + b"y" * 10_000_000
    assert count_text(long)[0] == count_text(long)[4] + 1 == 1_800_001


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 120), st.data(), st.sampled_from([0.01, 0.02, 0.3, 0.9]))
def test_tail_is_the_exact_probability(n, data, rate):
    k = data.draw(st.integers(0, n))
    p = Fraction(rate)
    exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    assert tail(k, n, rate) == pytest.approx(float(exact), rel=1e-9, abs=1e-15)


def test_tail_of_many():
    # The largest count that passes at a million stays below the rate by about two deviations.
    assert tail(19_700, 10**6, 0.02) < 0.05 < tail(19_900, 10**6, 0.02) < 0.5
    assert tail(10**6, 10**6, 0.02) == 1.0


def made(draw, n, langs):
    """Texts of which some are all digits, in capitals or of long words; labels with noise."""
    out = []
    for i in range(n):
        lang = langs[i % len(langs)]
        bad = draw.random() < 0.3
        words = [f"{'abcdefgh'[: draw.integers(1, 8)]}{draw.integers(10**6)}x" for _ in range(30)]
        if bad and draw.random() < 0.8:
            share = draw.random()
            words = [w + "#" * draw.integers(1, 5) if draw.random() < share else w for w in words]
        if draw.random() < 0.1:
            words[0] += "###"
        out.append((i, " ".join(words), lang, "s", 1, 2, "k", 3, int(not bad)))
    return out


def plain(rows, said, s):
    """Levels of strata and ids kept, by loops."""
    counted = {}
    for i, text, lang, *_ in rows:
        c = dict(zip(quality_rules.COUNTS, brute_counts(text or ""), strict=True))
        failed = c["n_words"] < s.fewest_words or 100 * c["n_repeat_words"] > s.most_repeats * c["n_words"]
        values = [10000 * c[a] // c[b] if c[b] else 0 for _, a, b in RULES]
        counted[i] = (lang, failed, values)
    half = lambda i: md5(str(i).encode()).hexdigest()[0] < "8"
    used = [(i, *counted[i], said[i]) for i in said if i in counted and not counted[i][1]]
    strata = {lang for i, lang, _, _, good in used if good and not half(i)}
    verdict = {}
    for stratum in {v[0] for v in counted.values()}:
        cutoffs = {}
        ours = [(v, good) for i, lang, _, v, good in used if lang == stratum and half(i)]
        for rule in range(len(RULES)):
            bad = sorted({v[rule] for v, good in ours if not good}, reverse=True)
            gains = [
                (sum(-s.weight if good else 1 for v, good in ours if v[rule] >= c), c) for c in bad
            ]
            if not gains or max(gains)[0] < s.least:
                continue
            caught = sorted((v[rule] for v, good in ours if not good and v[rule] >= max(gains)[1]), reverse=True)
            cutoffs[rule] = [
                caught[math.ceil(len(caught) * level / s.levels) - 1] for level in range(1, s.levels + 1)
            ]
        good = [v for i, lang, _, v, g in used if lang == stratum and g and not half(i)]
        passed = 0
        for level in range(1, s.levels + 1):
            lost = sum(any(v[r] >= c[level - 1] for r, c in cutoffs.items()) for v in good)
            if not good or tail(lost, len(good), s.limit) > s.error / len(strata):
                break
            passed = level
        verdict[stratum] = (passed, {r: c[passed - 1] for r, c in cutoffs.items()} if passed else {})
    kept = {
        i: not failed and not any(v[r] >= c for r, c in verdict[lang][1].items())
        for i, (lang, failed, v) in counted.items()
    }
    return {k: (v[0] if v[1] else 0) for k, v in verdict.items()}, kept


@pytest.mark.parametrize("seed", range(2))
def test_cutoffs_agree_with_loops(spark, seed):
    draw = np.random.default_rng(seed)
    rows = made(draw, 900, ["en", "en", "de", None])
    said = {r[0]: bool(r[-1]) for r in rows if draw.random() < 0.8}
    s = Settings(limit=0.1, error=0.2, weight=2, least=3, levels=5)
    labels = spark.createDataFrame([(i, int(g), 0) for i, g in said.items()], "doc_id bigint, quality int, id int")
    docs = spark.createDataFrame([r[:-1] for r in rows], DOCS).repartition(4)
    levels, kept = plain(rows, said, s)
    found = judge(docs, labels, settings=s).collect()
    assert {r["doc_id"]: r["kept"] for r in found} == kept
    lang = {r[0]: r[2] for r in rows}
    assert {(lang[r["doc_id"]], r["level"]) for r in found} == set(levels.items())
    assert any(levels.values()) and not all(kept.values())


def test_the_first_policy_that_fails_ends_its_stratum(spark):
    n = len(RULES)
    # 100 good documents reject nothing at level 1, 3 at level 2, 40 at level 3, none beyond.
    values = [5] * 40 + [15] * 3 + [0] * 57
    rows = [("a", True, False, *[v if i == 0 else 0 for i in range(n)]) for v in values]
    kinds = "stratum string, good boolean, design boolean, " + ", ".join(f"v{i} bigint" for i in range(n))
    steps = [("a", [20, 10, 5, 4], *[None] * (n - 1))]
    step_kinds = "stratum string, " + ", ".join(f"c{i} array<bigint>" for i in range(n))
    labelled, cutoffs = spark.createDataFrame(rows, kinds), spark.createDataFrame(steps, step_kinds)
    for limit, level, lost in ((0.1, 2, 3), (0.02, 0, 0), (0.05, 1, 0), (0.6, 4, 43)):
        s = Settings(levels=4, limit=limit, error=0.05)
        assert certify(labelled, cutoffs, s).collect() == [("a", level, 100, lost)]


def test_nulls_repeats_and_missing_labels(spark):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(1, None, None, *[None] * 5), (1, text, None, *[None] * 5), (None, text, "x", *[None] * 5)]
    rows += [(2, "", "x", *[None] * 5), (3, text + " " + text, "y", *[None] * 5)]
    docs = spark.createDataFrame(rows, DOCS)
    kinds = "doc_id bigint, quality int"
    for said in ([], [(1, 0), (1, 1), (2, None), (None, 1), (3, 7)], [(1, 0), (3, 1)]):
        found = judge(docs, spark.createDataFrame(said, kinds)).orderBy("n_words").collect()
        assert [(r["doc_id"], r["n_words"]) for r in found[:2]] in ([(1, 0), (2, 0)], [(2, 0), (1, 0)])
        assert sorted((r["n_words"], r["base_failed"], r["kept"]) for r in found) == [
            (0, True, False), (0, True, False), (40, False, True), (40, False, True), (80, True, False)
        ]
        assert {r["level"] for r in found} == {0}
    assert judge(docs.limit(0), spark.createDataFrame([], kinds)).count() == 0
    assert judge(docs, spark.createDataFrame([], kinds), strata=[]).count() == 5


def test_few_good_documents_are_rejected_in_every_stratum(spark):
    """On the given tables: what the holdout promises holds for all labelled documents."""
    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    found = judge(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), labels)
    rated = found.join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id").where("not base_failed")
    for r in rated.groupBy("lang").agg(
        F.count_if(F.expr("quality = 1 and not kept")).alias("lost"), F.count_if(F.expr("quality = 1")).alias("good")
    ).collect():
        assert r["lost"] <= 0.02 * r["good"]
    bad = rated.where("quality = 0").agg(F.avg(F.expr("double(not kept)"))).first()[0]
    assert bad > 0.8

"""Language identification against a plain version of it, and with many languages."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cataloom.llm import langid

KINDS = "doc_id bigint, text string, lang string"


def made(seed, langs, each):
    """Texts of languages that differ in their syllables."""
    draw = np.random.default_rng(seed)
    letters = list("abcdefghijklmnopqrstuvwxyzéñø")
    rows = []
    for lang in range(langs):
        syllables = ["".join(draw.choice(letters, 3)) for _ in range(12)]
        for _ in range(each):
            words = ["".join(draw.choice(syllables, draw.integers(1, 3))) for _ in range(draw.integers(5, 40))]
            rows.append((len(rows), " ".join(words).capitalize() + ", 12!", f"l{lang:03}"))
    return rows


def plain_counts(text):
    folded = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in text.encode())
    folded = re.sub(b" +", b" ", b" " + folded + b" ")
    return Counter(folded[i : i + 3] for i in range(len(folded) - 2))


def plain_fit(rows, vocabulary, clusters):
    """(idf by trigram, centroids by language as dictionaries)."""
    by_lang = {}
    for _, text, lang in rows:
        by_lang.setdefault(lang, []).append(plain_counts(text))
    turns, texts = {}, Counter()
    for counts in by_lang.values():
        own = Counter(g for c in counts for g in c)
        texts.update(own)
        for turn, (gram, _) in enumerate(sorted(own.items(), key=lambda x: (-x[1], x[0]))):
            turns[gram] = min(turn, turns.get(gram, turn))
    chosen = sorted(turns, key=lambda g: (turns[g], -texts[g], g))[:vocabulary]
    idf = {g: math.log1p(len(rows) / texts[g]) for g in chosen}
    grams = sorted(chosen)

    def vector(counts):
        v = np.array([math.log1p(counts[g]) * idf[g] for g in grams])
        length = math.sqrt((v * v).sum())
        return v / length if length else v

    centroids = {}
    for lang, counts in by_lang.items():
        own = sorted((vector(c).astype("f4") for c in counts), key=lambda v: v.tobytes())
        own = [v.astype(float) for v in own if v.any()]
        mean = sum(own) / len(own)
        seeds = [own[max(range(len(own)), key=lambda i: float(own[i] @ mean))]]
        while len(seeds) < min(clusters, len(own)):
            seeds.append(min(own, key=lambda v: max(float(v @ s) for s in seeds)))
        means = seeds
        for _ in range(12):
            groups = [[] for _ in means]
            for v in own:
                groups[max(range(len(means)), key=lambda i: float(v @ means[i]))].append(v)
            means = [sum(g) / len(g) for g in groups if g]
            means = [m / np.linalg.norm(m) for m in means]
        centroids[lang] = means
    return vector, centroids


def test_centroids_and_nearest_language_agree_with_a_plain_version(spark):
    rows = made(1, 6, 25)
    docs = spark.createDataFrame(rows, KINDS).repartition(4)
    settings = langid.Settings(per_lang=10**6, vocabulary=150, clusters=3)
    model = langid.fit(docs, settings)
    trained = {r["doc_id"] for r in langid.training_rows(docs, "doc_id", "lang").collect()}
    vector, centroids = plain_fit([r for r in rows if r[0] in trained], 150, 3)
    assert model.langs == [lang for lang in sorted(centroids) for _ in centroids[lang]]
    wanted = np.array([m for lang in sorted(centroids) for m in centroids[lang]])
    assert np.abs(model.centroids - wanted).max() < 1e-4
    found = {r["doc_id"]: r for r in langid.predict(docs, model).collect()}
    for i, text, _ in rows:
        v = vector(plain_counts(text))
        near = {lang: max(float(v @ m) for m in means) for lang, means in centroids.items()}
        assert found[i]["lang_pred"] == max(near, key=near.get)
        assert found[i]["score"] == pytest.approx(max(near.values()), abs=1e-4)


def test_three_hundred_languages_are_learned(spark):
    rows = made(2, 300, 8)
    docs = spark.createDataFrame(rows, KINDS).repartition(8)
    model = langid.fit(docs)
    assert len(set(model.langs)) == 300
    held = langid.predict(docs, model).where(langid.held_out("doc_id"))
    right = held.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0]
    assert right > 0.97


def test_a_rare_language_has_its_trigrams(spark):
    rows = made(3, 3, 400)
    rows = [r for r in rows if r[2] != "l002" or r[0] % 40 == 0]
    docs = spark.createDataFrame(rows, KINDS)
    model = langid.fit(docs, langid.Settings(vocabulary=60))
    found = langid.predict(docs.where("lang = 'l002'"), model)
    assert found.where("lang_pred <> 'l002'").count() == 0


def test_few_texts_of_a_known_language_are_rejected(spark):
    """On the given tables, among held-out documents with letters."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    found = langid.predict(docs, langid.fit(docs), keep=["doc_id"]).where("lang_pred <> 'und'")
    held = found.where(langid.held_out("doc_id"))
    assert held.where("rejected").count() <= 0.005 * held.count()


def test_rows_without_an_id_do_not_swell_the_sample(spark):
    rows = [(None if i % 2 else i, t, lang) for i, t, lang in made(4, 2, 500)]
    model = langid.fit(spark.createDataFrame(rows, KINDS), langid.Settings(per_lang=20))
    assert set(model.langs) == {"l000", "l001"}

import pytest
from pyspark.sql import functions as F

from cataloom.llm import langid, toxicity

DOCS = "doc_id bigint, text string, lang string, score string, `a.b` int"
ENGLISH = "the quick brown fox jumps over the lazy dog and then it goes home with the others "
GERMAN = "der schnelle braune Fuchs springt über den faulen Hund und dann geht er nach Hause "


def corpus(n=160):
    rows = []
    for i in range(n):
        words = (ENGLISH if i % 2 else GERMAN).split()
        text = " ".join(words[i % 7 :] + words[: 3 + i % 5])
        rows.append((i, text, "en" if i % 2 else "de", "kept", i))
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    extra = [
        (1000, None, "en", "kept", 0),
        (1001, "", None, "kept", 0),
        (1002, "123 !!! \n", "de", "kept", 0),
        (1003, "漢字漢字 漢字漢字漢字 漢字", None, "kept", 0),
        (1004, "THE LAZY DOG " * 20000, None, "kept", 0),
        (None, "und dann geht er", None, "kept", 0),
        (7, corpus()[7][1], "en", "kept", 7),
    ]
    return spark.createDataFrame(corpus() + extra, DOCS)


def test_languages_and_rejection(docs):
    found = langid.predict(docs, langid.fit(docs), keep=["doc_id", "lang"]).collect()
    assert len(found) == docs.count()
    by_id = {r["doc_id"]: r for r in found}
    assert all(by_id[i]["lang_pred"] == ("en" if i % 2 else "de") for i in range(160))
    assert not any(by_id[i]["rejected"] for i in range(160))
    for i in (1000, 1001, 1002):
        assert (by_id[i]["lang_pred"], by_id[i]["score"]) == ("und", 0.0)
    assert by_id[1003]["lang_pred"] in ("de", "en") and by_id[1003]["rejected"]
    assert by_id[1004]["lang_pred"] == "en" and by_id[None]["lang_pred"] == "de"
    assert all(0 <= r["score"] <= 1 for r in found)


def test_other_columns_stay_and_results_replace_their_names(docs):
    found = langid.predict(docs, langid.fit(docs))
    assert found.columns == ["doc_id", "text", "lang", "a.b", "lang_pred", "score", "rejected"]


def test_labels_of_held_out_rows_are_not_learned(spark, docs):
    held = docs.withColumn("lang", F.when(langid.held_out("doc_id"), F.lit("xx")).otherwise(F.col("lang")))
    assert "xx" not in langid.fit(held).langs


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([(1, "words", None)], "doc_id bigint, text string, lang string")
    assert langid.fit(none) is None
    assert langid.predict(none, None).first()["lang_pred"] == "und"
    assert langid.predict(none.limit(0), langid.fit(none.limit(0))).count() == 0


def test_trigrams_do_not_depend_on_chunks(monkeypatch):
    text = ("Ab  c--déf 12 GHI " * 40).encode()
    whole = sorted(x for c in langid.trigrams(text) for x in c.tolist())
    monkeypatch.setattr(langid, "CHUNK", 17)
    assert sorted(x for c in langid.trigrams(text) for x in c.tolist()) == whole


def toxic_corpus():
    rows, labels = [], []
    for i in range(400):
        text = corpus(8)[i % 8][1]
        toxic = int(i % 5 == 0)
        if toxic:
            text += (" the idiot ", " the moron ")[i // 5 % 2] + "goes home"
        rows.append((i, text))
        labels.append((i, toxic, 1))
    return rows, labels


@pytest.fixture(scope="module")
def toxic_model(spark):
    rows, labels = toxic_corpus()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels += [(None, 1, 1), (3, None, 1), (5000, 1, 1)]
    found = spark.createDataFrame(labels, "doc_id bigint, toxic int, quality int")
    return docs, toxicity.fit(docs, found)


def test_toxic_words_gapped_and_altered(spark, toxic_model):
    _, model = toxic_model
    texts = {
        "plain": "the idiot goes home",
        "inserted": "the idxiot goes home",
        "doubled": "the idiiot goes home",
        "spaced": "the i d i o t goes home",
        "dotted": "the i.d.i.o.t goes home",
        "starred": "the mo*ron goes home",
        "long": ENGLISH * 3000 + " moron",
        "clean": ENGLISH,
        "near": "the radio and the moon",
        "empty": "",
        "null": None,
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    found = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    for name in ("plain", "inserted", "doubled", "spaced", "dotted", "starred", "long"):
        assert found[name]["predicted"] == 1, name
    for name in ("clean", "near", "empty", "null"):
        assert found[name]["predicted"] == 0, name
    assert all(0 <= r["score"] <= 1 for r in found.values())
    assert found["empty"]["score"] == found["null"]["score"]


def test_held_out_labels_are_not_learned(spark, toxic_model):
    docs, model = toxic_model
    labels = spark.createDataFrame(toxic_corpus()[1], "doc_id bigint, toxic int, quality int")
    turned = labels.withColumn(
        "toxic", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    again = toxicity.fit(docs, turned)
    assert again.landmarks == model.landmarks and (again.weights == model.weights).all()


def test_no_model_without_both_classes(spark, toxic_model):
    docs, _ = toxic_model
    labels = spark.createDataFrame(toxic_corpus()[1], "doc_id bigint, toxic int, quality int")
    assert toxicity.fit(docs, labels.where("toxic = 0")) is None
    assert toxicity.fit(docs, labels.limit(0)) is None
    scored = toxicity.score(docs.limit(3), None)
    assert {tuple(r) for r in scored.select("score", "predicted").collect()} == {(0.0, 0)}
    assert toxicity.score(docs.limit(0), None).count() == 0


def brute_kernel(s, t, decay):
    from itertools import combinations

    total = 0.0
    for a in combinations(range(len(s)), 3):
        for b in combinations(range(len(t)), 3):
            if all(s[i] == t[j] for i, j in zip(a, b, strict=True)):
                total += decay ** (a[2] - a[0] + 1 + b[2] - b[0] + 1)
    return total


def test_kernel_agrees_with_its_definition():
    words = [b"idiot", b"idxiot", b"radio", b"tidio"]
    rows = toxicity.coded(words, 8)
    for z in words:
        found = toxicity.kernel(rows, toxicity.coded([z], len(z)), 0.75)
        for word, value in zip(words, found, strict=True):
            assert value == pytest.approx(brute_kernel(word, z, 0.75), rel=1e-5)


def test_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    found = langid.predict(docs, langid.fit(docs), keep=["doc_id", "lang"])
    held = found.where(langid.held_out("doc_id"))
    assert held.where("lang_pred = lang").count() >= 0.99 * held.count()
    scored = toxicity.score(docs, toxicity.fit(docs, labels), keep=["doc_id"]).join(labels, "doc_id")
    held = scored.where(toxicity.held_out("doc_id"))
    assert held.where("predicted = toxic").count() >= 0.98 * held.count()

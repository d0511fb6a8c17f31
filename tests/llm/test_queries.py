"""Registered queries on the given tables: against SQL where there is some, else brute force."""

import re
from pathlib import Path

import duckdb
import pytest
from test_jaccard import brute

import __spark_entry__ as entry
import corpus_pipeline
from cataloom.llm.queries import ORACLES, QUERIES

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def test_every_operator_has_its_query():
    numbers = [int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, duck, name):
    result = QUERIES[name](spark, str(DATA))
    found = duck.execute(ORACLES[name])
    columns = [c[0] for c in found.description]
    assert result.columns == columns
    ours = sorted((tuple(r) for r in result.collect()), key=repr)
    assert ours == sorted(found.fetchall(), key=repr)


COLUMNS = {
    "op1": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op2": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op3": "query_id bigint, rank int, vec_id bigint, score double",
    "op4": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op5": "doc_id bigint, held_out boolean, score double, predicted int",
    "op6": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op7": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double",
    "op8": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op9": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op10": "page_id bigint, url string, text string, n_chars bigint",
    "op11": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op12": "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint",
    "op13": "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_rows(spark, name):
    result = QUERIES[name](spark, str(DATA))
    wanted = COLUMNS[name.split("_")[0]].split(", ")
    kinds = [f"{c} {k}" for c, k in result.dtypes]
    assert kinds[: len(wanted)] == wanted
    keys = result.columns[0]
    source = {"doc_id": "documents", "page_id": "pages", "vec_id": "embeddings"}.get(keys)
    if source:
        rows = spark.read.parquet(f"{DATA}/{source}.parquet")
        assert result.select(keys).distinct().count() == rows.select(keys).distinct().count()


def test_links_of_documents(spark, rows):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    assert rows(QUERIES["op9_combination_jaccard"](spark, str(DATA))) == brute([tuple(r) for r in docs])


ROWS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score int, `__text` int"


def test_stages_return_the_columns_they_got(spark):
    given = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    data = [(*r, 1, 2) for r in given] + [(None, None, None, None, None, None, None)] * 2
    docs = spark.createDataFrame(data, ROWS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, str(DATA))
        assert kept.columns == docs.columns
        assert kept.exceptAll(docs).count() == 0
        assert stage(spark, docs.limit(0), str(DATA)).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(DATA)).count() >= docs.count()


def test_stages_drop_what_their_operators_find(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    names = {"language_id": "op6", "toxicity": "op5", "ngram_jaccard_join": "op9"}
    drop = {"op6": "rejected", "op5": "predicted = 1", "op9": "doc_id <> component_id"}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        op = names[name]
        query = next(q for n, q in QUERIES.items() if n.startswith(f"{op}_"))
        gone = {r[0] for r in query(spark, str(DATA)).where(drop[op]).select("doc_id").collect()}
        left = {r[0] for r in stage(spark, docs, str(DATA)).select("doc_id").collect()}
        assert left == {r[0] for r in docs.select("doc_id").collect()} - gone


def test_pipeline_packs_every_kept_document_once(spark):
    found = corpus_pipeline.run(spark, str(DATA)).collect()
    ends = {}
    for r in sorted(found, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 2048
    assert len({(r["doc_id"], r["piece"]) for r in found}) == len(found)


def test_documents_without_any_known_language_stay(spark):
    data = [(n, f"clean words of document {n}", None, "web", 5, 1, 2) for n in range(9)]
    docs = spark.createDataFrame([*data, (9, "12 34", None, "web", 5, 1, 2), (None,) * 7], ROWS)
    kept = corpus_pipeline.known_language(spark, docs, str(DATA))
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == list(range(9))


def test_rows_that_repeat_an_id_are_told_apart(spark):
    words = [f"{x}{n}" for x in "abcde" for n in range(12)]
    copied, changed = " ".join(words), " ".join([*words[:-1], "other"])
    alone, nameless = " ".join(words[::-1]), " ".join(words[::2] + words[1::2])
    texts = [(1, copied), (2, changed), (2, alone), (None, copied), (3, alone), (4, "x y"), (4, "x y")]
    texts += [(None, nameless), (None, nameless), (5, None), (5, None)]
    docs = spark.createDataFrame([(i, t, "en", "web", 1, 1, 2) for i, t in texts], ROWS)
    kept = corpus_pipeline.one_of_each(spark, docs.repartition(3), str(DATA))
    assert kept.columns == docs.columns
    found = sorted((tuple(r[:2]) for r in kept.collect()), key=repr)
    wanted = [(1, copied), (2, alone), (4, "x y"), (None, nameless), (5, None), (5, None)]
    assert found == sorted(wanted, key=repr)

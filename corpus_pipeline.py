"""From raw documents to packed training sequences, in stages.

Each stage gets the documents that its predecessor kept, as written and read again, and learns
from them where it learns. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cataloom.llm import jaccard, langid, packing, reachable, toxicity
from cataloom.operators.sizes import broadcast_if_small
from cataloom.storage import materialize

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


RESULTS = ("lang_pred", "score", "rejected", "predicted")


def place(docs: DataFrame, column: str) -> str:
    return f"c{docs.columns.index(column)}"


def numbered(docs: DataFrame) -> DataFrame:
    """Columns named by their place, so that none has the name of a result."""
    return docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that language identification rejects: without letters, or far from all
    languages learned."""
    reachable(spark)
    found = langid.predict(numbered(docs), langid.fit(docs), text_col=place(docs, "text"))
    return found.where("not rejected").drop(*RESULTS).toDF(*docs.columns)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents predicted as toxic by what the labelled ones among them teach."""
    reachable(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(numbered(docs), model, text_col=place(docs, "text"))
    return scored.where("predicted = 0").drop(*RESULTS).toDF(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near-duplicates the row with the smallest doc_id; one without an id
    only if none of the group has one.

    Rows are told apart by doc_id and text; of rows equal in both, one stays if the text has words.
    """
    reachable(spark)
    doc_id, text = place(docs, "doc_id"), place(docs, "text")
    # 128 bits: among 10^12 different rows two have one key about once in 10^15 such tables. The
    # join's tables have rows without an id, so its column must allow null.
    said = F.concat_ws("\0", F.col(doc_id).cast("string"), F.col(text))
    kind = F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in (doc_id, text)])
    key = F.nullif(F.md5(F.concat(kind, said).cast("binary")), F.lit(""))
    rows = numbered(docs).withColumn("key", key)
    groups = materialize(jaccard.join(rows.select("key", text), id_col="key", text_col=text), "groups")
    linked = groups.where("key <> component_id").select("key", "component_id")
    heads = linked.select(F.col("component_id").alias("key"), "component_id")
    members = materialize(linked.union(heads).distinct(), "members")
    order = F.struct(F.col(doc_id).isNull(), doc_id, "key")
    best = materialize(
        rows.select("key", doc_id)
        .join(broadcast_if_small(members), "key")
        .groupBy("component_id")
        .agg(F.min(order)["key"].alias("best")),
        "best",
    )
    gone = members.join(broadcast_if_small(best), "component_id").where("key <> best").select("key")
    left = rows.join(broadcast_if_small(materialize(gone, "repeats")), "key", "left_anti")
    again = groups.where("n_shingles > 0").groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    again = materialize(again.select("key"), "equal-rows")
    if not again.isEmpty():
        again = broadcast_if_small(again)
        whole = F.min(F.struct(*(c for c in left.columns if c != "key"))).alias("row")
        one = left.join(again, "key", "left_semi").groupBy("key").agg(whole).select("key", "row.*")
        left = left.join(again, "key", "left_anti").unionByName(one)
    return left.drop("key").toDF(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the ids of all documents into sequences of at most 2048 tokens."""
    reachable(spark)
    return packing.pack_documents(docs, VOCABULARY)


STAGES = [
    ("language_id", known_language),
    ("toxicity", not_toxic),
    ("ngram_jaccard_join", one_of_each),
    ("best_fit_packing", packed),
]

#: Learned models and tokenizers cannot be written in SQL; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

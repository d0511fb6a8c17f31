"""One query per operator over its whole table, with the SQL that must agree where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cataloom.llm import (
    bpe,
    jaccard,
    langid,
    licences,
    near_vectors,
    negatives,
    neighbours,
    packing,
    quality_rules,
    reachable,
    toxicity,
    warc,
    whitening,
    wrapper,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_best_fit_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(table(spark, d, "documents"), VOCABULARY)


@query
def op4_bpe_tree(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode(
        table(spark, d, "documents"), VOCABULARY, row=bpe.digest_row, columns=bpe.DIGEST
    )


@query
def op5_string_kernel_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    model = toxicity.fit(docs, table(spark, d, "labels"))
    scored = toxicity.score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted")


@query
def op6_centroid_language(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    found = langid.predict(docs, langid.fit(docs), keep=["doc_id"])
    return found.select(
        "doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected"
    )


@query
def op9_combination_jaccard(spark: SparkSession, d: str) -> DataFrame:
    return jaccard.join(table(spark, d, "documents"))


ORACLES["op9_combination_jaccard"] = r"""
    WITH RECURSIVE texts AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS w FROM documents),
    sets AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_distinct(list_transform(range(1, len(w) - 3),
                lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM texts),
    sizes AS (SELECT doc_id, len(s) AS n FROM sets),
    items AS (SELECT doc_id, unnest(s) AS x FROM sets),
    shared AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
        FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (
        SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
        WHERE 100 * k >= 75 * (x.n + y.n - k)),
    reached(origin, node) AS (
        SELECT doc_id, doc_id FROM documents
        UNION
        SELECT r.origin, l.b FROM reached r JOIN links l ON l.a = r.node),
    least AS (SELECT origin, min(node) AS component_id FROM reached GROUP BY origin)
    SELECT doc_id, n AS n_shingles, component_id FROM sizes JOIN least ON origin = doc_id"""


@query
def op8_seekable_warc(spark: SparkSession, d: str) -> DataFrame:
    back = warc.archive(table(spark, d, "pages"), payloads=False)
    return back.select(
        F.col("page").cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"),
    )


ORACLES["op8_seekable_warc"] = """
    WITH bodies AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
    sized AS (
        SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS payload_digest,
            max(page_id) OVER (PARTITION BY sha1(body)) AS kept
        FROM bodies)
    SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
        CASE WHEN payload_bytes >= 1000 AND kept <> page_id THEN 'revisit' ELSE 'response' END
            AS record_type,
        CASE WHEN payload_bytes >= 1000 AND kept <> page_id THEN kept END AS refers_to
    FROM sized"""


@query
def op10_wrapper_induction(spark: SparkSession, d: str) -> DataFrame:
    return wrapper.extract_text(table(spark, d, "pages"))


@query
def op7_fuzzy_notices(spark: SparkSession, d: str) -> DataFrame:
    return licences.scan(table(spark, d, "documents")).drop("spans")


@query
def op2_cross_polytope(spark: SparkSession, d: str) -> DataFrame:
    return near_vectors.linked(table(spark, d, "embeddings"))


ORACLES["op2_cross_polytope"] = """
    WITH RECURSIVE fine AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b ON a.vec_id <> b.vec_id
        WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
    reached(origin, node) AS (
        SELECT vec_id, vec_id FROM embeddings
        UNION
        SELECT r.origin, l.b FROM reached r JOIN links l ON l.a = r.node),
    least AS (SELECT origin, min(node) AS component_id FROM reached GROUP BY origin),
    counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
    SELECT e.vec_id, coalesce(c.n, 0) AS n_links, l.component_id, e.vec_id = l.component_id AS kept
    FROM embeddings e JOIN least l ON l.origin = e.vec_id LEFT JOIN counts c ON c.a = e.vec_id"""


@query
def op3_adaptive_scan(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings")
    return neighbours.nearest(vectors, k=20, queries=vectors.where("vec_id % 20 = 0"))


@query
def op11_risk_controlled_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality_rules.judge(table(spark, d, "documents"), table(spark, d, "labels"))


ORACLES["op11_risk_controlled_rules"] = r"""
    WITH texts AS (
        SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t,
            regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
            list_filter(string_split(coalesce(text, ''), chr(10)),
                lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
        FROM documents),
    runs AS (
        SELECT r, unnest(g) AS g, generate_subscripts(g, 1) AS i FROM (
            SELECT r, list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' ')) AS g
            FROM texts WHERE len(w) >= 8)),
    again AS (SELECT r, i FROM runs QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
    covered AS (SELECT r, count(DISTINCT i + o) AS n FROM again, range(8) AS t(o) GROUP BY r),
    counts AS (
        SELECT r, doc_id, stratum, len(w) AS n_words,
            length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
            length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
            len(lines) - len(list_distinct(lines)) AS n_dup_lines,
            coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines,
            length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
            length(regexp_replace(t, '[^!?]', '', 'g')) AS n_marks,
            length(regexp_replace(t, '[^0-9]', '', 'g')) AS n_digits
        FROM texts LEFT JOIN covered USING (r)),
    facts AS (
        SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts),
    shares AS (
        SELECT r, doc_id, stratum, base_failed, unnest([
            {'pos': 0, 'rule': 'symbols', 'a': n_symbols, 'b': word_chars},
            {'pos': 1, 'rule': 'upper', 'a': n_upper, 'b': word_chars},
            {'pos': 2, 'rule': 'marks', 'a': n_marks, 'b': word_chars},
            {'pos': 3, 'rule': 'digits', 'a': n_digits, 'b': word_chars},
            {'pos': 4, 'rule': 'dup_lines', 'a': n_dup_lines, 'b': n_lines},
            {'pos': 5, 'rule': 'repeats', 'a': n_repeat_words, 'b': n_words},
            {'pos': 6, 'rule': 'long_words', 'a': word_chars, 'b': n_words},
            {'pos': 7, 'rule': 'short_words', 'a': n_words, 'b': word_chars}], recursive := true)
        FROM facts),
    measured AS (
        SELECT *, CASE WHEN b > 0 THEN 10000 * a // b ELSE 0 END AS value FROM shares),
    said AS (
        SELECT doc_id, min(quality) = 1 AS good FROM labels WHERE quality IN (0, 1)
        GROUP BY doc_id HAVING min(quality) = max(quality)),
    labelled AS (
        SELECT m.*, good, substr(md5(CAST(doc_id AS VARCHAR)), 1, 1) < '8' AS design
        FROM measured m JOIN said USING (doc_id) WHERE NOT base_failed),
    histogram AS (
        SELECT stratum, pos, value, count(*) FILTER (good) AS good, count(*) FILTER (NOT good) AS bad
        FROM labelled WHERE design GROUP BY ALL),
    sums AS (
        SELECT stratum, pos, value, bad, sum(bad) OVER falling AS caught, sum(good) OVER falling AS lost
        FROM histogram WINDOW falling AS (PARTITION BY stratum, pos ORDER BY value DESC)),
    worth AS (
        SELECT stratum, pos, arg_max(value, (caught - 20 * lost, value)) AS least, max(caught - 20 * lost) AS gain
        FROM sums WHERE bad > 0 GROUP BY ALL HAVING gain >= 10),
    chosen AS (
        SELECT s.*, max(caught) OVER (PARTITION BY stratum, pos) AS every
        FROM sums s JOIN worth USING (stratum, pos) WHERE bad > 0 AND value >= least),
    steps AS (
        SELECT stratum, pos, level, max(value) AS cutoff FROM chosen, range(1, 17) AS t(level)
        WHERE caught * 16 >= every * level GROUP BY ALL),
    holdout AS (
        SELECT l.r, l.stratum, coalesce(min(level), 17) AS rejected_from
        FROM labelled l LEFT JOIN steps s ON s.stratum = l.stratum AND s.pos = l.pos AND l.value >= s.cutoff
        WHERE good AND NOT design GROUP BY l.r, l.stratum),
    tried AS (
        SELECT stratum, level, count(*) AS n, count(*) FILTER (rejected_from <= level) AS k
        FROM holdout, range(1, 17) AS t(level) GROUP BY ALL),
    tested AS (
        SELECT *, list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1)
            - lgamma(n - i + 1) + i * ln(0.02) + (n - i) * ln(0.98))))
            <= 0.05 / (SELECT count(DISTINCT stratum) FROM holdout) AS passed
        FROM tried),
    levels AS (
        SELECT stratum, coalesce(min(level) FILTER (NOT passed) - 1, 16) AS level FROM tested GROUP BY ALL),
    held AS (SELECT * FROM steps JOIN levels USING (stratum, level)),
    failed AS (
        SELECT r, string_agg(rule, ',' ORDER BY pos) AS failed_rules
        FROM measured JOIN held USING (stratum, pos) WHERE value >= cutoff GROUP BY r),
    with_cutoffs AS (SELECT DISTINCT stratum, level FROM held)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed AND failed_rules IS NULL AS kept, coalesce(failed_rules, '') AS failed_rules,
        CAST(coalesce(level, 0) AS INTEGER) AS level
    FROM facts LEFT JOIN failed USING (r) LEFT JOIN with_cutoffs USING (stratum)"""


@query
def op12_threshold_negatives(spark: SparkSession, d: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, d, "embeddings").withColumn("label", moved)
    found = negatives.mine(vectors, F.col("vec_id") % 50 == 0)
    return found.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


ORACLES["op12_threshold_negatives"] = """
    WITH fine AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
        FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
    scored AS (
        SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
            CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
        FROM fine a JOIN fine b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
    positives AS (
        SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
    SELECT anchor_id, positive_id,
        CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER)
            AS rank,
        id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 100 * score BETWEEN 50 * positive_score AND 95 * positive_score
    QUALIFY rank <= 3"""


@query
def op13_polarised_whitening(spark: SparkSession, d: str) -> DataFrame:
    found = whitening.whiten(table(spark, d, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").cast("bigint"))

"""Cleaning, normalising, ordering, quality checks."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cataloom.constants import CANONICAL_LANGUAGES, LABEL_REMOVALS, WHITESPACE
from cataloom.functions import (
    canonical_label as canonical,
    cents_to_units,
    clean_labels as labels_of,
    minutes_to_hours,
    null_tokens as without_tokens,
    parse_range as range_of,
    parse_weighted,
    split_trim,
    weighted_is_bad,
)
from cataloom.operators import ids, quality
from cataloom.operators.normalize import normalize_list, normalize_map
from cataloom.plans.transform import build_star as star_of
from cataloom.plans.transform import clean_facts as facts_of
from cataloom.plans.transform import spread
from cataloom.schemas import RAW_DETAIL_COLUMNS
from cataloom.showcase import query, roles, table
from cataloom.showcase.roles import GENRES
from cataloom.sources import landing
from cataloom.sources.tables import append_all, conform, project
from cataloom.storage import materialize


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


SPACES = "(" + " || ".join(f"chr({ord(c)})" for c in WHITESPACE) + ")"


def sql_replace(text: str, pairs) -> str:
    for old, new in pairs:
        text = f"replace({text}, {sql_text(old)}, {sql_text(new)})"
    return text


def sql_clean_labels(text: str) -> str:
    entry = sql_replace("x", [(r, "") for r in LABEL_REMOVALS])
    entry = f"replace(replace({entry}, chr(13) || chr(10), ' '), chr(10), ' ')"
    return f"""list_filter(
        list_transform(string_split({text}, ','), lambda x: trim({entry}, {SPACES})),
        lambda x: NOT starts_with(x, '#') AND NOT starts_with(x, '(')
            AND lower(x) <> 'not supported')"""


def sql_canonical(text: str, names) -> str:
    cases = " ".join(
        f"WHEN contains(lower({text}), {sql_text(n.lower())}) THEN {sql_text(n)}" for n in names
    )
    return f"CASE {cases} ELSE {text} END"


# ---- normalisation -------------------------------------------------------------------


@query(f"WITH {GENRES} SELECT id_genre, genre FROM genres")
def normalize_list_dim(spark, d):
    return roles.genres(spark, d)[0]


@query(f"WITH {GENRES} SELECT id_app, id_genre FROM apps_genres")
def normalize_list_bridge(spark, d):
    return roles.genres(spark, d)[1]


_PHRASES = f"""phrases AS (SELECT doc_id, unnest(l) AS phrase, generate_subscripts(l, 1) AS i
        FROM (SELECT doc_id, {sql_clean_labels('text')} AS l FROM documents)),
    dim AS (SELECT row_number() OVER (ORDER BY min(doc_id * 1000000 + i)) - 1 AS id_phrase, phrase
        FROM phrases WHERE phrase <> 'nan' GROUP BY phrase)"""


def _phrases(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", labels_of(F.col("text")).alias("phrases")
    )


_PHRASE_KEYS = ("doc_id", "phrases", "id_phrase", "phrase", "doc_id", True)


@query(f"""WITH {_PHRASES}
    SELECT id_phrase, phrase FROM dim""")
def normalize_text_dim(spark, d):
    """A dimension that grows with the data: every comma phrase of the whole texts."""
    return normalize_list(_phrases(spark, d), *_PHRASE_KEYS)[1]


@query(f"""WITH {_PHRASES}
    SELECT doc_id, id_phrase FROM phrases JOIN dim USING (phrase)""")
def normalize_text_bridge(spark, d):
    """The bridge reads the lists a second time, so they are stored, not parsed twice."""
    return normalize_list(materialize(_phrases(spark, d), "phrases"), *_PHRASE_KEYS)[2]


_PROPS = """props AS (SELECT event_id, k.key AS prop,
        CAST(json_extract(props, '$.' || k.key) AS BIGINT) AS "count"
    FROM events, unnest(json_keys(props)) AS k(key)),
    dim AS (SELECT row_number() OVER (ORDER BY min(event_id)) - 1 AS id_prop, prop
        FROM props GROUP BY prop)"""


def _props(spark, d):
    events = table(spark, d, "events").select(
        "event_id", parse_weighted(F.col("props")).alias("props")
    )
    events = materialize(events, "props")  # read twice below, so not parsed twice
    return normalize_map(events, "event_id", "props", "id_prop", "prop", "event_id")


@query(f"WITH {_PROPS} SELECT id_prop, prop FROM dim")
def normalize_map_dim(spark, d):
    return _props(spark, d)[1]


@query(f"""WITH {_PROPS} SELECT event_id, id_prop, "count" FROM props JOIN dim USING (prop)""")
def normalize_map_bridge(spark, d):
    return _props(spark, d)[2]


@query("""SELECT p_partkey, words[1] AS first_word, words[2] AS second_word
    FROM (SELECT p_partkey, string_split(p_name, ' ') AS words FROM part)""")
def split_columns(spark, d):
    words = table(spark, d, "part").select("p_partkey", F.split("p_name", " ").alias("words"))
    return spread(words, "words", ["first_word", "second_word"])


# ---- order ---------------------------------------------------------------------------


@query("""SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *,
        row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders)
    WHERE rn = 1""")
def keep_first(spark, d):
    orders = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return ids.keep_first(orders, "o_custkey", ["o_orderkey"])


@query("""SELECT row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS position,
        o_totalprice, o_orderkey FROM orders""")
def dense_ids(spark, d):
    orders = table(spark, d, "orders").select("o_totalprice", "o_orderkey")
    return ids.dense_ids(orders, ["o_totalprice", "o_orderkey"], "position")


_POSITIONS = """positions AS (SELECT o_orderkey,
        row_number() OVER (ORDER BY o_orderkey) - 1 AS position FROM orders)"""


def _batches(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey")
    orders = ids.dense_ids(orders, ["o_orderkey"], "position")
    return ids.with_batch(orders, "position", size=700)


@query(f"""WITH {_POSITIONS}
    SELECT o_orderkey, position, position // 700 AS batch_id FROM positions""")
def batch_ids(spark, d):
    return _batches(spark, d)


@query(f"""WITH {_POSITIONS}, batches AS (
        SELECT position // 700 AS batch_id, count(*) AS num_rows FROM positions GROUP BY 1)
    SELECT batch_id, num_rows,
        CAST(sum(num_rows) OVER (ORDER BY batch_id) AS BIGINT) AS done FROM batches""")
def batch_progress(spark, d):
    return ids.batch_progress(_batches(spark, d), "position")


# ---- cells ---------------------------------------------------------------------------


@query("""SELECT p_partkey AS id_app, p_brand AS name,
        CAST(round((p_retailprice + 510) * 100) AS BIGINT) / CAST(100 AS DOUBLE) AS price_usd
    FROM part WHERE p_brand <> 'Brand#4' AND nullif(p_retailprice, 910) <= 990""")
def required_and_ceiling(spark, d):
    cents = F.round((F.col("p_retailprice") + 510) * 100).cast("bigint").cast("string")
    part = table(spark, d, "part").select(
        F.col("p_partkey").alias("row_seq"),
        F.col("p_partkey").cast("string").alias("appid"),
        F.when(F.col("p_brand") != "Brand#4", F.col("p_brand")).alias("name"),
        F.lit("d").alias("developer"),
        F.lit("p").alias("publisher"),
        F.when(F.col("p_retailprice") != 910.0, cents).alias("price"),
    )
    raw = project(part, ["row_seq", *RAW_DETAIL_COLUMNS])
    return facts_of(raw)[0].select("id_app", "name", "price_usd")


@query("""SELECT doc_id, n_chars / CAST(100 AS DOUBLE) AS dollars,
        round(n_chars / CAST(60 AS DOUBLE), 2) AS hours FROM documents""")
def cents_minutes(spark, d):
    amount = F.col("n_chars")
    return table(spark, d, "documents").select(
        "doc_id", cents_to_units(amount).alias("dollars"), minutes_to_hours(amount).alias("hours")
    )


@query("""SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS low,
        CASE WHEN o_orderstatus <> 'P' THEN CAST(ceil(o_totalprice) AS BIGINT) * 1000 END AS high
    FROM orders""")
def parse_range(spark, d):
    low = F.format_number(F.floor("o_totalprice"), 0)
    high = F.format_number(F.ceil("o_totalprice") * 1000, 0)
    text = F.when(F.col("o_orderstatus") == "P", F.concat(low, F.lit(" .. ?"))).otherwise(
        F.concat(low, F.lit(" .. "), high)
    )
    orders = table(spark, d, "orders").select("o_orderkey", range_of(text).alias("bounds"))
    return spread(orders, "bounds", ["low", "high"])


@query(f"""SELECT doc_id, unnest(list_transform(string_split(text, ','),
        lambda x: trim(x, {SPACES}))) AS part FROM documents""")
def split_trim_list(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", F.explode(split_trim(F.col("text"))).alias("part")
    )


@query(f"""SELECT page_id, unnest({sql_clean_labels('html')}) AS label FROM pages""")
def clean_labels(spark, d):
    return table(spark, d, "pages").select(
        "page_id", F.explode(labels_of(F.col("html"))).alias("label")
    )


_NAMES = ("ring", "Old", "WIDGET", "col")


@query(f"SELECT p_partkey, {sql_canonical('p_name', _NAMES)} AS canonical FROM part")
def canonical_label(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", canonical(F.col("p_name"), _NAMES).alias("canonical")
    )


_TOKENS = {"ECONOMY": "NA", "PROMO": "null", "SMALL": "None", "LARGE": ""}


def _cell(values):
    cell = F.col("p_name")
    for kind, text in values.items():
        cell = F.when(F.col("p_type") == kind, F.lit(text)).otherwise(cell)
    return cell


@query("""SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN NULL WHEN 'PROMO' THEN NULL
        WHEN 'SMALL' THEN 'None' WHEN 'LARGE' THEN NULL ELSE p_name END AS cell FROM part""")
def null_tokens(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", without_tokens(_cell(_TOKENS)).alias("cell")
    )


@query("""SELECT p_partkey AS appid, CASE p_type WHEN 'PROMO' THEN NULL
        WHEN 'LARGE' THEN ' x ' ELSE p_name END AS name
    FROM part WHERE p_type NOT IN ('ECONOMY', 'SMALL')""")
def blank_names(spark, d):
    blanks = {"ECONOMY": "   ", "SMALL": " \t ", "PROMO": None, "LARGE": " x "}
    apps = table(spark, d, "part").select(
        F.col("p_partkey").alias("appid"), _cell(blanks).alias("name")
    )
    return landing.drop_blank_names(apps)


@query("""SELECT p_partkey AS id_app, p_name AS name, CAST(NULL AS VARCHAR) AS publisher,
        p_retailprice / 100 AS price_usd FROM part""")
def project_rename(spark, d):
    part = table(spark, d, "part").withColumnsRenamed(
        {"p_partkey": "id_app", "p_name": "name", "p_retailprice": "price_usd"}
    )
    part = part.withColumns({"price_usd": cents_to_units(F.col("price_usd"))})
    return project(part, ["id_app", "name", "publisher", "price_usd"])


_TYPED_TEXT = "CASE WHEN o_orderstatus = 'P' THEN o_orderkey || '?' ELSE o_orderkey || '' END"


def _typed(spark, d):
    key = F.col("o_orderkey").cast("string")
    text = F.when(F.col("o_orderstatus") == "P", F.concat(key, F.lit("?"))).otherwise(key)
    orders = table(spark, d, "orders").select(
        text.alias("id"),
        F.nullif(F.col("o_custkey"), F.lit(1)).cast("string").alias("owner"),
        F.col("o_orderpriority").alias("name"),
    )
    schema = T.StructType(
        [
            T.StructField("id", T.LongType(), False),
            T.StructField("owner", T.LongType()),
            T.StructField("name", T.StringType()),
        ]
    )
    return conform(orders, schema)


@query(f"""SELECT try_cast({_TYPED_TEXT} AS BIGINT) AS id, nullif(o_custkey, 1) AS owner,
        o_orderpriority AS name
    FROM orders WHERE try_cast({_TYPED_TEXT} AS BIGINT) IS NOT NULL""")
def typed_load(spark, d):
    return _typed(spark, d)[0]


@query(f"""SELECT {_TYPED_TEXT} AS id, CAST(nullif(o_custkey, 1) AS VARCHAR) AS owner,
        o_orderpriority AS name
    FROM orders WHERE try_cast({_TYPED_TEXT} AS BIGINT) IS NULL""")
def typed_load_rejected(spark, d):
    return _typed(spark, d)[1]


@query("""SELECT o_orderkey, o_custkey, CAST(NULL AS DOUBLE) AS o_totalprice FROM orders
        WHERE o_orderstatus = 'P'
    UNION ALL SELECT o_orderkey, NULL, o_totalprice FROM orders WHERE o_orderstatus <> 'P'""")
def append_union(spark, d):
    orders = table(spark, d, "orders")
    pending = F.col("o_orderstatus") == "P"
    return append_all(
        [
            orders.where(pending).select("o_orderkey", "o_custkey"),
            orders.where(~pending).select("o_totalprice", "o_orderkey"),
        ]
    )


@query("""SELECT doc_id, source FROM documents
    WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)""")
def failed_ids(spark, d):
    documents = table(spark, d, "documents").select("doc_id", "source")
    return landing.failed_ids(documents, table(spark, d, "labels"), "doc_id")


# ---- quality -------------------------------------------------------------------------


@query("""SELECT l_partkey, count(*) AS num_rows FROM lineitem
    WHERE l_partkey IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM labels WHERE doc_id = l_partkey) GROUP BY l_partkey""")
def dq_fk_orphans(spark, d):
    return quality.orphans(
        table(spark, d, "lineitem"), "l_partkey", table(spark, d, "labels"), "doc_id"
    )


@query("""SELECT l_orderkey, l_linenumber, count(*) AS num_rows FROM lineitem
    GROUP BY ALL HAVING count(*) > 1""")
def dq_pk_duplicates(spark, d):
    return quality.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""SELECT 'not_null' AS "check", 'part' AS "table", 'p_brand' AS "column",
        count(*) FILTER (WHERE p_brand = 'Brand#4') AS violations FROM part
    UNION ALL SELECT 'not_null', 'part', 'p_name', count(*) - count(p_name) FROM part
    UNION ALL SELECT 'primary_key', 'lineitem', 'l_orderkey,l_linenumber', count(*) FROM
        (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    UNION ALL SELECT 'foreign_key', 'lineitem', 'l_orderkey', count(*) FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
    UNION ALL SELECT 'foreign_key', 'lineitem', 'l_partkey', count(*) FROM lineitem
        WHERE l_partkey NOT IN (SELECT doc_id FROM labels)""")
def dq_report(spark, d):
    part = table(spark, d, "part").withColumn("p_brand", F.nullif("p_brand", F.lit("Brand#4")))
    lines = table(spark, d, "lineitem")
    return append_all(
        [
            quality.check_not_null(part, "part", ["p_brand", "p_name"]),
            quality.check_primary_key(lines, "lineitem", ["l_orderkey", "l_linenumber"]),
            quality.check_foreign_key(
                lines, "lineitem", "l_orderkey", table(spark, d, "orders"), "o_orderkey"
            ),
            quality.check_foreign_key(
                lines, "lineitem", "l_partkey", table(spark, d, "labels"), "doc_id"
            ),
        ]
    )


# ---- raw text to clean tables --------------------------------------------------------


def raw_details(spark, d):
    """Parts written as raw text records: null tokens, outliers, two rows per id, and by size
    a price (11), a count (12), an id (13) and tags (8, 15, 16) that cannot be read."""
    size, brand = F.col("p_size"), F.col("p_brand")
    cents = F.round(F.col("p_retailprice") * 100).cast("bigint")
    words = F.split("p_name", " ")

    def number(column):
        return column.cast("string")

    return table(spark, d, "part").select(
        F.col("p_partkey").alias("row_seq"),
        F.concat(
            number(F.floor(F.col("p_partkey") / 2)),
            F.when(size == 13, F.lit(".5")).when(size == 14, F.lit(".0")).otherwise(F.lit("")),
        ).alias("appid"),
        F.when(F.col("p_name") == "old ring", F.lit("N/A"))
        .otherwise(F.col("p_name"))
        .alias("name"),
        F.nullif(brand, F.lit("Brand#7")).alias("developer"),
        F.col("p_type").alias("publisher"),
        F.when(size == 3, F.lit("?"))
        .otherwise(
            F.concat(
                F.format_number(size * 1000, 0), F.lit(" .. "), F.format_number(size * 2000, 0)
            )
        )
        .alias("owners"),
        number(size * 37).alias("average_forever"),
        number(size).alias("average_2weeks"),
        number(size * 11).alias("median_forever"),
        F.when(size > 20, number(size * 5)).otherwise(F.lit("null")).alias("median_2weeks"),
        F.when(size == 12, F.lit("abc")).otherwise(number(size * 9)).alias("ccu"),
        F.when(size == 11, F.lit("9,99"))
        .when(size == 50, number(cents * 2))
        .otherwise(number(cents))
        .alias("price"),
        number(cents * 2).alias("initialprice"),
        number(size / 4).alias("discount"),
        F.when(size == 7, F.lit("[]"))
        .when(size == 8, F.lit("{'Score 50': 1}"))
        .when(size == 15, F.lit("{'half': 2.5}"))
        .when(size == 16, F.lit("{'more': 1} text"))
        .when(size == 17, F.lit("[ ]"))
        .otherwise(
            F.concat(
                F.lit("{'"), words[0], F.lit("': "), number(size),
                F.lit(", '"), words[1], F.lit("': "), number(size + 1),
                F.lit(", 'Shoot 'Em Up': 4, '"), words[0], F.lit("': 2}"),
            )
        )
        .alias("tags"),
        F.concat(
            F.lit("English*, Spanish - "), F.col("p_type"), F.lit(", #lang_"), brand,
            F.lit(", &lt;strong&gt;"), brand, F.lit("&lt;/strong&gt;\r\nx, Not supported,Hebrew"),
        ).alias("languages"),
        F.concat(words[0], F.lit(" ,"), words[1], F.lit(",")).alias("genre"),
    )


def facts_sql(id_app: str, row_seq: str, unreadable: str) -> str:
    """Facts of the raw records above, given the id and the order of a record."""
    return f"""facts AS (SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id_app ORDER BY row_seq) AS rn FROM (
        SELECT {row_seq} AS row_seq, {id_app} AS id_app, p_name AS name,
            p_brand AS developer, p_type AS publisher,
            CASE WHEN p_size <> 3 THEN CAST(p_size AS BIGINT) * 1000 END AS owners_min,
            CASE WHEN p_size <> 3 THEN CAST(p_size AS BIGINT) * 2000 END AS owners_max,
            round(p_size * 37 / CAST(60 AS DOUBLE), 2) AS average_forever_hs,
            round(p_size / CAST(60 AS DOUBLE), 2) AS average_2weeks_hs,
            round(p_size * 11 / CAST(60 AS DOUBLE), 2) AS median_forever_hs,
            CASE WHEN p_size > 20 THEN round(p_size * 5 / CAST(60 AS DOUBLE), 2) END
                AS median_2weeks_hs,
            CAST(p_size AS BIGINT) * 9 AS peak_ccu_yesterday,
            CAST(round(p_retailprice * 100) AS BIGINT) * (CASE p_size WHEN 50 THEN 2 ELSE 1 END)
                / CAST(100 AS DOUBLE) AS price_usd,
            CAST(round(p_retailprice * 100) AS BIGINT) * 2 / CAST(100 AS DOUBLE)
                AS initial_price_usd,
            p_size / CAST(4 AS DOUBLE) AS discount, p_size
        FROM part WHERE p_name <> 'old ring' AND p_brand <> 'Brand#7'
            AND coalesce(p_size, 0) NOT IN ({unreadable}))
    WHERE price_usd <= 1500) WHERE rn = 1)"""


_FACTS = facts_sql("p_partkey // 2", "p_partkey", "11, 12, 13")
NO_TAGS, BAD_TAGS = "(7, 17)", "(8, 15, 16)"
_APP_COLUMNS = """id_app, name, developer, publisher, owners_min, owners_max,
        average_forever_hs, average_2weeks_hs, median_forever_hs, median_2weeks_hs,
        peak_ccu_yesterday, price_usd, initial_price_usd, discount"""


@query(f"WITH {_FACTS} SELECT row_seq, {_APP_COLUMNS} FROM facts")
def clean_facts(spark, d):
    return facts_of(raw_details(spark, d))[0].drop("tags", "languages", "genre")


@query(f"""WITH {_FACTS}
    SELECT row_seq, CAST(id_app AS VARCHAR) AS appid, name, 'tags' AS reason FROM facts
        WHERE p_size IN {BAD_TAGS}
    UNION ALL SELECT p_partkey,
        (p_partkey // 2) || CASE p_size WHEN 13 THEN '.5' ELSE '' END, p_name,
        CASE p_size WHEN 11 THEN 'price' WHEN 12 THEN 'ccu' ELSE 'appid' END
    FROM part WHERE p_name <> 'old ring' AND p_brand <> 'Brand#7' AND p_size IN (11, 12, 13)""")
def rejected_facts(spark, d):
    """Rows set aside, each with the columns that cannot be read."""
    return star_of(raw_details(spark, d))[1]


@query("""SELECT event_id, (props <> '{"k": 69}') AS bad FROM events""")
def weighted_outcome(spark, d):
    """Broken text is told apart from text without labels."""
    props = F.col("props")
    text = F.when(props == '{"k": 69}', F.lit("[]")).otherwise(F.concat(F.lit("x"), props))
    parsed = parse_weighted(text)
    return table(spark, d, "events").select(
        "event_id", weighted_is_bad(text, parsed).alias("bad")
    )


def _star_part(labels_sql, dim_id, label, name):
    """Links of one list column (repeats kept) and their dimension, in SQL."""
    return f"""{name}_links AS (SELECT row_seq, id_app, unnest(l) AS {label},
            generate_subscripts(l, 1) AS i
        FROM (SELECT row_seq, id_app, {labels_sql} AS l FROM kept)),
    {name} AS (SELECT row_number() OVER (ORDER BY min(row_seq * 1000 + i)) - 1 AS {dim_id}, {label}
        FROM {name}_links GROUP BY {label})"""


_WORD = "string_split(name, ' ')"
_LANGUAGES_SQL = "['English', 'Spanish - ' || publisher, developer || ' x', 'Heew']"
_TAGS_SQL = f"""CASE WHEN p_size NOT IN {NO_TAGS} THEN
    [{_WORD}[1], {_WORD}[2], 'Shoot  Em Up'] ELSE [] END"""


def star_sql(facts: str) -> str:
    """WITH clauses of the seven clean tables made of the given facts."""
    return f"""{facts}, kept AS (SELECT * FROM facts
        WHERE p_size IS NULL OR p_size NOT IN {BAD_TAGS}),
    {_star_part(f"[{_WORD}[1], {_WORD}[2], '']", "id_genre", "genre", "genres")},
    {_star_part(_LANGUAGES_SQL, "id_language", "language", "languages")},
    {_star_part(_TAGS_SQL, "id_tag", "tag", "tags")}"""


#: Rows of all seven clean tables, one under the other.
STAR_ROWS = f"""SELECT 'apps' AS table_name, id_app AS "key", owners_max AS ref, name AS label,
        price_usd AS amount FROM kept
    UNION ALL SELECT 'genres', id_genre, NULL, nullif(genre, ''), NULL FROM genres
    UNION ALL SELECT 'languages', id_language, NULL,
        language || ' > ' || {sql_canonical('language', CANONICAL_LANGUAGES)}, NULL FROM languages
    UNION ALL SELECT 'tags', id_tag, NULL, tag, NULL FROM tags
    UNION ALL SELECT 'apps_genres', id_app, id_genre, NULL, NULL
        FROM genres_links JOIN genres USING (genre)
    UNION ALL SELECT 'apps_languages', id_app, id_language, NULL, NULL
        FROM languages_links JOIN languages USING (language)
    UNION ALL SELECT 'apps_tags', id_app, id_tag, NULL, CAST(CASE WHEN tag = 'Shoot  Em Up' THEN 4
            WHEN i = 1 THEN 2 ELSE p_size + 1 END AS DOUBLE)
        FROM tags_links JOIN tags USING (tag) JOIN kept USING (id_app)"""


def star_rows(tables):
    """The same of tables."""

    def rows(name, key, ref=None, label=None, amount=None):
        none = F.lit(None)
        return tables[name].select(
            F.lit(name).alias("table_name"),
            F.col(key).alias("key"),
            (none if ref is None else F.col(ref)).cast("bigint").alias("ref"),
            (none if label is None else label).cast("string").alias("label"),
            (none if amount is None else F.col(amount)).cast("double").alias("amount"),
        )

    both = F.concat("language", F.lit(" > "), "normalized_language")
    return append_all(
        [
            rows("apps", "id_app", "owners_max", F.col("name"), "price_usd"),
            rows("genres", "id_genre", label=F.col("genre")),
            rows("languages", "id_language", label=both),
            rows("tags", "id_tag", label=F.col("tag")),
            rows("apps_genres", "id_app", "id_genre"),
            rows("apps_languages", "id_app", "id_language"),
            rows("apps_tags", "id_app", "id_tag", amount="count"),
        ]
    )


@query(f"WITH {star_sql(_FACTS)} {STAR_ROWS}")
def build_star(spark, d):
    """Rows of the seven clean tables."""
    return star_rows(star_of(raw_details(spark, d))[0])

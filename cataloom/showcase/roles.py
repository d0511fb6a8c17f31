"""The given tables in the roles of the catalogue tables, in Spark and in SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cataloom.operators.normalize import normalize_list
from cataloom.showcase import table


def apps(spark: SparkSession, d: str) -> DataFrame:
    price, size = F.col("p_retailprice"), F.col("p_size")
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("id_app"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("developer"),
        F.col("p_type").alias("publisher"),
        size.cast("bigint").alias("peak_ccu_yesterday"),
        F.round((size - 5) / 60.0, 2).alias("average_2weeks_hs"),
        (size.cast("bigint") * 1000).alias("owners_max"),
        F.floor((price - 900.0) / 10.0).cast("double").alias("price_usd"),
        F.round(1000.0 - price, 1).alias("discount"),
    )


APPS = """apps AS (
    SELECT p_partkey AS id_app, p_name AS name, p_brand AS developer, p_type AS publisher,
        CAST(p_size AS BIGINT) AS peak_ccu_yesterday,
        round((p_size - 5) / CAST(60 AS DOUBLE), 2) AS average_2weeks_hs,
        CAST(p_size AS BIGINT) * 1000 AS owners_max,
        CAST(floor((p_retailprice - 900) / 10) AS DOUBLE) AS price_usd,
        round(1000 - p_retailprice, 1) AS discount
    FROM part)"""


def languages(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers, whose nation is the normalised name of several of them."""
    nation = table(spark, d, "nation")
    supplier = table(spark, d, "supplier")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("id_language"),
        F.col("s_name").alias("language"),
        F.col("n_name").alias("normalized_language"),
    )


def apps_languages(spark: SparkSession, d: str) -> DataFrame:
    links = table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("id_app"), F.col("l_suppkey").alias("id_language")
    )
    return links.distinct()


LANGUAGES = """languages AS (
    SELECT s_suppkey AS id_language, s_name AS language, n_name AS normalized_language
    FROM supplier JOIN nation ON s_nationkey = n_nationkey),
apps_languages AS (
    SELECT DISTINCT l_partkey AS id_app, l_suppkey AS id_language FROM lineitem)"""


def tags(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("id_tag"), F.col("s_name").alias("tag")
    )


def apps_tags(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem")
    weighed = lines.groupBy("l_partkey", "l_suppkey").agg(
        F.sum("l_quantity").cast("bigint").alias("count")
    )
    return weighed.withColumnsRenamed({"l_partkey": "id_app", "l_suppkey": "id_tag"})


TAGS = """tags AS (SELECT s_suppkey AS id_tag, s_name AS tag FROM supplier),
apps_tags AS (
    SELECT l_partkey AS id_app, l_suppkey AS id_tag,
        CAST(sum(l_quantity) AS BIGINT) AS "count"
    FROM lineitem GROUP BY ALL)"""


def genres(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Words of the part names, normalised: (dimension, bridge)."""
    words = table(spark, d, "part").select(
        F.col("p_partkey").alias("id_app"), F.split("p_name", " ").alias("words")
    )
    _, dim, bridge = normalize_list(words, "id_app", "words", "id_genre", "genre", "id_app")
    return dim, bridge


GENRES = """words AS (
    SELECT p_partkey AS id_app, unnest(string_split(p_name, ' ')) AS genre,
        generate_subscripts(string_split(p_name, ' '), 1) AS i
    FROM part),
genres AS (
    SELECT row_number() OVER (ORDER BY min(id_app * 100 + i)) - 1 AS id_genre, genre
    FROM words GROUP BY genre),
apps_genres AS (SELECT id_app, id_genre FROM words JOIN genres USING (genre))"""

"""Raw details to the seven clean tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cataloom.constants import NULL_TOKENS, PRICE_CEILING
from cataloom.functions import (
    canonical_label,
    cents_to_units,
    clean_labels,
    minutes_to_hours,
    null_tokens,
    parse_range,
    parse_weighted,
    split_trim,
    to_long,
    weighted_is_bad,
)
from cataloom.operators.ids import keep_first
from cataloom.operators.normalize import normalize_list, normalize_map
from cataloom.schemas import CLEAN, RAW_DETAIL_COLUMNS
from cataloom.sources.tables import read_staged, write_tables
from cataloom.storage import materialize

MONEY_COLUMNS = ("price", "initialprice")
TIME_COLUMNS = ("average_forever", "average_2weeks", "median_forever", "median_2weeks")
APP_COLUMNS = tuple(CLEAN["apps"].names)


def spread(df: DataFrame, array_col: str, names: list[str]) -> DataFrame:
    """Array elements as columns in place of the array; null where it is too short."""
    items = {name: F.get(F.col(array_col), F.lit(i)) for i, name in enumerate(names)}
    return df.withColumns(items).drop(array_col)


REJECTED = ("appid", "name", "reason")


def clean_facts(
    raw: DataFrame, order_col: str = "row_seq", tokens=NULL_TOKENS
) -> tuple[DataFrame, DataFrame]:
    """(typed facts, one per id, with the list columns still as text; rejected rows).

    The steps keep their order: required fields, readable cells, price ceiling, then first row
    per id, so a later copy can win when an earlier one was filtered out. A row with an id that
    is no whole number, or with a price, measure or count that is text but no number, is
    rejected; ``reason`` lists those columns. A missing price drops the row, as the ceiling does.
    """
    cells = {c: null_tokens(F.col(c).cast("string"), tokens) for c in RAW_DETAIL_COLUMNS}
    df = raw.select(order_col, *[c.alias(n) for n, c in cells.items()])
    df = df.dropna(subset=["name", "developer", "publisher"])
    numbers = {c: F.col(c).try_cast("double") for c in (*MONEY_COLUMNS, *TIME_COLUMNS, "discount")}
    numbers |= {"appid": to_long(F.col("appid")), "ccu": to_long(F.col("ccu"))}
    faults = [
        F.when((F.col(c).isNotNull() | F.lit(c == "appid")) & number.isNull(), F.lit(c))
        for c, number in sorted(numbers.items())
    ]
    df = df.withColumn("reason", F.concat_ws(",", *faults))
    rejected = df.where(F.col("reason") != "").select(order_col, *REJECTED)
    df = df.where(F.col("reason") == "").drop("reason")
    df = df.withColumns(
        {
            **numbers,
            **{c: cents_to_units(numbers[c]) for c in MONEY_COLUMNS},
            **{c: minutes_to_hours(numbers[c]) for c in TIME_COLUMNS},
            "owners": parse_range(F.col("owners")),
        }
    )
    df = df.withColumnsRenamed(
        {
            "appid": "id_app",
            "price": "price_usd",
            "initialprice": "initial_price_usd",
            "ccu": "peak_ccu_yesterday",
            **{c: f"{c}_hs" for c in TIME_COLUMNS},
        }
    )
    df = keep_first(df.where(F.col("price_usd") <= PRICE_CEILING), "id_app", [order_col])
    return spread(df, "owners", ["owners_min", "owners_max"]), rejected


def parse_lists(facts: DataFrame) -> DataFrame:
    """Text list columns as arrays and a map; ``_bad`` marks tags that cannot be parsed."""
    parsed = facts.withColumnsRenamed({"tags": "tags_text"}).withColumns(
        {
            "genre": split_trim(F.col("genre")),
            "languages": clean_labels(F.col("languages")),
            "tags": parse_weighted(F.col("tags_text")),
        }
    )
    return parsed.withColumn("_bad", weighted_is_bad(F.col("tags_text"), F.col("tags")))


def build_star(
    raw: DataFrame,
    out: str | None = None,
    order_col: str = "row_seq",
    fmt: str = "parquet",
    tokens=NULL_TOKENS,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """The seven clean tables, and the rejected rows with the reason for each: cells that are
    no numbers, or ``tags`` that cannot be parsed.

    Raw text is cleaned and parsed once and written; each dimension and bridge then
    reads only its own column of that table. With ``out`` the tables are written below it,
    one directory each, and Parquet ones are returned as read from there.
    """
    spark = raw.sparkSession
    typed, unreadable = clean_facts(raw, order_col, tokens)
    parsed = materialize(parse_lists(typed), "parsed")
    facts = parsed.where(~F.col("_bad"))
    broken = parsed.where("_bad").select(
        order_col, F.col("id_app").cast("string").alias("appid"), "name", F.lit("tags").alias("reason")
    )
    rejected = materialize(unreadable.unionByName(broken), "rejected_facts")

    facts, genres, apps_genres = normalize_list(
        facts, "id_app", "genre", "id_genre", "genre", order_col, stripped=True
    )
    facts, languages, apps_languages = normalize_list(
        facts, "id_app", "languages", "id_language", "language", order_col, stripped=True
    )
    facts, tags, apps_tags = normalize_map(facts, "id_app", "tags", "id_tag", "tag", order_col)
    languages = languages.withColumn("normalized_language", canonical_label(F.col("language")))

    def named(dim: DataFrame, *labels: str) -> DataFrame:
        # A label that is a null token, such as an empty one, keeps its id but has no name.
        return dim.withColumns({c: null_tokens(F.col(c), tokens) for c in labels})

    tables = {
        "apps": facts.select(*APP_COLUMNS),
        "genres": named(genres, "genre"),
        "languages": named(languages, "language", "normalized_language"),
        "tags": named(tags, "tag"),
        "apps_genres": apps_genres,
        "apps_languages": apps_languages,
        "apps_tags": apps_tags,
    }
    if out:
        write_tables(tables, out, fmt)
        if fmt == "parquet":
            tables = {name: read_staged(spark, out, name) for name in tables}
    return tables, rejected

"""Schemas of landed, raw and clean data."""

from pyspark.sql import types as T


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


RAW_LIST_COLUMNS = ("appid", "name")

RAW_DETAIL_COLUMNS = (
    "appid", "name", "developer", "publisher", "owners",
    "average_forever", "average_2weeks", "median_forever", "median_2weeks",
    "ccu", "price", "initialprice", "discount", "tags", "languages", "genre",
)

RAW_LIST = _text(*RAW_LIST_COLUMNS)
RAW_DETAILS = _text(*RAW_DETAIL_COLUMNS)

CORRUPT = "_corrupt"
LANDED_LIST = T.StructType(
    [
        T.StructField(
            "applist",
            T.StructType(
                [
                    T.StructField(
                        "apps",
                        T.ArrayType(
                            T.StructType(
                                [
                                    T.StructField("appid", T.LongType()),
                                    T.StructField("name", T.StringType()),
                                ]
                            )
                        ),
                    )
                ]
            ),
        )
    ]
)
# Scalars stay text: sources write some numbers quoted and some bare.
LANDED_DETAILS = _text(*RAW_DETAIL_COLUMNS, CORRUPT)


def _table(*columns: tuple) -> T.StructType:
    types = {"long": T.LongType(), "double": T.DoubleType(), "string": T.StringType()}
    return T.StructType(
        [
            T.StructField(name, types[kind.rstrip("!")], not kind.endswith("!"))
            for name, kind in columns
        ]
    )


# "!" marks a column that must not be null.
CLEAN = {
    "apps": _table(
        ("id_app", "long!"), ("name", "string!"), ("developer", "string!"),
        ("publisher", "string!"), ("owners_min", "long"), ("owners_max", "long"),
        ("average_forever_hs", "double"), ("average_2weeks_hs", "double"),
        ("median_forever_hs", "double"), ("median_2weeks_hs", "double"),
        ("peak_ccu_yesterday", "long"), ("price_usd", "double"),
        ("initial_price_usd", "double"), ("discount", "double"),
    ),
    "genres": _table(("id_genre", "long!"), ("genre", "string")),
    "languages": _table(
        ("id_language", "long!"), ("language", "string"), ("normalized_language", "string")
    ),
    "tags": _table(("id_tag", "long!"), ("tag", "string")),
    "apps_genres": _table(("id_app", "long"), ("id_genre", "long")),
    "apps_languages": _table(("id_app", "long"), ("id_language", "long")),
    "apps_tags": _table(("id_app", "long"), ("id_tag", "long"), ("count", "long")),
}

PRIMARY_KEYS = {
    "apps": "id_app", "genres": "id_genre", "languages": "id_language", "tags": "id_tag",
}

# (table, column, parent table, parent column)
FOREIGN_KEYS = (
    ("apps_genres", "id_app", "apps", "id_app"),
    ("apps_genres", "id_genre", "genres", "id_genre"),
    ("apps_languages", "id_app", "apps", "id_app"),
    ("apps_languages", "id_language", "languages", "id_language"),
    ("apps_tags", "id_app", "apps", "id_app"),
    ("apps_tags", "id_tag", "tags", "id_tag"),
)


def load_order(names) -> list:
    """Parents before the tables that point at them."""
    children = {table for table, *_ in FOREIGN_KEYS}
    return sorted(names, key=lambda n: (n in children, n))


def writable(schema: T.StructType) -> T.StructType:
    """The same columns, all nullable, as files report them when read back."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])

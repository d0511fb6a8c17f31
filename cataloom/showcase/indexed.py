"""Searches, rankings and related labels answered from stored indexes."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cataloom.operators.bitmaps import label_bitmaps, merged, search_indexed, stored
from cataloom.operators.cooccurrence import label_pairs, related_from_pairs
from cataloom.operators.cooccurrence import merged as merged_pairs
from cataloom.operators.label_lists import canonical_labels
from cataloom.operators.price_cells import price_index, rank_in_range
from cataloom.operators.profiles import stored_profile, update_profiles
from cataloom.operators.ranking import CRITERIA
from cataloom.showcase import ORACLES, query, roles, table
from cataloom.showcase.analytics import (
    _BY_GENRE,
    _BY_LANGUAGE,
    GENRE_KEYS,
    LANGUAGE_KEYS,
    _average,
    _rank_sql,
    _search_sql,
)
from cataloom.showcase.roles import APPS, GENRES, LANGUAGES, TAGS
from cataloom.storage import scratch_path


def _bitmaps(spark, d) -> DataFrame:
    """Made of the facts in two batches."""
    dim, bridge = roles.genres(spark, d)
    facets = {
        "language": (roles.apps_languages(spark, d), roles.languages(spark, d), "id_language", "normalized_language"),
        "genre": (bridge, dim, "id_genre", "genre"),
        "tag": (roles.apps_tags(spark, d), roles.tags(spark, d), "id_tag", "tag"),
    }

    def of(condition):
        some = {f: (links.where(condition), *rest) for f, (links, *rest) in facets.items()}
        return label_bitmaps(some, "id_app")

    return stored(merged(of("id_app % 3 = 0"), of("id_app % 3 <> 0")))


@query(ORACLES["search_all_of"])
def search_bitmap_all_of(spark, d):
    return search_indexed(
        roles.apps(spark, d), _bitmaps(spark, d), {"language": ["NATION_16", "NATION_20"]},
        fact_id="id_app", order_by="peak_ccu_yesterday",
    )


_ALL_THREE = """WHERE id_app IN (SELECT id_app FROM apps_genres JOIN genres USING (id_genre)
        WHERE genre = 'widget')
    AND id_app IN (SELECT id_app FROM apps_languages JOIN languages USING (id_language)
        WHERE normalized_language IN ('NATION_16', 'NATION_20')
        GROUP BY id_app HAVING count(DISTINCT normalized_language) = 2)
    AND id_app IN (SELECT id_app FROM apps_tags JOIN tags USING (id_tag)
        WHERE tag = 'Supplier#000000002')"""


@query(f"WITH {APPS}, {GENRES}, {LANGUAGES}, {TAGS} " + _search_sql(_ALL_THREE, "price_usd"))
def search_bitmap_three_facets(spark, d):
    chosen = {
        "genre": ["widget"], "language": ["NATION_16", "NATION_20"], "tag": ["Supplier#000000002"]
    }
    return search_indexed(
        roles.apps(spark, d), _bitmaps(spark, d), chosen, fact_id="id_app", order_by="price_usd"
    )


_RANGES = ((0, 1500), (0, 8), (3, 3), (2, 5), (5, 90), (-4, 2), (0.5, 7.5), (6, 6.5), (9, 1), (88, 10**6))


def _ranges_sql(tables: str, frm: str, label: str, criterion: str) -> str:
    rule = CRITERIA[criterion]
    extra = f" AND {rule.column} > 0" if rule.positive_only else ""
    measure = _average(rule.column) if rule.column else "count(id_app)"
    parts = [
        f"""SELECT CAST({low} AS DOUBLE) AS low, CAST({high} AS DOUBLE) AS high, * FROM (
        {_rank_sql(f"{APPS}, {tables}", frm, label, measure, rule.alias, extra, low=low, high=high)})"""
        for low, high in _RANGES
    ]
    return " UNION ALL ".join(parts)


def _ranges(index, criterion: str) -> DataFrame:
    parts = [
        rank_in_range(index, criterion, (low, high)).select(
            F.lit(float(low)).alias("low"), F.lit(float(high)).alias("high"), "*"
        )
        for low, high in _RANGES
    ]
    return reduce(DataFrame.unionByName, parts)


@query(_ranges_sql(LANGUAGES, _BY_LANGUAGE, "normalized_language", "average_2weeks_hs"))
def rank_cells_languages(spark, d):
    """Ten price ranges from one index."""
    index = price_index(
        roles.apps(spark, d), roles.apps_languages(spark, d), roles.languages(spark, d),
        **LANGUAGE_KEYS, width=2.0, cells=20,
    )
    return _ranges(index, "average_2weeks_hs")


@query(_ranges_sql(GENRES, _BY_GENRE, "genre", "apps_count"))
def rank_cells_genres(spark, d):
    dim, bridge = roles.genres(spark, d)
    index = price_index(roles.apps(spark, d), bridge, dim, **GENRE_KEYS, width=2.0, cells=20)
    return _ranges(index, "apps_count")


@query(ORACLES["related_labels_of_tag"])
def related_pairs_of_tag(spark, d):
    """From pairs of two batches of facts."""
    dim, bridge = roles.genres(spark, d)

    def of(condition):
        return label_pairs(
            roles.apps_tags(spark, d).where(condition), roles.tags(spark, d),
            dim_id_a="id_tag", label_a="tag",
            bridge_b=bridge.where(condition), dim_b=dim, dim_id_b="id_genre", label_b="genre",
            fact_id="id_app", heavy=50,
        )

    pairs = merged_pairs(of("id_app % 2 = 0"), of("id_app % 2 = 1"))
    return related_from_pairs(pairs, "Supplier#000000001", "genre")


@query(ORACLES["related_labels_of_language"])
def related_pairs_of_language(spark, d):
    dim, bridge = roles.genres(spark, d)
    pairs = label_pairs(
        roles.apps_languages(spark, d), roles.languages(spark, d),
        dim_id_a="id_language", label_a="normalized_language",
        bridge_b=bridge, dim_b=dim, dim_id_b="id_genre", label_b="genre", fact_id="id_app",
    )
    return related_from_pairs(pairs, "NATION_16", "genre")


@query("""WITH names AS (SELECT upper(substr(p_name, 2, 4)) AS name, min(p_partkey) AS position
        FROM part WHERE p_partkey % 3 = 0 GROUP BY 1)
    SELECT p_partkey, coalesce(arg_min(name, position), any_value(p_name)) AS found
    FROM part LEFT JOIN names ON contains(lower(p_name), lower(name)) GROUP BY p_partkey""")
def canonical_label_list(spark, d):
    """Names that are a table, looked up in all part names."""
    part = table(spark, d, "part").select("p_partkey", "p_name")
    name = F.upper(F.substring("p_name", 2, 4)).alias("name")
    names = part.where("p_partkey % 3 = 0").groupBy(name).agg(F.min("p_partkey").alias("position"))
    return canonical_labels(part, "p_name", names, "found").select("p_partkey", "found")


_PROFILED = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")


@query(" UNION ALL ".join(f"""SELECT '{c}' AS "column",
        CASE WHEN count(DISTINCT {c}) < 10 THEN 'categorical' ELSE '{kind}' END AS kind,
        count(*) - count({c}) AS num_nulls, CAST(min({c}) AS VARCHAR) AS "min",
        CAST(max({c}) AS VARCHAR) AS "max", true AS near FROM orders"""
    for c, kind in zip(_PROFILED, ("numeric", "numeric", "text", "text"), strict=True)))
def profile_stored(spark, d):
    """A profile kept by files and brought up to date after each of two drops; ``near``: counts
    are exact or within the stated five in a hundred."""
    orders = table(spark, d, "orders").select(*_PROFILED)
    path, root = scratch_path(spark, "orders"), scratch_path(spark, "profiles")
    for part in (orders.where("o_orderkey % 3 = 0"), orders.where("o_orderkey % 3 <> 0")):
        part.write.mode("append").parquet(path)
        update_profiles(spark, path, root)
    exact = orders.agg(*[F.countDistinct(c).alias(c) for c in _PROFILED]).first()
    known = F.lit(None)
    for c in _PROFILED:
        known = F.when(F.col("column") == c, F.lit(exact[c])).otherwise(known)
    apart = F.abs(F.col("n_distinct") - known)
    near = F.when(F.col("exact"), apart == 0).otherwise(apart <= known * 0.05)
    return stored_profile(spark, root).select(
        "column", "kind", "num_nulls", "min", "max", near.alias("near")
    )

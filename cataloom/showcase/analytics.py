"""Rankings, related labels, splits, search, exploration."""

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cataloom.operators import explore
from cataloom.operators.ranking import (
    CRITERIA,
    free_paid_split,
    rank_by_dimension,
    related_labels,
    resorted,
    with_shares,
)
from cataloom.operators.search import Facet, search
from cataloom.showcase import query, roles, table
from cataloom.showcase.roles import APPS, GENRES, LANGUAGES, TAGS

LANGUAGE_KEYS = {"fact_id": "id_app", "dim_id": "id_language", "label": "normalized_language"}
GENRE_KEYS = {"fact_id": "id_app", "dim_id": "id_genre", "label": "genre"}
TAG_KEYS = {"fact_id": "id_app", "dim_id": "id_tag", "label": "tag"}


def _rounded(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.round(column, 6))


def _rank_languages(spark, d, criterion, **options) -> DataFrame:
    return rank_by_dimension(
        roles.apps(spark, d), roles.apps_languages(spark, d), roles.languages(spark, d),
        **LANGUAGE_KEYS, criterion=criterion, **options,
    )


def _average(column: str) -> str:
    """Exact whatever the order of rows, rounded as the operator rounds."""
    total = f"CAST(sum(CAST({column} AS DECIMAL(25, 6))) AS DOUBLE)"
    return f"round({total} / count({column}), 6)"


def _rank_sql(
    roles_sql, frm, label, measure, alias, extra="", n=10, low=0, high=1500
):
    return f"""WITH {roles_sql}, ranked AS (
        SELECT {label}, {measure} AS {alias} FROM {frm}
        WHERE price_usd BETWEEN {low} AND {high}{extra} GROUP BY {label}
        ORDER BY {alias} DESC NULLS FIRST, {label} ASC NULLS LAST LIMIT {n})
    SELECT {label}, {alias} FROM ranked"""


_BY_LANGUAGE = "apps JOIN apps_languages USING (id_app) JOIN languages USING (id_language)"
_BY_GENRE = "apps JOIN apps_genres USING (id_app) JOIN genres USING (id_genre)"
_BY_TAG = "apps JOIN apps_tags USING (id_app) JOIN tags USING (id_tag)"


def _rank_genres(spark, d, criterion, **options) -> DataFrame:
    dim, bridge = roles.genres(spark, d)
    return rank_by_dimension(
        roles.apps(spark, d), bridge, dim, **GENRE_KEYS, criterion=criterion, **options
    )


def _rank_tags(spark, d, criterion, **options) -> DataFrame:
    return rank_by_dimension(
        roles.apps(spark, d), roles.apps_tags(spark, d), roles.tags(spark, d),
        **TAG_KEYS, criterion=criterion, **options,
    )


@query(_rank_sql(f"{APPS}, {LANGUAGES}", _BY_LANGUAGE, "normalized_language",
                 "count(id_app)", "apps_count"))
def rank_count(spark, d):
    return _rank_languages(spark, d, "apps_count")


def _register_rankings() -> None:
    """Every dimension by every criterion, in a price range that leaves some facts out."""
    dimensions = {
        "languages": (_rank_languages, LANGUAGES, _BY_LANGUAGE, "normalized_language"),
        "genres": (_rank_genres, GENRES, _BY_GENRE, "genre"),
        "tags": (_rank_tags, TAGS, _BY_TAG, "tag"),
    }
    for dimension, (rank, tables, frm, label) in dimensions.items():
        for criterion, rule in CRITERIA.items():
            extra = f" AND {rule.column} > 0" if rule.positive_only else ""
            measure = _average(rule.column) if rule.column else "count(id_app)"
            sql = _rank_sql(
                f"{APPS}, {tables}", frm, label, measure, rule.alias, extra,
                n=20, low=0, high=8,
            )

            def run(spark, d, rank=rank, criterion=criterion):
                return rank(spark, d, criterion, n=20, price_range=(0, 8))

            query(sql, f"rank_{dimension}_{rule.alias}")(run)


_register_rankings()


@query(_rank_sql(f"{APPS}, {LANGUAGES}", _BY_LANGUAGE, "normalized_language",
                 "count(DISTINCT id_app)", "apps_count"))
def rank_distinct_facts(spark, d):
    return _rank_languages(spark, d, "apps_count", distinct_facts=True)


@query(_rank_sql(f"{APPS}, {LANGUAGES}", _BY_LANGUAGE, "normalized_language",
                 _average("owners_max"), "avg_owners_max"))
def rank_resorted(spark, d):
    return resorted(_rank_languages(spark, d, "owners_max"))


@query(f"""WITH {GENRES}, {TAGS}
    SELECT genre, count(*) AS num_apps FROM genres JOIN apps_genres USING (id_genre)
    WHERE id_app IN (SELECT id_app FROM apps_tags JOIN tags USING (id_tag)
        WHERE tag = 'Supplier#000000001')
    GROUP BY genre ORDER BY num_apps DESC, genre LIMIT 10""")
def related_labels_of_tag(spark, d):
    dim, bridge = roles.genres(spark, d)
    return related_labels(
        roles.apps_tags(spark, d), roles.tags(spark, d),
        dim_id_a="id_tag", label_a="tag", value="Supplier#000000001",
        bridge_b=bridge, dim_b=dim, dim_id_b="id_genre", label_b="genre", fact_id="id_app",
    )


@query(f"""WITH {GENRES}, {TAGS}
    SELECT tag, count(*) AS num_apps FROM tags JOIN apps_tags USING (id_tag)
    WHERE id_app IN (SELECT id_app FROM apps_genres JOIN genres USING (id_genre)
        WHERE genre = 'widget')
    GROUP BY tag ORDER BY num_apps DESC, tag LIMIT 10""")
def related_labels_of_genre(spark, d):
    dim, bridge = roles.genres(spark, d)
    return related_labels(
        bridge, dim, dim_id_a="id_genre", label_a="genre", value="widget",
        bridge_b=roles.apps_tags(spark, d), dim_b=roles.tags(spark, d),
        dim_id_b="id_tag", label_b="tag", fact_id="id_app",
    )


@query(f"""WITH {GENRES}, {LANGUAGES}
    SELECT genre, count(*) AS num_apps FROM genres JOIN apps_genres USING (id_genre)
    WHERE id_app IN (SELECT id_app FROM apps_languages JOIN languages USING (id_language)
        WHERE normalized_language = 'NATION_16')
    GROUP BY genre ORDER BY num_apps DESC, genre LIMIT 10""")
def related_labels_of_language(spark, d):
    dim, bridge = roles.genres(spark, d)
    return related_labels(
        roles.apps_languages(spark, d), roles.languages(spark, d), dim_id_a="id_language",
        label_a="normalized_language", value="NATION_16",
        bridge_b=bridge, dim_b=dim, dim_id_b="id_genre", label_b="genre", fact_id="id_app",
    )


_SPLIT_SQL = """SELECT {label},
        CAST(sum(CASE WHEN price_usd = 0 THEN 1 ELSE 0 END) AS BIGINT) AS free_apps,
        CAST(sum(CASE WHEN price_usd > 0 THEN 1 ELSE 0 END) AS BIGINT) AS paid_apps
    FROM {frm} WHERE {label} = '{value}' GROUP BY {label}"""
_SPLIT_LANGUAGE = _SPLIT_SQL.format(
    label="normalized_language", frm=_BY_LANGUAGE, value="NATION_16"
)


def _split_language(spark, d, **options):
    return free_paid_split(
        roles.apps(spark, d), roles.apps_languages(spark, d), roles.languages(spark, d),
        **LANGUAGE_KEYS, value="NATION_16", **options,
    )


@query(f"WITH {APPS}, {LANGUAGES} {_SPLIT_LANGUAGE}", name="free_paid_split")
def free_paid_split_language(spark, d):
    return _split_language(spark, d)


@query(f"""WITH {APPS}, {LANGUAGES}
    SELECT normalized_language,
        count(DISTINCT CASE WHEN price_usd = 0 THEN id_app END) AS free_apps,
        count(DISTINCT CASE WHEN price_usd > 0 THEN id_app END) AS paid_apps
    FROM {_BY_LANGUAGE} WHERE normalized_language = 'NATION_16'
    GROUP BY normalized_language""")
def free_paid_split_distinct_facts(spark, d):
    return _split_language(spark, d, distinct_facts=True)


@query("WITH " + f"{APPS}, {GENRES} "
       + _SPLIT_SQL.format(label="genre", frm=_BY_GENRE, value="widget"))
def free_paid_split_genre(spark, d):
    dim, bridge = roles.genres(spark, d)
    return free_paid_split(roles.apps(spark, d), bridge, dim, **GENRE_KEYS, value="widget")


@query("WITH " + f"{APPS}, {TAGS} "
       + _SPLIT_SQL.format(label="tag", frm=_BY_TAG, value="Supplier#000000001"))
def free_paid_split_tag(spark, d):
    return free_paid_split(
        roles.apps(spark, d), roles.apps_tags(spark, d), roles.tags(spark, d),
        **TAG_KEYS, value="Supplier#000000001",
    )


@query(f"""WITH {APPS}, {LANGUAGES}, split AS ({_SPLIT_LANGUAGE})
    SELECT 'Free' AS kind, free_apps AS num_apps,
        round(free_apps / (free_apps + paid_apps), 6) AS share FROM split
    UNION ALL
    SELECT 'Paid', paid_apps, round(paid_apps / (free_apps + paid_apps), 6) FROM split""")
def free_paid_share(spark, d):
    return _rounded(with_shares(_split_language(spark, d)), "share")


_SHOWN = """name, developer, publisher, peak_ccu_yesterday, average_2weeks_hs, owners_max,
        price_usd, discount"""


def _search_sql(where="", order_by="peak_ccu_yesterday", n=2500):
    ties = [c.strip() for c in _SHOWN.split(",") if c.strip() != order_by]
    return f"""SELECT DISTINCT {_SHOWN} FROM apps {where}
    ORDER BY {order_by} DESC NULLS FIRST, {', '.join(f'{c} ASC NULLS LAST' for c in ties)}
    LIMIT {n}"""


def _language_facet(spark, d, values, match_key):
    return Facet(
        roles.apps_languages(spark, d), roles.languages(spark, d),
        "id_language", "normalized_language", values, match_key,
    )


@query(f"WITH {APPS} " + _search_sql(order_by="discount"))
def search_no_facet(spark, d):
    return search(roles.apps(spark, d), fact_id="id_app", order_by="discount")


_ALL_LANGUAGES = """WHERE id_app IN (SELECT id_app
    FROM apps_languages JOIN languages USING (id_language)
    WHERE normalized_language IN ('NATION_16', 'NATION_20')
    GROUP BY id_app HAVING count(DISTINCT {key}) = 2)"""


@query(f"WITH {APPS}, {LANGUAGES} "
       + _search_sql(_ALL_LANGUAGES.format(key="normalized_language")))
def search_all_of(spark, d):
    facet = _language_facet(spark, d, ["NATION_16", "NATION_20"], "label")
    return search(
        roles.apps(spark, d), [facet], fact_id="id_app", order_by="peak_ccu_yesterday"
    )


@query(f"WITH {APPS}, {LANGUAGES} " + _search_sql(_ALL_LANGUAGES.format(key="id_language")))
def search_match_id(spark, d):
    facet = _language_facet(spark, d, ["NATION_16", "NATION_20"], "id")
    return search(
        roles.apps(spark, d), [facet], fact_id="id_app", order_by="peak_ccu_yesterday"
    )


_GENRE_AND_LANGUAGE = """WHERE id_app IN (SELECT id_app
        FROM apps_genres JOIN genres USING (id_genre) WHERE genre IN ('new', 'widget')
        GROUP BY id_app HAVING count(DISTINCT genre) = 2)
    AND id_app IN (SELECT id_app FROM apps_languages JOIN languages USING (id_language)
        WHERE normalized_language IN ('NATION_16')
        GROUP BY id_app HAVING count(DISTINCT id_language) = 1)"""


@query(f"WITH {APPS}, {GENRES}, {LANGUAGES} "
       + _search_sql(_GENRE_AND_LANGUAGE, "owners_max", 100))
def search_two_facets(spark, d):
    dim, bridge = roles.genres(spark, d)
    facets = [
        Facet(bridge, dim, "id_genre", "genre", ["new", "widget"]),
        _language_facet(spark, d, ["NATION_16"], "id"),
    ]
    return search(
        roles.apps(spark, d), facets, fact_id="id_app", order_by="owners_max", n=100
    )


_GENRE_LANGUAGE_TAG = """WHERE id_app IN (SELECT id_app
        FROM apps_genres JOIN genres USING (id_genre) WHERE genre IN ('widget')
        GROUP BY id_app HAVING count(DISTINCT genre) = 1)
    AND id_app IN (SELECT id_app FROM apps_languages JOIN languages USING (id_language)
        WHERE normalized_language IN ('NATION_16', 'NATION_20')
        GROUP BY id_app HAVING count(DISTINCT id_language) = 2)
    AND id_app IN (SELECT id_app FROM apps_tags JOIN tags USING (id_tag)
        WHERE tag IN ('Supplier#000000002')
        GROUP BY id_app HAVING count(DISTINCT tag) = 1)"""


@query(f"WITH {APPS}, {GENRES}, {LANGUAGES}, {TAGS} "
       + _search_sql(_GENRE_LANGUAGE_TAG, "price_usd"))
def search_three_facets(spark, d):
    dim, bridge = roles.genres(spark, d)
    facets = [
        Facet(bridge, dim, "id_genre", "genre", ["widget"]),
        _language_facet(spark, d, ["NATION_16", "NATION_20"], "id"),
        Facet(
            roles.apps_tags(spark, d), roles.tags(spark, d),
            "id_tag", "tag", ["Supplier#000000002"],
        ),
    ]
    return search(roles.apps(spark, d), facets, fact_id="id_app", order_by="price_usd")


@query(f"""WITH {APPS}, {LANGUAGES}, found AS (
    {_search_sql(_ALL_LANGUAGES.format(key="normalized_language"), "owners_max", 1000)})
    SELECT * FROM found WHERE price_usd BETWEEN 2 AND 6
        AND publisher IN ('ECONOMY', 'PROMO') AND regexp_matches(name, 'old|w[a-i]dget$')""")
def search_post_filter(spark, d):
    """Ad-hoc filters act on the rows left by the limit, not before it."""
    facet = _language_facet(spark, d, ["NATION_16", "NATION_20"], "label")
    found = search(
        roles.apps(spark, d), [facet], fact_id="id_app", order_by="owners_max", n=1000
    )
    return explore.apply_filters(
        found,
        [
            explore.Between("price_usd", 2, 6),
            explore.In("publisher", ["ECONOMY", "PROMO"]),
            explore.Matches("name", "old|w[a-i]dget$"),
        ],
    )


@query(f"""WITH {LANGUAGES}
    SELECT DISTINCT normalized_language FROM languages ORDER BY 1 ASC NULLS LAST""")
def facet_values(spark, d):
    return explore.facet_values(roles.languages(spark, d), "normalized_language")


def _profile_sql():
    kinds = {"event_id": "numeric", "ts": "datetime", "user_id": "numeric",
             "event_type": "text", "value": "numeric", "props": "text"}
    parts = []
    for name, kind in kinds.items():
        text = f"strftime({{}}({name}), '%Y-%m-%d %H:%M:%S.%f')" if kind == "datetime" else \
            f"CAST({{}}({name}) AS VARCHAR)"
        step = f"CAST(max({name}) - min({name}) AS DOUBLE) / 100" if kind == "numeric" else \
            "CAST(NULL AS DOUBLE)"
        parts.append(
            f"""SELECT '{name}' AS "column", CASE WHEN count(DISTINCT {name}) < 10
                THEN 'categorical' ELSE '{kind}' END AS kind,
            count(DISTINCT {name}) AS n_distinct, {text.format('min')} AS "min",
            {text.format('max')} AS "max", round({step}, 6) AS step FROM events"""
        )
    return " UNION ALL ".join(parts)


@query(_profile_sql())
def profile_columns(spark, d):
    return _rounded(explore.profile(table(spark, d, "events")), "step")


@query(f"""SELECT "column", kind, "min", "max" FROM ({_profile_sql()})""")
def profile_kinds(spark, d):
    """Estimated counts, exact where the kind depends on them."""
    found = explore.profile(table(spark, d, "events"), exact="kind")
    return found.select("column", "kind", "min", "max")


@query("""SELECT DISTINCT nullif(event_type, 'error') AS event_type FROM events""")
def category_values(spark, d):
    events = table(spark, d, "events")
    return explore.categories(
        events.select(F.nullif("event_type", F.lit("error")).alias("event_type")), "event_type"
    )


@query("""SELECT event_id, nullif(event_type, 'error') AS event_type FROM events
    WHERE event_type IN ('click', 'error')""")
def filter_in(spark, d):
    events = table(spark, d, "events").select(
        "event_id", F.nullif("event_type", F.lit("error")).alias("event_type")
    )
    return explore.apply_filters(events, [explore.In("event_type", ["click", None])])


@query("SELECT event_id, value FROM events WHERE value BETWEEN 1.63 AND 12.31")
def filter_between(spark, d):
    events = table(spark, d, "events").select("event_id", "value")
    return explore.apply_filters(events, [explore.Between("value", 1.63, 12.31)])


@query("""SELECT event_id, ts FROM events
    WHERE ts BETWEEN TIMESTAMP '2024-01-03 00:00:00' AND TIMESTAMP '2024-01-10 12:00:00'""")
def filter_time(spark, d):
    events = explore.cast_datetimes(table(spark, d, "events").select("event_id", "ts"))
    first, last = "2024-01-03 00:00:00", "2024-01-10 12:00:00"
    bounds = (F.lit(t).cast("timestamp_ntz") for t in (first, last))
    return explore.apply_filters(events, [explore.Between("ts", *bounds)])


@query("""SELECT p_partkey, p_name FROM part
    WHERE p_name <> 'old ring' AND regexp_matches(p_name, '(old|new) [rb]')""")
def filter_regex(spark, d):
    part = table(spark, d, "part").select(
        "p_partkey", F.nullif("p_name", F.lit("old ring")).alias("p_name")
    )
    return explore.apply_filters(part, [explore.Matches("p_name", "(old|new) [rb]")])


@query("""SELECT o_orderkey, o_orderdate AS all_dates,
        CASE WHEN o_orderstatus = 'P' THEN o_orderpriority
            ELSE strftime(o_orderdate, '%Y-%m-%d') END AS some_dates
    FROM orders""")
def datetime_cast(spark, d):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    orders = table(spark, d, "orders").select(
        "o_orderkey",
        day.alias("all_dates"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority"))
        .otherwise(day)
        .alias("some_dates"),
    )
    return explore.cast_datetimes(orders)


@query("""SELECT event_id, strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS seen,
        CAST(10000 + user_id AS VARCHAR) AS code, event_type FROM events
    WHERE ts >= TIMESTAMP '2024-01-03 00:00:00' AND ts < TIMESTAMP '2024-01-10 12:00:01'
        AND event_type IN ('click', 'view') AND regexp_matches(CAST(10000 + user_id AS VARCHAR), '[13]$')""")
def explore_filtered(spark, d):
    """One call finds the date-times kept as text, profiles, and filters; digit ids stay text."""
    events = table(spark, d, "events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("seen"),
        (F.col("user_id") + 10000).cast("string").alias("code"),
        "event_type",
    )
    bounds = (F.lit(t).cast("timestamp_ntz") for t in ("2024-01-03 00:00:00", "2024-01-10 12:00:00"))
    profile, rows = explore.explore_table(
        events,
        [
            explore.Between("seen", *bounds),
            explore.In("event_type", ["click", "view"]),
            explore.Matches("code", "[13]$"),
        ],
    )
    kinds = {r["column"]: r["kind"] for r in profile.collect()}
    if kinds["seen"] != "datetime" or kinds["code"] not in ("text", "categorical"):
        raise AssertionError(kinds)
    return rows


@query(f"""WITH {APPS}
    SELECT id_app AS "Id_app", name AS "Name", publisher AS "Publisher",
        peak_ccu_yesterday AS "Peak CCU yesterday", owners_max AS "Owners (max)",
        average_2weeks_hs AS "Avg hs played last 2 weeks", price_usd AS "Current US Price"
    FROM apps""")
def display_names(spark, d):
    shown = roles.apps(spark, d).select(
        "id_app", "name", "publisher", "peak_ccu_yesterday", "owners_max",
        "average_2weeks_hs", "price_usd",
    )
    return explore.display_names(shown)


@query("""WITH last AS (SELECT min(ts) AS last_update,
        CAST(floor(epoch(TIMESTAMP '2024-03-01 12:34:56' - min(ts))) AS BIGINT) AS s FROM events)
    SELECT last_update, 'Last database update: ' || (s // 86400) || 'd '
        || ((s % 86400) // 3600) || 'h ' || ((s // 60) % 60) || 'm ' || (s % 60) || 's ago'
        AS message FROM last""")
def freshness(spark, d):
    now = datetime(2024, 3, 1, 12, 34, 56)
    return explore.freshness(table(spark, d, "events"), F.lit(now).cast("timestamp_ntz"), "ts")


@query("""SELECT min(ts) + INTERVAL 9 HOUR AS last_update FROM events""")
def freshness_zone(spark, d):
    """The load time as read on a clock nine hours ahead."""
    events = table(spark, d, "events").select(F.col("ts").cast("timestamp_ntz").alias("ts"))
    now = F.lit(datetime(2024, 3, 1)).cast("timestamp_ntz")
    return explore.freshness(events, now, "ts", zone="Asia/Tokyo").select("last_update")

"""Ids, normalisation, ranking, search, exploration and quality on hand-written rows."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cataloom.operators import explore, ids, normalize, quality, sizes
from cataloom.operators.ranking import (
    CRITERIA,
    free_paid_split,
    rank_by_dimension,
    related_labels,
    resorted,
    with_shares,
)
from cataloom.operators.search import Facet, search
from cataloom.schemas import CLEAN, writable

PARTITIONS = (1, 4, 13)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- order ---------------------------------------------------------------------------


@pytest.mark.parametrize("partitions", PARTITIONS)
def test_dense_ids_have_no_gaps(spark, partitions):
    numbers = list(range(0, 5000, 7))
    random.Random(1).shuffle(numbers)
    df = spark.createDataFrame([(n,) for n in numbers], "n bigint").repartition(partitions)
    found = ids.dense_ids(df, ["n"], "id").orderBy("id").collect()
    assert [tuple(r) for r in found] == list(enumerate(sorted(numbers)))


def test_dense_ids_of_nothing(spark):
    empty = spark.createDataFrame([], "n bigint")
    assert ids.dense_ids(empty, ["n"], "id").collect() == []


@pytest.mark.parametrize("partitions", PARTITIONS)
def test_keep_first_follows_order(spark, rows, partitions):
    data = [(i, i % 3 if i % 2 else 0, f"v{i}") for i in range(300)]
    df = spark.createDataFrame(data, "seq bigint, k bigint, v string").repartition(partitions)
    first = {}
    for seq, key, value in data:
        first.setdefault(key, (seq, key, value))
    assert rows(ids.keep_first(df, "k", ["seq"])) == sorted(first.values(), key=repr)


def test_keep_first_limits_before_the_shuffle(spark):
    df = spark.range(100).select("id", (F.col("id") % 3).alias("k"))
    assert plan_of(ids.keep_first(df, "k", ["id"])).count("WindowGroupLimit") == 2


def test_batches(spark, rows):
    df = spark.range(10).withColumnRenamed("id", "pos")
    batches = ids.with_batch(df, "pos", start=2, size=3)
    assert rows(batches) == [(p, (p - 2) // 3) for p in range(2, 10)]
    progress = ids.batch_progress(batches, "pos", start=2)
    assert rows(progress) == [(0, 3, 3), (1, 3, 6), (2, 2, 8)]


# ---- normalisation -------------------------------------------------------------------

LISTS = [
    (10, 0, ["b", "a ", "b"]),
    (11, 1, None),
    (12, 2, []),
    (13, 3, [" c", "nan", "a"]),
    (14, 4, ["", None, "b"]),
]


def normalized(spark, partitions=1):
    df = spark.createDataFrame(LISTS, "id bigint, seq bigint, l array<string>")
    return normalize.normalize_list(df.repartition(partitions), "id", "l", "id_x", "x", "seq")


@pytest.mark.parametrize("partitions", PARTITIONS)
def test_normalize_list(spark, rows, partitions):
    fact, dim, bridge = normalized(spark, partitions)
    assert fact.columns == ["id", "seq"] and fact.count() == len(LISTS)
    assert rows(dim) == [(0, "b"), (1, "a"), (2, "c"), (3, "")]
    assert rows(bridge) == [(10, 0), (10, 0), (10, 1), (13, 1), (13, 2), (14, 0), (14, 3)]


def test_large_dimension_gives_the_same_links(spark, rows, monkeypatch):
    expected = rows(normalized(spark)[2])
    monkeypatch.setattr(normalize, "BROADCAST_BYTES", 0)
    assert rows(normalized(spark)[2]) == expected


def test_normalize_map(spark, rows):
    data = [(1, 0, {"a": 5, "b": 3}), (2, 1, None), (3, 2, {"c": 1, "a": 2})]
    df = spark.createDataFrame(data, "id bigint, seq bigint, m map<string,bigint>")
    fact, dim, bridge = normalize.normalize_map(df, "id", "m", "id_t", "t", "seq")
    names = {r["id_t"]: r["t"] for r in dim.collect()}
    assert sorted(names) == [0, 1, 2] and {names[0], names[1]} == {"a", "b"}
    linked = {(r["id"], names[r["id_t"]], r["count"]) for r in bridge.collect()}
    assert linked == {(1, "a", 5), (1, "b", 3), (3, "c", 1), (3, "a", 2)}
    assert bridge.columns == ["id", "id_t", "count"] and fact.columns == ["id", "seq"]


def test_normalize_joins_back_to_the_lists(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(40)]
    lists = {i: [rng.choice(words) for _ in range(rng.randint(0, 9))] for i in range(400)}
    df = spark.createDataFrame(list(lists.items()), "id bigint, l array<string>")
    _, dim, bridge = normalize.normalize_list(df.repartition(5), "id", "l", "id_x", "x", "id")
    names = {r["id_x"]: r["x"] for r in dim.collect()}
    order = list(dict.fromkeys(w for i in sorted(lists) for w in lists[i]))
    assert [names[i] for i in range(len(names))] == order
    back = {}
    for r in bridge.collect():
        back.setdefault(r["id"], []).append(names[r["id_x"]])
    assert {k: sorted(v) for k, v in lists.items() if v} == {k: sorted(v) for k, v in back.items()}


def test_dimension_building_aggregates_by_hash(spark, monkeypatch):
    plans = []

    def seen(df, *args, **options):
        plans.append(plan_of(df))
        return ids.number_rows(df, *args, **options)

    monkeypatch.setattr(normalize, "number_rows", seen)
    normalized(spark, 4)
    (plan,) = plans
    assert "SortAggregate" not in plan and plan.count("HashAggregate") == 2
    assert plan.count("Exchange hashpartitioning") == 1


# ---- analytics -----------------------------------------------------------------------

APPS = [
    # id, name, developer, publisher, ccu, hours, owners, price, discount
    (1, "a", "d", "p", 10, 1.0, 100, 0.0, 0.0),
    (2, "b", "d", "p", 20, 0.0, 200, 10.0, 50.0),
    (3, "c", "d", "p", None, 3.0, 300, 20.0, 0.0),
    (4, "x", "e", "q", 5, 2.0, 400, None, 0.0),
    (5, "x", "e", "q", 5, 2.0, 400, 5.0, 0.0),
    (6, "x", "e", "q", 5, 2.0, 400, 5.0, 0.0),
]
APP_SCHEMA = """id_app bigint, name string, developer string, publisher string,
    peak_ccu_yesterday bigint, average_2weeks_hs double, owners_max bigint,
    price_usd double, discount double"""


@pytest.fixture(scope="module")
def star(spark):
    def frame(data, schema):
        return spark.createDataFrame(data, schema)

    return {
        "apps": frame(APPS, APP_SCHEMA),
        "languages": frame(
            [(0, "English", "English"), (1, "Spanish - Spain", "Spanish"),
             (2, "Spanish - Latin America", "Spanish"), (3, "", None), (4, "L'x", "L'x")],
            "id_language bigint, language string, normalized_language string",
        ),
        "apps_languages": frame(
            [(1, 0), (1, 1), (1, 2), (2, 0), (2, 1), (3, 3), (4, 0), (5, 4), (6, 4), (2, 0)],
            "id_app bigint, id_language bigint",
        ),
    }


KEYS = {"fact_id": "id_app", "dim_id": "id_language", "label": "normalized_language"}


def rank(star, criterion, **options):
    ranked = rank_by_dimension(
        star["apps"], star["apps_languages"], star["languages"],
        **KEYS, criterion=criterion, **options,
    )
    return [tuple(r) for r in ranked.collect()]


def test_rank_counts_links(star):
    # App 4 has no price and is in no range; equal counts fall back on the label.
    expected = [("English", 3), ("Spanish", 3), ("L'x", 2), (None, 1)]
    assert rank(star, "apps_count") == expected


def test_rank_counts_facts(star):
    expected = [("English", 2), ("L'x", 2), ("Spanish", 2), (None, 1)]
    assert rank(star, "apps_count", distinct_facts=True) == expected


def test_rank_puts_a_null_measure_first(star):
    found = rank(star, "peak_ccu_yesterday")
    assert found[0] == (None, None)
    assert found[1] == ("English", round(50 / 3, 6))


def test_rank_positive_measures(star):
    assert rank(star, "average_2weeks_hs") == [
        (None, 3.0), ("L'x", 2.0), ("English", 1.0), ("Spanish", 1.0),
    ]
    assert rank(star, "price_usd", price_range=(0, 10)) == [
        ("English", 10.0), ("Spanish", 10.0), ("L'x", 5.0),
    ]


@pytest.mark.parametrize("criterion", CRITERIA)
def test_rank_limit_and_plan(star, criterion):
    assert len(rank(star, criterion, n=2)) == 2
    ranked = rank_by_dimension(
        star["apps"], star["apps_languages"], star["languages"], **KEYS, criterion=criterion
    )
    plan = plan_of(ranked)
    assert "TakeOrderedAndProject" in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_resorted(star):
    ranked = rank_by_dimension(
        star["apps"], star["apps_languages"], star["languages"], **KEYS, criterion="apps_count"
    )
    assert [r[1] for r in resorted(ranked).collect()] == [1, 2, 3, 3]


def test_related_labels(star):
    found = related_labels(
        star["apps_languages"], star["languages"], dim_id_a="id_language",
        label_a="normalized_language", value="Spanish",
        bridge_b=star["apps_languages"], dim_b=star["languages"], dim_id_b="id_language",
        label_b="language", fact_id="id_app",
    )
    assert [tuple(r) for r in found.collect()] == [
        ("English", 3), ("Spanish - Spain", 2), ("Spanish - Latin America", 1),
    ]


def split(star, value, **options):
    return free_paid_split(
        star["apps"], star["apps_languages"], star["languages"], **KEYS, value=value, **options
    )


def test_free_paid(star, rows):
    assert rows(split(star, "Spanish")) == [("Spanish", 2, 1)]
    assert rows(split(star, "Spanish", distinct_facts=True)) == [("Spanish", 1, 1)]
    assert rows(split(star, "English")) == [("English", 1, 2)]  # null price in neither
    assert rows(split(star, "L'x")) == [("L'x", 0, 2)]
    assert rows(split(star, "unknown")) == []
    assert rows(with_shares(split(star, "English"))) == [
        ("Free", 1, 1 / 3), ("Paid", 2, 2 / 3),
    ]


def found_names(star, values, match_key, **options):
    facet = Facet(
        star["apps_languages"], star["languages"], "id_language", "normalized_language",
        values, match_key,
    )
    found = search(star["apps"], [facet], fact_id="id_app", order_by="owners_max", **options)
    return [r["name"] for r in found.collect()]


def test_search_match_key(star):
    assert found_names(star, ["Spanish"], "label") == ["b", "a"]
    assert found_names(star, ["Spanish"], "id") == ["b"]
    assert found_names(star, ["Spanish", "English"], "label") == ["b", "a"]
    assert found_names(star, ["Spanish", "English", "Spanish"], "id") == ["b"]
    assert found_names(star, ["Spanish", "unknown"], "label") == []


def test_search_without_broadcast(star, monkeypatch):
    expected = found_names(star, ["Spanish", "English"], "label")
    monkeypatch.setattr(sizes, "BROADCAST_ROWS", 0)
    assert found_names(star, ["Spanish", "English"], "label") == expected
    assert found_names(star, ["Spanish"], "id") == ["b"]


def test_search_with_many_labels(star):
    many = [f"none{i}" for i in range(150)]
    assert found_names(star, ["English", *many], "label") == []


def test_search_merges_equal_rows(star):
    assert found_names(star, ["L'x"], "label") == ["x"]


def test_search_without_facets(star):
    found = search(star["apps"], fact_id="id_app", order_by="peak_ccu_yesterday", n=3)
    assert [r["name"] for r in found.collect()] == ["c", "b", "a"]
    assert "TakeOrderedAndProject" in plan_of(found)


@pytest.mark.parametrize("match_key", ("label", "id"))
def test_search_reads_every_table_once(spark, star, tmp_path, match_key):
    stored = {}
    for name, df in star.items():
        df.write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    facet = Facet(
        stored["apps_languages"], stored["languages"], "id_language", "normalized_language",
        ["Spanish", "English"], match_key,
    )
    found = search(stored["apps"], [facet], fact_id="id_app", order_by="price_usd")
    plan = plan_of(found)
    assert plan.count("FileScan parquet") == 3 and "TakeOrderedAndProject" in plan
    # The bridge by fact, and equal result rows; a join of the two small tables may add its own.
    assert plan.count("Exchange hashpartitioning") <= 3


@pytest.mark.parametrize("criterion", CRITERIA)
def test_rankings_do_not_depend_on_the_layout(spark, criterion):
    """Values whose double sums depend on the order, and groups with equal averages."""
    apps = spark.range(3000).select(
        F.col("id").alias("id_app"),
        (F.col("id") % 97 * 9007199254740).alias("peak_ccu_yesterday"),
        (F.col("id") % 7 / 10 + 0.1).alias("average_2weeks_hs"),
        (F.col("id") % 5 * 1000).alias("owners_max"),
        (F.col("id") % 11 / 10 + 0.01).alias("price_usd"),
        (F.lit(50.1) - F.col("id") % 3 / 10).alias("discount"),
    )
    links = spark.range(60_000).select(
        (F.col("id") % 3000).alias("id_app"), (F.col("id") % 60).alias("id_language")
    )
    dim = spark.range(60).select(
        F.col("id").alias("id_language"),
        F.concat(F.lit("l"), F.col("id") % 40).alias("normalized_language"),
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for partitions in (1, 3, 8, 50):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            ranked = rank_by_dimension(
                apps.repartition(partitions), links.repartition(partitions), dim,
                **KEYS, criterion=criterion, n=25,
            )
            results.append([tuple(r) for r in ranked.collect()])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert all(r == results[0] for r in results)
    values = [v for _, v in results[0]]
    tied = [[name for name, v in results[0] if v == x] for x in dict.fromkeys(values)]
    assert values == sorted(values, reverse=True) and all(t == sorted(t) for t in tied)


# ---- exploring -----------------------------------------------------------------------


def test_facet_values(star):
    found = explore.facet_values(star["languages"], "normalized_language").collect()
    assert [r[0] for r in found] == ["English", "L'x", "Spanish", None]


def test_profile(spark):
    df = spark.range(0, 101).select(
        "id",
        F.when(F.col("id") % 3 == 1, "x").when(F.col("id") % 3 == 2, "y").alias("few"),
        F.col("id").cast("string").alias("text"),
        F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("at"),
    )
    for exact in (True, False, "kind"):
        found = {r["column"]: r for r in explore.profile(df, exact=exact).collect()}
        kinds = {c: r["kind"] for c, r in found.items()}
        assert kinds == {
            "id": "numeric", "few": "categorical", "text": "text", "at": "datetime",
        }
        assert found["few"]["n_distinct"] == 2
        assert (found["id"]["min"], found["id"]["max"], found["id"]["step"]) == ("0", "100", 1.0)
    assert {r[0] for r in explore.categories(df, "few").collect()} == {None, "x", "y"}


def test_filters(spark, rows):
    df = spark.createDataFrame(
        [(1, "Ab", 1.0), (2, None, 2.0), (3, "ab", None)], "id int, t string, v double"
    )

    def kept(*specs):
        return [r[0] for r in rows(explore.apply_filters(df, specs).select("id"))]

    assert kept(explore.In("t", ["ab"])) == [3]
    assert kept(explore.In("t", ["ab", None])) == [2, 3]
    assert kept(explore.In("t", [])) == []
    assert kept(explore.Between("v", 1, 2)) == [1, 2]
    assert kept(explore.Between("v", 1, None)) == [1, 2, 3]
    assert kept(explore.Matches("t", "^a.$")) == [3]
    assert kept(explore.Matches("t", "")) == [1, 2, 3]
    assert kept(explore.Matches("t", "b"), explore.Between("v", 0, 9)) == [1]


def test_cast_datetimes(spark):
    df = spark.createDataFrame(
        [("2024-01-02", "2024-01-02", datetime(2024, 1, 1)), (None, "no", None)],
        "a string, b string, c timestamp",
    )
    types = dict(explore.cast_datetimes(df).dtypes)
    assert types == {"a": "timestamp_ntz", "b": "string", "c": "timestamp_ntz"}


def test_digits_are_no_dates(spark):
    data = [("1995", "90210", "20240102", " 2024-01-02 10:11 "), ("2001", "10001", None, None)]
    df = spark.createDataFrame(data, "year string, code string, run string, at string")
    types = dict(explore.cast_datetimes(df).dtypes)
    assert types == {
        "year": "timestamp_ntz", "code": "string", "run": "string", "at": "timestamp_ntz",
    }


def test_one_call_profiles_and_filters(spark, rows):
    df = spark.createDataFrame(
        [(1, "2024-01-02", "123"), (2, "2024-01-05", "456"), (3, None, "789")],
        "id int, at string, code string",
    )
    low, high = datetime(2024, 1, 1), datetime(2024, 1, 3)
    profile, kept = explore.explore_table(df, [explore.Between("at", low, high)])
    assert {r["column"] for r in profile.collect()} == {"id", "at", "code"}
    assert dict(kept.dtypes)["at"] == "timestamp_ntz" and [r[0] for r in rows(kept)] == [1]


def test_display_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "price_usd int, normalized_language int, x int")
    assert explore.display_names(df).columns == ["Current US Price", "Normalized_language", "X"]


def test_freshness(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 2, 10),), (datetime(2024, 1, 1, 9, 59, 58),)], "_loaded_at timestamp"
    )
    now = datetime(2024, 1, 4, 11, 1, 1)
    found = explore.freshness(df, now).first()
    assert found["message"] == "Last database update: 3d 1h 1m 3s ago"
    latest = explore.freshness(df, now, latest=True, zone="Asia/Tokyo").first()
    assert latest["message"] == "Last database update: 2d 1h 1m 1s ago"
    assert latest["last_update"] == datetime(2024, 1, 2, 19)


# ---- quality -------------------------------------------------------------------------


def test_quality_report(spark):
    tables = {n: spark.createDataFrame([], writable(s)) for n, s in CLEAN.items()}
    tables["genres"] = spark.createDataFrame(
        [(0, "a"), (0, "b"), (None, "c")], "id_genre bigint, genre string"
    )
    tables["apps_genres"] = spark.createDataFrame(
        [(1, 0), (1, 7), (1, 7), (None, None)], "id_app bigint, id_genre bigint"
    )
    found = {
        (r["check"], r["table"], r["column"]): r["violations"]
        for r in quality.report(tables).collect()
    }
    wrong = {k: v for k, v in found.items() if v}
    assert wrong == {
        ("not_null", "genres", "id_genre"): 1,
        ("primary_key", "genres", "id_genre"): 1,
        ("foreign_key", "apps_genres", "id_app"): 3,
        ("foreign_key", "apps_genres", "id_genre"): 2,
    }
    assert len(found) == 7 + 4 + 6


# ---- skew ----------------------------------------------------------------------------


@pytest.fixture
def small_thresholds(spark):
    """Limits of adaptive execution at the size of test data; no broadcast."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "30000",
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def test_hot_application_is_split(spark, small_thresholds):
    """A third of all links belongs to one fact; the join does not leave it to one task."""
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000)
    links = spark.range(0, 300_000, 1, 8).select(
        hot.alias("id_app"), (F.xxhash64("id") % 1000).alias("id_x")
    )
    fact = spark.range(5000).select(F.col("id").alias("id_app"), F.lit(1.0).alias("price_usd"))
    dim = spark.range(-1000, 1000).select(
        F.col("id").alias("id_x"), F.concat(F.lit("x"), F.col("id") % 3).alias("x")
    )
    ranked = rank_by_dimension(
        fact, links, dim, fact_id="id_app", dim_id="id_x", label="x", criterion="apps_count"
    )
    assert sum(r["apps_count"] for r in ranked.collect()) == 300_000
    assert "skew=true" in plan_of(ranked)


def test_hot_label_is_split(spark, small_thresholds, monkeypatch):
    monkeypatch.setattr(normalize, "BROADCAST_BYTES", 0)
    words = F.array(F.lit("hot"), F.concat(F.lit("w"), F.col("id") % 3000))
    df = spark.range(30_000).select("id", words.alias("l"))
    _, dim, bridge = normalize.normalize_list(df, "id", "l", "id_x", "x", "id")
    assert len(bridge.collect()) == 60_000 and dim.count() == 3001
    assert "skew=true" in plan_of(bridge)
    hot = dim.where(F.col("x") == "hot").first()["id_x"]
    assert bridge.where(F.col("id_x") == hot).count() == 30_000


@pytest.mark.parametrize("distinct", (False, True))
def test_hot_dimension_id_is_split(spark, small_thresholds, monkeypatch, distinct):
    """One label has half of all links: joins by dimension id share it among tasks."""
    monkeypatch.setattr(sizes, "BROADCAST_ROWS", 0)
    hot = F.when(F.col("id") % 2 == 0, 3).otherwise(F.col("id") % 2000)
    links = spark.range(0, 300_000, 1, 8).select(
        (F.col("id") % 9000).alias("id_app"), hot.alias("id_x")
    )
    fact = spark.range(9000).select(F.col("id").alias("id_app"), F.lit(1.0).alias("price_usd"))
    dim = spark.range(4000).select(
        F.col("id").alias("id_x"), F.concat(F.lit("x"), F.col("id")).alias("x")
    )
    options = {"fact_id": "id_app", "dim_id": "id_x", "label": "x"}
    if distinct:
        ranked = rank_by_dimension(
            fact, links, dim, **options, criterion="apps_count", distinct_facts=True
        )
        assert ranked.collect()[0]["x"] == "x3"
        assert "skew=true" in plan_of(ranked)
    found = free_paid_split(fact, links, dim, **options, value="x3")
    assert found.first()["paid_apps"] == links.where("id_x = 3").count()
    facet = Facet(links, dim, "id_x", "x", ["x3", "x5"], "id")
    some = search(
        fact, [facet], fact_id="id_app", order_by="price_usd", columns=["id_app", "price_usd"]
    )
    both = links.where("id_x IN (3, 5)").groupBy("id_app").agg(F.count_distinct("id_x").alias("n"))
    assert some.count() == min(2500, both.where("n = 2").count())

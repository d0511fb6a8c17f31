"""Stored indexes against the operators that read facts and links each time."""

import numpy as np
import pytest

from cataloom.operators.bitmaps import label_bitmaps, matching_bits, merged, search_indexed, stored
from cataloom.operators.cooccurrence import label_pairs, related_from_pairs
from cataloom.operators.cooccurrence import merged as merged_pairs
from cataloom.operators.price_cells import price_index, rank_in_range
from cataloom.operators.ranking import rank_by_dimension, related_labels
from cataloom.operators.search import Facet, search

pytestmark = pytest.mark.usefixtures("small_jobs")

COLUMNS = ("name", "price_usd")
KEYS = {"fact_id": "id_app", "dim_id": "id_tag", "label": "tag"}


@pytest.fixture(scope="module")
def tables(spark):
    """Facts with negative, small and very large ids; links that repeat, of hot and rare labels."""
    draw = np.random.default_rng(0)
    ids = [-70000, -32768, -1, 0, 1, 32767, 32768, 32769, 10**12, 2**62] + list(range(5, 300))
    facts = [
        (i, f"n{i}", None if draw.random() < 0.05 else float(draw.choice([0, 0.5, 9.99, 10, 19.99, 55, 1500, 4000, -3])),
         *(None if draw.random() < 0.1 else int(v) for v in draw.integers(0, 50, 2)),
         None if draw.random() < 0.1 else round(float(draw.random()), 3), float(draw.integers(0, 90)))
        for i in ids
    ]
    kinds = "id_app bigint, name string, price_usd double, peak_ccu_yesterday bigint, owners_max bigint, average_2weeks_hs double, discount double"
    dims = [(t, f"T{min(t, 17)}" if t != 5 else None) for t in range(20)]  # three ids share a label
    links = [(i, int(t)) for i in ids for t in draw.choice(25, 6, p=[0.3, *[0.7 / 24] * 24])]
    links += [(None, 3), (3, None), (999999, 4)]
    others = [(i, int(t)) for i in ids for t in draw.integers(0, 6, 2)]
    return (
        spark.createDataFrame(facts, kinds),
        spark.createDataFrame(links, "id_app bigint, id_tag bigint"),
        spark.createDataFrame(dims, "id_tag bigint, tag string"),
        spark.createDataFrame(others, "id_app bigint, id_genre bigint"),
        spark.createDataFrame([(g, f"G{g}") for g in range(6)], "id_genre bigint, genre string"),
    )


def test_bitmaps_find_what_a_search_finds(spark, tables, rows):
    fact, tags, tag, genres, genre = tables
    facets = {"tag": (tags, tag, "id_tag", "tag"), "genre": (genres, genre, "id_genre", "genre")}
    index = stored(label_bitmaps(facets, "id_app"))
    for chosen in (
        {"tag": ["T0"]}, {"tag": ["T0", "T3", "T0"]}, {"tag": ["T17", "T1"]}, {"tag": ["none"]},
        {"tag": ["T0"], "genre": ["G1", "G2"]}, {"tag": ["T0"], "genre": []}, {},
    ):
        wanted = search(
            fact,
            [Facet(*facets[f], values) for f, values in chosen.items()],
            fact_id="id_app", order_by="price_usd", columns=COLUMNS, n=50,
        )
        found = search_indexed(
            fact, index, chosen, fact_id="id_app", order_by="price_usd", columns=COLUMNS, n=50
        )
        assert [tuple(r) for r in found.collect()] == [tuple(r) for r in wanted.collect()], chosen
    with pytest.raises(ValueError):
        matching_bits(index, {"tag": []})


def test_bitmaps_of_batches_add_up(spark, tables, rows, monkeypatch):
    fact, tags, tag, *_ = tables
    index = lambda links: label_bitmaps({"tag": (links, tag, "id_tag", "tag")}, "id_app")
    whole = index(tags)
    parts = merged(index(tags.where("id_app % 3 = 0")), index(tags.where("NOT id_app % 3 <=> 0")))
    assert rows(parts) == rows(whole)
    options = {"fact_id": "id_app", "order_by": "price_usd", "columns": COLUMNS}
    few = rows(search_indexed(fact, whole, {"tag": ["T0", "T2"]}, **options))
    monkeypatch.setattr("cataloom.operators.bitmaps.BROADCAST_BYTES", 0)
    assert rows(search_indexed(fact, whole, {"tag": ["T0", "T2"]}, **options)) == few != []


def test_an_indexed_search_reads_no_links(spark, tables, capsys):
    fact, tags, tag, *_ = tables
    index = stored(label_bitmaps({"tag": (tags, tag, "id_tag", "tag")}, "id_app"))
    matching_bits(index, {"tag": ["T0"]}).explain("formatted")
    plan = capsys.readouterr().out
    assert "IsNotNull(label)" in plan.split("PushedFilters")[1] and "id_tag" not in plan


@pytest.mark.parametrize("criterion", ["apps_count", "average_2weeks_hs", "peak_ccu_yesterday"])
def test_rankings_of_any_range(spark, tables, criterion):
    fact, tags, tag, *_ = tables
    index = price_index(fact, tags, tag, **KEYS, width=5.0, cells=6)
    ranges = [(0, 8), (0.5, 0.5), (9.99, 55), (-5, 0), (-100, 10**6), (26, 27)]
    for price_range in [*ranges, (9, 1)]:
        wanted = rank_by_dimension(
            fact, tags, tag, **KEYS, criterion=criterion, price_range=price_range, n=30
        )
        found = rank_in_range(index, criterion, price_range, 30)
        assert found.columns == wanted.columns and found.dtypes == wanted.dtypes
        assert [tuple(r) for r in found.collect()] == [tuple(r) for r in wanted.collect()], price_range


def test_a_ranking_joins_nothing(spark, tables, capsys):
    fact, tags, tag, *_ = tables
    index = price_index(fact, tags, tag, **KEYS)
    rank_in_range(index, "price_usd", (3, 400)).explain()
    assert "Join" not in capsys.readouterr().out


def options(tables):
    _, tags, tag, genres, genre = tables
    return {
        "bridge_a": tags, "dim_a": tag, "dim_id_a": "id_tag", "label_a": "tag",
        "bridge_b": genres, "dim_b": genre, "dim_id_b": "id_genre", "label_b": "genre",
        "fact_id": "id_app",
    }


@pytest.mark.parametrize("heavy", [0, 6, 1000])
def test_related_labels_from_pairs(spark, tables, heavy):
    o = options(tables)
    pairs = label_pairs(**o, heavy=heavy)
    assert (pairs.heavy_a.count() == 0) == (heavy == 1000) and (pairs.pairs.count() == 0) == (heavy == 0)
    for value in ("T0", "T17", "none"):
        wanted = related_labels(**o, value=value)
        found = related_from_pairs(pairs, value, "genre")
        assert [tuple(r) for r in found.collect()] == [tuple(r) for r in wanted.collect()]


def test_pairs_of_batches_add_up(spark, tables):
    o = options(tables)

    def of(condition):
        some = {n: o[n].where(condition) for n in ("bridge_a", "bridge_b")}
        return label_pairs(**(o | some), heavy=6)

    both = merged_pairs(of("id_app < 100"), of("id_app >= 100"))
    wanted = related_labels(**o, value="T0")
    assert [tuple(r) for r in related_from_pairs(both, "T0", "genre").collect()] == [
        tuple(r) for r in wanted.collect()
    ]


def test_a_fact_with_ten_thousand_labels(spark):
    n = 10_000
    ids = spark.range(n)
    dim = ids.selectExpr("id AS id_tag", "concat('T', id) AS tag")
    links = ids.selectExpr("1 AS id_app", "id AS id_tag").union(ids.selectExpr("id AS id_app", "id % 7 AS id_tag"))
    o = {"dim_id_a": "id_tag", "label_a": "tag", "dim_id_b": "id_tag", "label_b": "tag", "fact_id": "id_app"}
    pairs = label_pairs(links, dim, bridge_b=links, dim_b=dim, **o)
    assert pairs.heavy_a.count() == n and pairs.pairs.count() == 7
    for value in ("T3", "T9000"):
        wanted = related_labels(links, dim, bridge_b=links, dim_b=dim, value=value, **o)
        found = related_from_pairs(pairs, value, "tag")
        assert [tuple(r) for r in found.collect()] == [tuple(r) for r in wanted.collect()]

"""Random messy records against a plain row-by-row reading of the rules."""

import random

import pytest

from cataloom.constants import CANONICAL_LANGUAGES, LABEL_REMOVALS, NULL_TOKENS
from cataloom.operators.ranking import CRITERIA, rank_by_dimension
from cataloom.operators.search import SEARCH_COLUMNS, Facet, search
from cataloom.plans.transform import build_star
from cataloom.schemas import RAW_DETAIL_COLUMNS
from cataloom.sources.raw_csv import read_raw_csv
from cataloom.sources.tables import write_table

PIECES = (
    "English", "english ", "Spanish - Spain", "SPANISH", "Thai*", "&lt;strong&gt;", "br", "[b]",
    "\r\n", "\n", " ", " ", "#x", "(all)", "Not supported", "not supported;", "nan", "é",
    "\\/", "/", "strstrongong", "",
)
GENRES = ("Action", " Indie", "RPG ", "", "nan", "A ", "Free to Play")
TAGS = ("Action", "1990's", "Shoot 'Em Up", "Co op", "é", "Very Long Tag Name")


def random_record(rng, number):
    def maybe(value, share=0.1):
        return rng.choice(("", "NA", "null")) if rng.random() < share else value

    def phrase():
        return "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 3)))

    weights = ", ".join(f"'{rng.choice(TAGS)}': {rng.randint(0, 99)}" for _ in range(4))
    return {
        "appid": str(rng.randint(1, number)),
        "name": maybe(rng.choice(("a", "b", 'q"q', "None"))),
        "developer": maybe("d", 0.05),
        "publisher": maybe("p", 0.05),
        "owners": maybe(rng.choice(("1,000 .. 2,000,000", "0 .. 20,000", "x .. 5", "7"))),
        "average_forever": maybe(str(rng.randint(0, 500))),
        "average_2weeks": maybe(str(rng.randint(0, 3))),
        "median_forever": maybe(str(rng.randint(0, 500))),
        "median_2weeks": maybe(str(rng.randint(0, 500))),
        "ccu": maybe(str(rng.randint(0, 9))),
        "price": maybe(rng.choice(("0", "999", "150000", "150001", "200000"))),
        "initialprice": maybe(str(rng.randint(0, 9999))),
        "discount": maybe(str(rng.randint(0, 90))),
        "tags": maybe(rng.choice(("[]", "{" + weights + "}", "{'Score 50': 1}"))),
        "languages": maybe(",".join(phrase() for _ in range(rng.randint(1, 5)))),
        "genre": maybe(",".join(rng.choice(GENRES) for _ in range(rng.randint(1, 4)))),
    }


def number_or_none(text, kind):
    try:
        return kind(text)
    except (TypeError, ValueError):
        return None


def expected_facts(records):
    facts = {}
    for raw in records:
        row = {k: None if v in NULL_TOKENS else v for k, v in raw.items()}
        price = number_or_none(row["price"], float)
        required = (row["name"], row["developer"], row["publisher"], price)
        if None in required or price / 100 > 1500 or int(row["appid"]) in facts:
            continue
        bounds = (row["owners"] or "").split(" .. ")
        bounds = [number_or_none(b.replace(",", ""), int) for b in bounds] + [None, None]

        def hours(column, row=row):
            minutes = number_or_none(row[column], float)
            return None if minutes is None else round(minutes / 60, 2)

        def cents(column, row=row):
            amount = number_or_none(row[column], float)
            return None if amount is None else amount / 100

        facts[int(row["appid"])] = {
            "lists": row,
            "cells": (
                row["name"], row["developer"], row["publisher"], bounds[0], bounds[1],
                hours("average_forever"), hours("average_2weeks"), hours("median_forever"),
                hours("median_2weeks"), number_or_none(row["ccu"], int), price / 100,
                cents("initialprice"), number_or_none(row["discount"], float),
            ),
        }
    return facts


def expected_languages(text):
    labels = []
    for entry in (text or "").split(",") if text is not None else []:
        for fragment in LABEL_REMOVALS:
            entry = entry.replace(fragment, "")
        entry = entry.replace("\r\n", " ").replace("\n", " ").strip()
        if entry[:1] not in ("#", "(") and entry.lower() != "not supported" and entry != "nan":
            labels.append(entry)
    return labels


def expected_genres(text):
    return [g.strip() for g in text.split(",") if g.strip() != "nan"] if text is not None else []


def expected_tags(text):
    if text in (None, "[]"):
        return {}
    if "Score" in text:
        return None
    weights = {}
    for item in text[1:-1].split(", "):
        name, _, weight = item.rpartition(": ")
        name = name[1:-1].replace("0'", "0").replace("'Em Up", " Em Up")
        weights[name] = int(weight)
    return weights


@pytest.mark.parametrize("seed", (1, 2))
def test_star(spark, rows, seed):
    rng = random.Random(seed)
    records = [random_record(rng, 250) for _ in range(600)]
    schema = ", ".join(f"{c} string" for c in RAW_DETAIL_COLUMNS)
    data = [(i, *[r[c] for c in RAW_DETAIL_COLUMNS]) for i, r in enumerate(records)]
    raw = spark.createDataFrame(data, f"row_seq bigint, {schema}").repartition(7)
    star, rejected = build_star(raw)

    facts = expected_facts(records)
    broken = {k for k, f in facts.items() if expected_tags(f["lists"]["tags"]) is None}
    assert broken and {int(r["appid"]) for r in rejected.collect()} == broken
    facts = {k: f for k, f in facts.items() if k not in broken}
    assert rows(star["apps"]) == sorted(((k, *f["cells"]) for k, f in facts.items()), key=repr)

    def check(dim, bridge, lists):
        order = list(dict.fromkeys(label for labels in lists.values() for label in labels))
        assert [(r[0], r[1]) for r in dim.orderBy(dim.columns[0]).collect()] == [
            (i, label or None) for i, label in enumerate(order)
        ]
        links = [
            (k, order.index(label), *extra)
            for k, labels in lists.items()
            for label, extra in (
                ((n, (w,)) for n, w in labels.items())
                if isinstance(labels, dict)
                else ((n, ()) for n in labels)
            )
        ]
        assert rows(bridge) == sorted(links, key=repr)

    check(star["genres"], star["apps_genres"],
          {k: expected_genres(f["lists"]["genre"]) for k, f in facts.items()})
    check(star["languages"], star["apps_languages"],
          {k: expected_languages(f["lists"]["languages"]) for k, f in facts.items()})
    check(star["tags"], star["apps_tags"],
          {k: expected_tags(f["lists"]["tags"]) for k, f in facts.items()})
    for r in star["languages"].collect():
        text = r["language"] or ""
        hits = [c for c in CANONICAL_LANGUAGES if c.lower() in text.lower()]
        assert r["normalized_language"] == (hits[0] if hits else r["language"])


def test_csv_file_gives_the_same_star(spark, rows, tmp_path):
    rng = random.Random(3)
    records = [random_record(rng, 100) for _ in range(200)]
    for record in records:
        record["languages"] = record["languages"].replace("\r\n", "\n")
    schema = ", ".join(f"{c} string" for c in RAW_DETAIL_COLUMNS)
    data = [(i, *[r[c] for c in RAW_DETAIL_COLUMNS]) for i, r in enumerate(records)]
    raw = spark.createDataFrame(data, f"row_seq bigint, {schema}")
    ordered = raw.repartitionByRange(3, "row_seq").sortWithinPartitions("row_seq")
    path = write_table(ordered.drop("row_seq"), str(tmp_path / "raw"), "csv")
    direct, _ = build_star(raw)
    through_files, _ = build_star(read_raw_csv(spark, path))
    for name, table in direct.items():
        assert rows(through_files[name]) == rows(table), name


@pytest.fixture(scope="module")
def random_star(spark):
    rng = random.Random(5)
    apps = [
        (i, rng.choice("ab"), "d", "p", rng.choice((None, 1, 2, 30)),
         rng.choice((None, 0.0, 1.5, 2.0)), rng.choice((None, 100, 200)),
         rng.choice((None, 0.0, 5.0, 10.0, 99.0)), rng.choice((None, 0.0, 50.0)))
        for i in range(300)
    ]
    dim = [(i, f"v{i}", rng.choice(("x", "y", "z", "it's", None))) for i in range(12)]
    bridge = [(rng.randrange(310), rng.choice((0, 0, 0, rng.randrange(13)))) for _ in range(2000)]
    app_schema = """id_app bigint, name string, developer string, publisher string,
        peak_ccu_yesterday bigint, average_2weeks_hs double, owners_max bigint,
        price_usd double, discount double"""
    frames = (
        spark.createDataFrame(apps, app_schema),
        spark.createDataFrame(bridge, "id_app bigint, id_language bigint"),
        spark.createDataFrame(dim, "id_language bigint, language string, label string"),
    )
    return apps, bridge, dim, frames


@pytest.mark.parametrize("criterion", CRITERIA)
@pytest.mark.parametrize("distinct", (False, True))
def test_rankings(random_star, criterion, distinct):
    apps, bridge, dim, frames = random_star
    rule = CRITERIA[criterion]
    by_id, labels = {a[0]: a for a in apps}, {d[0]: d[2] for d in dim}
    place = {c: i + 1 for i, c in enumerate(SEARCH_COLUMNS)}
    links = [(a, labels[d]) for a, d in bridge if a in by_id and d in labels]
    groups = {}
    for app, label in set(links) if distinct else links:
        row = by_id[app]
        value = row[place[rule.column]] if rule.column else row[0]
        if row[place["price_usd"]] is None or not 0 <= row[place["price_usd"]] <= 50:
            continue
        if rule.positive_only and not (value is not None and value > 0):
            continue
        groups.setdefault(label, []).append(value)
    expected = []
    for label, values in groups.items():
        known = [v for v in values if v is not None]
        average = round(sum(known) / len(known), 6) if known else None
        expected.append((label, average if rule.column else len(known)))
    expected.sort(key=lambda r: (r[1] is not None, -(r[1] or 0), r[0] is None, r[0] or ""))
    found = rank_by_dimension(
        *frames, fact_id="id_app", dim_id="id_language", label="label", criterion=criterion,
        price_range=(0, 50), n=3, distinct_facts=distinct,
    ).collect()
    assert [r[0] for r in found] == [r[0] for r in expected[:3]]
    assert [r[1] for r in found] == pytest.approx([r[1] for r in expected[:3]])


@pytest.mark.parametrize("match_key", ("label", "id"))
@pytest.mark.parametrize("chosen", (["x"], ["x", "it's"], ["x", "y", "z"], ["x", "no"]))
def test_search(random_star, match_key, chosen):
    apps, bridge, dim, (fact, links, names) = random_star
    labels = {d[0]: d[2] for d in dim}
    found = {}
    for app, key in bridge:
        if labels.get(key) in chosen:
            found.setdefault(app, set()).add(labels[key] if match_key == "label" else key)
    hits = {a[1:] for a in apps if len(found.get(a[0], ())) == len(chosen)}
    facet = Facet(links, names, "id_language", "label", chosen, match_key)
    result = search(fact, [facet], fact_id="id_app", order_by="discount").collect()
    assert {tuple(r) for r in result} == hits and len(result) == len(hits)
    nulls = [r["discount"] is None for r in result]
    assert nulls == sorted(nulls, reverse=True)


@pytest.mark.parametrize("order_by", ("discount", "peak_ccu_yesterday", "owners_max"))
@pytest.mark.parametrize("n", (1, 2, 5, 40, 1000))
def test_search_top_n(random_star, order_by, n):
    apps, _, _, (fact, _, _) = random_star
    place = SEARCH_COLUMNS.index(order_by)
    ties = [i for i in range(len(SEARCH_COLUMNS)) if i != place]

    def rank(row):
        measure = row[place]
        rest = [(row[i] is None, row[i] if row[i] is not None else 0) for i in ties]
        return (measure is not None, -(measure or 0), rest)

    expected = sorted({a[1:] for a in apps}, key=rank)[:n]
    found = search(fact, fact_id="id_app", order_by=order_by, n=n).collect()
    assert [tuple(r) for r in found] == expected


def test_search_top_n_of_spread_values(spark):
    """A measure with many values: only rows at the top are compared as a whole."""
    data = [(i, "a", float(i // 2 * 37 % 1000)) for i in range(2000)] + [(-1, "a", None)]
    fact = spark.createDataFrame(data, "id bigint, name string, v double")
    found = search(fact, fact_id="id", order_by="v", n=10, columns=["name", "v"]).collect()
    values = sorted({d[2] for d in data if d[2] is not None}, reverse=True)
    assert [r["v"] for r in found] == [None, *values[:9]]

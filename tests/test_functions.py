"""Cells: every documented edge value."""

import pytest
from pyspark.sql import functions as F

from cataloom import functions as C
from cataloom.constants import WHITESPACE


def values(spark, texts, make, schema="i int, x string"):
    df = spark.createDataFrame(list(enumerate(texts)), schema)
    return [r[0] for r in df.orderBy("i").select(make(F.col("x"))).collect()]


def test_strip_takes_all_white_space(spark):
    texts = [f"{c}a{c} b{c}{c}" for c in WHITESPACE] + ["", None, "  "]
    expected = [t.strip() if t is not None else None for t in texts]
    assert values(spark, texts, C.strip) == expected


def test_null_tokens(spark):
    texts = ["NA", "null", "nan", "N/A", "", "None", " NA", "na", None]
    expected = [None, None, None, None, None, "None", " NA", "na", None]
    assert values(spark, texts, C.null_tokens) == expected


def test_parse_range(spark):
    texts = ["10,000 .. 20,000", None, "x", "5", "1 .. y"]
    expected = [[10000, 20000], None, [None], [5], [1, None]]
    assert values(spark, texts, C.parse_range) == expected


def test_minutes_to_hours_is_half_free(spark):
    df = spark.range(0, 200_000).select("id", C.minutes_to_hours(F.col("id")).alias("h"))
    for number, hours in df.collect():
        assert hours == round(number / 60.0, 2)


def test_cents(spark):
    texts = ["150000", "1", "0", None]
    found = values(spark, texts, lambda x: C.cents_to_units(x.cast("double")))
    assert found == [1500.0, 0.01, 0.0, None]


def test_to_long(spark):
    texts = ["12", "12.0", "9007199254740993.0", " -7. ", "+3", "['999']", "12.7", "1e3", "9" * 20, "", None]
    expected = [12, 12, 9007199254740993, -7, 3, None, None, None, None, None, None]
    assert values(spark, texts, C.to_long) == expected


def test_split_trim(spark):
    texts = ["Action, Indie ,RPG", "A,,B", None, ""]
    expected = [["Action", "Indie", "RPG"], ["A", "", "B"], None, [""]]
    assert values(spark, texts, C.split_trim) == expected


LANGUAGES = {
    "English<strong>*</strong>, French": ["English<><>", "French"],
    "&lt;strong&gt;English&lt;/strong&gt;*": ["English"],
    "Hebrew": ["Heew"],
    "English\r\nInterface: English": ["English Interface: English"],
    "English\nInterface": ["English Interface"],
    "#lang_a, #lang_b, English": ["English"],
    "English, (all with full audio support)": ["English"],
    "Not supported": [],
    "Spanish - Spain, Spanish - Latin America": ["Spanish - Spain", "Spanish - Latin America"],
    "English, English*": ["English", "English"],
    "English[b]*[/b], Thai": ["English", "Thai"],
}


def test_clean_labels(spark):
    assert values(spark, list(LANGUAGES), C.clean_labels) == list(LANGUAGES.values())
    assert values(spark, [None], C.clean_labels) == [None]


def test_canonical_label(spark):
    texts = ["Spanish - Latin America", "simplified CHINESE", "Heew", "French, English", None]
    expected = ["Spanish", "Chinese", "Heew", "English", None]
    assert values(spark, texts, C.canonical_label) == expected


TAGS = {
    """{'Action': 5, "1980's": 10, "Shoot 'Em Up": 3}""":
        [("Action", 5), ("1980s", 10), ("Shoot  Em Up", 3)],
    """{"a": 1, "b": 3, "a": 2}""": [("a", 2), ("b", 3)],
    """{'One': 1}""": [("One", 1)],
    "{}": [],
    """{"b": 1, "a": 2, "b": 3, "c": 4, "a": null, "b": 5}""": [("b", 5), ("a", None), ("c", 4)],
    """{'a': '7', 'b': 2.0, 'c': null}""": [("a", 7), ("b", 2), ("c", None)],
}


def test_weighted_entries(spark):
    found = values(
        spark, list(TAGS), lambda x: C.last_value_per_key(F.map_entries(C.parse_weighted(x)))
    )
    assert [[tuple(e) for e in cell] for cell in found] == list(TAGS.values())


@pytest.mark.parametrize(
    "text,bad",
    [(None, False), ("", False), ("[]", False), (" [] ", False), ("{}", False),
     ("{'Score 50': 1}", True), ("bad", True), ("{'a': 1}", False),
     ("[ ]", False), ("\n", False), ("\u3000", False), ('{"a": 1} x', True),
     ('{"a": 1},{"b": 2}', True), ('{"a": 2.9}', True), ('{"a": "x"}', True), ('{"a": {"b": 1}}', True), ('{"a": 1', True), ("[1]", True)],
)
def test_weighted_outcome(spark, text, bad):
    found = values(spark, [text], lambda x: C.weighted_is_bad(x, C.parse_weighted(x)))
    assert found == [bad]


def test_elapsed_text(spark):
    seconds = [0, 59, 3600, 86399, 86400, 273906]
    found = values(
        spark, [str(s) for s in seconds], lambda x: C.elapsed_text(x.cast("bigint"))
    )
    assert found == [
        f"{s // 86400}d {s % 86400 // 3600}h {s // 60 % 60}m {s % 60}s" for s in seconds
    ]

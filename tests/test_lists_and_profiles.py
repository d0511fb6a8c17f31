"""Long label lists and stored profiles."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from cataloom.constants import CANONICAL_LANGUAGES, CATEGORICAL_BELOW
from cataloom.functions import canonical_label
from cataloom.operators.explore import profile
from cataloom.operators.label_lists import canonical_labels, runs
from cataloom.operators.profiles import QUANTILES, TABLE, stored_profile, update_profiles
from cataloom.sources import snapshots

pytestmark = pytest.mark.usefixtures("small_jobs")


def brute(text, names):
    if text is None:
        return None
    return next((n for n in names if n.lower() in text.lower()), text)


def test_runs(spark):
    df = spark.createDataFrame([("abcab",), ("é😀",), ("",), (None,)], "t string")
    found = df.select(runs(F.col("t"), 3), runs(F.col("t"), 1)).collect()
    assert found[0][0] == ["abc", "bca", "cab"] and found[1][1] == ["é", "😀"]
    assert found[1][0] == [] and found[2][1] == []


@pytest.mark.parametrize("names", [["An", "a", "Bana", "XYZ"], ["q", ""], ["ban", "BAN", "na na"], []])
def test_short_and_empty_names(spark, names):
    texts = ["Banana", "an", "ab", "", None, "x", "NA NA", "Banana", "été a"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = {r["i"]: r["c"] for r in canonical_labels(df, "t", names, "c").collect()}
    assert found == {i: brute(t, names) for i, t in enumerate(texts)}


def test_agrees_with_the_case_expression(spark, rows):
    texts = [f"{n} - {w}" for n in CANONICAL_LANGUAGES for w in ("x", "ENGLISH", "")] + ["none of them", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    wanted = df.withColumn("c", canonical_label(F.col("t")))
    assert rows(canonical_labels(df, "t", CANONICAL_LANGUAGES, "c")) == rows(wanted)


def test_fifty_thousand_names(spark):
    draw = np.random.default_rng(0)
    syllables = [a + b for a in "bcdfghklmnprstvz" for b in "aeiou"]
    make = lambda k: "".join(draw.choice(syllables, k))
    names = list(dict.fromkeys(make(draw.integers(3, 7)) for _ in range(52_000)))[:50_000]
    # A name whose place is late is found only where no earlier one is.
    texts = [make(draw.integers(2, 12)).upper() for _ in range(2000)]
    texts += [f"{make(2)} {names[i]} {make(2)}" for i in range(0, 50_000, 100)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = {r["t"]: r["c"] for r in canonical_labels(df, "t", names, "c").collect()}
    lowered = [(n.lower(), n) for n in names]
    assert len(found) == len(set(texts))
    for t in draw.choice(texts, 300):
        low = t.lower()
        assert found[t] == next((n for lo, n in lowered if lo in low), t)


SCHEMA = "id bigint, few int, edge int, word string, day date, number double, nothing string, `a.b` int"


def write(spark, path, start, n):
    rows = [
        (i, i % 3, i % CATEGORICAL_BELOW, f"w{i % 4000}", dt.date(2020, 1, 1) + dt.timedelta(i % 9),
         None if i % 5 == 0 else i / 7, None, 1)
        for i in range(start, start + n)
    ]
    spark.createDataFrame(rows, SCHEMA).repartition(2).write.mode("append").parquet(path)


def test_profiles_are_brought_up_to_date(spark, tmp_path):
    path, root = str(tmp_path / "table é"), str(tmp_path / "profiles")
    write(spark, path, 0, 6000)
    assert update_profiles(spark, path, root) == 2
    assert update_profiles(spark, path, root) == 0
    write(spark, path, 6000, 14000)
    assert update_profiles(spark, path, root) == 2
    assert snapshots.current(spark, root).tables[TABLE].rows == 4
    exact = {r["column"]: r for r in profile(spark.read.parquet(path)).collect()}
    found = {r["column"]: r for r in stored_profile(spark, root).collect()}
    assert list(found) == list(exact)
    for name, r in found.items():
        e = exact[name]
        assert (r["kind"], r["min"], r["max"], r["step"]) == (e["kind"], e["min"], e["max"], e["step"])
        assert abs(r["n_distinct"] - e["n_distinct"]) <= 0.05 * e["n_distinct"]
        assert not r["exact"] or r["n_distinct"] == e["n_distinct"]
    assert found["few"]["exact"] and found["edge"]["exact"] and not found["id"]["exact"]
    assert (found["number"]["num_nulls"], found["nothing"]["num_nulls"]) == (4000, 20000)
    for q, v in zip(QUANTILES, found["id"]["quantiles"], strict=True):
        assert abs(v / 20000 - q) <= 0.02
    assert found["word"]["quantiles"] is None


def test_files_that_are_gone_do_not_count(spark, tmp_path):
    path, root = tmp_path / "table", str(tmp_path / "profiles")
    write(spark, str(path / "part=1"), 0, 100)
    write(spark, str(path / "part=2"), 100, 100)
    update_profiles(spark, f"{path}/*", root)
    before = {r["column"]: r["max"] for r in stored_profile(spark, root).collect()}
    (path / "part=2").rename(tmp_path / "away")
    assert update_profiles(spark, f"{path}/*", root) == 0
    after = {r["column"]: r["max"] for r in stored_profile(spark, root).collect()}
    assert (before["id"], after["id"]) == ("199", "99")


def test_an_update_reads_new_files_only(spark, tmp_path):
    path, root = str(tmp_path / "table"), str(tmp_path / "profiles")
    write(spark, path, 0, 100)
    update_profiles(spark, path, root)
    # An old file that cannot be read any more does no harm.
    for file in (tmp_path / "table").glob("part-*.parquet"):
        stat = file.stat()
        file.write_bytes(b"x" * stat.st_size)
        import os

        os.utime(file, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    write(spark, path, 100, 50)
    schema = spark.createDataFrame([], SCHEMA).schema
    assert update_profiles(spark, path, root, schema) == 2

"""CSV files shared by tasks against the scan that reads each file in one task."""

import csv

import numpy as np
import pytest
from pyspark.sql import types as T

from cataloom.schemas import CORRUPT
from cataloom.sources.raw_csv import split_raw_csv
from cataloom.sources.split_csv import records, split_csv, split_states, _lines

pytestmark = pytest.mark.usefixtures("small_jobs")

TEXT = T.StructType([T.StructField(n, T.StringType()) for n in ("a", "c", "b")])


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "300")
    spark.conf.set(names[1], "1")
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def write(path, rows, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as out:
        csv.writer(out, lineterminator=end).writerows([("a", "b", "c"), *rows])


def cells(seed, n):
    draw = np.random.default_rng(seed)
    parts = ["x", "é😀", "\n", "\n\n", '"', '""', ",", " ", "NA", "word " * 9, "\n" * 5, "1"]
    make = lambda: "".join(draw.choice(parts, draw.integers(0, 5)))
    return [(f"r{i}", make(), make()) for i in range(n)]


def same(spark, path, schema=TEXT):
    ours, lost = split_csv(spark, path, schema)
    theirs, their_lost = split_raw_csv(spark, path, schema)
    in_order = lambda df: [tuple(r)[1:] for r in df.orderBy("row_seq").collect()]
    assert in_order(ours) == in_order(theirs)
    assert in_order(lost) == in_order(their_lost)
    assert ours.columns == theirs.columns
    return ours


@pytest.mark.parametrize("seed", range(2))
def test_one_file_in_many_splits(spark, tmp_path, small_splits, seed):
    write(tmp_path / "one.csv", cells(seed, 200))
    ours = same(spark, str(tmp_path))
    assert ours.count() == 200
    assert split_states(_lines(spark, str(tmp_path))).count() > 20
    # Numbers are those of the places in the file, the header being 0.
    assert sorted(r["row_seq"] for r in ours.select("row_seq").collect()) == list(range(1, 201))


def test_records_longer_than_splits(spark, tmp_path, small_splits):
    long = [("a1", "x\n" * 900, "y"), ("a2", "", "z" * 2000), ("a3", '"\n,"' * 400, "\n" * 900)]
    write(tmp_path / "one.csv", [*long, ("a4", "1", "2"), *long])
    assert same(spark, str(tmp_path)).count() == 7


def test_files_keep_their_order(spark, tmp_path, small_splits):
    for number in range(3):
        write(tmp_path / f"part {number} é%20.csv", cells(number, 5 + 40 * number))
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "part 9.csv").write_text("a,b,c\n")
    assert same(spark, str(tmp_path)).count() == 15 + 120


def test_line_ends_and_empty_lines(spark, tmp_path, small_splits):
    write(tmp_path / "one.csv", [("a1", "x", "y"), ("a2", "p q", "r" * 100)], "\r\n")
    assert same(spark, str(tmp_path)).count() == 2
    (tmp_path / "one.csv").write_text('a,b,c\n\n1,2,3\n\n\n4,"\n\n",6\n\n')
    assert same(spark, str(tmp_path)).count() == 2
    (tmp_path / "one.csv").write_text('a,b,c\n1,"2\n2",3')  # no line end after the last record
    assert same(spark, str(tmp_path)).count() == 1


def test_rejected_lines_and_types(spark, tmp_path, small_splits):
    rows = [("1", "x", "y"), ("2", "x"), ("3", "line\nbreak", "y", "more"), ("four", "x", "y\n")] * 8
    write(tmp_path / "one.csv", rows)
    same(spark, str(tmp_path))
    typed = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("c", T.StringType())])
    same(spark, str(tmp_path), typed)
    good, rejected = split_csv(spark, str(tmp_path), typed)
    assert good.count() == 8 and rejected.columns == ["row_seq", CORRUPT] and rejected.count() == 24


def test_what_cannot_be_read_is_an_error(spark, tmp_path, small_splits):
    path = tmp_path / "one.csv"
    path.write_text('a,b,c\n1,"2,3\n4,5,6\n')
    with pytest.raises(ValueError, match="odd number of quotes"):
        split_csv(spark, str(tmp_path), TEXT)
    path.write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="no column c"):
        split_csv(spark, str(tmp_path), TEXT)
    path.write_text("a,b,c\n1,2,3\n")
    (tmp_path / "two.csv").write_text("a,c,b\n1,2,3\n")
    with pytest.raises(ValueError, match="different headers"):
        split_csv(spark, str(tmp_path), TEXT)


def test_more_splits_than_are_broadcast(spark, tmp_path, small_splits, monkeypatch):
    write(tmp_path / "one.csv", cells(4, 60))
    monkeypatch.setattr("cataloom.operators.sizes.BROADCAST_ROWS", 3)
    assert same(spark, str(tmp_path)).count() == 60
    assert records(spark, str(tmp_path)).where("is_header").count() == 1

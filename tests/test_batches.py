"""Batches that are put twice, cut short, or put by two writers."""

import threading

import pytest

from cataloom.operators.ids import batch_progress, with_batch
from cataloom.sources import batches, versions

pytestmark = pytest.mark.usefixtures("small_jobs")

FIELDS = ("appid", "name", "absent")


def details(spark, *rows):
    return spark.createDataFrame(rows, "row_seq int, batch_id int, appid int, name string, more int")


def kept(spark, root):
    found = batches.read_batches(spark, root, FIELDS).collect()
    return sorted((r["batch_id"], r["appid"], r["name"], r["absent"]) for r in found)


def test_a_batch_put_twice_is_there_once(spark, tmp_path):
    root = str(tmp_path / "a b")
    assert kept(spark, root) == [] and batches.restart_position(spark, root) == 0
    both = details(spark, (0, 0, 5, "a", 1), (1, 0, 6, None, 1), (2, 1, 7, "c", 1))
    for version in range(3):
        assert batches.put_batches(both, root, FIELDS) == version
    whole = [(0, "5", "a", None), (0, "6", None, None), (1, "7", "c", None)]
    assert batches.read_batches(spark, root, FIELDS).columns == [*FIELDS, "batch_id"]
    assert sorted(kept(spark, root), key=repr) == sorted(whole, key=repr)
    # A batch put again with other rows replaces itself and no other.
    batches.put_batches(details(spark, (2, 1, 8, "d", 1)), root, FIELDS)
    assert (1, "8", "d", None) in kept(spark, root) and len(kept(spark, root)) == 3


def test_a_batch_cut_short_is_not_there(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    batches.put_batches(details(spark, (0, 0, 5, "a", 1)), root, FIELDS)

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(versions, "commit", fails)
        with pytest.raises(RuntimeError):
            batches.put_batches(details(spark, (1, 1, 6, "b", 1)), root, FIELDS)
    assert kept(spark, root) == [(0, "5", "a", None)]
    assert batches.restart_position(spark, root, 0, 1) == 1
    with pytest.raises(ValueError, match="without a batch_id"):
        batches.put_batches(details(spark, (1, None, 6, "b", 1)), root, FIELDS)
    assert len(kept(spark, root)) == 1


def test_progress_and_the_place_to_begin_again(spark, tmp_path, rows):
    root = str(tmp_path)
    raw = details(spark, *[(i, None, i, "n", 0) for i in range(100, 123)]).drop("batch_id")
    work = with_batch(raw, "row_seq", 100, 5)
    for number in (0, 1, 4):
        part = work.where(f"batch_id = {number}")
        batches.put_batches(part, root, FIELDS, position="row_seq")
    found = rows(batches.progress(spark, root, 100))
    assert found == rows(batch_progress(work.where("batch_id IN (0, 1, 4)"), "row_seq", 100))
    assert found == [(0, 5, 5), (1, 5, 10), (4, 3, 23)]
    assert batches.restart_position(spark, root, 100, 5) == 110
    # A batch without usable rows is done too.
    batches.put_batches(work.limit(0), root, FIELDS, position="row_seq", numbers=[2])
    assert batches.restart_position(spark, root, 100, 5) == 115
    batches.put_batches(work.where("batch_id = 3"), root, FIELDS, numbers=[3])
    assert batches.restart_position(spark, root, 100, 5) == 125
    assert len(kept(spark, root)) == 18
    assert {r["batch"]: r["num_rows"] for r in batches.ledger(spark, root).collect()} == {
        0: 5, 1: 5, 2: 0, 3: 5, 4: 3
    }


def test_two_writers_both_get_in(spark, tmp_path):
    root = str(tmp_path)

    def put(number):
        batches.put_batches(details(spark, (number, number, number, "n", 0)), root, FIELDS)

    threads = [threading.Thread(target=put, args=(n,)) for n in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert [r[0] for r in kept(spark, root)] == [0, 1, 2, 3]
    assert versions.newest(spark, root) == 3

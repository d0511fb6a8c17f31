import hashlib
import random

import pyarrow as pa
import pytest
import zstandard

from cataloom.llm import warc

ROWS = "page_id bigint, url string, html string, id string, sha1 int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], ROWS)


def expected(rows, least):
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    kept = {}
    for id_, _, text in rows:
        if id_ is not None:
            kept[sha(text)] = max(kept.get(sha(text), id_), id_)
    out = []
    for id_, _, text in rows:
        size = len((text or "").encode())
        of = kept.get(sha(text))
        revisit = size >= least and of is not None and of != id_
        out.append(
            (str(id_), size, sha(text), "revisit" if revisit else "response", str(of) if revisit else None)
        )
    return sorted(out, key=repr)


CASES = [
    (1, "http://a/1", "x" * 50),
    (2, "http://a/2", "x" * 50),
    (3, None, None),
    (4, "", ""),
    (5, "http://a/5 \r\n b", "ü\r\n\r\nWARC/1.1" * 300),
    (6, "http://a/6", "y" * 1000),
    (7, "http://a/7", "y" * 1000),
    (9, "http://a/9", "y" * 1000),
    (10, "http://a/10", "y" * 999),
    (11, "http://a/11", "y" * 999),
    (12, "http://a/12", "é" * 300000),
    (9, "http://a/9", "y" * 1000),
    (None, "http://a/0", "y" * 1000),
]


def test_round_trip(spark, rows, monkeypatch):
    back = warc.archive(pages(spark, CASES).repartition(3))
    found = rows(back.select("page", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    assert found == expected(CASES, 1000)
    texts = {str(i): (t or "").encode() for i, _, t in CASES}
    for r in back.collect():
        stored = bytes(r["payload"])
        assert stored == (b"" if r["record_type"] == "revisit" else texts[r["page"]])


def test_bundles_are_whole_archives(spark, tmp_path):
    path = str(tmp_path / "archive")
    index = warc.write(pages(spark, CASES), path).collect()
    files = {p.name: p.read_bytes() for p in (tmp_path / "archive").iterdir()}
    assert {r["bundle"] for r in index} == set(files)
    ids = []
    for content in files.values():
        plain = zstandard.ZstdDecompressor().stream_reader(content, read_across_frames=True).read()
        at = 0
        while at < len(plain):
            fields, _, at = warc.parse(plain, at)
            ids.append(fields["x-page-id"])
    assert sorted(ids) == sorted(str(i) for i, _, _ in CASES)


def test_frames_are_found_by_the_seek_table():
    rnd = random.Random(1)
    parts = [rnd.randbytes(rnd.choice([10, 5000, warc.FRAME_BYTES + 9])) for _ in range(120)]
    bundle = warc.Bundle()
    places = [bundle.add(p) for p in parts]
    reader = warc.Reader(pa.BufferReader(bundle.close()))
    assert len(reader) == places[-1][0] + 1 > 3
    for (frame, offset), part in rnd.sample(list(zip(places, parts, strict=True)), 60):
        assert reader.frame(frame)[offset : offset + len(part)] == part


def test_damage_is_an_error():
    with pytest.raises(ValueError):
        warc.Reader(pa.BufferReader(b"no bundle at all"))
    with pytest.raises(ValueError):
        warc.parse(b"HTTP/1.1 200\r\n\r\n")
    bad = warc.record("1", "u", b"abc", hashlib.sha1(b"abd").digest(), None)
    with pytest.raises(ValueError):
        warc._row(bad, 0, "1", True)
    with pytest.raises(ValueError):
        warc._row(bad, 0, "2", True)


def test_no_pages(spark):
    assert warc.archive(pages(spark, [])).count() == 0


def test_reading_is_dealt_by_bundles(spark, tmp_path):
    pages = spark.createDataFrame(
        [(i, f"http://h/{i}", f"page {i}") for i in range(60)], "page_id bigint, url string, html string"
    )
    index = warc.write(pages.repartition(12), str(tmp_path))
    bundles = index.select("bundle").distinct().count()
    back = warc.read(str(tmp_path), index)
    assert bundles == 12 and back.rdd.getNumPartitions() == 12
    assert back.count() == 60

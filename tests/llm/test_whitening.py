"""Whitening against plain whole-number and double arithmetic."""

from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cataloom.llm.queries import QUERIES
from cataloom.llm.whitening import Settings, centred, squares, whiten

ROWS = "vec_id bigint, embedding array<float>, id string, x int, n string, a int"


def brute(vectors, components=16):
    """{position: (n, deviation, whitened, explained)} of the vectors of one length."""
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors]
    fit = sorted({tuple(v) for v in x})
    n, d = len(fit), len(x[0])
    sums = [sum(v[i] for v in fit) for i in range(d)]
    y = [[n * v[i] - sums[i] for i in range(d)] for v in fit]
    v = np.array(
        [[float(Fraction(sum(r[i] * r[j] for r in y), n**3)) for j in range(d)] for i in range(d)]
    )
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    out = []
    for row in x:
        away = [n * row[i] - sums[i] for i in range(d)]
        white = (np.array([float(Fraction(a, n)) for a in away]) @ axes) / np.sqrt(values)
        out.append((n, sum(a * a for a in away), white, values / np.trace(v)))
    return out


def check(found, vectors, ids):
    wanted = dict(zip(ids, brute(vectors), strict=True))
    by_id: dict = {}
    for r in found:
        by_id.setdefault(r["vec_id"], {})[r["component"]] = r
    assert set(by_id) == set(wanted)
    signs: dict = {}
    for i, (n, deviation, white, explained) in wanted.items():
        assert sorted(by_id[i]) == list(range(1, len(white) + 1))
        for k, r in by_id[i].items():
            assert (r["n"], int(r["deviation"])) == (n, deviation)
            assert r["explained"] == pytest.approx(explained[k - 1], rel=1e-9)
            assert r["identity_error"] < 1e-9
            if abs(white[k - 1]) > 1e-6:
                sign = signs.setdefault(k, np.sign(white[k - 1] * r["whitened"]))
                assert r["whitened"] == pytest.approx(sign * white[k - 1], rel=1e-7, abs=1e-9)


def test_query_agrees_with_plain_arithmetic(spark):
    d = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{d}/embeddings.parquet").collect()
    found = QUERIES["op13_polarised_whitening"](spark, d).collect()
    check(found, [r["embedding"] for r in rows], [r["vec_id"] for r in rows])


def test_nulls_copies_lengths_and_clashing_columns(spark):
    draw = np.random.default_rng(1)
    longer, shorter = draw.normal(size=(30, 5)).tolist(), draw.normal(size=(9, 3)).tolist()
    vectors = [*longer, longer[0], longer[0], *shorter]
    data = [(i, v, "a", 1, "b", 2) for i, v in enumerate(vectors)]
    bad = [None, [], [1.0, None, 1.0], [float("nan")] * 3, [1.0, float("inf"), 2.0]]
    data += [(900 + i, v, "a", 1, "b", 2) for i, v in enumerate(bad)]
    found = whiten(spark.createDataFrame(data, ROWS).repartition(5)).collect()
    check([r for r in found if r["vec_id"] < 32], vectors[:32], range(32))
    check([r for r in found if r["vec_id"] >= 32], vectors[32:], range(32, 41))
    nameless = spark.createDataFrame([(None, *r[1:]) for r in data], ROWS)
    assert whiten(nameless).where("vec_id IS NULL").count() == len(found)


def test_components_without_variance_give_no_rows(spark):
    flat = [(i, [float(i), 2.0 * i, 7.0], "a", 1, "b", 2) for i in range(12)]
    found = whiten(spark.createDataFrame(flat, ROWS)).collect()
    assert {r["component"] for r in found} == {1} and len(found) == 12
    assert found[0]["explained"] == pytest.approx(1)
    assert whiten(spark.createDataFrame(flat[:1] * 3, ROWS)).count() == 0
    empty = whiten(spark.createDataFrame([], ROWS))
    assert empty.count() == 0 and empty.columns[0] == "vec_id"


def test_fewer_components_and_other_names(spark):
    draw = np.random.default_rng(2).normal(size=(40, 6)).tolist()
    rows = spark.createDataFrame([(f"r{i}", v) for i, v in enumerate(draw)], "name string, v array<double>")
    found = whiten(rows, Settings(components=2), "name", "v")
    assert found.columns[0] == "name" and found.count() == 80


def test_entries_too_large_fail(spark):
    rows = spark.createDataFrame([(1, [1e15]), (2, [0.0])], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="too large to be whitened"):
        whiten(rows).collect()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-(2**45), 2**45), min_size=1, max_size=40), st.sampled_from([0, 20, 40]))
def test_squares_are_exact(values, shift):
    z = np.array([v >> shift for v in values], np.int64)[:, None]
    assert squares(z) == [sum(int(v) ** 2 for v in z[:, 0])]


def test_centred_values_beyond_64_bits():
    x, n = np.array([[2**39], [-(2**39)]], np.int64), 2**30
    y = centred(x, n, [5])
    assert [int(v) for v in y[:, 0]] == [n * 2**39 - 5, -n * 2**39 - 5]
    assert squares(y) == [sum(int(v) ** 2 for v in y[:, 0])]

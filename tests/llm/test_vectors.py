import math

import numpy as np
import pytest

from cataloom.llm import near_vectors, neighbours, vectors

ROWS = "vec_id bigint, embedding array<float>, label int, node string, id int, vector int"
INF, NAN = math.inf, math.nan


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 1, 1) for i, v in rows], ROWS)


def odd_rows(first, width):
    return [
        (first, None),
        (first + 1, [0.0] * width),
        (first + 2, [None] + [1.0] * (width - 1)),
        (first + 3, [INF] + [1.0] * (width - 1)),
        (first + 4, [NAN] + [1.0] * (width - 1)),
        (first + 5, []),
        (first + 6, [1.0]),
    ]


def fine(rows, width):
    return [
        (i, np.array(v, np.float64))
        for i, v in rows
        if v and len(v) == width and None not in v and np.isfinite(v).all() and any(v)
    ]


def brute_links(rows, width):
    good = fine(rows, width)
    unit = np.array([v / np.linalg.norm(v) for _, v in good])
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    low = np.array([i for i, _ in good])
    while True:
        now = np.array([min(low[k], low[n].min(initial=low[k])) for k, n in enumerate(near)])
        if (now == low).all():
            break
        low = now
    found = {i: (int(n.sum()), int(c)) for (i, _), n, c in zip(good, near, low, strict=True)}
    return sorted((i, *found.get(i, (0, i)), found.get(i, (0, i))[1] == i) for i, _ in rows)


def clustered(seed, n, width, spread):
    random_ = np.random.default_rng(seed)
    centres = random_.standard_normal((n, width))
    rows = []
    for centre in centres:
        for _ in range(int(random_.integers(1, 6))):
            rows.append((centre + spread * random_.standard_normal(width)).astype(np.float32))
        rows += [rows[-1]] * int(random_.integers(0, 3))
    rows += [(3 * rows[0]).astype(np.float32)]
    order = random_.permutation(len(rows))
    return [(int(i), rows[k].tolist()) for i, k in enumerate(order)]


@pytest.mark.parametrize("width", [64, 48, 3])
def test_near_duplicates_agree_with_brute_force(spark, rows, width):
    data = clustered(1, 60, width, 0.25) + odd_rows(9000, width)
    found = near_vectors.linked(frame(spark, data).repartition(3))
    assert rows(found) == sorted(brute_links(data, width), key=repr)


def test_one_large_group_in_many_cells(spark, rows):
    random_ = np.random.default_rng(2)
    centre = random_.standard_normal(32)
    data = [
        (i, (centre + 0.2 * random_.standard_normal(32)).astype(np.float32).tolist())
        for i in range(500)
    ]
    settings = near_vectors.Settings(cell=64, slot=300)
    found = near_vectors.linked(frame(spark, data), settings)
    assert rows(found) == sorted(brute_links(data, 32), key=repr)


def test_no_vectors(spark, rows):
    assert rows(near_vectors.linked(frame(spark, []))) == []
    data = odd_rows(1, 4)[:6]
    assert rows(near_vectors.linked(frame(spark, data))) == [(i, 0, i, True) for i, _ in data]
    assert neighbours.nearest(frame(spark, data)).count() == 0
    assert neighbours.nearest(frame(spark, [])).count() == 0


def test_hadamard_rotations_keep_inner_products():
    random_ = np.random.default_rng(3)
    rows = random_.standard_normal((9, 20))
    turned = vectors.rotated(rows, seed=5)
    assert turned.shape == (9, 64) and np.allclose(turned @ turned.T, rows @ rows.T)


def brute_nearest(rows, width, k, asked):
    good = fine(rows, width)
    found = {}
    for i, v in good:
        if asked(i):
            near = sorted((-float((v * w).sum()), j) for j, w in good if j != i)[:k]
            found[i] = [(j, -s) for s, j in near]
    return found


def result(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(found[r["query_id"]])
    return found


def test_all_lists_and_no_doubt_are_exact(spark):
    data = clustered(4, 150, 16, 0.4) + odd_rows(9000, 16)
    settings = neighbours.Settings(list_rows=20, probed=1.0, doubt=99.0, cell=64, block=5, bounding=50)
    asked = frame(spark, data).where("vec_id % 7 = 0")
    found = result(neighbours.nearest(frame(spark, data), 10, settings, asked))
    expected = brute_nearest(data, 16, 10, lambda i: i % 7 == 0)
    assert found.keys() == expected.keys()
    for i, near in expected.items():
        assert [j for j, _ in found[i]] == [j for j, _ in near]
        assert [s for _, s in found[i]] == pytest.approx([s for _, s in near], abs=1e-12)


def test_lengths_differ_and_few_candidates(spark):
    data = [(i, [float(i + 1), float(-i)]) for i in range(5)]
    found = result(neighbours.nearest(frame(spark, data), 20))
    expected = brute_nearest(data, 2, 20, lambda i: True)
    assert {i: [j for j, _ in n] for i, n in found.items()} == {
        i: [j for j, _ in n] for i, n in expected.items()
    }


def test_repeated_ids(spark):
    data = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.0]), (None, [3.0, 0.0])]
    assert result(neighbours.nearest(frame(spark, data), 5)) == {1: [(2, 0.5)], 2: [(1, 0.5)]}


def test_recall_on_given_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    data = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    found = result(neighbours.nearest(table, 20, queries=table.where("vec_id % 20 = 0")))
    expected = brute_nearest(data, len(data[0][1]), 20, lambda i: i % 20 == 0)
    hits = sum(len({j for j, _ in found[i]} & {j for j, _ in near}) for i, near in expected.items())
    assert all(len(found[i]) == 20 for i in expected)
    assert hits >= 0.9 * 20 * len(expected)


def test_near_duplicates_of_several_lengths(spark, rows):
    groups = [(0, clustered(6, 20, 64, 0.2)), (1000, clustered(7, 20, 5, 0.2)), (2000, [(0, [2.0]), (1, [3.0]), (2, [-1.0])])]
    data = [[(first + i, v) for i, v in some] for first, some in groups]
    found = near_vectors.linked(frame(spark, sum(data, [])).repartition(5))
    wanted = sum((brute_links(d, len(d[0][1])) for d in data), [])
    assert rows(found) == sorted(wanted, key=repr)
    assert {r[1] for r in wanted if r[0] >= 2000} == {0, 1}


def test_nearest_of_several_lengths(spark):
    settings = neighbours.Settings(list_rows=20, probed=1.0, doubt=99.0, cell=64, block=5)
    data = [[(n + i, v) for i, v in clustered(n, 40, width, 0.4)] for n, width in ((1, 8), (1000, 3), (2000, 64))]
    data.append([(3000, [1.0, 2.0])])  # a query with no candidate
    every = frame(spark, sum(data, []))
    found = result(neighbours.nearest(every, 6, settings, every.where("vec_id % 5 = 0")))
    wanted = {}
    for some in data:
        wanted |= brute_nearest(some, len(some[0][1]), 6, lambda i: i % 5 == 0)
    assert {i: [j for j, _ in n] for i, n in found.items()} == {
        i: [j for j, _ in n] for i, n in wanted.items() if n
    }


def test_the_sample_is_bounded(spark):
    data = spark.range(40_000).selectExpr("id", "array(double(id % 977), double(id % 13) + 1, 1D) AS vector")
    index = neighbours.fit(data, 3, neighbours.Settings(sample=500, bounding=100, list_rows=4000))
    assert index.sample.shape == (100, 3) and len(index.centres) == 10

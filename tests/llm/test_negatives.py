"""Hard negatives against a search through all rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cataloom.llm.negatives import Range, Segment, Settings, mine, pack, search

ROWS = "vec_id bigint, embedding array<double>, label int, id int, x string, part int, score string"
SMALL = Settings(scale=4, segment=15, segments=2, anchors=10, first=2)


def brute(rows, asked, s):
    """rows: (id, vector, label); sorted result."""
    fine = {}
    for i, v, label in rows:
        if i is None or label is None or v is None:
            continue
        if any(c is None or not math.isfinite(c) for c in v):
            continue
        key, x = (i, str(label), len(v)), [math.floor(s.scale * c) for c in v]
        fine[key] = min(fine.get(key, x), x)
    out = []
    for (i, label, size), a in fine.items():
        if not asked(i):
            continue
        scored = sorted(
            (-sum(p * q for p, q in zip(a, x, strict=True)), j, other)
            for (j, other, length), x in fine.items()
            if length == size
        )
        near = [(j, -t) for t, j, other in scored if other == label and j != i][: s.positives]
        for j, p in near:
            hard = [(k, -t) for t, k, o in scored if o != label and s.low * p <= -100 * t <= s.high * p]
            out += [(i, j, n + 1, k, p, t) for n, (k, t) in enumerate(hard[: s.negatives])]
    return sorted(out, key=repr)


def made(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "a", 2, "b") for i, v, label in rows], ROWS)


@pytest.mark.parametrize("seed", range(2))
def test_ties_repeats_and_signs(spark, rows, seed):
    draw = np.random.default_rng(seed)
    # Few different entries, so that scores tie; some labels are rare.
    data = [
        (int(i), (draw.integers(-2, 4, 3) / 4).tolist(), int(label))
        for i, label in enumerate(draw.choice([0, 0, 0, 0, 1, 1, 2, 3], 120))
    ]
    data += data[:20] + [(5, [1.0, 1.0, 1.0], 3), (5, [0.5, 0.5, 0.5], data[5][2])]
    found = mine(made(spark, data).repartition(6), F.col("vec_id") % 5 == 0, SMALL)
    assert rows(found) == brute(data, lambda i: i % 5 == 0, SMALL)


def test_nulls_lengths_and_zero_vectors(spark, rows):
    draw = np.random.default_rng(9)
    data = [(i, draw.normal(size=2 + i % 3).tolist(), i % 2) for i in range(60)]
    data += [(60, None, 1), (61, [None, 1.0], 1), (62, [math.nan, 1.0], 1), (63, [1.0, math.inf], 1)]
    data += [(64, [1.0, 1.0], None), (None, [1.0, 1.0], 1), (65, [0.0, 0.0], 1), (66, [0.0, 0.0], 0)]
    data += [(67, [0.0, 0.0], 0), (68, [], 1), (69, [], 1), (70, [], 0)]
    assert rows(mine(made(spark, data), settings=SMALL)) == brute(data, lambda i: True, SMALL)


def test_anchors_without_partners_and_empty_tables(spark):
    alone = [(0, [1.0, 2.0], 1), (50, [1.0, 2.0], 2)]
    assert mine(made(spark, alone)).count() == 0
    empty = mine(made(spark, alone).limit(0), F.col("vec_id") % 50 == 0)
    assert empty.count() == 0
    assert empty.columns[:4] == ["anchor_id", "positive_id", "rank", "negative_id"]
    assert mine(made(spark, alone), F.lit(None).cast("boolean")).count() == 0


def test_entries_beyond_doubles_are_exact(spark, rows):
    s = Settings(scale=1, segment=7, first=2)
    draw = np.random.default_rng(3)
    data = [(i, (draw.integers(1, 2**20, 2) * 1024.0 + 2**29).tolist(), i % 3) for i in range(30)]
    assert rows(mine(made(spark, data), F.col("vec_id") < 6, s)) == brute(data, lambda i: i < 6, s)
    huge = made(spark, [(0, [1e300], 1), (1, [1.0], 1)])
    with pytest.raises(Exception, match="too large"):
        mine(huge).collect()


def segment_of(x, labels):
    import pyarrow as pa

    n = len(x)
    table = pa.table(
        {
            "dimension": pa.array([x.shape[1]] * n, pa.int32()),
            "label": [""] * n,
            "part": pa.array([0] * n, pa.int32()),
            "id": list(range(n)),
            "of": labels,
            "x": pa.array(x.tolist(), pa.list_(pa.int64())),
        }
    )
    return Segment(pack(table).to_pylist()[0])


def test_reading_stops_where_the_threshold_falls_below_the_windows():
    draw = np.random.default_rng(5)
    x = draw.integers(-20, 20, (4000, 4))
    x[:5] = [100, 100, 100, 100]
    segment = segment_of(x, ["a"] * len(x))
    best = Range(-np.inf, np.inf, 3)
    depth = search(np.array([1, 1, 1, 1]), segment, [best], np.ones(len(x), bool), 8)
    assert depth == 8
    assert best.best == [(-400, 0, "a"), (-400, 1, "a"), (-400, 2, "a")]
    # A window above all rows is left at once; one with too few rows is read to its lower end.
    assert search(np.array([1, 1, 1, 1]), segment, [Range(401, 500, 3)], np.ones(len(x), bool), 8) == 0
    narrow = Range(70, 399, 3)
    assert search(np.array([-1, 0, 0, 0]), segment, [narrow], np.ones(len(x), bool), 8) == 0
    equal = Range(-np.inf, np.inf, 3)
    same = segment_of(np.ones((50, 2), np.int64), ["a"] * 50)
    # Equal scores: nothing may be left unread.
    assert search(np.array([1, 2]), same, [equal], np.arange(50) >= 40, 8) == 50
    assert [i for _, i, _ in equal.best] == [40, 41, 42]

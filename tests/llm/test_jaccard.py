import random
import re
from collections import defaultdict

import numpy as np
import pytest

from cataloom.llm import graph, jaccard


def brute(rows):
    """{position: (number of shingles, least id of the component)}"""
    sets = []
    for _, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall("[^\x20\x09-\x0d]+", low)
        n = max(1, len(words) - 4) if words else 0
        sets.append({tuple(words[i : i + 5]) for i in range(n)})
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    places = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            places[x].append(i)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in places[x] if j > i}:
            both = len(s & sets[j])
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                parent[find(j)] = find(i)
    least = {}
    for i, (id_, _) in enumerate(rows):
        if id_ is not None:
            root = find(i)
            least[root] = min(least.get(root, id_), id_)
    return sorted(
        ((id_, len(sets[i]), least.get(find(i))) for i, (id_, _) in enumerate(rows)), key=repr
    )


def corpus(seed, families=25):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    passage = [rnd.choice(words) for _ in range(60)]
    texts = [None, "", "   ", "one", "One", "one two three four", "a b c d e", "A  b\tc\nd e"]
    for _ in range(families):
        base = [rnd.choice(words) for _ in range(rnd.choice([6, 20, 60, 150, 700]))]
        if rnd.random() < 0.5:
            base += passage
        for _ in range(rnd.choice([1, 2, 12])):
            copy = list(base)
            for _ in range(rnd.randint(0, 4)):
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            if rnd.random() < 0.3:
                copy = copy[: -rnd.randint(1, max(1, len(copy) // 6))]
            texts.append(" ".join(copy))
    texts += [texts[-1]] * 3
    ids = rnd.sample(range(10000), len(texts))
    return list(zip(ids, texts, strict=True))


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("rare", [1, 32])
def test_links_agree_with_brute_force(spark, rows, seed, rare, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK_DOCS", 7)
    data = corpus(seed)
    docs = spark.createDataFrame([(*r, "x", 1) for r in data], "doc_id bigint, text string, row string, size int")
    found = jaccard.join(docs.repartition(5), jaccard.Rule(rare=rare))
    assert rows(found) == brute(data)


def test_one_large_group_of_near_copies(spark, rows):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(500)]
    base = [rnd.choice(words) for _ in range(140)]
    data = []
    for i in range(400):
        copy = list(base)
        for _ in range(rnd.randint(0, 7)):
            copy[rnd.randrange(len(copy))] = f"own{rnd.random()}"
        data.append((i, " ".join(copy)))
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    assert rows(jaccard.join(docs)) == brute(data)


def test_no_rows_no_ids_and_repeated_rows(spark, rows):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert rows(jaccard.join(none)) == []
    data = [(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (None, "alone here")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    assert rows(jaccard.join(docs)) == sorted(
        [(None, 2, 4), (4, 2, 4), (4, 2, 4), (None, 1, None)], key=repr
    )


def test_blocks_and_very_long_words(monkeypatch):
    texts = [b"a bb  ccc\tdd e f " * 50, b"", b"x" * 5000 + b" y z", b"q " * 300]
    whole = jaccard.shingles(texts, 5)
    monkeypatch.setattr(jaccard, "BLOCK", 64)
    for a, b in zip(whole, jaccard.shingles(texts, 5), strict=True):
        assert np.array_equal(a, b)
    long_ = b"z" * (jaccard.LONG_WORD + 5)
    token, owner = jaccard.shingles([long_ + b" a", long_ + b" a", long_ + b"z a"], 5)
    assert len(set(token.tolist())) == 2 and owner.tolist().count(0) == 1


def test_linked_sets_share_a_key():
    random_ = np.random.default_rng(4)
    rule = jaccard.Rule()
    for size in [1, 3, 8, 30, 43, 44, 58, 60, 90, 118, 400, 1500]:
        for _ in range(30):
            pool = random_.choice(1 << 40, 2 * size + 4, replace=False).astype(np.uint64)
            n = size + int(random_.integers(0, size // 3 + 1))
            both = -(-75 * (size + n) // 175)
            if both > size or 100 * both < 75 * (size + n - both):
                continue
            counts = dict(zip(pool.tolist(), random_.integers(2, 90, len(pool)).tolist(), strict=True))
            shared, a, b = pool[:both], pool[both:size], pool[size : size + n - both]
            found = []
            for own, full in ((a, size), (b, n)):
                # What only one set has may or may not be in other documents.
                tokens = np.concatenate([shared, own[random_.random(len(own)) < 0.5]])
                of = np.array([counts[t] for t in tokens.tolist()])
                found.append(jaccard.signatures(tokens, of, full, rule)[0])
            assert len(np.intersect1d(*found)) > 0


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 9), (5, 5), (20, 11), (11, 30), (30, 12), (2, 1)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    found = {r["node"]: r["component"] for r in graph.components(df).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7, 11: 11, 12: 11, 20: 11, 30: 11}
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)], "a bigint, b bigint")
    assert {r["component"] for r in graph.components(chain).collect()} == {0}
    assert graph.components(df.limit(0)).count() == 0

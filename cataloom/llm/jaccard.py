"""Documents linked by the Jaccard similarity of their sets of word n-grams (shingles).

Link: shared shingles are at least 75 in 100 of all shingles of both. The search is exact and
has no caps. How it gets from texts to links:

1. Texts become sets of hashed shingles, in chunks of documents. A chunk sends each distinct
   shingle once to the shingle's part, with the document that has it, or only with its count
   if several do. So a shingle that every document has costs one entry per chunk.
2. Parts add up in how many documents a shingle is, and answer those in two or more. A
   document can only have a link if 75 in 100 of its shingles are answered; of all others
   nothing but the size is kept.
3. Documents equal in their sets stand in for each other: one of them goes on.
4. The index holds token combinations of prefixes. Shingles are ordered rarest first. Single
   shingles are indexed for the rare class, pairs for the frequent ones, which a hash deals
   into classes so that a pair is made of two shingles of one class. The prefix is extended
   until so many shingles would have to be missing to destroy all combinations that no linked
   document can miss them all: with n shingles of a class and combinations of k, that takes
   n - k + 1. Very short sets index single shingles only. The number of classes follows the
   size of the set in bands; near the border of a band a set is indexed under both, since a
   linked set can be on the other side of it.
5. Under each index key, all are compared with the key's document that has the fewest shingles
   of its own (of near copies, the least altered), then documents that are still in different
   components with each other. Links inside a component change nothing.
   Two sets are only compared if enough is left of both: the first shingle that they share is
   rare, and then a key whose own shingles from there on suffice for the overlap, or all their
   shared shingles must.

Shingles are compared by 48-bit hashes of their words: two of different text in one pair of
documents are taken as equal once in about 10^8 pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cataloom.llm.graph import components
from cataloom.storage import materialize

CHUNK_DOCS, CHUNK_BYTES = 4096, 4 << 20
BLOCK = 1 << 20  # bytes hashed at once
SEVERAL = 0xFFFF
LONG_WORD = 1 << 16
FIRST_BAND, CLASSES = 44, 32  # least set size of the first band with classes, and their number

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


@dataclass(frozen=True)
class Rule:
    words: int = 5
    percent: int = 75  # shared shingles in 100 of all of both
    rare: int = 32  # a shingle in at most so many documents is of the rare class

    def least(self, size):
        """Fewest shared shingles that a set of this size needs."""
        return -(-size * self.percent // 100)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits; one to one."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(_BASE))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of a block that ends with white space."""
    space = _SPACE[data]
    edge = np.diff(np.concatenate([[True], space]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    sizes = ends - starts
    longest = int(min(sizes.max(), LONG_WORD))
    powers = np.full(longest, _BASE | 1, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers)
    at = np.arange(len(data)) - np.repeat(
        np.concatenate([[0], starts]), np.diff(np.concatenate([[0], starts, [len(data)]]))
    )
    weighted = np.where(space, _U(0), _BYTE[data] * powers[np.minimum(at, longest - 1)])
    hashes = mix(np.add.reduceat(weighted, starts) + sizes.astype(np.uint64))
    for i in np.flatnonzero(sizes > LONG_WORD):
        word = data[starts[i] : ends[i]].tobytes()
        hashes[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return starts, hashes


def blocks(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Stretches of about ``BLOCK`` bytes that end with white space, as all of ``data`` does."""
    at = 0
    while at < len(data):
        end = at + BLOCK
        while end < len(data) and not (gap := _SPACE[data[end - 1 : end - 1 + BLOCK]]).any():
            end += BLOCK
        end = end + int(np.argmax(gap)) if end < len(data) else len(data)
        yield at, data[at:end]
        at = end


def shingles(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (shingle, text number) of all texts, ordered by shingle, then text."""
    data = np.frombuffer((b"\n".join(texts) + b"\n").translate(_LOWER), np.uint8)
    found = [(at + s, h) for at, part in blocks(data) for s, h in [word_hashes(part)]]
    starts, hashes = (np.concatenate(x) for x in zip(*found, strict=True))
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.uint16)
    lengths = np.array([len(t) + 1 for t in texts])
    owner = np.searchsorted(np.cumsum(lengths), starts, side="right")

    def joined(first: np.ndarray, n: int) -> np.ndarray:
        total = np.full(len(first), n, np.uint64)
        for j in range(n):
            total = mix(total * _U(_BASE | 1) + hashes[first + j])
        return total

    first = np.arange(max(0, len(hashes) - words + 1))
    first = first[owner[first] == owner[first + words - 1]]
    found, texts_of = [joined(first, words)], [owner[first]]
    counts = np.bincount(owner, minlength=len(texts))
    begin = np.concatenate([[0], np.cumsum(counts)])
    for n in range(1, words):
        short = np.flatnonzero(counts == n)
        found.append(joined(begin[short], n))
        texts_of.append(short)
    token = np.concatenate(found) >> _U(16)
    owner = np.concatenate(texts_of)
    order = np.lexsort((owner, token))
    token, owner = token[order], owner[order].astype(np.uint16)
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
    return token[new], owner[new]


def _pack(token: np.ndarray, owner: np.ndarray, counts: np.ndarray) -> bytes:
    """Tokens in order, so that their high bytes compress."""
    n = np.array([len(token)], "<u4").tobytes()
    high = (token >> _U(32)).astype(np.uint16)
    planes = [(high >> 8).astype(np.uint8), (high & 255).astype(np.uint8)]
    parts = [*planes, token.astype("<u4"), owner.astype("<u2"), counts.astype("<u4")]
    return n + b"".join(p.tobytes() for p in parts)


def _unpack(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, owners, and a count for each token whose owner is SEVERAL."""
    n = int(np.frombuffer(payload, "<u4", 1)[0])
    top = np.frombuffer(payload, np.uint8, n, 4).astype(np.uint64)
    mid = np.frombuffer(payload, np.uint8, n, 4 + n).astype(np.uint64)
    low = np.frombuffer(payload, "<u4", n, 4 + 2 * n).astype(np.uint64)
    owner = np.frombuffer(payload, "<u2", n, 4 + 6 * n)
    counts = np.frombuffer(payload, "<u4", -1, 4 + 8 * n)
    return (top << _U(40)) | (mid << _U(32)) | low, owner, counts


def _by_owner(token: np.ndarray, owner: np.ndarray, n: int) -> list[np.ndarray]:
    """The tokens of each of n owners, in their order."""
    order = np.argsort(owner, kind="stable")
    return np.split(token[order], np.cumsum(np.bincount(owner, minlength=n))[:-1])


def signatures(
    tokens: np.ndarray, counts: np.ndarray, size: int, rule: Rule
) -> tuple[np.ndarray, np.ndarray]:
    """Index keys of a set, and how many tokens it could share with a set that it first meets
    there; from its shared tokens, in how many documents each is, and its full size."""
    order = np.lexsort((tokens, counts))
    tokens, rare = tokens[order], counts[order] <= rule.rare
    missing = size - rule.least(size) - (size - len(tokens)) + 1  # tokens that must be kept off
    rest = len(tokens) - np.arange(len(tokens))
    keys, rests = [], []
    band = -1
    # A linked set is at most 100 / percent as large; bands double.
    while band < 0 or FIRST_BAND << band <= size:
        begin = 0 if band < 0 else FIRST_BAND << band
        if begin <= size and size * rule.percent < 100 * (FIRST_BAND << (band + 1)):
            salt = _U((band + 2) * _BASE & _MASK)
            if band < 0:
                keys.append(mix(tokens[:missing] + salt))
                rests.append(rest[:missing])
            else:
                classes = CLASSES << band
                kind = np.where(rare, -1, (mix(tokens) % _U(classes)).astype(np.int64))
                end = prefix_end(kind, missing)
                single = np.flatnonzero(kind[:end] < 0)
                keys.append(mix(tokens[single] + salt))
                rests.append(rest[single])
                pairs = pair_keys(tokens[:end], kind[:end], salt)
                keys.append(pairs)
                rests.append(np.full(len(pairs), len(tokens)))
        band += 1
    keys, first = np.unique(np.concatenate(keys), return_index=True)
    return keys, np.concatenate(rests)[first]


def prefix_end(kind: np.ndarray, missing: int) -> int:
    """How many tokens it takes until ``missing`` must be lost to destroy all combinations: a
    token counts unless it is the first of a frequent class."""
    first = np.zeros(len(kind), bool)
    frequent = np.flatnonzero(kind >= 0)
    first[frequent[np.unique(kind[frequent], return_index=True)[1]]] = True
    return int(np.searchsorted(np.cumsum(~first), missing)) + 1


def pair_keys(tokens: np.ndarray, kind: np.ndarray, salt: np.uint64) -> np.ndarray:
    """Keys of all pairs of tokens of one frequent class."""
    order = np.argsort(kind[kind >= 0], kind="stable")
    token, own = tokens[kind >= 0][order], kind[kind >= 0][order]
    keys = [np.empty(0, np.uint64)]
    gap = 1
    while gap < len(token):
        same = np.flatnonzero(own[gap:] == own[:-gap])
        if not len(same):
            break
        low = np.minimum(token[same], token[same + gap])
        high = np.maximum(token[same], token[same + gap])
        keys.append(mix(mix(low + salt) ^ (high * _U(_BASE | 1))))
        gap += 1
    return np.concatenate(keys)


def shared_shingles(
    docs: DataFrame, rule: Rule, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``row`` (a number), ``id``, ``size`` of its set, and if it may have
    a link: ``digest`` of the set, its shared ``tokens`` (48 bit), index ``keys``."""
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col).cast("binary"), F.lit(b"").cast("binary")).alias("text"),
    )
    kind = texts.schema["id"]
    sent = T.StructType(
        [
            *T.StructType.fromDDL("part bigint, chunk bigint, place int"),
            kind,
            *T.StructType.fromDDL("size bigint, digest binary, payload binary"),
        ]
    )

    def rows(part, chunk, place, ids, size, digest, payload) -> pa.RecordBatch:
        n = len(payload)
        same = lambda x: x if isinstance(x, (list, np.ndarray)) else [x] * n
        columns = [
            pa.array(same(part), pa.int64()),
            pa.array(same(chunk), pa.int64()),
            pa.array(same(place), pa.int32()),
            ids,
            pa.array(same(size), pa.int64()),
            pa.array(same(digest), pa.binary()),
            pa.array(payload, pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=sent.names)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                own, weight = [], 0
                while at + len(own) < batch.num_rows and len(own) < CHUNK_DOCS:
                    text = batch.column(1)[at + len(own)].as_py()
                    if own and weight + len(text) > CHUNK_BYTES:
                        break
                    own.append(text)
                    weight += len(text)
                yield from send_chunk(number, batch.column(0).slice(at, len(own)), own)
                number += 1
                at += len(own)

    def send_chunk(number: int, ids: pa.Array, own: list[bytes]) -> Iterator[pa.RecordBatch]:
        token, owner = shingles(own, rule.words)
        new = np.ones(len(token), bool)
        new[1:] = token[1:] != token[:-1]
        begin = np.flatnonzero(new)
        counts = np.diff(np.append(begin, len(token)))
        repeated = np.repeat(counts, counts) > 1
        sets = _by_owner(token, owner, len(own))
        several = _by_owner(token[repeated], owner[repeated], len(own))
        digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
        payload = [s.astype("<u8").tobytes() for s in several]
        to = [(number + i) % parts for i in range(len(own))]
        size = [len(s) for s in sets]
        yield rows(to, number, list(range(len(own))), ids, size, digests, payload)
        token, first = token[begin], owner[begin]
        first = np.where(counts > 1, SEVERAL, first)
        part = (token % _U(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        bounds = np.cumsum(np.bincount(part, minlength=parts))
        payload, to = [], []
        for p, (lo, hi) in enumerate(zip([0, *bounds[:-1]], bounds, strict=True)):
            if hi > lo:
                of = order[lo:hi]
                payload.append(_pack(token[of], first[of], counts[of][first[of] == SEVERAL]))
                to.append(p)
        yield rows(to, number, -1, pa.nulls(len(to), ids.type), None, None, payload)

    def answer(table: pa.Table) -> pa.Table:
        """Passes documents on; to each chunk its shingles that are in two documents or more."""
        place = table["place"].to_numpy()
        out = [table.filter(pa.array(place >= 0))]
        sent_ = table.filter(pa.array(place < 0))
        chunks = sent_["chunk"].to_pylist()
        got = [_unpack(p.as_py()) for p in sent_["payload"]]
        if got:
            token = np.concatenate([g[0] for g in got])
            owner = np.concatenate([g[1] for g in got])
            count = np.ones(len(token), np.int64)
            count[owner == SEVERAL] = np.concatenate([g[2] for g in got])
            source = np.repeat(np.arange(len(got)), [len(g[0]) for g in got])
            order = np.argsort(token, kind="stable")
            token, owner, count, source = (x[order] for x in (token, owner, count, source))
            begin = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
            total = np.add.reduceat(count, begin)
            total = np.repeat(total, np.diff(np.append(begin, len(token))))
            keep = total > 1
            token, owner, source, total = (x[keep] for x in (token, owner, source, total))
            order = np.argsort(source, kind="stable")
            bounds = np.cumsum(np.bincount(source, minlength=len(got)))
            payload, to = [], []
            for i, (lo, hi) in enumerate(zip([0, *bounds[:-1]], bounds, strict=True)):
                if hi > lo:
                    of = order[lo:hi]
                    payload.append(_pack(token[of], owner[of], np.minimum(total[of], 2**32 - 1)))
                    to.append(chunks[i])
            ids = pa.nulls(len(to), table["id"].type)
            out.append(pa.Table.from_batches([rows(0, to, -1, ids, None, None, payload)]))
        return pa.concat_tables(out)

    result = T.StructType(
        [
            T.StructField("row", T.LongType()),
            kind,
            *T.StructType.fromDDL(
                "size bigint, digest binary, tokens array<bigint>, keys array<bigint>, rests array<int>"
            ),
        ]
    )

    def finish(table: pa.Table) -> pa.Table:
        place = table["place"].to_numpy()
        own = table.filter(pa.array(place >= 0)).sort_by("place")
        n = own.num_rows
        got = [_unpack(p.as_py()) for p in table.filter(pa.array(place < 0))["payload"]]
        empty = [(np.empty(0, np.uint64), np.empty(0, np.uint16), np.empty(0, np.uint32))]
        token, owner, total = (np.concatenate(x) for x in zip(*(got or empty), strict=True))
        many = owner == SEVERAL
        known, known_total = token[many], total[many]
        order = np.argsort(known)
        known, known_total = known[order], known_total[order]
        single = np.argsort(owner[~many], kind="stable")
        bounds = np.cumsum(np.bincount(owner[~many], minlength=n))[:-1]
        singles = np.split(token[~many][single], bounds)
        totals = np.split(total[~many][single], bounds)
        chunk = table["chunk"][0].as_py()
        size, tokens, keys, rests = own["size"].to_pylist(), [], [], []
        for i in range(n):
            several = np.frombuffer(own["payload"][i].as_py(), "<u8")
            mine = np.concatenate([singles[i], several])
            if not len(mine) or 100 * len(mine) < rule.percent * size[i]:
                tokens.append(None)
                keys.append(None)
                rests.append(None)
                continue
            count = np.concatenate([totals[i], known_total[np.searchsorted(known, several)]])
            own_keys, own_rests = signatures(mine, count, size[i], rule)
            keys.append(own_keys.view(np.int64))
            rests.append(own_rests.astype(np.int32))
            tokens.append(mine.view(np.int64))
        place = own["place"].to_numpy().astype(np.int64)
        row = ((chunk >> 32) << 32) | ((chunk & 0xFFFFF) << 12) | place
        columns = [
            pa.array(row, pa.int64()),
            own["id"].combine_chunks(),
            own["size"].combine_chunks(),
            own["digest"].combine_chunks(),
            pa.array(tokens, pa.list_(pa.int64())),
            pa.array(keys, pa.list_(pa.int64())),
            pa.array(rests, pa.list_(pa.int32())),
        ]
        return pa.Table.from_arrays(columns, names=result.names)

    return (
        texts.mapInArrow(send, sent)
        .groupBy("part")
        .applyInArrow(answer, sent)
        .groupBy("chunk")
        .applyInArrow(finish, result)
    )


def verified(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) of rows that are linked, by the sets' shared tokens and sizes."""
    left, right = (
        sets.select(*(F.col(c).alias(f"{c}_{x}") for c in ("row", "size", "tokens"))) for x in "ab"
    )
    both = F.size(F.array_intersect("tokens_a", "tokens_b"))
    return (
        pairs.join(left, F.col("a") == F.col("row_a"))
        .join(right, F.col("b") == F.col("row_b"))
        .where(100 * both >= rule.percent * (F.col("size_a") + F.col("size_b") - both))
        .select("a", "b")
    )


CELL = 512  # rows of either side


def between_components(
    meetings: DataFrame, parts: DataFrame, sets: DataFrame, rule: Rule
) -> DataFrame:
    """Links (a, b) between the rows of any two components that meet (component_a, component_b).

    The larger component is the host, the other its guest. Rows of a host and of all its guests
    are dealt into cells of bounded size, each verified in one task; pairs are never emitted.
    """
    members = materialize(
        sets.select("row").join(parts.withColumnRenamed("node", "row"), "row", "left").select(
            "row", F.coalesce("component", "row").alias("component")
        ),
        "members",
    )
    counts = members.groupBy("component").agg(F.count("*").alias("n"))
    a, b = (
        counts.select(F.col("component").alias(f"component_{x}"), F.col("n").alias(f"n_{x}"))
        for x in "ab"
    )
    first_hosts = F.struct("n_a", "component_a") > F.struct("n_b", "component_b")
    either = lambda x, y: F.when(first_hosts, F.col(x)).otherwise(F.col(y))
    visits = materialize(
        meetings.join(a, "component_a")
        .join(b, "component_b")
        .select(
            either("component_a", "component_b").alias("host"),
            either("component_b", "component_a").alias("guest"),
            either("n_a", "n_b").alias("host_rows"),
            either("n_b", "n_a").alias("guest_rows"),
        ),
        "visits",
    )
    dealt = lambda c: F.ceil(F.col(c) / CELL).cast("int")
    hosts = materialize(
        visits.groupBy("host")
        .agg(F.max("host_rows").alias("host_rows"), F.sum("guest_rows").alias("guest_rows"))
        .select("host", dealt("host_rows").alias("host_parts"), dealt("guest_rows").alias("guest_parts")),
        "hosts",
    )
    of = lambda n: F.pmod(F.xxhash64("row"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = (
        hosts.join(members, F.col("host") == F.col("component"))
        .withColumn("host_part", of("host_parts"))
        .withColumn("guest_part", every("guest_parts"))
    )
    right = (
        visits.select("host", "guest")
        .join(hosts, "host")
        .join(members, F.col("guest") == F.col("component"))
        .withColumn("guest_part", of("guest_parts"))
        .withColumn("host_part", every("host_parts"))
    )
    cell = ["host", "host_part", "guest_part"]
    seats = materialize(
        left.select(*cell, "row", F.lit(False).alias("visits")).union(
            right.select(*cell, "row", F.lit(True).alias("visits"))
        ),
        "cells",
    )
    filled = seats.join(sets.select("row", "size", "tokens"), "row")

    def verify(table: pa.Table) -> pa.Table:
        visits_ = table["visits"].to_numpy(zero_copy_only=False)
        row, size = table["row"].to_numpy(), table["size"].to_numpy()
        tokens = [t.values.to_numpy() for t in table["tokens"].combine_chunks()]
        host, guest = np.flatnonzero(~visits_), np.flatnonzero(visits_)
        found: list[tuple[int, int]] = []
        if len(host):
            values = np.concatenate([tokens[i] for i in host])
            owner = np.repeat(np.arange(len(host)), [len(tokens[i]) for i in host])
            order = np.argsort(values, kind="stable")
            values, owner = values[order], owner[order]
            for g in guest:
                low = np.searchsorted(values, tokens[g], "left")
                n = np.searchsorted(values, tokens[g], "right") - low
                at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
                both = np.bincount(owner[at], minlength=len(host))
                linked = 100 * both >= rule.percent * (size[g] + size[host] - both)
                found += [(row[g], row[h]) for h in host[linked]]
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return materialize(
        filled.groupBy(*cell).applyInArrow(verify, "a bigint, b bigint"), "links-between"
    )


def join(
    docs: DataFrame, rule: Rule | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col``, ``n_shingles`` and ``component_id`` of every document.

    The component is the least id reachable by links, its own included; a null id is never the
    least unless all are null. Null and empty texts have no shingles and no links. Rows that
    repeat an id are documents of their own.
    """
    rule = rule or Rule()
    all_ = materialize(shared_shingles(docs, rule, id_col, text_col), "shingles")
    alive = all_.where(F.col("tokens").isNotNull())
    equal = materialize(
        alive.groupBy("digest", "size").agg(F.min("row").alias("rep"), F.min("id").alias("low")),
        "equal-sets",
    )
    sets = materialize(
        alive.join(equal.select(F.col("rep").alias("row")), "row", "left_semi").select(
            "row",
            "size",
            (F.col("size") - F.size("tokens")).alias("own"),
            "tokens",
            F.arrays_zip("keys", "rests").alias("keys"),
        ),
        "sets",
    )
    entries = sets.select("row", "size", "own", F.explode("keys").alias("k")).select(
        "row", "size", "own", F.col("k.keys").alias("key"), F.col("k.rests").alias("rest")
    )
    heads = materialize(
        entries.groupBy("key")
        .agg(F.count("*").alias("n"), F.min(F.struct("own", "row", "size", "rest")).alias("head"))
        .where("n > 1")
        .select("key", *(F.col(f"head.{c}").alias(f"head_{c}") for c in ("row", "size", "rest"))),
        "heads",
    )
    index = materialize(entries.drop("own").join(heads, "key"), "index")

    def may_link(size_a: str, rest_a: str, size_b: str, rest_b: str):
        """The sizes are near enough, and what is left suffices for the overlap."""
        low, high = F.least(size_a, size_b), F.greatest(size_a, size_b)
        both = F.col(size_a) + F.col(size_b)
        enough = F.least(rest_a, rest_b) * (100 + rule.percent) >= both * rule.percent
        return (high * rule.percent <= low * 100) & enough

    first = materialize(
        index.where("row != head_row")
        .where(may_link("size", "rest", "head_size", "head_rest"))
        .select(F.least("head_row", "row").alias("a"), F.greatest("head_row", "row").alias("b"))
        .distinct(),
        "first-pairs",
    )
    links = materialize(verified(first, sets, rule), "first-links")
    parts = components(links)
    placed = materialize(
        index.join(parts.withColumnRenamed("node", "row"), "row", "left").select(
            "key", "row", "size", "rest", F.coalesce("component", "row").alias("component")
        ),
        "placed",
    )
    # Components that meet under a key, by the sizes and rests of their sets there.
    groups = placed.groupBy("key", "component").agg(
        F.min("size").alias("small"), F.max("size").alias("large"), F.max("rest").alias("rest")
    )
    mixed = groups.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    groups = materialize(groups.join(mixed, "key", "left_semi"), "groups")
    left, right = (
        groups.select(
            "key", *(F.col(c).alias(f"{c}_{x}") for c in ("component", "small", "large", "rest"))
        )
        for x in "ab"
    )
    small = F.col("small_a") + F.col("small_b")
    meetings = (
        left.join(right, "key")
        .where(
            (F.col("component_a") < F.col("component_b"))
            & (F.col("small_a") * rule.percent <= F.col("large_b") * 100)
            & (F.col("small_b") * rule.percent <= F.col("large_a") * 100)
            & (F.least("rest_a", "rest_b") * (100 + rule.percent) >= small * rule.percent)
        )
        .select("key", "component_a", "component_b")
    )
    more = between_components(meetings.drop("key").distinct(), parts, sets, rule)
    parts = components(links.union(more)) if more.head(1) else parts
    # From rows that stand for equal sets to all rows, and to the least id of each component.
    of_rep = equal.join(parts.withColumnRenamed("node", "rep"), "rep", "left").select(
        "digest", "size", "low", F.coalesce("component", "rep").alias("component")
    )
    of_rep = materialize(of_rep, "components")
    lowest = materialize(of_rep.groupBy("component").agg(F.min("low").alias("least")), "least-ids")
    named = materialize(
        of_rep.join(lowest, "component").select("digest", "size", "least"), "named-sets"
    )
    linked = alive.join(named, ["digest", "size"]).select("id", "size", "least")
    alone = all_.where(F.col("tokens").isNull()).select("id", "size", F.col("id").alias("least"))
    return linked.union(alone).toDF(id_col, "n_shingles", "component_id")

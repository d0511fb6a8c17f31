"""All-of search by bitmaps: which facts have a label, as bits of the fact ids.

The index has a row per facet, label and bucket of 32,768 fact ids, with one bit per id. A search
reads the rows of its labels only, combines them by AND within each bucket, and tests one bit per
fact; bridges and dimensions are not read. Indexes add up by OR, so that of a batch of new facts is
merged with the one there is.
"""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cataloom.constants import SEARCH_ROWS
from cataloom.operators.normalize import BROADCAST_BYTES
from cataloom.operators.ranking import top_n
from cataloom.operators.search import SEARCH_COLUMNS
from cataloom.storage import materialize

BITMAP_BYTES = 4096
KEYS = ("facet", "label", "bucket")


def label_bitmaps(
    facets: Mapping[str, tuple[DataFrame, DataFrame, str, str]], fact_id: str
) -> DataFrame:
    """The index of facets, each given as (bridge, dimension, dimension id, label).

    Bits are set by dimension id first, with partial results in the map tasks, so neither a hot
    label nor repeated links make a large group, and only bitmaps meet the dimension.
    """
    parts = []
    for facet, (bridge, dim, dim_id, label) in facets.items():
        links = bridge.where(F.col(fact_id).isNotNull())
        per_id = links.groupBy(
            dim_id, F.bitmap_bucket_number(F.col(fact_id).cast("bigint")).alias("bucket")
        ).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(fact_id).cast("bigint"))).alias("bits"))
        named = per_id.join(dim.select(dim_id, F.col(label).alias("label")), dim_id)
        parts.append(named.where("label IS NOT NULL").select(F.lit(facet).alias("facet"), "label", "bucket", "bits"))
    return merged(*parts)


def merged(*indexes: DataFrame) -> DataFrame:
    """One index of the facts of all."""
    rows = reduce(DataFrame.unionByName, indexes)
    return rows.groupBy(*KEYS).agg(F.bitmap_or_agg("bits").alias("bits"))


def stored(index: DataFrame, path: str | None = None) -> DataFrame:
    """The index written so that a search reads little more than the rows of its labels."""
    ordered = index.repartitionByRange(*KEYS).sortWithinPartitions(*KEYS)
    return materialize(ordered, "bitmaps", path)


def matching_bits(index: DataFrame, chosen: Mapping[str, Sequence[str]]) -> DataFrame:
    """(bucket, bits) of the facts that have all chosen labels of all facets."""
    wanted = {facet: list(dict.fromkeys(values)) for facet, values in chosen.items() if values}
    if not wanted:
        raise ValueError("no label is chosen")
    any_of = [(F.col("facet") == f) & F.col("label").isin(v) for f, v in wanted.items()]
    found = index.where(reduce(lambda a, b: a | b, any_of)).groupBy("bucket")
    number = sum(len(v) for v in wanted.values())
    found = found.agg(F.count("*").alias("_labels"), F.bitmap_and_agg("bits").alias("bits"))
    return found.where((F.col("_labels") == number) & (F.bitmap_count("bits") > 0)).drop("_labels")


def having(fact: DataFrame, hits: DataFrame, fact_id: str) -> DataFrame:
    """The facts whose bit is set. Bitmaps of a checked size are broadcast; more of them meet the
    facts by bucket, of which each has as many ids as any other at most."""
    hits = materialize(hits, "hits")
    few = hits.count() * BITMAP_BYTES <= BROADCAST_BYTES
    number = F.col(fact_id).cast("bigint")
    place = F.bitmap_bit_position(number)
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10)
    bits = hits.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits"))
    marked = fact.withColumn("_bucket", F.bitmap_bucket_number(number))
    met = marked.join(F.broadcast(bits) if few else bits, "_bucket")
    return met.where(F.getbit(byte.cast("int"), (place % 8).cast("int")) == 1).drop("_bucket", "_bits")


def search_indexed(
    fact: DataFrame,
    index: DataFrame,
    chosen: Mapping[str, Sequence[str]],
    *,
    fact_id: str,
    order_by: str,
    n: int = SEARCH_ROWS,
    columns: Sequence[str] = SEARCH_COLUMNS,
) -> DataFrame:
    """``search.search`` with facets matched by label: the top facts among those that have every
    chosen label; equal result rows merge."""
    if order_by not in columns:
        raise ValueError(f"{order_by!r} is not among the result columns")
    if any(chosen.values()):
        fact = having(fact, matching_bits(index, chosen), fact_id)
    rows = fact.select(*columns).distinct()
    return top_n(rows, order_by, n, *[c for c in columns if c != order_by])

"""Faceted search: facts that have all the chosen labels of every facet."""

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cataloom.constants import SEARCH_ROWS
from cataloom.operators.ranking import top_n
from cataloom.operators.sizes import broadcast_if_small

SEARCH_COLUMNS = (
    "name", "developer", "publisher", "peak_ccu_yesterday", "average_2weeks_hs",
    "owners_max", "price_usd", "discount",
)
_BITS = 62


@dataclass(frozen=True)
class Facet:
    """Chosen labels of one dimension.

    ``match_key="label"``: a fact needs every chosen label. ``"id"``: a fact needs as
    many different dimension ids among the chosen labels as there are labels, so a fact
    linked to two ids of one label does not match that label alone.
    """

    bridge: DataFrame
    dim: DataFrame
    dim_id: str
    label: str
    values: Sequence[str] = ()
    match_key: str = "label"


def facet_matches(facet: Facet, fact_id: str) -> DataFrame:
    """Ids of the facts that satisfy one facet (one grouped pass over its bridge)."""
    values = list(dict.fromkeys(facet.values))
    name = F.col(facet.label)
    dim = facet.dim.where(name.isin(values))
    links = facet.bridge.select(fact_id, facet.dim_id)
    if facet.match_key == "id":
        hits = links.join(broadcast_if_small(dim.select(facet.dim_id)), facet.dim_id)
        # A set per fact holds at most the chosen ids and needs one shuffle.
        found = hits.groupBy(fact_id).agg(F.collect_set(facet.dim_id).alias("_found"))
        return found.where(F.size("_found") == len(values)).select(fact_id)
    if facet.match_key != "label":
        raise ValueError(f"unknown match_key {facet.match_key!r}")
    # One bit per chosen label: OR-ing bits needs one shuffle and combines before it,
    # where a distinct count would shuffle twice.
    words = []
    for start in range(0, len(values), _BITS):
        bits = F
        for i, value in enumerate(values[start : start + _BITS]):
            bits = bits.when(name == F.lit(value), F.lit(1 << i).cast("bigint"))
        words.append(bits.otherwise(F.lit(0).cast("bigint")).alias(f"_w{len(words)}"))
    marks = [f"_w{i}" for i in range(len(words))]
    found = (
        links.join(broadcast_if_small(dim.select(facet.dim_id, *words)), facet.dim_id)
        .groupBy(fact_id)
        .agg(*[F.bit_or(m).alias(m) for m in marks])
    )
    number = reduce(lambda a, b: a + b, [F.bit_count(m) for m in marks])
    return found.where(number == len(values)).select(fact_id)


def search(
    fact: DataFrame,
    facets: Sequence[Facet] = (),
    *,
    fact_id: str,
    order_by: str,
    n: int = SEARCH_ROWS,
    columns: Sequence[str] = SEARCH_COLUMNS,
) -> DataFrame:
    """Top facts by a measure among those matching all facets; equal result rows merge.

    One pass over the fact: equal rows merge in the map tasks first, and each task sends its
    own n best on.
    """
    if order_by not in columns:
        raise ValueError(f"{order_by!r} is not among the result columns")
    hits = fact
    for facet in facets:
        if facet.values:
            hits = hits.join(facet_matches(facet, fact_id), fact_id, "left_semi")
    rows = hits.select(*columns).distinct()
    return top_n(rows, order_by, n, *[c for c in columns if c != order_by])

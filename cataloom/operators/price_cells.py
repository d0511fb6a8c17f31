"""Rankings of a dimension for any price range, without joining facts and links again.

Prices fall into cells of equal width. For each label, cell and criterion the index holds the total
and the count over all cells up to that one, so what lies between two cells is the difference
of two of its rows. The two cells that a range cuts are read in full: links with their price
and measures, stored in the order of the cells. Prices below the first or above the last of the
bounded number of cells share an open cell at each end, which is always read like a cut one.
"""

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cataloom.constants import PRICE_CEILING, RANKING_ROWS
from cataloom.operators.ranking import CRITERIA, Criterion, top_n
from cataloom.storage import materialize


@dataclass(frozen=True)
class PriceIndex:
    label: str
    width: float
    cells: int
    sums: DataFrame  # _label, _cell, and running sums per criterion
    rows: DataFrame  # _label, _cell, _price, and measures

    def cell(self, price: float) -> int:
        return max(-1, min(self.cells, math.floor(price / self.width)))


def _exact(rule: Criterion) -> str:
    return f"decimal({19 + rule.places},{rule.places})"


def _sums() -> list[Column]:
    """Per criterion: links that count, values that are not null, and their total."""
    out = []
    for name, rule in CRITERIA.items():
        value = F.col(f"_{name}")
        counts = F.col("_price").isNotNull() & (value > 0 if rule.positive_only else F.lit(True))
        out += [
            F.count_if(counts).alias(f"links_{name}"),
            F.count_if(counts & value.isNotNull()).alias(f"rows_{name}"),
            F.sum(F.when(counts, value.cast(_exact(rule)))).alias(f"total_{name}"),
        ]
    return out


def _names() -> list[str]:
    return [f"{kind}_{name}" for name in CRITERIA for kind in ("links", "rows", "total")]


def price_index(
    fact: DataFrame,
    bridge: DataFrame,
    dim: DataFrame,
    *,
    fact_id: str,
    dim_id: str,
    label: str,
    price: str = "price_usd",
    width: float = 10.0,
    cells: int = math.ceil(PRICE_CEILING / 10),
    path: str | None = None,
) -> PriceIndex:
    """Build and store the index (below ``path``, else in the shared folder)."""
    measures = {n: F.col(r.column) if r.column else F.lit(1) for n, r in CRITERIA.items()}
    cell = F.greatest(F.lit(-1), F.least(F.lit(cells), F.floor(F.col(price) / width))).cast("int")
    facts = fact.where(F.col(price).isNotNull()).select(
        fact_id,
        F.col(price).alias("_price"),
        cell.alias("_cell"),
        *[m.alias(f"_{n}") for n, m in measures.items()],
    )
    links = bridge.select(fact_id, dim_id).join(facts, fact_id)
    rows = links.join(dim.select(dim_id, F.col(label).alias("_label")), dim_id).drop(fact_id, dim_id)
    in_order = rows.repartitionByRange("_cell", F.xxhash64("_label")).sortWithinPartitions("_cell")
    rows = materialize(in_order, "price-rows", path and f"{path}/rows")

    per_cell = rows.groupBy("_label", "_cell").agg(*_sums())
    every = F.explode(F.sequence(F.lit(-1), F.lit(cells))).alias("_cell")
    nothing = [F.lit(None).cast(per_cell.schema[n].dataType).alias(n) for n in _names()]
    # A row for each label and each of the bounded number of cells.
    dense = per_cell.unionByName(per_cell.select("_label").distinct().select("_label", every, *nothing))
    up_to = Window.partitionBy("_label").orderBy("_cell")
    total = dense.groupBy("_label", "_cell").agg(*[F.sum(n).alias(n) for n in _names()])
    running = [F.coalesce(F.sum(n).over(up_to), F.lit(0)).cast(per_cell.schema[n].dataType).alias(n) for n in _names()]
    sums = total.select("_label", "_cell", *running)
    sums = sums.repartitionByRange("_cell", F.xxhash64("_label")).sortWithinPartitions("_cell")
    return PriceIndex(label, width, cells, materialize(sums, "price-sums", path and f"{path}/sums"), rows)


def rank_in_range(
    index: PriceIndex,
    criterion: str,
    price_range: tuple = (0, PRICE_CEILING),
    n: int = RANKING_ROWS,
) -> DataFrame:
    """``ranking.rank_by_dimension`` from the index: top labels by one criterion over the facts in
    a price range, bounds included."""
    rule, (low, high) = CRITERIA[criterion], price_range
    first, last = index.cell(low), index.cell(high)
    names = [f"{kind}_{criterion}" for kind in ("links", "rows", "total")]
    cut = index.rows.where(F.col("_cell").isin(first, last) & F.col("_price").between(low, high))
    wanted = [c for c, name in zip(_sums(), _names(), strict=True) if name in names]
    parts = [cut.groupBy("_label").agg(*wanted)]
    if last - first > 1:
        sign = F.when(F.col("_cell") == first, -1).otherwise(1)
        between = index.sums.where(F.col("_cell").isin(first, last - 1))
        parts.append(between.select("_label", *[(F.col(c) * sign).alias(c) for c in names]))
    both = reduce(DataFrame.unionByName, parts).groupBy("_label")
    sums = both.agg(*[F.sum(c).alias(c) for c in names]).where(F.col(names[0]) > 0)
    average = F.try_divide(F.col(names[2]).cast("double"), F.col(names[1]))
    result = F.round(average, rule.places) if rule.column else F.col(names[1]).cast("bigint")
    shown = sums.select(F.col("_label").alias(index.label), result.alias(rule.alias))
    return top_n(shown, rule.alias, n, index.label)

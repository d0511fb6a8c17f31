"""Rankings of a dimension, related labels, free-versus-paid split."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cataloom.constants import PRICE_CEILING, RANKING_ROWS
from cataloom.operators.sizes import broadcast_if_small


@dataclass(frozen=True)
class Criterion:
    """A measure to rank by: average of ``column``, or the number of facts if it is None.

    Values are added as decimals of ``places`` places, so the sum does not depend on the order
    of rows, and averages are ranked as rounded to as many.
    """

    alias: str
    column: str | None = None
    positive_only: bool = False
    places: int = 6


CRITERIA = {
    "apps_count": Criterion("apps_count"),
    "peak_ccu_yesterday": Criterion("avg_peak_ccu_yesterday", "peak_ccu_yesterday"),
    "average_2weeks_hs": Criterion("avg_2weeks_hs", "average_2weeks_hs", positive_only=True),
    "owners_max": Criterion("avg_owners_max", "owners_max"),
    "price_usd": Criterion("avg_price_usd", "price_usd", positive_only=True),
    "discount": Criterion("avg_discount", "discount"),
}


def top_n(df: DataFrame, measure: str, n: int, *tie_break: str) -> DataFrame:
    """Largest first, nulls before all, equal rows by the tie-break columns ascending."""
    ties = [F.col(c).asc_nulls_last() for c in tie_break]
    return df.orderBy(F.col(measure).desc_nulls_first(), *ties).limit(n)


def rank_by_dimension(
    fact: DataFrame,
    bridge: DataFrame,
    dim: DataFrame,
    *,
    fact_id: str,
    dim_id: str,
    label: str,
    criterion: str,
    price_range: tuple = (0, PRICE_CEILING),
    price: str = "price_usd",
    n: int = RANKING_ROWS,
    distinct_facts: bool = False,
) -> DataFrame:
    """Top labels of a dimension by one criterion over facts in a price range.

    Links are first added up by dimension id, so only one row per id meets the
    dimension table, however large that is. A fact linked to two ids that share a label
    counts twice, unless ``distinct_facts`` is set.
    """
    rule = CRITERIA[criterion]
    kept = fact.where(F.col(price).between(*price_range))
    if rule.positive_only:
        kept = kept.where(F.col(rule.column) > 0)
    exact = f"decimal({19 + rule.places},{rule.places})"
    value = F.col(rule.column).cast(exact) if rule.column else F.col(fact_id)
    kept = kept.select(fact_id, value.alias("_value"))
    total = F.sum("_value") if rule.column else F.lit(None).cast("double")
    names = dim.select(dim_id, label)
    links = bridge.select(fact_id, dim_id)

    if distinct_facts:
        links = links.join(names, dim_id).select(fact_id, label).distinct()
        sums = links.join(kept, fact_id).groupBy(label)
        sums = sums.agg(total.alias("_total"), F.count("_value").alias("_rows"))
    else:
        per_id = links.join(kept, fact_id).groupBy(dim_id)
        per_id = per_id.agg(total.alias("_total"), F.count("_value").alias("_rows"))
        sums = per_id.join(names, dim_id).groupBy(label)
        sums = sums.agg(F.sum("_total").alias("_total"), F.sum("_rows").alias("_rows"))

    average = F.round(F.try_divide(F.col("_total").cast("double"), F.col("_rows")), rule.places)
    result = average if rule.column else F.col("_rows")
    return top_n(sums.select(label, result.alias(rule.alias)), rule.alias, n, label)


def resorted(ranking: DataFrame) -> DataFrame:
    """A ranking in ascending order of its measure, as bar charts want it."""
    label, measure = ranking.columns
    return ranking.orderBy(F.col(measure).asc_nulls_last(), F.col(label).asc_nulls_last())


def related_labels(
    bridge_a: DataFrame,
    dim_a: DataFrame,
    *,
    dim_id_a: str,
    label_a: str,
    value: str,
    bridge_b: DataFrame,
    dim_b: DataFrame,
    dim_id_b: str,
    label_b: str,
    fact_id: str,
    n: int = RANKING_ROWS,
) -> DataFrame:
    """Most frequent labels of dimension B among facts that have one label of dimension A."""
    chosen = broadcast_if_small(dim_a.where(F.col(label_a) == F.lit(value)).select(dim_id_a))
    # distinct() replaces the exchange the join needs and drops repeats before it.
    facts = bridge_a.join(chosen, dim_id_a, "left_semi").select(fact_id).distinct()
    per_id = (
        bridge_b.select(fact_id, dim_id_b)
        .join(facts, fact_id, "left_semi")
        .groupBy(dim_id_b)
        .agg(F.count("*").alias("num_apps"))
    )
    counts = (
        per_id.join(dim_b.select(dim_id_b, label_b), dim_id_b)
        .groupBy(label_b)
        .agg(F.sum("num_apps").alias("num_apps"))
    )
    return top_n(counts, "num_apps", n, label_b)


def free_paid_split(
    fact: DataFrame,
    bridge: DataFrame,
    dim: DataFrame,
    *,
    fact_id: str,
    dim_id: str,
    label: str,
    value: str,
    price: str = "price_usd",
    distinct_facts: bool = False,
) -> DataFrame:
    """Free and paid facts of one label; no row for an unknown label, null price in neither."""
    chosen = broadcast_if_small(dim.where(F.col(label) == F.lit(value)).select(dim_id))
    hits = bridge.select(fact_id, dim_id).join(chosen, dim_id).select(fact_id)
    if distinct_facts:
        hits = hits.distinct()
    amount = F.col(price)
    return (
        hits.join(fact.select(fact_id, price), fact_id)
        .groupBy(F.lit(value).alias(label))
        .agg(
            F.sum(F.when(amount == 0, 1).otherwise(0)).alias("free_apps"),
            F.sum(F.when(amount > 0, 1).otherwise(0)).alias("paid_apps"),
        )
    )


def with_shares(split: DataFrame) -> DataFrame:
    """One row per kind with its share of both; null share when there is nothing to share."""
    both = F.col("free_apps") + F.col("paid_apps")
    kinds = F.array(
        F.struct(F.lit("Free").alias("kind"), F.col("free_apps").alias("num_apps")),
        F.struct(F.lit("Paid").alias("kind"), F.col("paid_apps").alias("num_apps")),
    )
    rows = split.select(both.alias("_both"), F.inline(kinds))
    return rows.select("kind", "num_apps", F.try_divide("num_apps", "_both").alias("share"))

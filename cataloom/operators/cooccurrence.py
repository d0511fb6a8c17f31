"""Related labels from a table of label pairs.

Counts of how often a label of one facet stands beside one of another are added up fact by fact
and kept. Facts with very many labels would give the square of them in pairs; they are kept as they
are, in tables of their own, and counted when a label of theirs is asked for. So the pairs of a
fact are bounded in number, and answers are whole. Tables of new facts add up with those there are.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cataloom.constants import RANKING_ROWS
from cataloom.operators.ranking import top_n
from cataloom.operators.sizes import broadcast_if_small
from cataloom.storage import materialize

HEAVY_PAIRS = 1 << 16


@dataclass(frozen=True)
class Pairs:
    """``pairs``: (label_a, label_b, num_apps) of facts with few labels. ``heavy_a``: (fact,
    label_a) and ``heavy_b``: (fact, label_b, num_apps) of the others."""

    pairs: DataFrame
    heavy_a: DataFrame
    heavy_b: DataFrame


def label_pairs(
    bridge_a: DataFrame,
    dim_a: DataFrame,
    *,
    dim_id_a: str,
    label_a: str,
    bridge_b: DataFrame,
    dim_b: DataFrame,
    dim_id_b: str,
    label_b: str,
    fact_id: str,
    heavy: int = HEAVY_PAIRS,
    path: str | None = None,
) -> Pairs:
    """Build and store the tables. A fact is heavy if it has more than ``heavy`` pairs."""
    named_a = dim_a.select(dim_id_a, F.col(label_a).alias("label_a")).where("label_a IS NOT NULL")
    a = bridge_a.select(F.col(fact_id).alias("fact"), dim_id_a).join(named_a, dim_id_a)
    a = a.where("fact IS NOT NULL").select("fact", "label_a").distinct()
    b = bridge_b.select(F.col(fact_id).alias("fact"), dim_id_b)
    b = b.join(dim_b.select(dim_id_b, F.col(label_b).alias("label_b")), dim_id_b)
    b = b.where("fact IS NOT NULL").groupBy("fact", "label_b").agg(F.count("*").alias("num_apps"))

    def place(name: str) -> str | None:
        return path and f"{path}/{name}"

    a, b = materialize(a, "labels-a", place("labels_a")), materialize(b, "labels-b", place("labels_b"))
    sizes = a.groupBy("fact").agg(F.count("*").alias("n")).join(
        b.groupBy("fact").agg(F.count("*").alias("m")), "fact"
    )
    many = broadcast_if_small(materialize(sizes.where(F.col("n") * F.col("m") > heavy).select("fact"), "heavy"))
    light = a.join(many, "fact", "left_anti").join(b, "fact")
    pairs = light.groupBy("label_a", "label_b").agg(F.sum("num_apps").alias("num_apps"))
    in_order = pairs.repartitionByRange("label_a").sortWithinPartitions("label_a")
    return Pairs(
        materialize(in_order, "pairs", place("pairs")),
        materialize(a.join(many, "fact", "left_semi"), "heavy-a", place("heavy_a")),
        materialize(b.join(many, "fact", "left_semi"), "heavy-b", place("heavy_b")),
    )


def merged(old: Pairs, new: Pairs) -> Pairs:
    """The tables of the facts of both, which have no fact in common."""
    pairs = old.pairs.unionByName(new.pairs).groupBy("label_a", "label_b")
    return Pairs(
        pairs.agg(F.sum("num_apps").alias("num_apps")),
        old.heavy_a.unionByName(new.heavy_a),
        old.heavy_b.unionByName(new.heavy_b),
    )


def related_from_pairs(tables: Pairs, value: str, label_b: str, n: int = RANKING_ROWS) -> DataFrame:
    """``ranking.related_labels`` from the tables: the most frequent labels beside ``value``."""
    known = tables.pairs.where(F.col("label_a") == F.lit(value)).select("label_b", "num_apps")
    facts = broadcast_if_small(tables.heavy_a.where(F.col("label_a") == F.lit(value)).select("fact"))
    heavy = tables.heavy_b.join(facts, "fact", "left_semi").select("label_b", "num_apps")
    counts = known.unionByName(heavy).groupBy(F.col("label_b").alias(label_b))
    return top_n(counts.agg(F.sum("num_apps").alias("num_apps")), "num_apps", n, label_b)

"""From landed files to loaded tables."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cataloom.constants import BATCH_SIZE
from cataloom.operators import quality
from cataloom.plans.extract import extract
from cataloom.plans.transform import build_star
from cataloom.schemas import CLEAN
from cataloom.sources.tables import load_tables


@dataclass(frozen=True)
class Outcome:
    raw: dict[str, DataFrame]
    rejected_facts: DataFrame
    rejected_rows: dict[str, DataFrame]
    quality: DataFrame


def run(
    spark: SparkSession,
    list_path: str,
    details_path: str,
    base: str,
    database: str = "default",
    start: int = 0,
    batch_size: int = BATCH_SIZE,
    one_document: bool = True,
    buckets: int = 0,
) -> Outcome:
    """Extract to ``base/raw``, transform to ``base/clean``, refresh tables in ``base/tables``.

    A failing stage raises, and the stages after it do not run. All rejected rows are written,
    below paths of their own, and stay what they are when the next run replaces the rest.
    """
    raw = extract(spark, list_path, details_path, f"{base}/raw", start, batch_size, one_document)
    _, rejected_facts = build_star(raw["app_details"], f"{base}/clean")
    rejected_rows = load_tables(
        spark, f"{base}/clean", f"{base}/tables", database=database, buckets=buckets
    )
    loaded = {name: spark.table(f"`{database}`.`{name}`") for name in CLEAN}
    return Outcome(raw, rejected_facts, rejected_rows, quality.report(loaded))

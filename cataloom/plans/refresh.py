"""Landed files to tables that all change in one step."""

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cataloom.constants import BATCH_SIZE
from cataloom.plans.extract import extract
from cataloom.plans.transform import build_star
from cataloom.schemas import CLEAN, load_order
from cataloom.sources import snapshots, versions
from cataloom.sources.tables import conform
from cataloom.storage import materialize

RAW = ("app_list", "app_details")


@dataclass(frozen=True)
class Refresh:
    snapshot: snapshots.Snapshot
    reports: dict[str, DataFrame]  # of the extraction
    rejected_facts: DataFrame
    rejected_rows: dict[str, DataFrame]


def refresh(
    spark: SparkSession,
    list_path: str,
    details_path: str,
    root: str,
    start: int = 0,
    batch_size: int = BATCH_SIZE,
    one_document: bool = True,
    check: bool = True,
) -> Refresh:
    """Extract, transform and put the raw list, the raw details and the seven clean tables in
    force below ``root`` as one state.

    Every stage writes to folders of this refresh alone. If one fails, or the rules of the clean
    tables are broken (``check``), or another refresh was put in force meanwhile, an error is
    raised and readers go on with what they had.
    """
    before = versions.newest(spark, root)
    work = f"{root.rstrip('/')}/work/{uuid.uuid4().hex}"
    raw = extract(spark, list_path, details_path, f"{work}/raw", start, batch_size, one_document)
    clean, rejected_facts = build_star(raw["app_details"])
    frames = {name: raw[name] for name in RAW}
    rejected_rows = {}
    for name in load_order(CLEAN):
        frames[name], bad = conform(clean[name], CLEAN[name])
        rejected_rows[name] = materialize(bad, name, f"{work}/rejected/{name}")
    snapshot = snapshots.replace(spark, root, frames, before, check)
    reports = {name: df for name, df in raw.items() if name not in RAW}
    return Refresh(snapshot, reports, rejected_facts, rejected_rows)

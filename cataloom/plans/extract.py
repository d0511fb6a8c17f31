"""Landed list and details to raw tables."""

import uuid

from pyspark.sql import DataFrame, SparkSession

from cataloom.constants import BATCH_SIZE
from cataloom.schemas import RAW_DETAIL_COLUMNS
from cataloom.sources import landing
from cataloom.storage import materialize


def extract(
    spark: SparkSession,
    list_path: str,
    details_path: str,
    raw: str,
    start: int = 0,
    batch_size: int = BATCH_SIZE,
    one_document: bool = True,
) -> dict[str, DataFrame]:
    """Write and return the raw tables.

    ``app_list``: the whole list, whatever ``start`` is. ``app_details``: one record for each
    application asked for, that is from position ``start`` on, with its batch. ``failed_ids``:
    those asked for without a usable record. ``unrequested``: usable records of applications
    not asked for. ``rejected``: records that cannot be used.

    The list and the details replace those of an earlier run, once the new list is known to
    have applications. The reports get a folder of their own for each run.
    """
    named = landing.drop_blank_names(landing.read_app_list(spark, list_path, one_document))
    listed = landing.numbered_list(named)
    if listed.isEmpty():
        raise ValueError(f"no applications in {list_path}")
    listed = materialize(listed, "app_list", f"{raw}/app_list")
    work = landing.work_list(listed, start, batch_size)
    reports = f"{raw}/reports/{uuid.uuid4().hex}"
    # JSON is parsed once; the uses below read only the columns they need from Parquet.
    marked = landing.mark_rejected(landing.read_details(spark, details_path))
    good, rejected = landing.split_details(materialize(marked, "landed", f"{reports}/landed"))
    details = landing.details_in_list_order(work, good)
    details = details.select(
        "row_seq", "batch_id", *[details[c].cast("string").alias(c) for c in RAW_DETAIL_COLUMNS]
    )
    details = materialize(details, "app_details", f"{raw}/app_details")
    failed = landing.failed_ids(work, good)
    others = landing.unrequested(work, good)
    return {
        "app_list": listed,
        "app_details": details,
        "rejected": rejected,
        "failed_ids": materialize(failed, "failed_ids", f"{reports}/failed_ids"),
        "unrequested": materialize(others, "unrequested", f"{reports}/unrequested"),
    }

"""Landed JSON: the list of applications and one detail record per application."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cataloom.constants import BATCH_SIZE
from cataloom.functions import strip
from cataloom.operators.ids import dense_ids, keep_first, with_batch
from cataloom.schemas import CORRUPT, LANDED_DETAILS, LANDED_LIST, RAW_DETAIL_COLUMNS


# Order of list elements: file, split of the file, document in the split, place in it.
LIST_ORDER = ("list_file", "list_block", "list_doc", "list_pos")


def read_app_list(spark: SparkSession, path: str, one_document: bool = True) -> DataFrame:
    """One row per element of the nested list, with the columns of ``LIST_ORDER``.

    A file that is one document is read, whole, by one task; land a large list as one document
    per line and set ``one_document=False``, so that tasks share it.
    """
    documents = (
        spark.read.schema(LANDED_LIST)
        .json(path, multiLine=one_document)
        .select(
            "applist",
            F.col("_metadata.file_path").alias("list_file"),
            F.col("_metadata.file_block_start").alias("list_block"),
            F.monotonically_increasing_id().alias("list_doc"),
        )
    )
    apps = documents.select(
        *LIST_ORDER[:3], F.posexplode("applist.apps").alias("list_pos", "_app")
    )
    return apps.select(*LIST_ORDER, "_app.appid", "_app.name")


def drop_blank_names(apps: DataFrame) -> DataFrame:
    """Without blank names; a missing name is not blank and stays."""
    return apps.where(F.coalesce(strip(F.col("name")), F.lit("None")) != "")


def numbered_list(apps: DataFrame) -> DataFrame:
    """All applications in list order with a gap-free row_seq."""
    return dense_ids(apps, LIST_ORDER, "row_seq").drop(*LIST_ORDER)


def work_list(numbered: DataFrame, start: int = 0, size: int = BATCH_SIZE) -> DataFrame:
    """The applications to ask for, from position ``start`` on, with a batch number."""
    return with_batch(numbered, "row_seq", start, size)


# Order of landed records: file, split of the file, line in the split.
LANDED_ORDER = ("landed_file", "landed_block", "landed_line")


def with_landed_file(scan: DataFrame) -> DataFrame:
    """A file scan, batch or stream, with the file and split of each record."""
    return scan.select(
        "*",
        F.col("_metadata.file_path").alias("landed_file"),
        F.col("_metadata.file_block_start").alias("landed_block"),
    )


def with_landed_line(scan: DataFrame) -> DataFrame:
    """With a number that grows line by line in a split; to be stored with the rows."""
    return scan.withColumn("landed_line", F.monotonically_increasing_id())


def read_details(spark: SparkSession, path: str) -> DataFrame:
    """Detail records as text columns, with the columns of ``LANDED_ORDER``.

    A line that is no JSON object fills ``_corrupt``.
    """
    scan = spark.read.schema(LANDED_DETAILS).json(path, columnNameOfCorruptRecord=CORRUPT)
    return with_landed_line(with_landed_file(scan))


def mark_rejected(details: DataFrame, appid: str = "appid") -> DataFrame:
    """With ``rejected``: not parsed, or not naming one application by its number."""
    usable = F.col(appid).try_cast("bigint").isNotNull()
    if CORRUPT in details.columns:
        usable = usable & F.col(CORRUPT).isNull()
    return details.withColumn("rejected", ~usable)


def split_details(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable records with a numeric appid, rejected records as they came)."""
    good = marked.where(~F.col("rejected")).drop(CORRUPT, "rejected")
    good = good.withColumn("appid", F.col("appid").cast("bigint"))
    return good, marked.where("rejected").drop("rejected")


def failed_ids(apps: DataFrame, good: DataFrame, appid: str = "appid") -> DataFrame:
    """Requested applications without a usable detail record."""
    # The distinct ids are shuffled once and serve the join as they are.
    return apps.join(good.select(appid).distinct(), appid, "left_anti")


def unrequested(apps: DataFrame, good: DataFrame, appid: str = "appid") -> DataFrame:
    """Usable detail records of applications that were not asked for."""
    return good.join(apps.select(appid).distinct(), appid, "left_anti").select(*good.columns)


def details_in_list_order(work: DataFrame, good: DataFrame) -> DataFrame:
    """Detail records of the requested applications, numbered as requested.

    One record answers a request: the first landed one. Choosing it cuts a much-repeated
    application down before the shuffle, and the join reuses that shuffle.
    """
    answers = keep_first(good, "appid", LANDED_ORDER).drop(*LANDED_ORDER)
    wanted = work.select("appid", "row_seq", "batch_id")
    return wanted.join(answers, "appid").select("row_seq", "batch_id", *RAW_DETAIL_COLUMNS)

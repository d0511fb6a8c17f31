"""Incremental ingest of landed detail records."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cataloom.operators.ids import dense_ids
from cataloom.schemas import CORRUPT, LANDED_DETAILS, RAW_DETAIL_COLUMNS
from cataloom.sources.landing import (
    LANDED_ORDER,
    mark_rejected,
    with_landed_file,
    with_landed_line,
)

_ORDER_TYPES = (T.StringType(), T.LongType(), T.LongType())
_PART_TYPES = {"batch_id": T.LongType(), "rejected": T.BooleanType()}


def ingest_stream(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    schema: T.StructType = LANDED_DETAILS,
    key: str = "appid",
) -> StreamingQuery:
    """Take up all files not yet ingested, in batches, then stop.

    The checkpoint remembers the files done. A batch writes its own directory and
    replaces it when repeated, so a restart neither loses nor doubles rows. Usable and
    rejected records are split in one pass, by the partition column ``rejected``.
    """
    stream = with_landed_file(
        spark.readStream.schema(schema)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(landing)
    )

    def store(batch: DataFrame, batch_id: int) -> None:
        marked = mark_rejected(with_landed_line(batch), key)
        out = marked.write.mode("overwrite").partitionBy("rejected")
        out.parquet(f"{target}/batch_id={batch_id}")

    return (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingested(
    spark: SparkSession, target: str, rejected: bool = False, schema: T.StructType = LANDED_DETAILS
) -> DataFrame:
    """Usable (or rejected) records of all batches, with batch_id and landing order."""
    added = {**dict(zip(LANDED_ORDER, _ORDER_TYPES, strict=True)), **_PART_TYPES}
    stored = T.StructType([*schema.fields, *[T.StructField(n, t) for n, t in added.items()]])
    rows = spark.read.schema(stored).option("basePath", target).parquet(target)
    rows = rows.where(F.col("rejected") == F.lit(rejected)).drop("rejected")
    return rows if rejected else rows.drop(CORRUPT)


def ingested_details(spark: SparkSession, target: str) -> DataFrame:
    """All usable details numbered in landing order, ready for a rebuild of the clean tables."""
    order = ["batch_id", *LANDED_ORDER]
    numbered = dense_ids(ingested(spark, target), order, "row_seq")
    return numbered.select("row_seq", "batch_id", *RAW_DETAIL_COLUMNS)

"""Batches that can be repeated.

A table is kept by batch number. Putting a batch writes its rows to a folder of its own and then
enters it in the ledger (the version files of ``sources.versions``), in one step for all batches of
the call. The last entry of a number counts, so a batch that is put again replaces itself and
doubles nothing, and one that was cut short before its entry does not exist. Progress and the
place to begin again come from the ledger, not from a file beside the data.
"""

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cataloom.constants import BATCH_SIZE
from cataloom.sources import versions
from cataloom.sources.tables import project

_LEDGER = "batches array<struct<batch: bigint, rows: bigint, last: bigint, path: string>>"


def put_batches(
    df: DataFrame,
    root: str,
    fields: Sequence[str],
    batch: str = "batch_id",
    position: str | None = None,
    numbers: Iterable[int] = (),
) -> int:
    """Store the batches that ``df`` has rows of, and enter them; the version of the ledger.

    ``fields`` are kept as text, missing ones null. ``numbers`` are batches that are done even
    if they have no rows. With ``position`` the ledger knows how far a batch got. Writers of
    different batches may work at the same time; of two that put the same one the later entry
    counts.
    """
    spark, root = df.sparkSession, root.rstrip("/")
    place = f"data/{uuid.uuid4().hex}"
    number = F.col(f"`{batch}`").cast("bigint").alias("_batch")
    at = (F.lit(None) if position is None else F.col(f"`{position}`")).cast("bigint").alias("_at")
    text = [F.col(f"`{c}`").cast("string").alias(c) for c in fields]
    rows = project(df, [*dict.fromkeys([*fields, batch, *([position] if position else [])])])
    rows.select(*text, number, at).write.partitionBy("_batch").parquet(f"{root}/{place}")
    written = spark.read.schema(_stored(fields)).parquet(f"{root}/{place}")
    sizes = written.groupBy("_batch").agg(F.count("*").alias("rows"), F.max("_at").alias("last"))
    found = {r["_batch"]: r for r in sizes.collect()}  # one row per batch
    if None in found:
        raise ValueError(f"rows without a {batch}")
    entries = [
        {"batch": n, "rows": r["rows"], "last": r["last"], "path": f"{place}/_batch={n}"}
        for n, r in sorted(found.items())
    ]
    entries += [
        {"batch": n, "rows": 0, "last": None, "path": None} for n in sorted(set(numbers) - set(found))
    ]
    while True:
        try:
            return versions.commit(spark, root, {"batches": entries}, versions.newest(spark, root))
        except versions.VersionConflict:
            continue  # an entry beside ours; ours comes after it


def _stored(fields: Sequence[str]) -> T.StructType:
    text = [T.StructField(f, T.StringType()) for f in fields]
    return T.StructType([*text, T.StructField("_at", T.LongType()), T.StructField("_batch", T.LongType())])


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """The batches done: batch, num_rows, last position, path below the root, version."""
    root = root.rstrip("/")
    if versions.newest(spark, root) < 0:
        kind = "batch bigint, num_rows bigint, last bigint, path string, version bigint"
        return spark.createDataFrame([], kind)
    files = spark.read.schema(_LEDGER).json(f"{versions.folder(root)}/*.json")
    number = F.regexp_extract(F.col("_metadata.file_name"), r"\d+", 0).cast("bigint")
    entries = files.select(number.alias("version"), F.inline("batches"))
    newest = F.max_by(F.struct("rows", "last", "path", "version"), "version").alias("_")
    found = entries.groupBy("batch").agg(newest)
    return found.select("batch", F.col("_.rows").alias("num_rows"), "_.last", "_.path", "_.version")


def read_batches(
    spark: SparkSession, root: str, fields: Sequence[str], batch: str = "batch_id"
) -> DataFrame:
    """The rows of all batches done, each batch once, with its number."""
    root = root.rstrip("/")
    entries = ledger(spark, root).where("path IS NOT NULL").select("path").collect()
    if not entries:
        kind = T.StructType([*_stored(fields).fields[:-2], T.StructField(batch, T.LongType())])
        return spark.createDataFrame([], kind)
    # One folder per batch.
    files = spark.read.schema(T.StructType(_stored(fields).fields[:-2]))
    rows = files.parquet(*[f"{root}/{r['path']}" for r in entries])
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/_batch=(-?\d+)/", 1)
    return rows.withColumn(batch, number.cast("bigint"))


def progress(spark: SparkSession, root: str, start: int = 0) -> DataFrame:
    """(batch, num_rows, done) per batch: ``done`` counts positions from ``start`` up to its last."""
    done = (F.col("last") - F.lit(start) + 1).alias("done")
    return ledger(spark, root).select("batch", "num_rows", done)


def restart_position(spark: SparkSession, root: str, start: int = 0, size: int = BATCH_SIZE) -> int:
    """The first position of the first batch that is not done, of batches of ``size`` positions
    numbered from ``start`` on, as ``operators.ids.with_batch`` gives them."""
    done = ledger(spark, root).select("batch")
    after = done.select((F.col("batch") + 1).alias("batch"))
    first = spark.range(1).select(F.col("id").alias("batch"))
    missing = after.where("batch >= 0").union(first).join(done, "batch", "left_anti")
    return start + size * missing.agg(F.min("batch")).first()[0]

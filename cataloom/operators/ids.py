"""Order-dependent operators: gap-free numbers, keep-first, work batches."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cataloom.constants import BATCH_SIZE
from cataloom.storage import materialize

_SLOT = "_slot"
_SLICE_BITS = 33  # monotonically_increasing_id: slice number above, row in slice below


def number_rows(
    df: DataFrame, order_cols: Sequence[str], id_col: str, **measures: Column
) -> tuple[DataFrame, list]:
    """Number rows 0…n-1 in ascending order, and summarise each range slice.

    The rows are range-partitioned into ordered slices (at most
    ``spark.sql.shuffle.partitions``; small neighbours are merged at run time) and each
    slice is numbered by its own task, so no task sees the whole order. Slices are written
    before they are counted: counts and numbers then come from the same rows even if an
    executor is lost. The driver sees one summary row per slice.
    ``order_cols`` must identify a row, else equal rows get their numbers in any order.
    """
    staged = materialize(
        df.repartitionByRange(*order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn(_SLOT, F.monotonically_increasing_id()),
        "ordered",
    )
    slice_no = F.shiftright(_SLOT, _SLICE_BITS)
    summary = (
        staged.groupBy(slice_no.alias("slice"))
        .agg(F.count("*").alias("rows"), *[m.alias(n) for n, m in measures.items()])
        .collect()
    )
    sizes = {row["slice"]: row["rows"] for row in summary}
    starts, total = [], 0
    for s in range(max(sizes, default=0) + 1):
        starts.append(total)
        total += sizes.get(s, 0)
    start_of = F.expr("array(" + ", ".join(f"{s}L" for s in starts) + ")")
    in_slice = F.col(_SLOT).bitwiseAND(F.lit((1 << _SLICE_BITS) - 1))
    position = F.get(start_of, slice_no.cast("int")) + in_slice
    return staged.select(position.alias(id_col), *df.columns), summary


def dense_ids(df: DataFrame, order_cols: Sequence[str], id_col: str) -> DataFrame:
    """Put a gap-free number 0…n-1, in the order of ``order_cols``, before the columns."""
    return number_rows(df, order_cols, id_col)[0]


def keep_first(df: DataFrame, key: str | Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """The first row of each key in the given order.

    The rank limit is applied in every map task before the shuffle, so a key that holds
    much of the table sends one row per task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def with_batch(
    df: DataFrame, position: str, start: int = 0, size: int = BATCH_SIZE, batch: str = "batch_id"
) -> DataFrame:
    """Rows from position ``start`` on, with the number of the batch each belongs to."""
    number = F.floor((F.col(position) - F.lit(start)) / F.lit(size))
    return df.where(F.col(position) >= start).withColumn(batch, number)


def batch_progress(
    batches: DataFrame, position: str, start: int = 0, batch: str = "batch_id"
) -> DataFrame:
    """Rows per batch and rows done after it.

    Positions have no gaps, so the running number is the last position of the batch: a
    plain aggregate, not a running window over all batches.
    """
    return batches.groupBy(batch).agg(
        F.count("*").alias("num_rows"),
        (F.max(position) - F.lit(start) + 1).alias("done"),
    )

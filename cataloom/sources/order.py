"""Row order of files."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cataloom.operators.ids import number_rows
from cataloom.operators.normalize import BROADCAST_BYTES

_ROW_BITS = 33


def with_file_order(
    df: DataFrame, path: str | Sequence[str], name: str = "row_seq"
) -> DataFrame:
    """Number the rows of a scan of ``path`` in file order: by path, then by place in the file.

    For sources read one task per file (multi-line CSV and JSON). The numbers have gaps;
    store them with the rows before any shuffle, for a later scan may pack files
    differently.
    """
    listing = df.sparkSession.read.format("binaryFile").load(path)
    listing = listing.select(F.col("_metadata.file_path").alias("_path"))
    files, summary = number_rows(
        listing, ["_path"], "_file_no", path_bytes=F.sum(F.octet_length("_path"))
    )
    if sum(row["path_bytes"] for row in summary) <= BROADCAST_BYTES:
        files = F.broadcast(files)
    # Within a file the id grows row by row; its upper bits say which task, not which file.
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    marked = df.withColumns({"_path": F.col("_metadata.file_path"), "_row": row})
    order = F.shiftleft("_file_no", _ROW_BITS) + F.col("_row")
    return (
        marked.join(files, "_path", "left")
        .withColumn(name, order)
        .drop("_path", "_row", "_file_no")
    )

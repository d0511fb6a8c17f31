"""Raw CSV: columns by header name, quotes doubled inside cells, line breaks inside cells."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cataloom.constants import NULL_TOKENS
from cataloom.functions import null_tokens
from cataloom.schemas import CORRUPT, RAW_DETAILS
from cataloom.sources.order import with_file_order

FORMAT = {"header": True, "quote": '"', "escape": '"'}
# The writer would otherwise trim cells.
WRITE_OPTIONS = FORMAT | {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def scan_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType = RAW_DETAILS,
    multi_line: bool = True,
) -> DataFrame:
    """All columns of the files under their header names, and ``_corrupt``.

    Columns may stand in any order among others; one that ``schema`` names and the header does
    not is an error. All files of a scan must have one header; another is an error too. A row
    with too few or too many cells, or with one that does not fit its type, fills ``_corrupt``.
    Without ``multi_line`` a cell cannot hold a line break, and large files are split.
    """
    options = FORMAT | {"multiLine": multi_line}
    header = spark.read.options(**options).csv(path).columns
    missing = [name for name in schema.names if name not in header]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in {path}")
    kinds = {f.name: f.dataType for f in schema}
    full = [T.StructField(name, kinds.get(name, T.StringType())) for name in header]
    strict = {
        "enforceSchema": False,
        "columnNameOfCorruptRecord": CORRUPT,
        # Else a row is only checked as far as the columns in use.
        "columnPruning": False,
    }
    text = T.StructField(CORRUPT, T.StringType())
    scan = spark.read.schema(T.StructType([*full, text])).options(**options, **strict).csv(path)
    # Spark refuses plans that need the corrupt text alone, as a mere count of sound rows would;
    # with nothing of a first cell added to it, they need a column beside it.
    nothing = F.substring(F.col(f"`{header[0]}`").cast("string"), 1, 0)
    return scan.withColumn(CORRUPT, F.nullif(F.concat_ws("", CORRUPT, nothing), F.lit("")))


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType = RAW_DETAILS,
    multi_line: bool = True,
) -> DataFrame:
    """The schema's columns of the sound rows of a CSV scan."""
    return sound(scan_csv(spark, path, schema, multi_line)).select(*schema.names)


def sound(scan: DataFrame) -> DataFrame:
    return scan.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def split_raw_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType = RAW_DETAILS,
    tokens: Sequence[str] = NULL_TOKENS,
    multi_line: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(sound rows with null tokens applied, rejected lines), each with a row_seq in file order.

    With line breaks inside cells a file is one task's work here; ``split_csv.split_csv`` shares
    large files among tasks. Write the result as Parquet once for everything later.
    """
    return told_apart(with_file_order(scan_csv(spark, path, schema, multi_line), path), schema, tokens)


def told_apart(
    ordered: DataFrame, schema: T.StructType, tokens: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """(sound rows, rejected lines) of a scan with ``row_seq``."""
    cells = {
        f.name: null_tokens(F.col(f.name), tokens)
        for f in schema
        if isinstance(f.dataType, T.StringType)
    }
    good = sound(ordered).select("row_seq", *schema.names).withColumns(cells)
    rejected = ordered.where(F.col(CORRUPT).isNotNull()).select("row_seq", CORRUPT)
    return good, rejected


def read_raw_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType = RAW_DETAILS,
    tokens: Sequence[str] = NULL_TOKENS,
    multi_line: bool = True,
) -> DataFrame:
    """The sound rows of ``split_raw_csv``."""
    return split_raw_csv(spark, path, schema, tokens, multi_line)[0]

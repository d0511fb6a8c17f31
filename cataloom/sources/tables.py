"""Writing, creating, filling and querying tables."""

import uuid
from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cataloom.schemas import CLEAN, load_order, writable
from cataloom.sources.raw_csv import WRITE_OPTIONS, read_csv
from cataloom.storage import materialize


def project(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Exactly the listed fields: extras go, missing ones are null text."""
    have = set(df.columns)
    return df.select(
        *[F.col(f) if f in have else F.lit(None).cast("string").alias(f) for f in fields]
    )


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", fields: Sequence[str] | None = None
) -> str:
    """Replace what is at ``path`` (any URI Spark can write) by the listed fields."""
    out = project(df, fields) if fields else df
    options = WRITE_OPTIONS if fmt == "csv" else {}
    out.write.mode("overwrite").format(fmt).options(**options).save(path)
    return path


def write_tables(tables: dict[str, DataFrame], base: str, fmt: str = "parquet") -> dict[str, str]:
    """One directory per table below ``base``."""
    return {name: write_table(df, f"{base}/{name}", fmt) for name, df in tables.items()}


def published_path(base: str, path: str) -> str:
    """Where a table goes below ``base``: under its stage and its name (``clean/apps``)."""
    return "/".join([base.rstrip("/"), *path.rstrip("/").split("/")[-2:]])


def publish(df: DataFrame, path: str, base: str, fmt: str = "parquet") -> str:
    """Write a table of stage path ``…/raw/x`` or ``…/clean/x`` to a shared store."""
    return write_table(df, published_path(base, path), fmt)


def reset_batches(
    spark: SparkSession, path: str, fields: Sequence[str], fmt: str = "parquet"
) -> None:
    """Empty the target of appended batches."""
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    write_table(spark.createDataFrame([], schema), path, fmt)


def append_batch(df: DataFrame, path: str, fields: Sequence[str], fmt: str = "parquet") -> None:
    """Add one batch, aligned by name."""
    options = WRITE_OPTIONS if fmt == "csv" else {}
    project(df, fields).write.mode("append").format(fmt).options(**options).save(path)


def append_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames, aligned by name, missing columns null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def conform(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows that fit a table schema, typed; and the rows that do not, as they came."""
    casts = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in schema}
    faults = [
        F.col(f"`{f.name}`").isNotNull() & casts[f.name].isNull()
        if f.nullable
        else casts[f.name].isNull()
        for f in schema
    ]
    faulty = reduce(lambda a, b: a | b, faults)
    good = df.where(~faulty).select(*[c.alias(n) for n, c in casts.items()])
    return good, df.where(faulty)


def read_staged(spark: SparkSession, base: str, name: str, fmt: str = "parquet") -> DataFrame:
    """A staged table of the clean schema; CSV cells come as text."""
    schema = CLEAN[name]
    if fmt == "csv":
        text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
        return read_csv(spark, f"{base}/{name}", text)
    return spark.read.schema(writable(schema)).format(fmt).load(f"{base}/{name}")


def create_tables(
    spark: SparkSession,
    root: str,
    names: Sequence[str] = tuple(CLEAN),
    database: str = "default",
    buckets: int = 0,
) -> None:
    """Create the missing ones of the clean tables, empty, below ``root``."""
    for name in load_order(names):
        if not spark.catalog.tableExists(f"{database}.{name}"):
            _empty(spark, root, name, database, buckets)


def prepare_tables(
    spark: SparkSession,
    root: str,
    names: Sequence[str] = tuple(CLEAN),
    database: str = "default",
    buckets: int = 0,
) -> None:
    """Empty the clean tables, creating those that are missing."""
    for name in load_order(names):
        _empty(spark, root, name, database, buckets)


def load_tables(
    spark: SparkSession,
    staged: str,
    root: str,
    names: Sequence[str] = tuple(CLEAN),
    database: str = "default",
    fmt: str = "parquet",
    buckets: int = 0,
) -> dict[str, DataFrame]:
    """Full refresh of tables from staged directories; gives the rejected rows per table.

    All tables, and their rejected rows, are written to a new directory first; only then is
    each table pointed at its new data, parents before children. A failure while writing, or a
    table with other columns, leaves all old data in place. The tables are switched one after
    the other, not in one step: a reader between two switches can join a new bridge to an old
    dimension, whose ids differ, and a table whose bucket count changes is missing for a
    moment. Readers that cannot wait for the refresh to end should be given a database of
    their own per refresh.

    With ``buckets`` the facts and bridges are stored bucketed by application, so that
    joining them shuffles neither. One application's links then stay in one file; leave
    it off where a single application may hold a large share of all links.
    """
    version = f"{root}/{uuid.uuid4().hex}"
    rejected = {}
    for name in load_order(names):
        _check_columns(spark, database, name)
    for name in load_order(names):
        good, bad = conform(read_staged(spark, staged, name, fmt), CLEAN[name])
        _write_version(good, f"{version}/{name}", database, buckets)
        rejected[name] = materialize(bad, name, f"{version}/rejected/{name}")
    for name in load_order(names):
        _switch(spark, database, name, f"{version}/{name}", buckets)
    return rejected


BUCKET_KEY = "id_app"


def _empty(spark: SparkSession, root: str, name: str, database: str, buckets: int) -> None:
    path = f"{root}/{uuid.uuid4().hex}/{name}"
    _write_version(spark.createDataFrame([], writable(CLEAN[name])), path, database, buckets)
    _switch(spark, database, name, path, buckets)


def _write_version(df: DataFrame, path: str, database: str, buckets: int) -> None:
    if not buckets or BUCKET_KEY not in df.columns:
        write_table(df, path)
        return
    # Spark writes buckets only through a table; its files outlive this external one.
    holder = f"`{database}`.`v{uuid.uuid4().hex}`"
    writer = df.repartition(buckets, BUCKET_KEY).write.format("parquet").option("path", path)
    writer.bucketBy(buckets, BUCKET_KEY).sortBy(BUCKET_KEY).saveAsTable(holder)
    df.sparkSession.sql(f"DROP TABLE {holder}")


def _bucket_count(spark: SparkSession, table: str) -> int:
    described = spark.sql(f"DESCRIBE EXTENDED {table}")
    row = described.where(F.col("col_name") == "Num Buckets").first()
    return int(row["data_type"]) if row else 0


def _check_columns(spark: SparkSession, database: str, name: str) -> None:
    """An existing table must have the columns that it is about to be given."""
    if spark.catalog.tableExists(f"{database}.{name}"):
        found = {(f.name, f.dataType) for f in spark.table(f"`{database}`.`{name}`").schema}
        if found != {(f.name, f.dataType) for f in CLEAN[name]}:
            raise ValueError(f"table {database}.{name} has other columns than {name}")


def _switch(spark: SparkSession, database: str, name: str, path: str, buckets: int) -> None:
    """Point a table at a finished directory."""
    table = f"`{database}`.`{name}`"
    columns = writable(CLEAN[name])
    buckets = buckets if BUCKET_KEY in columns.names else 0
    location = path.replace("'", "\\'")
    if spark.catalog.tableExists(f"{database}.{name}"):
        if _bucket_count(spark, table) == buckets:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {table}")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    layout = (
        f"CLUSTERED BY ({BUCKET_KEY}) SORTED BY ({BUCKET_KEY}) INTO {buckets} BUCKETS"
        if buckets
        else ""
    )
    spark.sql(f"CREATE TABLE {table} ({fields}) USING parquet {layout} LOCATION '{location}'")


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Append rows to a table of an external database, keeping its structure."""
    df.write.jdbc(url, table, mode="append", properties=properties)


def run_sql(spark: SparkSession, query: str, args: dict[str, Any] | None = None) -> DataFrame:
    """A lazy result; values come as named parameters, never pasted into the text."""
    return spark.sql(query, args=args or {})

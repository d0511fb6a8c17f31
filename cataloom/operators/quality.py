"""Declared constraints as reports (check, table, column, violations)."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cataloom.schemas import CLEAN, FOREIGN_KEYS, PRIMARY_KEYS


def _report(df: DataFrame, check: str, table: str, column: str, violations) -> DataFrame:
    return df.agg(F.coalesce(violations, F.lit(0)).cast("bigint").alias("violations")).select(
        F.lit(check).alias("check"),
        F.lit(table).alias("table"),
        F.lit(column).alias("column"),
        "violations",
    )


def check_not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Nulls per required column, all columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = [
        F.struct(
            F.lit("not_null").alias("check"),
            F.lit(table).alias("table"),
            F.lit(c).alias("column"),
            F.col(c).alias("violations"),
        )
        for c in columns
    ]
    return counts.select(F.inline(F.array(*rows)))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys met more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("num_rows")).where("num_rows > 1")


def check_primary_key(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Keys that are not unique."""
    found = duplicate_keys(df, keys)
    return _report(found, "primary_key", table, ",".join(keys), F.count("*"))


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Key values without a parent, with their number of rows; null points nowhere and passes.

    Rows are counted per key before the join, so a hot key is one row there.
    """
    used = df.where(F.col(column).isNotNull()).groupBy(column)
    used = used.agg(F.count("*").alias("num_rows"))
    known = parent.select(F.col(parent_column).alias(column))
    return used.join(known, column, "left_anti")


def check_foreign_key(
    df: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Rows that point at no parent."""
    found = orphans(df, column, parent, parent_column)
    return _report(found, "foreign_key", table, column, F.sum("num_rows"))


def check_table(df: DataFrame, table: str, key: str, required: Sequence[str]) -> DataFrame:
    """Nulls per required column and keys that are not unique, in one pass over the table."""
    per_key = df.groupBy(key).agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(required)],
    )
    counts = per_key.agg(
        F.count_if(F.col("_rows") > 1).alias("_key"),
        *[F.coalesce(F.sum(f"_{i}"), F.lit(0)).alias(f"_{i}") for i in range(len(required))],
    )

    def row(check: str, column: str, count: str):
        return F.struct(
            F.lit(check).alias("check"),
            F.lit(table).alias("table"),
            F.lit(column).alias("column"),
            F.col(count).cast("bigint").alias("violations"),
        )

    rows = [row("not_null", c, f"_{i}") for i, c in enumerate(required)]
    return counts.select(F.inline(F.array(*rows, row("primary_key", key, "_key"))))


def check_foreign_keys(
    df: DataFrame, table: str, parents: Sequence[tuple[str, DataFrame, str]]
) -> DataFrame:
    """Rows that point at no parent, for all (column, parent, parent column) in one pass."""
    ends = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("key")) for c, _, _ in parents]
    )
    used = (
        df.select(F.inline(ends))
        .where(F.col("key").isNotNull())
        .groupBy("column", "key")
        .agg(F.count("*").alias("num_rows"))
    )
    known = reduce(
        DataFrame.union,
        [p.select(F.lit(c).alias("column"), F.col(k).alias("key")) for c, p, k in parents],
    )
    lost = used.join(known, ["column", "key"], "left_anti")
    counts = lost.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("column") == c, F.col("num_rows"))), F.lit(0)).alias(
                f"_{i}"
            )
            for i, (c, _, _) in enumerate(parents)
        ]
    )
    rows = [
        F.struct(
            F.lit("foreign_key").alias("check"),
            F.lit(table).alias("table"),
            F.lit(c).alias("column"),
            F.col(f"_{i}").cast("bigint").alias("violations"),
        )
        for i, (c, _, _) in enumerate(parents)
    ]
    return counts.select(F.inline(F.array(*rows)))


def report(tables: dict[str, DataFrame]) -> DataFrame:
    """Every declared constraint of the clean tables; each table with a key and each bridge is
    read once for its own checks, and once more for what it is a parent of."""
    parts = [
        check_table(tables[t], t, key, [f.name for f in CLEAN[t] if not f.nullable])
        for t, key in PRIMARY_KEYS.items()
    ]
    for name in dict.fromkeys(t for t, *_ in FOREIGN_KEYS):
        parents = [(c, tables[p], k) for t, c, p, k in FOREIGN_KEYS if t == name]
        parts.append(check_foreign_keys(tables[name], name, parents))
    return reduce(DataFrame.unionByName, parts)

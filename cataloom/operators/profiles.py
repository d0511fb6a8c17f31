"""Profiles of a stored table that are kept, file by file, and brought up to date.

Each file of the table has a row: numbers of rows and nulls, bounds, a sketch of the different
values and, of numbers, one of the quantiles. Rows of files that are there already are kept, so
an update reads new files only, and a profile adds the rows up without reading the table. Where
the estimate leaves open whether a column is categorical (below twice the threshold) its values are
counted exactly, so kinds are right.

Estimates: ``n_distinct`` is within 5 % in more than 99 of 100 cases (HyperLogLog sketches of 2^12
registers, whose standard error is 1.6 %); a quantile's rank is within 0.02 of the one asked for in
99 of 100 cases (KLL sketches with k = 200).
"""

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cataloom.constants import CATEGORICAL_BELOW
from cataloom.operators.explore import _kind
from cataloom.sources import snapshots

TABLE = "file_profiles"
REGISTERS = 12  # binary logarithm of their number
KLL = 200
QUANTILES = (0.01, 0.25, 0.5, 0.75, 0.99)
_FILE = ("file_path", "file_size", "file_modification_time")


def _files(spark: SparkSession, path: str) -> DataFrame:
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return listing.select(*[F.col(f"_metadata.{c}").alias(c) for c in _FILE])


def _is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def update_profiles(
    spark: SparkSession,
    path: str,
    root: str,
    schema: T.StructType | None = None,
    columns: Sequence[str] | None = None,
) -> int:
    """Profile the files below ``path`` that have no row yet, or have changed; how many they were.

    Rows are kept as a snapshot table below ``root``; those of files that are gone are dropped. A
    table is profiled with the same columns every time.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    table = reader.parquet(path)
    fields = [f for f in table.schema if columns is None or f.name in columns]
    state = snapshots.current(spark, root)
    listed = _files(spark, path)
    new, kept = listed, None
    if TABLE in state.tables:
        known = state.read(spark, TABLE)
        new = listed.join(known, list(_FILE), "left_anti")
        kept = known.join(listed, list(_FILE), "left_semi")
    names = [r["file_path"] for r in new.select("file_path").collect()]  # what a listing has anyway
    if not names and (kept is None or kept.count() == state.tables[TABLE].rows):
        return 0
    aggregates = [F.count("*").alias("rows")]
    for i, field in enumerate(fields):
        col = F.col(f"`{field.name}`")
        aggregates += [
            F.count(col).alias(f"n{i}"),
            F.min(col).alias(f"lo{i}"),
            F.max(col).alias(f"hi{i}"),
            F.hll_sketch_agg(col.cast("string"), F.lit(REGISTERS)).alias(f"hll{i}"),
        ]
        if _is_number(field.dataType):
            aggregates.append(F.kll_sketch_agg_double(col.cast("double"), F.lit(KLL)).alias(f"kll{i}"))
    meta = [F.col(f"_metadata.{c}").alias(c) for c in _FILE]
    some = table.where(F.col("_metadata.file_path").isin(names))
    made = some.select(*meta, *[F.col(f"`{f.name}`") for f in fields]).groupBy(*_FILE).agg(*aggregates)
    rows = made if kept is None else kept.unionByName(made)
    notes = {"columns": T.StructType(fields).json(), "path": path}
    snapshots.replace(spark, root, {TABLE: rows}, after=state.version, notes=notes)
    return len(names)


def stored_profile(spark: SparkSession, root: str) -> DataFrame:
    """A row per column: kind, n_distinct and whether it is exact, nulls, bounds, step, quantiles
    (of numbers)."""
    state = snapshots.current(spark, root)
    files, path = state.read(spark, TABLE), state.notes["path"]
    fields = T.StructType.fromJson(json.loads(state.notes["columns"])).fields
    aggregates, rows = [F.sum("rows").alias("rows")], []
    for i, field in enumerate(fields):
        aggregates += [
            F.sum(f"n{i}").alias(f"n{i}"),
            F.min(f"lo{i}").alias(f"lo{i}"),
            F.max(f"hi{i}").alias(f"hi{i}"),
            F.hll_sketch_estimate(F.hll_union_agg(f"hll{i}")).alias(f"d{i}"),
        ]
        if _is_number(field.dataType):
            sketch = F.kll_merge_agg_double(f"kll{i}", F.lit(KLL))
            at = F.array(*[F.lit(q) for q in QUANTILES])
            some = F.kll_sketch_get_n_double(sketch) > 0
            aggregates.append(F.when(some, F.kll_sketch_get_quantile_double(sketch, at)).alias(f"q{i}"))
        kind, number = _kind(field.dataType), _is_number(field.dataType)
        low, high = F.col(f"lo{i}"), F.col(f"hi{i}")
        step = (high - low).cast("double") / 100 if number else F.lit(None).cast("double")
        rows.append(
            F.struct(
                F.lit(field.name).alias("column"),
                F.lit(kind).alias("kind"),
                F.col(f"d{i}").cast("bigint").alias("n_distinct"),
                (F.col("rows") - F.col(f"n{i}")).alias("num_nulls"),
                low.cast("string").alias("min"),
                high.cast("string").alias("max"),
                step.alias("step"),
                (F.col(f"q{i}") if number else F.lit(None)).cast("array<double>").alias("quantiles"),
            )
        )
    merged = files.agg(*aggregates).select(F.inline(F.array(*rows)))
    found = merged.collect()  # one row per column
    unsure = [r["column"] for r in found if (r["n_distinct"] or 0) < 2 * CATEGORICAL_BELOW]
    table = spark.read.parquet(path)
    known = files.select("file_path")
    counts = {}
    for name in unsure:
        one = table.select(F.col("_metadata.file_path").alias("file_path"), F.col(f"`{name}`").alias("v"))
        # Of the files in the profile, whatever has come since.
        counts[name] = one.join(known, "file_path", "left_semi").select("v").distinct().agg(F.count("v")).first()[0]
    kinds = "column string, kind string, n_distinct bigint, exact boolean, num_nulls bigint, min string, max string, step double, quantiles array<double>"
    out = []
    for r in found:
        exact = r["column"] in counts
        number = counts.get(r["column"], r["n_distinct"])
        kind = "categorical" if number < CATEGORICAL_BELOW else r["kind"]
        out.append((r["column"], kind, number, exact, r["num_nulls"], r["min"], r["max"], r["step"], r["quantiles"]))
    return spark.createDataFrame(out, kinds)

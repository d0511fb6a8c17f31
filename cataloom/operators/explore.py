"""Looking at tables: facet values, previews, profiles, ad-hoc filters, freshness."""

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cataloom.constants import CATEGORICAL_BELOW, DISPLAY_LABELS, PREVIEW_ROWS, UPDATE_TEXT
from cataloom.functions import elapsed_text


def facet_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values in ascending order, null last."""
    return df.select(column).distinct().orderBy(F.col(column).asc_nulls_last())


def table_names(spark: SparkSession, database: str = "default") -> list[str]:
    """Stored tables of a database (no views), by name."""
    tables = spark.catalog.listTables(database)
    return sorted(t.name for t in tables if t.tableType in ("MANAGED", "EXTERNAL"))


def preview(
    spark: SparkSession, database: str = "default", n: int = PREVIEW_ROWS
) -> dict[str, DataFrame]:
    """A few rows, any, of every stored table."""
    return {
        name: spark.table(f"`{database}`.`{name}`").limit(n)
        for name in table_names(spark, database)
    }


def _kind(data_type: T.DataType) -> str:
    if isinstance(data_type, T.NumericType):
        return "numeric"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "datetime"
    return "text"


def profile(
    df: DataFrame, columns: Sequence[str] | None = None, exact: bool | str = True
) -> DataFrame:
    """One row per column: filter kind, distinct values (nulls not counted), bounds, step.

    Exact counts are taken column by column: each reads one column of the stored table and
    shuffles its distinct values only, where one aggregate would copy every row per column.
    ``exact=False`` estimates the counts, all columns in one pass without a shuffle of values.
    ``exact="kind"`` estimates first and counts exactly where the estimate leaves open whether
    a column is categorical, so kinds are right and wide tables cost about one pass.
    """
    columns = list(columns or df.columns)
    if exact is False:
        return _profile(df, columns, F.approx_count_distinct)
    parts = []
    if exact == "kind":
        estimate = _profile(df, columns, F.approx_count_distinct)
        counts = {r["column"]: r["n_distinct"] for r in estimate.collect()}
        columns = [c for c in columns if counts[c] < 2 * CATEGORICAL_BELOW]
        parts.append(estimate.where(~F.col("column").isin(columns)) if columns else estimate)
    parts += [_profile(df.select(f"`{c}`").distinct(), [c], F.count) for c in columns]
    return reduce(DataFrame.unionByName, parts)


def _profile(df: DataFrame, columns: Sequence[str], count) -> DataFrame:
    aggregates, rows = [], []
    for i, name in enumerate(columns):
        col = F.col(f"`{name}`")
        aggregates += [
            count(col).alias(f"n{i}"), F.min(col).alias(f"lo{i}"), F.max(col).alias(f"hi{i}"),
        ]
        kind = _kind(df.schema[name].dataType)
        low, high = F.col(f"lo{i}"), F.col(f"hi{i}")
        step = (high - low).cast("double") / 100 if kind == "numeric" else F.lit(None)
        rows.append(
            F.struct(
                F.lit(name).alias("column"),
                F.when(F.col(f"n{i}") < CATEGORICAL_BELOW, "categorical")
                .otherwise(kind)
                .alias("kind"),
                F.col(f"n{i}").alias("n_distinct"),
                low.cast("string").alias("min"),
                high.cast("string").alias("max"),
                step.cast("double").alias("step"),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def categories(df: DataFrame, column: str) -> DataFrame:
    """The values a categorical filter offers, null among them."""
    return df.select(column).distinct()


@dataclass(frozen=True)
class In:
    """Keep rows with one of the values; ``None`` among them keeps nulls."""

    column: str
    values: Sequence[Any]

    def predicate(self) -> Column:
        col = F.col(f"`{self.column}`")
        hit = col.isin([v for v in self.values if v is not None])
        return hit | col.isNull() if None in self.values else hit


@dataclass(frozen=True)
class Between:
    """Keep rows within both bounds; no effect while a bound is missing."""

    column: str
    low: Any
    high: Any

    def predicate(self) -> Column:
        if self.low is None or self.high is None:
            return F.lit(True)
        return F.col(f"`{self.column}`").between(F.lit(self.low), F.lit(self.high))


@dataclass(frozen=True)
class Matches:
    """Keep rows in which the pattern (Java syntax) is found, case-sensitive.

    Null does not match; an empty pattern keeps every row.
    """

    column: str
    pattern: str

    def predicate(self) -> Column:
        if not self.pattern:
            return F.lit(True)
        return F.col(f"`{self.column}`").rlike(self.pattern)


def apply_filters(df: DataFrame, specs: Sequence[In | Between | Matches]) -> DataFrame:
    """All filters, one after the other, on the same lazy plan."""
    return reduce(lambda d, spec: d.where(spec.predicate()), specs, df)


def as_datetime(text: Column) -> Column:
    """A date-time with a year of exactly four digits, on its own or followed by more of a
    date; null for all else, such as longer runs of digits."""
    shaped = text.rlike(r"^\s*\d{4}\s*$|^\s*\d{4}-")
    return F.when(shaped, text.try_cast("timestamp_ntz"))


def cast_datetimes(df: DataFrame) -> DataFrame:
    """Text columns of which every value is a date-time become timestamps without zone.

    One aggregate over all text columns decides; timestamps with zone drop it. A column of
    bare years counts as dates, one of other digits stays text.
    """
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    as_time = {c: as_datetime(F.col(f"`{c}`")) for c in texts}
    changes = {
        f.name: F.col(f"`{f.name}`").cast("timestamp_ntz")
        for f in df.schema
        if isinstance(f.dataType, T.TimestampType)
    }
    if texts:
        bad = [
            F.count_if(F.col(f"`{c}`").isNotNull() & t.isNull()).alias(c)
            for c, t in as_time.items()
        ]
        counts = df.agg(*bad).first()
        changes |= {c: t for c, t in as_time.items() if counts[c] == 0}
    return df.withColumns(changes) if changes else df


def explore_table(
    df: DataFrame, specs: Sequence[In | Between | Matches] = (), exact: bool | str = True
) -> tuple[DataFrame, DataFrame]:
    """(profile that says which filter each column takes, rows that pass the chosen filters).

    Date-times kept as text are found first, so both see them as date-times. Counts are exact
    unless ``exact`` asks for estimates (see ``profile``).
    """
    typed = cast_datetimes(df)
    return profile(typed, exact=exact), apply_filters(typed, specs)


def display_names(df: DataFrame, labels: dict = DISPLAY_LABELS) -> DataFrame:
    """Columns under the names shown to readers."""
    return df.withColumnsRenamed({c: labels.get(c, c.capitalize()) for c in df.columns})


def freshness(
    df: DataFrame,
    now: datetime | Column,
    loaded_at: str = "_loaded_at",
    zone: str | None = None,
    latest: bool = False,
) -> DataFrame:
    """Load time of a table (the earliest row, or the latest) and how long ago that was."""
    pick = F.max if latest else F.min
    last = df.agg(pick(loaded_at).alias("last_update"))
    seconds = F.timestamp_diff("SECOND", F.col("last_update"), F.lit(now))
    message = F.concat(F.lit(UPDATE_TEXT), elapsed_text(seconds), F.lit(" ago"))
    if zone:
        session_zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
        local = F.convert_timezone(F.lit(session_zone), F.lit(zone), F.col("last_update"))
    else:
        local = F.col("last_update")
    return last.select(local.alias("last_update"), message.alias("message"))


def table_freshness(
    spark: SparkSession, table: str, now: datetime, zone: str | None = None, latest: bool = False
) -> DataFrame:
    """Freshness of a stored table; a row was loaded when its file was written."""
    written = F.col("_metadata.file_modification_time").alias("_loaded_at")
    return freshness(spark.table(table).select(written), now, zone=zone, latest=latest)

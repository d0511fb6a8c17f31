"""Tables that are refreshed together: a reader sees all of them old or all of them new.

The files of a refresh go to a folder of their own, which nobody reads until a version file (see
``sources.versions``) names them, for all tables at once. A failure before that leaves the state in
force as it is. Old files stay; ``unused_folders`` tells which no recent version needs.
"""

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cataloom.operators import quality
from cataloom.schemas import CLEAN, load_order, writable
from cataloom.sources import versions
from cataloom.sources.tables import conform, read_staged
from cataloom.storage import materialize


class BrokenSnapshot(ValueError):
    """Tables about to be put in force break their keys."""


@dataclass(frozen=True)
class Part:
    path: str  # below the root, so that the whole can be moved
    rows: int


@dataclass(frozen=True)
class Stored:
    """A table of a snapshot: its columns and the folders its rows are in."""

    schema: str
    parts: tuple[Part, ...] = ()

    @property
    def rows(self) -> int:
        return sum(p.rows for p in self.parts)


@dataclass(frozen=True)
class Snapshot:
    """One state of all tables. What is read through it stays the same during and after later
    refreshes."""

    root: str
    version: int
    tables: Mapping[str, Stored]
    notes: Mapping[str, Any] = field(default_factory=dict)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        stored = self.tables[name]
        schema = T.StructType.fromJson(json.loads(stored.schema))
        paths = [f"{self.root}/{p.path}" for p in stored.parts]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def frames(self, spark: SparkSession) -> dict[str, DataFrame]:
        return {name: self.read(spark, name) for name in self.tables}

    def register(self, spark: SparkSession, prefix: str = "") -> None:
        """Temporary views of all tables, for SQL in this session."""
        for name, df in self.frames(spark).items():
            df.createOrReplaceTempView(f"{prefix}{name}")


def at_version(spark: SparkSession, root: str, number: int) -> Snapshot:
    """An earlier state, as long as its files are there."""
    root = root.rstrip("/")
    found = versions.content(spark, root, number)
    tables = {
        name: Stored(t["schema"], tuple(Part(**p) for p in t["parts"]))
        for name, t in found.get("tables", {}).items()
    }
    return Snapshot(root, number, tables, found.get("notes", {}))


def current(spark: SparkSession, root: str) -> Snapshot:
    """The state in force; without tables, and of version -1, if there is none yet."""
    return at_version(spark, root, versions.newest(spark, root))


def store(spark: SparkSession, root: str, frames: Mapping[str, DataFrame]) -> dict[str, Stored]:
    """Write tables to a new folder; nobody reads them before they are put in force."""
    root, batch = root.rstrip("/"), f"data/{uuid.uuid4().hex}"
    out = {}
    for name, df in frames.items():
        written = materialize(df, name, f"{root}/{batch}/{name}")
        schema = writable(df.schema).json()
        out[name] = Stored(schema, (Part(f"{batch}/{name}", written.count()),))
    return out


def put_in_force(
    spark: SparkSession, root: str, tables: Mapping[str, Stored], after: int, notes: Mapping | None = None
) -> Snapshot:
    """Make stored tables the state after version ``after``, in one step.

    VersionConflict if another writer was faster: its state stays, and this one's files are not
    used. Start again from what is in force then.
    """
    what = {"tables": {n: asdict(t) for n, t in tables.items()}, "notes": dict(notes or {})}
    number = versions.commit(spark, root, what, after)
    return Snapshot(root.rstrip("/"), number, dict(tables), dict(notes or {}))


def replace(
    spark: SparkSession,
    root: str,
    frames: Mapping[str, DataFrame],
    after: int | None = None,
    check: bool = False,
    notes: Mapping | None = None,
) -> Snapshot:
    """Put new contents of some tables in force together; the others stay what they are.

    ``after`` is the version that the contents were made from; by default the one in force when the
    call begins. With ``check`` they are held against the rules of the clean tables before, and
    BrokenSnapshot is raised if some are broken.
    """
    before = current(spark, root) if after is None else at_version(spark, root, after)
    stored = dict(before.tables) | store(spark, root, frames)
    if check:
        made = Snapshot(root.rstrip("/"), -1, stored).frames(spark)
        broken = quality.report({n: made[n] for n in CLEAN}).where("violations > 0").collect()
        if broken:
            raise BrokenSnapshot("; ".join(f"{r['check']} {r['table']}.{r['column']}" for r in broken))
    return put_in_force(spark, root, stored, before.version, notes)


def load_snapshot(
    spark: SparkSession,
    staged: str,
    root: str,
    names: Sequence[str] = tuple(CLEAN),
    fmt: str = "parquet",
    check: bool = False,
) -> tuple[Snapshot, dict[str, DataFrame]]:
    """Full refresh of tables from staged directories, in one step; and the rejected rows per
    table, which keep a folder of their own."""
    before = versions.newest(spark, root)
    good, rejected = {}, {}
    reports = f"{root.rstrip('/')}/rejected/{uuid.uuid4().hex}"
    for name in load_order(names):
        good[name], bad = conform(read_staged(spark, staged, name, fmt), CLEAN[name])
        rejected[name] = materialize(bad, name, f"{reports}/{name}")
    return replace(spark, root, good, before, check), rejected


def empty_snapshot(spark: SparkSession, root: str, names: Iterable[str] = tuple(CLEAN)) -> Snapshot:
    """Empty the named tables in one step, adding those that are missing."""
    before = current(spark, root)
    empty = {n: Stored(writable(CLEAN[n]).json()) for n in names}
    return put_in_force(spark, root, dict(before.tables) | empty, before.version)


def history(spark: SparkSession, root: str) -> DataFrame:
    """(version, table_name, num_rows, parts) of all states."""
    kind = (
        "tables map<string, struct<schema: string, parts: array<struct<path: string, rows: bigint>>>>"
    )
    files = spark.read.schema(kind).json(f"{versions.folder(root)}/*.json")
    number = F.regexp_extract(F.col("_metadata.file_name"), r"\d+", 0).cast("bigint")
    rows = files.select(number.alias("version"), F.explode("tables").alias("table_name", "stored"))
    count = F.aggregate("stored.parts", F.lit(0).cast("bigint"), lambda n, p: n + p["rows"])
    return rows.select(
        "version", "table_name", count.alias("num_rows"), F.size("stored.parts").alias("parts")
    )


def unused_folders(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Data folders that only versions before the last ``keep`` ones name."""
    last = versions.newest(spark, root)

    def named(numbers: Iterable[int]) -> set[str]:
        found = (at_version(spark, root, n).tables.values() for n in numbers)
        return {p.path for tables in found for t in tables for p in t.parts}

    recent = max(0, last + 1 - keep)
    gone = named(range(recent)) - named(range(recent, last + 1))
    return sorted(f"{root.rstrip('/')}/{p}" for p in gone)

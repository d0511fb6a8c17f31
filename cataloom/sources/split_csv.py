"""CSV with line breaks inside cells, read by many tasks per file.

A line break ends a record only where the quotes before it in the file are even in number, which
a task that begins somewhere in the file cannot know. So there are two passes. The first counts the
quotes of each split; sums over the splits before give the state at each split's start. The
second walks each split's lines with that state: records that begin and end in the split are whole,
and the pieces of a record that crosses into later splits are put together by a group of their own.
Spark's CSV functions then take the records apart.

Quotes stand around cells and are doubled inside, as RFC 4180 has it; a lone quote within a bare
cell would shift the state, and a file with an odd number of them is an error. One carriage return
before a record's line feed belongs to the line end. Empty lines are no records.
"""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cataloom.constants import NULL_TOKENS
from cataloom.operators.ids import dense_ids
from cataloom.operators.sizes import broadcast_if_small
from cataloom.schemas import CORRUPT, RAW_DETAILS
from cataloom.sources.raw_csv import FORMAT, told_apart
from cataloom.storage import materialize

_ROW_BITS = 33
_WHOLE, _BEGIN, _REST = 0, 1, 2  # a record; the beginning of one; a later piece of one
_PIECES = "file string, block bigint, number bigint, kind int, text string"


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines as they stand, up to the line feed, with their file and split, in order."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )


def split_states(lines: DataFrame) -> DataFrame:
    """(file, block, inside): whether a split begins inside a quoted cell."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counts = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
    counts = materialize(counts, "quotes")
    open_files = counts.groupBy("file").agg(F.sum("odd").alias("odd")).where("odd % 2 = 1")
    unclosed = [r["file"] for r in open_files.limit(5).collect()]
    if unclosed:
        raise ValueError(f"an odd number of quotes in {', '.join(unclosed)}")
    # One row per split of a file.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(before) % 2, F.lit(0)) == 1
    return materialize(counts.select("file", "block", inside.alias("inside")), "states")


def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of the records, from lines in order with the state at their split's start."""
    walker = _Walker()
    for batch in batches:
        yield from walker.take(batch)
    yield from walker.end()


class _Walker:
    """What is open at a line: its split, the quotes so far, and the lines of a record begun."""

    def __init__(self):
        self.split: tuple[str, int] | None = None
        self.inside = False
        self.begun: list[str] = []
        self.rest = False  # what is begun has its beginning in an earlier split
        self.number = 0

    def take(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        block = batch.column("block").to_numpy()
        files = batch.column("file").dictionary_encode()
        file = files.indices.to_numpy()
        edges = np.flatnonzero((np.diff(block) != 0) | (np.diff(file) != 0)) + 1
        for lo, hi in zip([0, *edges], [*edges, len(block)], strict=True):
            if lo == hi:
                continue
            split = (files.dictionary[int(file[lo])].as_py(), int(block[lo]))
            if split != self.split:
                yield from self.end()
                self.split, self.number = split, 0
                self.inside = self.rest = batch.column("inside")[int(lo)].as_py()
            yield self.lines(batch.column("value").slice(lo, hi - lo))

    def lines(self, values: pa.Array) -> pa.RecordBatch:
        quotes = pc.count_substring(values, '"').to_numpy(zero_copy_only=False)
        after = (np.cumsum(quotes) + self.inside) % 2 == 1
        before = np.concatenate([[self.inside], after[:-1]])
        # Lines that are a record by themselves stay as they are; few others are joined.
        single = ~before & ~after
        texts: list[tuple[int, int, str]] = []  # place, kind, text
        for i in np.flatnonzero(~single):
            self.begun.append(values[int(i)].as_py())
            if not after[i]:
                texts.append((int(i), _REST if self.rest else _WHOLE, "\n".join(self.begun)))
                self.begun, self.rest = [], False
        self.inside = bool(after[-1])
        places = np.concatenate([np.flatnonzero(single), np.array([t[0] for t in texts], np.int64)])
        kinds = np.concatenate([np.full(single.sum(), _WHOLE), np.array([t[1] for t in texts], np.int64)])
        joined = pa.array([t[2] for t in texts], values.type)
        text = pa.concat_arrays([values.filter(pa.array(single)), joined])
        order = places.argsort(kind="stable")
        text, kinds = text.take(pa.array(order)), kinds[order]
        full = pc.invert(pc.is_in(text, pa.array(["", "\r"], values.type))).to_numpy(zero_copy_only=False)
        full |= kinds == _REST
        return self._sent(text.filter(pa.array(full)), kinds[full])

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.begun:
            text = pa.array(["\n".join(self.begun)], pa.string())
            yield self._sent(text, np.array([_REST if self.rest else _BEGIN]))
        self.begun = []

    def _sent(self, text: pa.Array, kinds: np.ndarray) -> pa.RecordBatch:
        counted = kinds != _REST
        numbers = self.number + np.cumsum(counted) - counted
        self.number += int(counted.sum())
        n = len(text)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([self.split[0]] * n, pa.string()),
                pa.array(np.full(n, self.split[1], np.int64)),
                pa.array(numbers.astype(np.int64)),
                pa.array(kinds.astype(np.int32)),
                text.cast(pa.string()),
            ],
            names=["file", "block", "number", "kind", "text"],
        )


def records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(row_seq, is_header, text) of all records, the header of each file among them.

    ``row_seq`` follows the order of the files' paths and the place in the file, with gaps between
    files.
    """
    lines = _lines(spark, path)
    states = split_states(lines)
    few = broadcast_if_small(states)
    with_state = lines.join(few, ["file", "block"], "left")
    if few is states:  # too many for a broadcast: after the shuffle lines need their order again
        with_state = with_state.sortWithinPartitions("file", "block", "line")
    known = F.coalesce("inside", F.raise_error(F.lit("the files changed while they were read")))
    pieces = with_state.select("value", "file", "block", known.cast("boolean").alias("inside"))
    pieces = materialize(pieces.mapInArrow(walk, _PIECES), "records")

    # At most two pieces per split: the rest of an earlier record comes before a new beginning.
    order = Window.partitionBy("file").orderBy("block", F.desc("kind"))
    begun = F.sum(F.when(F.col("kind") == _BEGIN, 1).otherwise(0)).over(order)
    cut = pieces.where(F.col("kind") != _WHOLE).withColumn("record", begun)
    whole = cut.groupBy("file", "record").agg(
        F.min(F.when(F.col("kind") == _BEGIN, F.struct("block", "number"))).alias("first"),
        F.sort_array(F.collect_list(F.struct("block", F.negate("kind").alias("place"), "text"))).alias("pieces"),
    )
    joined = whole.select(
        "file",
        "first.block",
        "first.number",
        F.array_join(F.transform("pieces", lambda p: p["text"]), "\n").alias("text"),
    )
    sizes = pieces.where(F.col("kind") != _REST).groupBy("file", "block").agg(F.count("*").alias("n"))
    files = dense_ids(sizes.select("file").distinct(), ["file"], "file_no")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "file", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start")
    ).join(files, "file")
    starts = broadcast_if_small(materialize(starts, "starts"))
    complete = pieces.where(F.col("kind") == _WHOLE).select("file", "block", "number", "text")
    found = complete.unionByName(joined).join(starts, ["file", "block"])
    place = F.col("start") + F.col("number")
    return found.select(
        (F.shiftleft("file_no", _ROW_BITS) + place).alias("row_seq"),
        (place == 0).alias("is_header"),
        F.regexp_replace("text", r"\r\z", "").alias("text"),
    )


def scan_split_csv(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType = RAW_DETAILS
) -> DataFrame:
    """Like ``raw_csv.scan_csv``, with ``row_seq``: all columns under their header names, and
    ``_corrupt``. Columns that ``schema`` does not name are text; one that no header has, or files
    with different headers, are errors."""
    options = {key: str(value) for key, value in FORMAT.items()}
    header = spark.read.options(**options, multiLine=True).csv(path).columns
    missing = [name for name in schema.names if name not in header]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in {path}")
    kinds = {f.name: f.dataType.simpleString() for f in schema}
    options |= {"header": "false", "multiLine": "true", "columnNameOfCorruptRecord": CORRUPT}

    def cells(of: dict[str, str]):
        columns = [f"`{name.replace('`', '``')}` {of.get(name, 'string')}" for name in header]
        return F.from_csv("text", ", ".join([*columns, f"{CORRUPT} string"]), options).alias("_cells")

    found = records(spark, path)
    heads = found.where("is_header").select(cells({})).distinct()
    if heads.limit(2).count() > 1:
        raise ValueError(f"files with different headers in {path}")
    return found.where("NOT is_header").select("row_seq", cells(kinds)).select("row_seq", "_cells.*")


def split_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType = RAW_DETAILS,
    tokens: Sequence[str] = NULL_TOKENS,
) -> tuple[DataFrame, DataFrame]:
    """(sound rows with null tokens applied, rejected lines), each with its row_seq: what
    ``raw_csv.split_raw_csv`` gives, from files that are shared by tasks."""
    return told_apart(scan_split_csv(spark, path, schema), schema, tokens)

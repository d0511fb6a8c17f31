"""Turn a list or map column into a dimension and a bridge table."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cataloom.functions import last_value_per_key, strip
from cataloom.operators.ids import number_rows

# A dimension up to this many bytes of labels and ids is broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024


def normalize_list(
    df: DataFrame,
    id_col: str,
    list_col: str,
    dim_id: str,
    label: str,
    order_col: str,
    stripped: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split a list column off: (fact without it, dimension, bridge).

    Dimension ids follow the first appearance of a label in the order of ``order_col``
    (unique per row) and, in a row, list position. The bridge keeps repeats.
    The list is read twice, so give a stored table, not a costly plan. ``stripped`` says that
    its labels have no white space around them already.
    """
    entries = F.col(list_col) if stripped else F.transform(F.col(list_col), strip)
    labels = F.filter(entries, lambda x: x != "nan")
    dim, links = _split_off(
        df, labels, labels, lambda x: x, {}, id_col, dim_id, label, order_col
    )
    return df.drop(list_col), dim, links


def normalize_map(
    df: DataFrame,
    id_col: str,
    map_col: str,
    dim_id: str,
    label: str,
    order_col: str,
    weight: str = "count",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split a map column off: (fact without it, dimension, bridge with the weight).

    A key met twice in one map counts once, at its first place with its last value.
    """
    entries = last_value_per_key(F.map_entries(F.col(map_col)))
    dim, links = _split_off(
        df, entries, F.map_keys(F.col(map_col)), lambda e: e["key"],
        {weight: lambda e: e["value"]}, id_col, dim_id, label, order_col,
    )
    return df.drop(map_col), dim, links


def first_places(df: DataFrame, names: Column, label: str, order_col: str) -> DataFrame:
    """Each label once, with the first row that has it and its place in that row.

    Each row gives a label once, with its first place, so that the smallest row and the place in
    that row fix the order. Both are numbers: a hash aggregate with partial results before the
    shuffle, whatever the share of the commonest label.
    """
    return (
        df.select(
            F.col(order_col).alias("_row"),
            F.posexplode(F.array_distinct(names)).alias("_place", label),
        )
        .groupBy(label)
        .agg(
            F.min("_row").alias("_row"),
            F.min_by("_place", "_row").alias("_place"),
        )
    )


def label_links(df: DataFrame, entries: Column, name_of, extras, id_col: str, label: str) -> DataFrame:
    """A row per list entry: the id, the label, and the extras."""
    return df.select(id_col, F.explode(entries).alias("_entry")).select(
        id_col,
        name_of(F.col("_entry")).alias(label),
        *[get(F.col("_entry")).alias(name) for name, get in extras.items()],
    )


def _split_off(
    df, entries: Column, names: Column, name_of, extras, id_col, dim_id, label, order_col
):
    first = first_places(df, names, label, order_col)
    numbered, summary = number_rows(
        first, ["_row", "_place"], dim_id, label_bytes=F.sum(F.octet_length(label))
    )
    dim = numbered.select(dim_id, label)
    links = label_links(df, entries, name_of, extras, id_col, label)
    size = sum(row["label_bytes"] + 16 * row["rows"] for row in summary)
    bridge = look_up(links, dim, label, dim_id, size)
    return dim, bridge.select(id_col, dim_id, *extras)


def look_up(
    links: DataFrame, dim: DataFrame, label: str, dim_id: str, dim_bytes: int
) -> DataFrame:
    """Replace labels by ids.

    A dimension of checked small size is broadcast. A larger one is joined by shuffle: both
    sides are plain shuffles, so adaptive execution splits the label that has a large share of
    the links, and the links are made once.
    """
    if dim_bytes <= BROADCAST_BYTES:
        return links.join(F.broadcast(dim), label, "left")
    return links.join(dim, label, "left")

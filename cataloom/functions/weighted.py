"""Weighted labels kept as a dict literal or JSON object in one text cell."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from cataloom.constants import WEIGHTED_REPAIRS
from cataloom.functions.numbers import to_long
from cataloom.functions.text import strip


def with_value(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def parse_weighted(text: Column, repairs=WEIGHTED_REPAIRS) -> Column:
    """Map from label to weight; null for none (null, empty, ``[]``) and for broken text.

    Weights may be bare or quoted whole numbers; text with any other weight, or with anything
    beside one object, is broken.
    """

    def numbers(objects: Column) -> Column:
        cells = F.get(objects, F.lit(0))
        no_number = F.exists(F.map_values(cells), lambda v: v.isNotNull() & to_long(v).isNull())
        usable = (F.size(objects) == 1) & ~no_number
        return F.when(usable, F.transform_values(cells, lambda _, v: to_long(v)))

    repaired = reduce(lambda t, r: F.replace(t, F.lit(r[0]), F.lit(r[1])), repairs, text)
    # In a list, text after the object breaks the whole; on its own it would be passed over.
    listed = F.concat(F.lit("["), repaired, F.lit("]"))
    return with_value(F.from_json(listed, "array<map<string,string>>"), numbers)


def weighted_is_bad(text: Column, parsed: Column) -> Column:
    """True where the cell has content that could not be parsed."""
    inner = F.coalesce(strip(text), F.lit(""))
    return (inner != "") & ~inner.rlike(r"^\[\s*\]$") & parsed.isNull()


def last_value_per_key(entries: Column) -> Column:
    """Entries (key, value) with each key once: first position kept, last value wins."""

    def merged(placed: Column) -> Column:
        """Of entries sorted by key and place: the first place and the last value of each run."""

        def turns(at: Column, beside: Column) -> Column:
            other = F.get(placed, beside)["key"]
            return other.isNull() | (other != F.get(placed, at)["key"])

        first = F.filter(placed, lambda _, j: turns(j, j - 1))
        last = F.filter(placed, lambda _, j: turns(j, j + 1))
        runs = F.zip_with(
            first,
            last,
            lambda a, b: F.struct(a["place"], a["key"], b["value"].alias("value")),
        )
        return F.transform(
            F.array_sort(runs), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"))
        )

    def merge(all_entries: Column) -> Column:
        keys = F.array_distinct(F.transform(all_entries, lambda e: e["key"]))
        placed = F.transform(
            all_entries,
            lambda e, j: F.struct(e["key"].alias("key"), j.alias("place"), e["value"].alias("value")),
        )
        return F.when(F.size(keys) == F.size(all_entries), all_entries).otherwise(
            with_value(F.array_sort(placed), merged)
        )

    return with_value(entries, merge)

"""Column expressions; every one stays inside the JVM."""

from cataloom.functions.numbers import cents_to_units, minutes_to_hours, parse_range, to_long
from cataloom.functions.text import (
    canonical_label,
    clean_labels,
    elapsed_text,
    null_tokens,
    remove_fragments,
    split_trim,
    strip,
)
from cataloom.functions.weighted import last_value_per_key, parse_weighted, weighted_is_bad

__all__ = [
    "canonical_label", "cents_to_units", "clean_labels", "elapsed_text", "last_value_per_key",
    "minutes_to_hours", "null_tokens", "parse_range", "parse_weighted", "remove_fragments",
    "split_trim", "strip", "to_long", "weighted_is_bad",
]

"""Text: stripping, null tokens, label lists."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from cataloom.constants import CANONICAL_LANGUAGES, LABEL_REMOVALS, NULL_TOKENS, WHITESPACE


def strip(text: Column) -> Column:
    """Without white space at both ends (all Unicode white space, not only blanks)."""
    return F.btrim(text, F.lit(WHITESPACE))


def null_tokens(text: Column, tokens=NULL_TOKENS) -> Column:
    """Null where the whole cell is one of ``tokens``."""
    return F.when(~text.isin(*tokens), text)


def remove_fragments(text: Column, fragments=LABEL_REMOVALS) -> Column:
    """Remove each fragment from the result of the one before; order matters."""
    return reduce(lambda t, f: F.replace(t, F.lit(f), F.lit("")), fragments, text)


def split_trim(text: Column, separator: str = ",") -> Column:
    """Array of the stripped parts of a separated list."""
    # A lone character without a meaning in patterns is split on without a pattern.
    plain = len(separator) == 1 and separator not in "\\^$.|?*+()[]{}"
    pattern = separator if plain else f"\\Q{separator}\\E"
    return F.transform(F.split(text, F.lit(pattern)), strip)


def clean_labels(text: Column, fragments=LABEL_REMOVALS) -> Column:
    """Array of the usable labels in a messy comma list.

    Markup fragments go, line breaks become blanks, and entries that are no label
    (``#…``, ``(…``, ``not supported``) are left out, each tested on its own.
    No fragment holds a comma, so none reaches over two entries: the text is cleaned as a
    whole, in compiled code, and only then split.
    """
    if any("," in f for f in fragments):
        raise ValueError("a fragment cannot contain the separator")
    text = remove_fragments(text, fragments)
    for line_break in ("\r\n", "\n"):
        text = F.replace(text, F.lit(line_break), F.lit(" "))

    def usable(entry: Column) -> Column:
        marked = entry.startswith("#") | entry.startswith("(")
        return ~marked & (F.lower(entry) != "not supported")

    return F.filter(split_trim(text), usable)


def canonical_label(text: Column, names=CANONICAL_LANGUAGES) -> Column:
    """First of ``names`` contained in the text, ignoring case; else the text itself."""
    lowered = F.lower(text)
    hits = [F.when(lowered.contains(name.lower()), F.lit(name)) for name in names]
    return F.coalesce(*hits, text)


def elapsed_text(seconds: Column) -> Column:
    """``3d 4h 5m 6s`` from a number of seconds."""
    day = F.lit(86400)
    in_day = F.pmod(seconds, day)
    return F.format_string(
        "%dd %dh %dm %ds",
        F.floor(seconds / day),
        F.floor(in_day / 3600),
        F.pmod(F.floor(in_day / 60), F.lit(60)),
        F.pmod(in_day, F.lit(60)),
    )

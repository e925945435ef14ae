"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def category_key(text: Column) -> Column:
    """User input to category form: trimmed, lower case, blanks to underscores."""
    return F.translate(F.lower(F.trim(text)), " ", "_")


def category_matches(category: Column, wanted: Column) -> Column:
    """True when no category is asked for, or the asked text occurs in the category."""
    none_asked = F.coalesce(wanted, F.lit("")) == ""
    return none_asked | F.coalesce(F.lower(category), F.lit("")).contains(wanted)


def title_label(text: Column) -> Column:
    """Underscores to blanks and a capital at each word start; other letters stay."""
    pieces = F.split(F.translate(text, "_", " "), r"(?<=\W)(?=\w)")
    return F.array_join(F.transform(pieces, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substr(w, F.lit(2)))), "")


def short_id(ident: Column) -> Column:
    return F.substring(ident.cast("string"), 1, 8)


def whole_number(x: Column) -> Column:
    """A double printed without decimals, halves going to the even neighbour."""
    return F.bround(x, 0).cast("bigint").cast("string")

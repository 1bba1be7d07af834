"""String cleaning expressions (CLN-1..4, CLN-12, SC-1..3, SC-5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accent map the warehouse uses for city and category names.
# Each character of ACCENTED maps to the character at the same position of PLAIN.
ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüçñ"
PLAIN = "aaaaaeeeeiiiiooooouuuucn"

UNKNOWN = "unknown"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_lower(c) -> Column:
    """``lower(trim(c))`` — cities, categories, payment types."""
    return F.lower(F.trim(_c(c)))


def trim_upper(c) -> Column:
    """``upper(trim(c))`` — state codes."""
    return F.upper(F.trim(_c(c)))


def fold_accents(c) -> Column:
    """Lower-case, then map accented Latin letters to plain ones.

    Lower-casing first also folds upper-case accented letters ('Á' -> 'a').
    """
    return F.translate(F.lower(_c(c)), ACCENTED, PLAIN)


def text_len(c) -> Column:
    """Character length ignoring trailing blanks (fixed-width string semantics)."""
    return F.length(F.rtrim(_c(c)))


def default_unknown(c) -> Column:
    return F.coalesce(_c(c), F.lit(UNKNOWN))


def untrimmed(c) -> Column:
    """True where the value carries leading or trailing blanks."""
    return _c(c) != F.trim(_c(c))

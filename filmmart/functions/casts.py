"""Lenient text -> typed casts with the reference SQL engine's semantics.

All three are plain Column expressions (JVM-side, codegen'd); a text that does not
fit gives NULL, never an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted spellings.
# Decimal or scientific number with optional sign and blanks around it.
INT_TEXT_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# y-m-d with one separator used twice, optional time and zone, blanks around it.
DATE_TEXT_PATTERN = (
    r"^\s*\d{4}([-/ ])\d{1,2}\1\d{1,2}"
    r"([ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?\s*(Z|[+-]\d{2}(:?\d{2})?)?)?\s*$"
)
DATE_PART_PATTERN = r"^\s*(\d{4}[-/ ]\d{1,2}[-/ ]\d{1,2})"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_int(c) -> Column:
    """Number text -> INT, rounded half away from zero; NULL for anything else or overflow."""
    c = _col(c).cast("string")
    as_int = F.round(c.try_cast("double")).try_cast("int")
    return F.when(c.rlike(INT_TEXT_PATTERN), as_int)


def try_bool(c) -> Column:
    """true/t/yes/y/1 and false/f/no/n/0 in any case; NULL otherwise."""
    return _col(c).cast("string").try_cast("boolean")


def try_date(c) -> Column:
    """ISO-like y-m-d (separator '-', '/' or blank), optional time part ignored."""
    c = _col(c).cast("string")
    ymd = F.translate(F.regexp_extract(c, DATE_PART_PATTERN, 1), "/ ", "--")
    return F.when(c.rlike(DATE_TEXT_PATTERN), ymd.try_cast("date"))


__all__ = ["try_int", "try_bool", "try_date", "INT_TEXT_PATTERN", "DATE_TEXT_PATTERN"]

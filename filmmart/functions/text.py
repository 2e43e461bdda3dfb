"""String helpers used by the models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Patterns the models use.
TRAILING_YEAR = r"\s*\(\d{4}\)\s*$"
CONTROL_CHARS = r"[\x00-\x1f]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_year(c) -> Column:
    """``Blue Coast (1988)`` -> ``Blue Coast``; the pattern is end-anchored so it matches once."""
    return F.trim(F.regexp_replace(_col(c), TRAILING_YEAR, ""))


def name_slug(c) -> Column:
    """Critic name -> slug: blanks to ``_``, lower case. NULL stays NULL."""
    return F.lower(F.replace(_col(c), F.lit(" "), F.lit("_")))


def prefixed(prefix: str, c) -> Column:
    return F.concat(F.lit(prefix), _col(c))


def last_segment(c) -> Column:
    """Last ``/``-separated segment of a link."""
    return F.element_at(F.split(_col(c), "/"), -1)


def scrub_control(c) -> Column:
    return F.regexp_replace(_col(c), CONTROL_CHARS, " ")


def scrub_strings(df: DataFrame) -> DataFrame:
    """Control characters -> blank in every top-level string column."""
    return df.select(*[
        scrub_control(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields])


def drop_prefix_once(c, prefix: str) -> Column:
    """Remove ``prefix`` at the start, once (``m/m/x`` -> ``m/x``)."""
    c = _col(c)
    return F.when(c.startswith(prefix), F.substring(c, len(prefix) + 1, 1 << 30)).otherwise(c)


__all__ = ["strip_year", "name_slug", "prefixed", "last_segment", "scrub_control", "scrub_strings",
           "drop_prefix_once", "TRAILING_YEAR", "CONTROL_CHARS"]

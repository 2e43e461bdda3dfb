"""JSON text operations on Columns and DataFrames."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = "record"

# Strict JSON: neither the parser's leniencies nor its limits on length and nesting.
STRICT = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", "allowSingleQuotes": "false",
          "allowNonNumericNumbers": "false", "maxStringLen": "2147483647", "maxNumLen": "2147483647",
          "maxNestingDepth": "1000000"}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _strict(c: Column) -> Column:
    """Whether the text is one JSON document by the strict parser, whatever its size.

    The text is tokenised as the skipped value of an object; a corrupt-record column tells
    whether that worked. A single wrap can be closed early by the text itself (``1},{"v":2``);
    wrapping it both as a value and as an element of an array cannot both be fooled, so trailing
    text, raw control characters in strings and similar are rejected.
    """
    def parses(before: str, after: str) -> Column:
        return F.from_json(F.concat(F.lit(before), c, F.lit(after)), "_none int, _bad string", STRICT)["_bad"].isNull()

    return parses('{"v":', "}") & parses('{"v":[', "]}")


def _may_repeat_keys(c: Column) -> Column:
    """False only for documents without a repeated key: VARIANT refuses those. It is asked element by element, so a large
    array is decided like a small one; an element that it refuses for another reason counts as suspect."""
    parts = F.from_json(c, "array<string>", {"maxStringLen": "2147483647", "maxNestingDepth": "1000000"})
    nested = F.exists(parts, lambda e: e.rlike(r"^\s*[\[{]") & F.try_parse_json(e).isNull())
    return F.when(F.ltrim(c).startswith("["), F.coalesce(nested, F.lit(True))).otherwise(F.try_parse_json(c).isNull())


@F.pandas_udf(T.StringType())
def _decoded(texts: pd.Series) -> pd.Series:
    """The few documents that are not plainly well formed, by a decoder that takes repeated keys (the last one wins) and the
    words NaN and Infinity (no JSON, so null); NULL for what is malformed."""
    def one(t: str | None) -> str | None:
        if t is None:
            return None
        try:
            return json.dumps(json.loads(t, parse_constant=lambda _: None), ensure_ascii=False, separators=(",", ":"))
        except (ValueError, RecursionError):
            return None

    return texts.map(one)


def canonical_json(c) -> Column:
    """Parsed and re-serialised (compact), at any size: of equal keys in an object the last one stays, NaN and infinities become null;
    NULL for what is no JSON document. Only documents that the strict parser refuses or that may repeat a key leave the JVM."""
    c = _col(c)
    strict = c.isNotNull() & _strict(c)
    plain = strict & ~_may_repeat_keys(c)
    own = F.get_json_object(c, "$")
    decoded = _decoded(F.when(~plain & (F.trim(c) != ""), c))
    return F.when(plain, own).otherwise(F.coalesce(decoded, F.when(strict, own)))


def is_valid_json(c) -> Column:
    """Validity of one whole JSON document, whatever its size."""
    return canonical_json(c).isNotNull()


def reject_reason(c, canonical) -> Column:
    """NULL for a good document, otherwise a short reason, from its text and its canonical form."""
    c, canonical = _col(c), _col(canonical)
    return (F.when(c.isNull(), F.lit("empty file"))
            .when(F.trim(c) == "", F.lit("empty file"))
            .when(canonical.isNull(), F.lit("malformed JSON")))


def split_valid(df: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects with ``reason``): one pass computes the reason, two filters split it."""
    tagged = df.withColumn("reason", reject_reason(col, canonical_json(col)))
    good = tagged.filter(F.col("reason").isNull()).drop("reason")
    bad = tagged.filter(F.col("reason").isNotNull())
    return good, bad


def unnest_records(df: DataFrame, data: str = "data", keep=("_loaded_at", "_source_file"),
                   with_position: bool = False) -> DataFrame:
    """One row per element of the JSON array in ``data``; envelope columns repeated.

    An empty array or a JSON ``null`` document gives no rows. Elements stay JSON text
    (objects are re-serialised compactly, strings unquoted).
    """
    arr = F.from_json(F.col(data), "array<string>")
    cols = [F.col(k) for k in keep]
    if with_position:
        return df.select(*cols, F.posexplode(arr).alias("_pos", RECORD))
    return df.select(*cols, F.explode(arr).alias(RECORD))


def unnest_rejects(df: DataFrame, data: str = "data") -> DataFrame:
    """Envelope rows whose document is not an array (a bare object, a scalar): they would
    vanish in ``unnest_records``; the reference's engine fails on them."""
    arr = F.from_json(F.col(data), "array<string>")
    return (df.filter(arr.isNull() & (F.trim(F.col(data)) != "null"))
              .withColumn("reason", F.lit("not a JSON array")))


def lines_as_array(c) -> Column:
    """A JSON-lines text (one document per line, as Spark's JSON writer emits) -> one JSON
    array text, per file; blank lines are dropped. Each line is still validated as part of
    the array."""
    lines = F.filter(F.split(_col(c), "\r?\n"), lambda x: F.trim(x) != "")
    return F.concat(F.lit("["), F.array_join(lines, ","), F.lit("]"))


def as_array(c) -> Column:
    """Object-or-array tolerance: a bare object is wrapped into a one-element array."""
    c = _col(c)
    return F.when(F.ltrim(c).startswith("{"), F.concat(F.lit("["), c, F.lit("]"))).otherwise(c)


def path(c, p: str) -> Column:
    """JSON path -> text: scalars unquoted, objects/arrays as JSON text, JSON null -> NULL."""
    return F.get_json_object(_col(c), p)


__all__ = ["is_valid_json", "reject_reason", "canonical_json", "split_valid", "unnest_records",
           "unnest_rejects", "as_array", "lines_as_array", "path", "RECORD"]

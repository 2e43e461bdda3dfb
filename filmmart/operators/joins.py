"""Join shapes of the gold models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def full_outer_on_nullable(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """FULL OUTER JOIN on a nullable key where NULLs never match.

    Rows with a NULL key cannot match anything, so they skip the join and are appended;
    otherwise the sort-merge join hashes every NULL-key row into one task. Column names
    of the two sides must be disjoint.
    """
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"column names on both sides: {sorted(clash)}")
    lk, rk = F.col(left_key), F.col(right_key)
    matched = left.filter(lk.isNotNull()).join(right.filter(rk.isNotNull()), lk == rk, "full_outer")
    out = (matched
           .unionByName(left.filter(lk.isNull()), allowMissingColumns=True)
           .unionByName(right.filter(rk.isNull()), allowMissingColumns=True))
    return out.select(*left.columns, *right.columns)


def full_outer_split(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """FULL OUTER JOIN for keys of which one may hold much of either side.

    A full outer join cannot be split within a key: all rows of a hot key meet in one task. Here the matches are an inner
    join, which the adaptive plan splits on both sides, and each side's unmatched rows an anti join against the other side's distinct keys
    (reduced before they are shuffled), which it splits on the row side. NULL keys match nothing and skip both.
    Column names of the two sides must be disjoint.
    """
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"column names on both sides: {sorted(clash)}")
    lk, rk = F.col(left_key), F.col(right_key)
    has_left, has_right = left.filter(lk.isNotNull()), right.filter(rk.isNotNull())
    left_only = has_left.join(has_right.select(rk.alias("_k")).distinct(), lk == F.col("_k"), "left_anti")
    right_only = has_right.join(has_left.select(lk.alias("_k")).distinct(), rk == F.col("_k"), "left_anti")
    out = has_left.join(has_right, lk == rk)
    for part in (left_only, left.filter(lk.isNull()), right_only, right.filter(rk.isNull())):
        out = out.unionByName(part, allowMissingColumns=True)
    return out.select(*left.columns, *right.columns)


def inner_then_left(df: DataFrame, must: DataFrame, must_on: tuple[str, str], may: DataFrame, may_on: tuple[str, str]) -> DataFrame:
    """rows that have a match in ``must``, with what ``may`` has for them (NULL otherwise). ``*_on``: the column of ``df`` and the
    other side's; the other sides' key columns are dropped."""
    out = df.join(must, F.col(must_on[0]) == F.col(must_on[1])).drop(must_on[1])
    return out.join(may, F.col(may_on[0]) == F.col(may_on[1]), "left").drop(may_on[1])


def left_lookup(df: DataFrame, dim: DataFrame, left_on: str | Column, right_on: str, take: Sequence[str],
                broadcast: bool = False) -> DataFrame:
    """LEFT JOIN that keeps every row; unresolved lookups give NULL in ``take``.

    ``broadcast`` only for dimensions of a fixed, known size (the date spine); other
    dimensions are left to AQE, which broadcasts from measured runtime size.
    """
    lcol = F.col(left_on) if isinstance(left_on, str) else left_on
    d = dim.select(F.col(right_on).alias("_lk"), *take)
    if broadcast:
        d = F.broadcast(d)
    return df.join(d, lcol == F.col("_lk"), "left").drop("_lk")


def routed_lookup(df: DataFrame, route_col: str, routes: Mapping[str, tuple[DataFrame, str, str]],
                  take: str, out: str) -> DataFrame:
    """For each literal value of ``route_col``, a LEFT JOIN on its own column pair.

    ``routes[value] = (dim, dim_column, df_column)``. Each row is joined once, by its
    route; rows of other route values get NULL. Equivalent to one left join per route
    gated by ``route_col = value`` plus a CASE, minus the joins that cannot match.
    """
    stacked, key = None, None
    for value, (dim, dim_col, df_col) in routes.items():
        d = dim.select(F.lit(value).alias("_route"), F.col(dim_col).alias("_rk"), F.col(take).alias("_taken"))
        stacked = d if stacked is None else stacked.unionByName(d)
        own = F.col(route_col) == F.lit(value)
        key = F.when(own, F.col(df_col)) if key is None else key.when(own, F.col(df_col))
    # One pass over the input: each row looks its own route's key up in the stacked dimensions.
    keyed = df.withColumn("_key", key)
    out_df = keyed.join(stacked, (F.col(route_col) == F.col("_route")) & (F.col("_key") == F.col("_rk")), "left")
    kept = [c for c in df.columns if c != out]
    return out_df.select(*kept, F.col("_taken").alias(out))


__all__ = ["full_outer_on_nullable", "full_outer_split", "inner_then_left", "left_lookup", "routed_lookup"]

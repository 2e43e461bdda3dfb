"""Latest row per natural key (E8) and its NULL-exempt form.

Written as ``row_number() over (partition by key order by ...) = 1`` so Catalyst plans a
WindowGroupLimit on both sides of the shuffle: every map task already keeps only its
best row per key, so a hot key (or the NULL key) sends at most one row per task
across the network instead of all of its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOADED_AT = "_loaded_at"
SOURCE_FILE = "_source_file"

_UNORDERABLE = (T.MapType, T.VariantType) if hasattr(T, "VariantType") else (T.MapType,)


def total_order(df: DataFrame, first: Sequence[Column] = (), skip: Sequence[str] = ()) -> list[Column]:
    """``first``, then ``_loaded_at`` and ``_source_file`` descending if present (file names carry the time
    of the crawl: inside one load the newest file wins), then every other column ascending with
    NULLs last: a total order, so results never depend on scan order."""
    order = list(first)
    used = set(skip)
    if not first and LOADED_AT in df.columns:
        order.append(F.col(LOADED_AT).desc_nulls_last())
        used.add(LOADED_AT)
        if SOURCE_FILE in df.columns:
            order.append(F.col(SOURCE_FILE).desc_nulls_last())
            used.add(SOURCE_FILE)
    for f in df.schema.fields:
        if f.name in used or isinstance(f.dataType, _UNORDERABLE):
            continue
        order.append(F.col(f.name).asc_nulls_last())
    return order


def _keys(keys) -> list[Column]:
    return [F.col(k) if isinstance(k, str) else k for k in ([keys] if isinstance(keys, (str, Column)) else keys)]


def latest_per_key(df: DataFrame, keys, order: Sequence[Column] | None = None,
                   null_keys: str = "collapse") -> DataFrame:
    """Keep one row per key: the first by ``order`` (default: latest load, then total order).

    ``null_keys``: ``collapse`` (reference behaviour: all NULL-key rows are one group),
    ``keep`` (NULL-key rows all pass through untouched, F4).
    """
    key_cols = _keys(keys)
    order = list(order) if order is not None else total_order(df)
    if null_keys == "keep":
        any_null = F.lit(False)
        for k in key_cols:
            any_null = any_null | k.isNull()
        nulls = df.filter(any_null)
        rest = latest_per_key(df.filter(~any_null), key_cols, order, "collapse")
        return rest.unionByName(nulls)
    if null_keys != "collapse":
        raise ValueError(f"null_keys must be 'collapse' or 'keep', not {null_keys!r}")
    w = Window.partitionBy(*key_cols).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def top_n_per_group(df: DataFrame, keys, order: Sequence[Column], n: int, rank_col: str | None = None) -> DataFrame:
    """First ``n`` rows of each group by ``order`` (C3, B9); also a WindowGroupLimit plan."""
    w = Window.partitionBy(*_keys(keys)).orderBy(*order)
    out = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    if rank_col:
        return out.withColumn(rank_col, F.col("_rn").cast("long")).drop("_rn")
    return out.drop("_rn")


__all__ = ["latest_per_key", "top_n_per_group", "total_order", "LOADED_AT", "SOURCE_FILE"]

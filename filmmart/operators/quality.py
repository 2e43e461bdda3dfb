"""Declared data tests (G1-G6). Each returns a DataFrame: failing groups or one verdict row.

Verdict rows share one shape: ``model, column_name, test, failures (BIGINT), status``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import PLATFORMS

VERDICT_COLS = ["model", "column_name", "test", "failures", "status"]


def _status(failures: Column) -> Column:
    return F.when(failures == 0, F.lit("pass")).otherwise(F.lit("fail"))


def _verdict(df: DataFrame, model: str, column: str, test: str) -> DataFrame:
    """``df`` has one row with a ``failures`` column."""
    f = F.coalesce(F.col("failures"), F.lit(0)).cast("long")
    return df.select(F.lit(model).alias("model"), F.lit(column).alias("column_name"), F.lit(test).alias("test"),
                     f.alias("failures"), _status(f).alias("status"))


def not_null(df: DataFrame, cols: Sequence[str], model: str = "") -> DataFrame:
    """G1: NULL count of every column in one scan, one verdict row per column."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', `_{i}`" for i, c in enumerate(cols))
    long = agg.selectExpr(f"stack({len(cols)}, {pairs}) as (column_name, failures)")
    f = F.col("failures").cast("long")
    return long.select(F.lit(model).alias("model"), "column_name", F.lit("not_null").alias("test"),
                       f.alias("failures"), _status(f).alias("status"))


def duplicate_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """G2 failing rows: non-NULL key values present more than once, with their count."""
    key = list(cols)
    nn = F.lit(True)
    for c in key:
        nn = nn & F.col(c).isNotNull()
    return df.filter(nn).groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def unique(df: DataFrame, cols: Sequence[str], model: str = "") -> DataFrame:
    """G2 verdict: number of key values that repeat."""
    dup = duplicate_keys(df, cols).agg(F.count(F.lit(1)).alias("failures"))
    return _verdict(dup, model, ",".join(cols), "unique")


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """G3 failing groups: non-NULL foreign key values without a parent, with their row count.

    The child is reduced to distinct keys first (partial aggregation on the map side), so a
    hot key costs one row in the anti join, not all of its rows.
    """
    keys = child.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("_fk")).agg(F.count(F.lit(1)).alias("n"))
    parents = parent.select(F.col(pk).alias("_pk")).filter(F.col("_pk").isNotNull())
    return keys.join(parents, F.col("_fk") == F.col("_pk"), "left_anti").withColumnRenamed("_fk", fk)


def relationships(child: DataFrame, fk: str, parent: DataFrame, pk: str, model: str = "") -> DataFrame:
    """G3 verdict: child rows whose non-NULL key has no parent."""
    bad = orphans(child, fk, parent, pk).agg(F.sum("n").alias("failures"))
    return _verdict(bad, model, fk, "relationships")


def unaccepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """G4 failing groups: values outside the list (NULL passes, as in SQL ``NOT IN``)."""
    return (df.filter(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))
              .groupBy(col).agg(F.count(F.lit(1)).alias("n")))


def accepted_values(df: DataFrame, col: str, values: Sequence, model: str = "") -> DataFrame:
    bad = unaccepted_values(df, col, values).agg(F.sum("n").alias("failures"))
    return _verdict(bad, model, col, "accepted_values")


def row_count_between(df: DataFrame, lo: int, hi: int, model: str = "") -> DataFrame:
    """One row with the count and whether it lies in [lo, hi]."""
    n = F.count(F.lit(1))
    return df.agg(n.alias("n")).select(
        F.lit(model).alias("model"), F.col("n").cast("long").alias("n"), F.lit(lo).cast("long").alias("min_value"),
        F.lit(hi).cast("long").alias("max_value"), F.col("n").between(lo, hi).alias("passed"))


def freshness(df: DataFrame, now, ts_col: str = "_loaded_at", warn_hours: int = 24, error_hours: int = 48,
              source: str = "") -> DataFrame:
    """Age of the newest load against a given 'now' (never the wall clock, so re-runs agree)."""
    now_col = now if isinstance(now, Column) else F.lit(now).cast("timestamp")
    newest = df.agg(F.max(ts_col).alias("max_loaded_at"))
    age = (F.unix_micros(now_col) - F.unix_micros(F.col("max_loaded_at"))) / 3600000000.0
    return newest.select(
        F.lit(source).alias("source"), "max_loaded_at", age.alias("age_hours"),
        F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
         .when(age > error_hours, F.lit("error"))
         .when(age > warn_hours, F.lit("warn"))
         .otherwise(F.lit("pass")).alias("status"))


def sources_freshness(bronze: dict[str, DataFrame], now, warn_hours: int = 24, error_hours: int = 48) -> DataFrame:
    """G6 over every bronze table (the reference declares it once for the whole source)."""
    parts = [freshness(df, now, "_loaded_at", warn_hours, error_hours, source=name) for name, df in bronze.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# The declared tests of the gold tables, as (table, columns, test, argument).
DECLARED = (
    ("dim_date", ("date_key",), "unique", None), ("dim_date", ("date_key",), "not_null", None),
    ("dim_movie", ("movie_key",), "unique", None), ("dim_movie", ("movie_key",), "not_null", None),
    ("dim_movie", ("*",), "row_count_between", None),
    ("dim_critic", ("critic_key",), "unique", None), ("dim_critic", ("critic_key",), "not_null", None),
    ("fact_movie_score", ("score_key",), "unique", None), ("fact_movie_score", ("score_key", "movie_key"), "not_null", None),
    ("fact_movie_score", ("movie_key",), "relationships", ("dim_movie", "movie_key")),
    ("fact_movie_score", ("platform",), "accepted_values", PLATFORMS),
    ("fact_critic_review", ("critic_review_key",), "unique", None), ("fact_critic_review", ("critic_review_key",), "not_null", None),
    ("fact_critic_review", ("movie_key",), "relationships", ("dim_movie", "movie_key")),
    ("fact_critic_review", ("critic_key",), "relationships", ("dim_critic", "critic_key")),
    ("fact_critic_review", ("date_key",), "relationships", ("dim_date", "date_key")),
)


def _exact(tables: dict[str, DataFrame], test: tuple, rows: tuple[int, int]) -> DataFrame:
    """One declared test by a scan of its own."""
    model, cols, kind, arg = test
    df = tables[model]
    if kind == "unique":
        return unique(df, list(cols), model)
    if kind == "not_null":
        return not_null(df, cols, model)
    if kind == "relationships":
        return relationships(df, cols[0], tables[arg[0]], arg[1], model)
    if kind == "accepted_values":
        return accepted_values(df, cols[0], list(arg), model)
    return row_count_between(df, *rows, model).select(
        "model", F.lit("*").alias("column_name"), F.lit(kind).alias("test"),
        F.when(F.col("passed"), 0).otherwise(1).cast("long").alias("failures"),
        F.when(F.col("passed"), "pass").otherwise("fail").alias("status"))


def gold_tests(gold: dict[str, DataFrame], movie_rows: tuple[int, int] = (1, 1_000_000)) -> DataFrame:
    """The gold schema's declared tests, one verdict row each, every test by its own scan. ``movie_rows``: accepted row count of
    ``dim_movie`` (declared: 1 to 1,000,000; a larger catalogue gives its own)."""
    parts = [_exact(gold, t, movie_rows) for t in DECLARED]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- the same tests, gathered while the tables are written


def observed(model: str) -> dict[str, Column]:
    """What a write of the table notes for its declared tests: rows, NULLs, values that are not accepted."""
    out = {"rows": F.count(F.lit(1))}
    for table, cols, kind, arg in DECLARED:
        if table == model and kind == "not_null":
            out.update({f"null {c}": F.count_if(F.col(c).isNull()) for c in cols})
        if table == model and kind == "accepted_values":
            out[f"unaccepted {cols[0]}"] = F.count_if(F.col(cols[0]).isNotNull() & ~F.col(cols[0]).isin(list(arg)))
    return out


def key_bitmaps(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """name, bucket, bits, n: the non-NULL values of dense integer keys as bitmaps of 32,768 values each, and their rows;
    one scan for all keys. A dense key costs a bit per value in the shuffle, where a group-by of the values costs a row."""
    pairs = ", ".join(f"'{k}', cast(`{k}` as bigint)" for k in keys)
    long = df.selectExpr(f"stack({len(keys)}, {pairs}) as (name, key)").filter("key is not null")
    return long.groupBy("name", F.bitmap_bucket_number("key").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("key")).alias("bits"), F.count(F.lit(1)).alias("n"))


def gold_tests_from(gold: dict[str, DataFrame], noted: dict[str, dict], save, movie_rows: tuple[int, int] = (1, 1_000_000)) -> DataFrame:
    """The declared tests from what the writes noted (``observed``), and from one scan per table for its surrogate keys.

    Keys are dense integers, so their values fit bitmaps. A key is unique if it has as many rows as bits; a foreign key has
    no orphan if the parent's bitmaps do not grow by it. Only a test that fails this way scans again, to count the failures.
    ``save(df, name)`` writes a small table and reads it back. The driver gets a number or two per test.
    """
    wanted: dict[str, dict] = {}
    for model, cols, kind, arg in DECLARED:
        if kind in ("unique", "relationships"):
            wanted.setdefault(model, {})[cols[0]] = None
        if kind == "relationships":
            wanted.setdefault(arg[0], {})[arg[1]] = None
    maps = None
    for m, cols in wanted.items():
        own = key_bitmaps(gold[m], list(cols)).withColumn("model", F.lit(m))
        maps = own if maps is None else maps.unionByName(own)
    maps = save(maps, "key-bitmaps")
    counted = {(r["model"], r["name"]): (r["n"], r["bits"]) for r in maps.groupBy("model", "name").agg(
        F.sum("n").alias("n"), F.sum(F.bitmap_count("bits")).alias("bits")).collect()}
    # A foreign key's bitmaps and its parent's, put together, for all relationships at once.
    related = [(m, c[0], *arg) for m, c, kind, arg in DECLARED if kind == "relationships"]
    both = None
    for k, (m, c, parent, pk) in enumerate(related):
        ends = ((F.col("model") == m) & (F.col("name") == c)) | ((F.col("model") == parent) & (F.col("name") == pk))
        own = maps.filter(ends).select(F.lit(k).alias("k"), "bucket", "bits")
        both = own if both is None else both.unionByName(own)
    both = both.groupBy("k", "bucket").agg(F.bitmap_or_agg("bits").alias("bits")).groupBy("k").agg(F.sum(F.bitmap_count("bits")).alias("bits"))
    together = {related[r["k"]]: r["bits"] for r in both.collect()}

    def grows(model: str, col: str, parent: str, pk: str) -> bool:
        return together.get((model, col, parent, pk), 0) > counted.get((parent, pk), (0, 0))[1]

    rows, scans = [], []
    for test in DECLARED:
        model, cols, kind, arg = test
        if kind in ("unique", "relationships"):
            n, bits = counted.get((model, cols[0]), (0, 0))
            if n != bits if kind == "unique" else grows(model, cols[0], *arg):
                scans.append(_exact(gold, test, movie_rows))
            else:
                rows.append((model, cols[0], kind, 0))
        elif kind == "not_null":
            rows += [(model, c, kind, noted[model][f"null {c}"]) for c in cols]
        elif kind == "accepted_values":
            rows.append((model, cols[0], kind, noted[model][f"unaccepted {cols[0]}"]))
        else:
            rows.append((model, "*", kind, int(not movie_rows[0] <= noted[model]["rows"] <= movie_rows[1])))
    spark = next(iter(gold.values())).sparkSession
    out = spark.createDataFrame([(*r, "fail" if r[3] else "pass") for r in rows], "model string, column_name string, test string, failures long, status string")
    for s in scans:
        out = out.unionByName(s)
    return out


__all__ = ["not_null", "unique", "duplicate_keys", "orphans", "relationships", "unaccepted_values",
           "accepted_values", "row_count_between", "freshness", "sources_freshness", "gold_tests", "observed", "key_bitmaps", "gold_tests_from",
           "VERDICT_COLS"]

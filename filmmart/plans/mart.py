"""H2: the whole build -- bronze -> 8 silver -> 5 gold -> declared tests -- in one call."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsonops import unnest_rejects
from ..operators.quality import gold_tests_from, observed
from ..session import scratch_path
from ..sources.feeds import bootstrap, read_bronze_root, rebuild_table
from . import gold as G
from . import silver as S

SILVER_ORDER = ["silver_rt_crosswalk", "silver_mc_general", "silver_mc_critic_reviews", "silver_mc_user_reviews",
                "silver_rt_critic_reviews", "silver_rt_details", "silver_rt_reviews", "silver_rt_score"]

GOLD = ["dim_date", "dim_movie", "dim_critic", "fact_movie_score", "fact_critic_review"]


def build_mart(spark: SparkSession, bronze: dict[str, DataFrame], out_dir: str,
               partitions: int | None = None, timings: dict | None = None,
               on_step=None, movie_rows: tuple[int, int] = (1, 1_000_000)) -> dict[str, DataFrame]:
    """Rebuild every silver and gold table under ``out_dir`` (overwrite), each read back
    from its written copy, so a table with several consumers is computed once and its
    lineage is cut. Returns the tables plus ``silver_rejects`` (bronze documents that are no
    array, which would vanish otherwise) and ``tests`` (one verdict row per declared test and
    one per bronze table for its rejects)."""
    timings = timings if timings is not None else {}
    out: dict[str, DataFrame] = {}
    noted: dict[str, dict] = {}

    def write(name: str, df_fn) -> DataFrame:
        if on_step:
            on_step(name)
        t = time.time()
        df, path = df_fn(), f"{out_dir.rstrip('/')}/{name}"
        if name in GOLD:  # the write notes what its declared tests need
            out[name], noted[name] = rebuild_table(df, path, observed(name))
        else:
            out[name] = rebuild_table(df, path)
        timings[name] = round(time.time() - t, 3)
        return out[name]

    def saved(df: DataFrame, name: str) -> DataFrame:
        return rebuild_table(df, scratch_path(spark, name))

    for name in SILVER_ORDER:
        if name == "silver_rt_details":
            write(name, lambda: S.silver_rt_details(bronze["rt_details"], out["silver_rt_crosswalk"]))
        else:
            write(name, lambda n=name: S.build_silver(bronze[S.BRONZE_OF[n]], S.SPECS[n]))
    write("silver_rejects", lambda: silver_rejects(bronze))
    dd = write("dim_date", lambda: G.dim_date(spark))
    dm = write("dim_movie", lambda: G.dim_movie(out["silver_mc_general"], out["silver_rt_details"], partitions))
    dc = write("dim_critic", lambda: G.dim_critic(out["silver_mc_critic_reviews"], out["silver_rt_critic_reviews"],
                                                  partitions))
    write("fact_movie_score", lambda: G.fact_movie_score(dm, out["silver_mc_general"], out["silver_mc_user_reviews"],
                                                         out["silver_rt_score"], partitions))
    write("fact_critic_review", lambda: G.fact_critic_review(out["silver_mc_critic_reviews"],
                                                             out["silver_rt_critic_reviews"], dm, dc, dd, partitions))
    t = time.time()
    if on_step:
        on_step("tests")
    out["tests"] = gold_tests_from({k: out[k] for k in GOLD}, noted, saved, movie_rows)
    out["tests"] = out["tests"].unionByName(reject_verdicts(out["silver_rejects"], list(bronze)))
    timings["tests"] = round(time.time() - t, 3)
    return out


def silver_rejects(bronze: dict[str, DataFrame]) -> DataFrame:
    """Bronze documents that no silver table can unnest, over all tables: bronze_table, _loaded_at, _source_file, reason."""
    out = None
    for name, df in bronze.items():
        bad = unnest_rejects(df).select(F.lit(name).alias("bronze_table"), "_loaded_at", "_source_file", "reason")
        out = bad if out is None else out.unionByName(bad)
    return out


def reject_verdicts(rejects: DataFrame, tables: list[str]) -> DataFrame:
    """One verdict row per bronze table: no document may be rejected."""
    counted = rejects.groupBy(F.col("bronze_table").alias("_t")).agg(F.count(F.lit(1)).alias("_n"))
    names = rejects.sparkSession.createDataFrame([(t,) for t in tables], "model string")
    n = F.coalesce("_n", F.lit(0)).cast("long")
    return names.join(counted, F.col("model") == F.col("_t"), "left").select(
        "model", F.lit("data").alias("column_name"), F.lit("json_array").alias("test"), n.alias("failures"),
        F.when(n == 0, "pass").otherwise("fail").alias("status"))


def build_from_root(spark: SparkSession, bronze_root: str, out_dir: str, **kw) -> dict[str, DataFrame]:
    """Bootstrap absent bronze tables (empty), then build."""
    bootstrap(spark, bronze_root)
    return build_mart(spark, read_bronze_root(spark, bronze_root), out_dir, **kw)


__all__ = ["build_mart", "build_from_root", "silver_rejects", "reject_verdicts", "register_views", "SILVER_ORDER"]


def register_views(tables: dict[str, DataFrame], prefix: str = "") -> list[str]:
    """Temp views over built tables, for ad-hoc SQL (``spark.sql('select ... from dim_movie')``)."""
    names = []
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names

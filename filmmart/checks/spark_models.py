"""Spark side of the model checks: stand-in bronze -> silver -> gold, rendered."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import gold as G
from ..plans import silver as S
from ..plans.standins import bronze_from_driver
from ..session import scratch_path
from ..sources.feeds import rebuild_table
from .render import render


def silver_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return S.build_all_silver(bronze_from_driver(spark, sf_dir))


def silver_query(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        b = bronze_from_driver(spark, sf_dir)
        if name == "silver_rt_details":
            xw = S.build_silver(b["rt_crosswalk"], S.SPECS["silver_rt_crosswalk"])
            return render(S.silver_rt_details(b["rt_details"], xw))
        return render(S.build_silver(b[S.BRONZE_OF[name]], S.SPECS[name]))
    run.__name__ = name
    return run


def _dim_movie(spark, sf_dir, s=None):
    s = s or silver_tables(spark, sf_dir)
    return G.dim_movie(s["silver_mc_general"], s["silver_rt_details"])


def q_dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date dimension as the facts use it: every order's date looked up in the spine."""
    from ..operators.joins import left_lookup
    from ..plans.standins import table
    dd = G.dim_date(spark)
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("_d"))
    cols = [c for c in dd.columns]
    out = left_lookup(o, dd.withColumn("_day", F.col("date_day")), "_d", "_day", cols, broadcast=True)
    return render(out.select("o_orderkey", *cols))


def q_gold_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole written build, and its verdict rows."""
    from ..plans.mart import build_mart
    return build_mart(spark, bronze_from_driver(spark, sf_dir), scratch_path(spark, "gold_tests"))["tests"]


def q_sources_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.quality import sources_freshness
    return render(sources_freshness(bronze_from_driver(spark, sf_dir), "2024-01-03 12:00:00"))


def q_dim_movie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render(_dim_movie(spark, sf_dir))


def q_dim_critic(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = silver_tables(spark, sf_dir)
    return render(G.dim_critic(s["silver_mc_critic_reviews"], s["silver_rt_critic_reviews"]))


def q_fact_movie_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = silver_tables(spark, sf_dir)
    dm = _dim_movie(spark, sf_dir, s)
    return render(G.fact_movie_score(dm, s["silver_mc_general"], s["silver_mc_user_reviews"], s["silver_rt_score"]))


def q_fact_critic_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = silver_tables(spark, sf_dir)
    for n in ("silver_mc_critic_reviews", "silver_rt_critic_reviews"):  # for the dimension and for the fact: built once
        s[n] = rebuild_table(s[n], scratch_path(spark, n))
    dc = G.dim_critic(s["silver_mc_critic_reviews"], s["silver_rt_critic_reviews"])
    return render(G.fact_critic_review(s["silver_mc_critic_reviews"], s["silver_rt_critic_reviews"],
                                       _dim_movie(spark, sf_dir, s), dc, G.dim_date(spark)))


def model_queries() -> dict:
    out = {n: silver_query(n) for n in S.SPECS}
    out.update({"dim_date": q_dim_date, "dim_movie": q_dim_movie, "dim_critic": q_dim_critic,
                "fact_movie_score": q_fact_movie_score, "fact_critic_review": q_fact_critic_review,
                "gold_tests": q_gold_tests, "sources_freshness": q_sources_freshness})
    return out

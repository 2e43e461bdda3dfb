"""Gold star schema: dim_date, dim_movie, dim_critic, fact_movie_score, fact_critic_review."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import try_date, try_int
from ..functions.text import name_slug, prefixed, strip_year
from ..operators.dedup import latest_per_key, total_order
from ..operators.joins import inner_then_left, left_lookup, routed_lookup
from ..operators.keys import dense_key

# Spine bounds (end exclusive) and platform labels.
SPINE_START = "1970-01-01"
SPINE_END = "2031-01-01"
MC, RT = "metacritic", "rottentomatoes"


def _asc(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def dim_date(spark: SparkSession, start: str = SPINE_START, end: str = SPINE_END,
             partitions: int | None = None) -> DataFrame:
    """Daily spine [start, end). Gap-free, so the key ordered by date is the day offset + 1:
    no window and no single-task sort; the spine is generated in parallel by ``range``."""
    d0 = _dt.date.fromisoformat(start)
    n = (_dt.date.fromisoformat(end) - d0).days
    ids = spark.range(0, n, numPartitions=partitions) if partitions else spark.range(0, n)
    day = F.date_add(F.lit(d0), F.col("id").cast("int"))
    base = ids.select((F.col("id") + 1).alias("date_key"), day.alias("date_day"))
    d = F.col("date_day")
    return base.select(
        "date_key", "date_day",
        F.year(d).cast("long").alias("year"),
        F.quarter(d).cast("long").alias("quarter"),
        F.month(d).cast("long").alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).cast("long").alias("day_of_month"),
        (F.dayofweek(d) - 1).cast("long").alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).cast("long").alias("week_of_year"),
        F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string")).alias("year_quarter"),
    )


def dim_movie(silver_mc_general: DataFrame, silver_rt_details: DataFrame, partitions: int | None = None) -> DataFrame:
    """MC and RT movies matched on imdb_id, keyed by (title, release_year, ...)."""
    order = _asc("title", "release_year", "movie_natural_key", "mc_slug", "rt_movie_id")
    return dense_key(dim_movie_rows(silver_mc_general, silver_rt_details), order, "movie_key", partitions)


def dim_movie_rows(silver_mc_general: DataFrame, silver_rt_details: DataFrame) -> DataFrame:
    """MC and RT movies matched on imdb_id; unmatched rows of either side kept.

    Each side is split once on ``imdb_id IS NULL``: NULL rows skip both the per-id dedup
    (F4, NULLs exempt) and the join (NULLs never match) and are appended; only non-NULL
    rows are deduplicated and full-outer joined. Splitting twice would leave branches
    with contradictory filters that still scan, sort and shuffle.
    """
    smg, srd = silver_mc_general, silver_rt_details

    def mc_cols(df):
        return df.select(F.col("movie_slug").alias("mc_slug"), F.col("title").alias("mc_title"),
                         F.col("premiere_year").alias("release_year"), "rating", "duration_minutes",
                         F.col("imdb_id").alias("mc_imdb_id"),
                         F.get_json_object("genres", "$[0]").alias("primary_genre"))

    def rt_cols(df):
        return df.select(F.col("movie_id").alias("rt_movie_id"), strip_year("title").alias("rt_title"),
                         F.col("urlid").alias("rt_urlid"), F.col("imdb_id").alias("rt_imdb_id"))

    has_id = F.col("imdb_id").isNotNull()
    mc = mc_cols(latest_per_key(smg.filter(has_id), "imdb_id", total_order(smg)))
    rt = rt_cols(latest_per_key(srd.filter(has_id), "imdb_id", total_order(srd)))
    matched = mc.join(rt, F.col("mc_imdb_id") == F.col("rt_imdb_id"), "full_outer")
    j = (matched
         .unionByName(mc_cols(smg.filter(~has_id)), allowMissingColumns=True)
         .unionByName(rt_cols(srd.filter(~has_id)), allowMissingColumns=True))
    return j.select(
        F.coalesce("mc_slug", "rt_movie_id").alias("movie_natural_key"), "mc_slug", "rt_movie_id",
        F.coalesce("mc_title", "rt_title").alias("title"), "release_year", "rating", "duration_minutes",
        F.coalesce("mc_imdb_id", "rt_imdb_id").alias("imdb_id"), "primary_genre", "rt_urlid")


def dim_critic(silver_mc_critic_reviews: DataFrame, silver_rt_critic_reviews: DataFrame,
               partitions: int | None = None) -> DataFrame:
    """One row per critic slug: MC by author_slug, RT by a slug of the name; latest load wins."""
    smc, src = silver_mc_critic_reviews, silver_rt_critic_reviews
    mc = latest_per_key(smc.filter(F.col("author_slug").isNotNull()), "author_slug", total_order(smc)).select(
        prefixed("mc::", F.col("author_slug")).alias("author_slug"), F.col("author").alias("critic_name"),
        "publication_name", "publication_slug")
    rt_in = src.filter(F.col("critic_name").isNotNull()).withColumn("_slug", name_slug("critic_name"))
    rt = latest_per_key(rt_in, "_slug", total_order(src)).select(
        prefixed("rt::", F.col("_slug")).alias("author_slug"), "critic_name",
        F.col("publication").alias("publication_name"), F.lit(None).cast("string").alias("publication_slug"))
    critics = mc.unionByName(rt)
    order = _asc("author_slug", "critic_name", "publication_name", "publication_slug")
    return dense_key(critics, order, "critic_key", partitions)


def _json_ints(df: DataFrame, col: str, keys: list[str], names: list[str]) -> DataFrame:
    """Several keys of one JSON object column, parsed once, leniently cast to INT."""
    raw = [f"_{n}_raw" for n in names]
    out = df.select("*", F.json_tuple(F.col(col), *keys).alias(*raw))
    return out.select(*[c for c in df.columns], *[try_int(r).alias(n) for r, n in zip(raw, names)])


def user_scores(reviews: DataFrame) -> DataFrame:
    """per movie the mean user score times ten and the number of scored reviews."""
    scored = reviews.filter(F.col("score").isNotNull()).groupBy("movie_slug")
    return scored.agg(F.round(F.avg("score") * 10).cast("int").alias("user_score"), F.count(F.lit(1)).alias("user_review_count"))


def liked_share(liked: Column, not_liked: Column) -> tuple[Column, Column]:
    """the number of votes, and the liked ones in per cent (NULL without votes)."""
    votes = liked.cast("long") + not_liked.cast("long")
    share = F.round(F.lit(100.0) * liked.cast("double") / votes.cast("double")).cast("int")
    return votes, F.when(votes > 0, share)


def union_as_text(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """both inputs, with ``col`` widened to text explicitly."""
    text = lambda df: df.withColumn(col, F.col(col).cast("string"))
    return text(a).unionByName(text(b))


def fact_movie_score(dm: DataFrame, silver_mc_general: DataFrame, silver_mc_user_reviews: DataFrame,
                     silver_rt_score: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row per (movie, platform)."""
    by_users = user_scores(silver_mc_user_reviews).withColumnRenamed("movie_slug", "_user_slug")
    mcg = silver_mc_general.select(F.col("movie_slug").alias("_mc_slug"), "critic_score", "critic_review_count")
    dmm = dm.filter(F.col("mc_slug").isNotNull()).select("movie_key", "mc_slug")
    mc = (inner_then_left(dmm, mcg, ("mc_slug", "_mc_slug"), by_users, ("mc_slug", "_user_slug"))
             .select("movie_key", F.lit(MC).alias("platform"), "critic_score", "user_score",
                     "critic_review_count",
                     F.coalesce(F.col("user_review_count"), F.lit(0)).cast("long").alias("user_review_count")))
    scores = silver_rt_score.select(F.col("movie_id").alias("_rt_id"), "critics_all", "audience_all")
    scores = _json_ints(scores, "critics_all", ["score", "reviewCount"], ["critic_score", "critic_review_count"])
    scores = _json_ints(scores, "audience_all", ["likedCount", "notLikedCount"], ["_liked", "_not_liked"])
    dmr = dm.filter(F.col("rt_movie_id").isNotNull()).select("movie_key", "rt_movie_id")
    votes, ratio = liked_share(F.col("_liked"), F.col("_not_liked"))
    rt = (dmr.join(scores, F.col("_rt_id") == F.col("rt_movie_id"))
             .select("movie_key", F.lit(RT).alias("platform"), "critic_score",
                     ratio.alias("user_score"), "critic_review_count",
                     votes.alias("user_review_count")))
    order = _asc("movie_key", "platform", "critic_score", "user_score", "critic_review_count", "user_review_count")
    out = dense_key(mc.unionByName(rt), order, "score_key", partitions)
    return out.select("score_key", "movie_key", "platform", "critic_score", "user_score",
                      "critic_review_count", "user_review_count")


def critic_reviews_union(silver_mc_critic_reviews: DataFrame, silver_rt_critic_reviews: DataFrame) -> DataFrame:
    """Both platforms' reviews in one shape; MC's INT score widened to text explicitly."""
    mc = silver_mc_critic_reviews.filter(F.col("score").isNotNull()).select(
        "movie_slug", prefixed("mc::", F.col("author_slug")).alias("author_slug"),
        try_date("review_date").alias("review_date"), "score",
        "quote", F.lit(MC).alias("platform"))
    rt = silver_rt_critic_reviews.filter(F.col("critic_name").isNotNull()).select(
        F.col("movie_id").alias("movie_slug"), prefixed("rt::", name_slug("critic_name")).alias("author_slug"),
        try_date("review_date").alias("review_date"), "score",
        "quote", F.lit(RT).alias("platform"))
    return union_as_text(mc, rt, "score")


def fact_critic_review(silver_mc_critic_reviews: DataFrame, silver_rt_critic_reviews: DataFrame,
                       dm: DataFrame, dc: DataFrame, dd: DataFrame, partitions: int | None = None) -> DataFrame:
    enriched = fact_critic_review_rows(silver_mc_critic_reviews, silver_rt_critic_reviews, dm, dc, dd)
    order = _asc("movie_key", "critic_key", "date_key", "platform", "score", "quote")
    out = dense_key(enriched, order, "critic_review_key", partitions)
    return out.select("critic_review_key", "movie_key", "critic_key", "date_key", "platform", "score", "quote")


def fact_critic_review_rows(silver_mc_critic_reviews: DataFrame, silver_rt_critic_reviews: DataFrame,
                            dm: DataFrame, dc: DataFrame, dd: DataFrame) -> DataFrame:
    """Reviews of both platforms with movie, critic and date keys resolved (NULL when unknown)."""
    reviews = critic_reviews_union(silver_mc_critic_reviews, silver_rt_critic_reviews)
    with_movie = routed_lookup(reviews, "platform", {
        MC: (dm, "mc_slug", "movie_slug"),
        RT: (dm, "rt_movie_id", "movie_slug"),
    }, take="movie_key", out="movie_key")
    with_critic = left_lookup(with_movie, dc, "author_slug", "author_slug", ["critic_key"])
    with_date = left_lookup(with_critic, dd, "review_date", "date_day", ["date_key"], broadcast=True)
    return with_date.select("movie_key", "critic_key", "date_key", "platform", "score", "quote")


def build_gold(spark: SparkSession, silver: dict[str, DataFrame], partitions: int | None = None) -> dict[str, DataFrame]:
    dd = dim_date(spark)
    dm = dim_movie(silver["silver_mc_general"], silver["silver_rt_details"], partitions)
    dc = dim_critic(silver["silver_mc_critic_reviews"], silver["silver_rt_critic_reviews"], partitions)
    fms = fact_movie_score(dm, silver["silver_mc_general"], silver["silver_mc_user_reviews"],
                           silver["silver_rt_score"], partitions)
    fcr = fact_critic_review(silver["silver_mc_critic_reviews"], silver["silver_rt_critic_reviews"],
                             dm, dc, dd, partitions)
    return {"dim_date": dd, "dim_movie": dm, "dim_critic": dc, "fact_movie_score": fms,
            "fact_critic_review": fcr}


__all__ = ["dim_date", "dim_movie", "dim_movie_rows", "dim_critic", "fact_movie_score", "fact_critic_review",
           "fact_critic_review_rows",
           "critic_reviews_union", "build_gold", "MC", "RT"]

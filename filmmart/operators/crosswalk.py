"""Identity crosswalk between the two platforms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.jsonops import as_array
from ..functions.text import drop_prefix_once


def _blank_null(c):
    return F.when(F.col(c) != "", F.col(c)) if isinstance(c, str) else F.when(c != "", c)


def identity_map(bronze: DataFrame, data: str = "data") -> DataFrame:
    """imdb_id -> (mc_slug, title), first occurrence wins over all bronze rows.

    Payloads may be an object or an array; slug = ``movie_slug`` or else ``slug``; empty
    strings count as missing. "First" = earliest load, then file, then position in the
    file (the reference's scan order is undefined, so this fixes one). ``min_by`` is a
    partial aggregate: a popular id costs one row per map task in the shuffle.
    """
    recs = bronze.select("_loaded_at", "_source_file",
                         F.posexplode(F.from_json(as_array(F.col(data)), "array<string>")).alias("_pos", "_r"))
    t = recs.select("_loaded_at", "_source_file", "_pos",
                    F.json_tuple("_r", "imdb_id", "movie_slug", "slug", "title").alias("i", "ms", "s", "title"))
    slug = F.coalesce(_blank_null("ms"), _blank_null("s"))
    t = t.select(_blank_null("i").alias("imdb_id"), slug.alias("mc_slug"), "title", "_loaded_at", "_source_file",
                 "_pos").filter(F.col("imdb_id").isNotNull() & F.col("mc_slug").isNotNull())
    order = F.struct("_loaded_at", "_source_file", "_pos")
    first = t.groupBy("imdb_id").agg(F.min_by(F.struct("mc_slug", "title"), order).alias("_f"))
    return first.select("imdb_id", F.col("_f.mc_slug").alias("mc_slug"), F.col("_f.title").alias("title"))


def build_crosswalk(ids: DataFrame, mapping: DataFrame, raw: str = "rt_raw") -> DataFrame:
    """D2 + D3: ids with a partner id; ``tv/`` entries dropped, a leading ``m/`` removed once.

    ``mapping`` (imdb_id, rt_raw) is an input table (the remote lookup's result). The
    join is left to AQE, which broadcasts whichever side is measured small.
    """
    m = mapping.filter(~F.col(raw).startswith("tv/")).select(
        "imdb_id", drop_prefix_once(F.col(raw), "m/").alias("rt_slug"))
    j = m.join(ids, "imdb_id")
    return j.select("imdb_id", "rt_slug", "mc_slug", "title")


__all__ = ["identity_map", "build_crosswalk"]

"""Silver models: JSON envelopes -> typed rows, latest per natural key."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import try_bool, try_int
from ..functions.jsonops import RECORD, unnest_records
from ..operators.dedup import latest_per_key, total_order

_CAST = {"text": lambda c: c, "json": lambda c: c, "int": try_int, "bool": try_bool}


@dataclass(frozen=True)
class SilverSpec:
    name: str
    fields: tuple            # (output column, JSON key, kind: text | int | bool | json)
    required: str            # output column that must be non-NULL
    keys: tuple              # natural key (output columns)
    source_file: bool = True  # keep _source_file in the output


# Tables, output columns and JSON keys of the feeds, with their types and natural keys.
SPECS = {s.name: s for s in (
    SilverSpec("silver_mc_general", (
        ("movie_slug", "movie_slug", "text"), ("slug", "slug", "text"), ("id", "id", "int"),
        ("title", "title", "text"), ("description", "description", "text"),
        ("release_date", "release_date", "text"), ("premiere_year", "premiere_year", "int"),
        ("rating", "rating", "text"), ("duration_minutes", "duration", "int"),
        ("in_theaters", "in_theaters", "bool"), ("tagline", "tagline", "text"),
        ("imdb_id", "imdb_id", "text"), ("genres", "genres", "json"),
        ("critic_score", "critic_score", "int"), ("critic_review_count", "critic_review_count", "int"),
        ("critic_sentiment", "critic_sentiment", "text")),
        "movie_slug", ("movie_slug",)),
    SilverSpec("silver_mc_critic_reviews", (
        ("movie_slug", "movie_slug", "text"), ("author", "author", "text"),
        ("author_slug", "author_slug", "text"), ("publication_name", "publication_name", "text"),
        ("publication_slug", "publication_slug", "text"), ("quote", "quote", "text"),
        ("score", "score", "int"), ("url", "url", "text"), ("review_date", "date", "text")),
        "movie_slug", ("movie_slug", "author_slug", "review_date")),
    SilverSpec("silver_mc_user_reviews", (
        ("movie_slug", "movie_slug", "text"), ("review_id", "review_id", "text"),
        ("author", "author", "text"), ("quote", "quote", "text"), ("score", "score", "int"),
        ("review_date", "date", "text"), ("spoiler", "spoiler", "bool"),
        ("thumbs_up", "thumbs_up", "int"), ("thumbs_down", "thumbs_down", "int")),
        "movie_slug", ("review_id",)),
    SilverSpec("silver_rt_critic_reviews", (
        ("movie_id", "movie_id", "text"), ("review_id", "review_id", "text"),
        ("critic_name", "critic_name", "text"), ("publication", "publication", "text"),
        ("score", "score", "text"), ("quote", "quote", "text"), ("review_date", "review_date", "text")),
        "movie_id", ("review_id",), source_file=False),
    SilverSpec("silver_rt_crosswalk", (
        ("imdb_id", "imdb_id", "text"), ("rt_slug", "rt_slug", "text"),
        ("mc_slug", "mc_slug", "text"), ("title", "title", "text")),
        "rt_slug", ("rt_slug",), source_file=False),
    SilverSpec("silver_rt_details", (
        ("movie_id", "movie_id", "text"), ("title", "title", "text"), ("rating", "rating", "text"),
        ("release_date", "release", "text"), ("rtid", "rtid", "text"), ("urlid", "urlid", "text")),
        "movie_id", ("movie_id",)),
    SilverSpec("silver_rt_reviews", (
        ("movie_id", "movie_id", "text"), ("review_id", "reviewId", "text"), ("quote", "quote", "text"),
        ("rating", "rating", "text"), ("is_verified", "isVerified", "bool"),
        ("is_super_reviewer", "isSuperReviewer", "bool"), ("has_spoilers", "hasSpoilers", "bool"),
        ("has_profanity", "hasProfanity", "bool"), ("created_at", "creationDate", "text"),
        ("user_display_name", "userDisplayName", "text"), ("user_account_link", "userAccountLink", "text"),
        ("user_realm", "userRealm", "text"), ("user_id", "userId", "text")),
        "movie_id", ("review_id",)),
    SilverSpec("silver_rt_score", (
        ("movie_id", "movie_id", "text"), ("description", "description", "text"),
        ("audience_all", "audienceAll", "json"), ("audience_verified", "audienceVerified", "json"),
        ("critics_all", "criticsAll", "json"), ("critics_top", "criticsTop", "json")),
        "movie_id", ("movie_id",)),
)}

BRONZE_OF = {
    "silver_mc_general": "mc_general", "silver_mc_critic_reviews": "mc_critic_reviews",
    "silver_mc_user_reviews": "mc_user_reviews", "silver_rt_critic_reviews": "rt_critic_reviews",
    "silver_rt_crosswalk": "rt_crosswalk", "silver_rt_details": "rt_details",
    "silver_rt_reviews": "rt_reviews", "silver_rt_score": "rt_score",
}


def typed_records(bronze: DataFrame, spec: SilverSpec) -> DataFrame:
    """Unnest, read all fields with one parse per record, drop rows without the required
    key, apply the lenient casts. Columns: declared fields, ``_loaded_at``, ``_source_file``."""
    recs = unnest_records(bronze)
    outs = [f[0] for f in spec.fields]
    raw = recs.select("_loaded_at", "_source_file",
                      F.json_tuple(F.col(RECORD), *[f[1] for f in spec.fields]).alias(*outs))
    raw = raw.filter(F.col(spec.required).isNotNull())
    return raw.select(*[_CAST[kind](F.col(out)).alias(out) for out, _, kind in spec.fields],
                      "_loaded_at", "_source_file")


def build_silver(bronze: DataFrame, spec: SilverSpec) -> DataFrame:
    typed = typed_records(bronze, spec)
    latest = latest_per_key(typed, list(spec.keys), total_order(typed))
    cols = [f[0] for f in spec.fields] + ["_loaded_at"] + (["_source_file"] if spec.source_file else [])
    return latest.select(*cols)


def silver_rt_details(bronze_details: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Latest details per movie_id, LEFT JOIN the (rt_slug-unique) crosswalk for imdb_id."""
    d = build_silver(bronze_details, SPECS["silver_rt_details"])
    xw = crosswalk.select(F.col("rt_slug").alias("_xw_slug"), F.col("imdb_id"))
    j = d.join(xw, d["movie_id"] == F.col("_xw_slug"), "left")
    return j.select("movie_id", "title", "rating", "release_date", "rtid", "urlid", "imdb_id",
                    "_loaded_at", "_source_file")


def build_all_silver(bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    out = {}
    for name, spec in SPECS.items():
        if name == "silver_rt_details":
            continue
        out[name] = build_silver(bronze[BRONZE_OF[name]], spec)
    out["silver_rt_details"] = silver_rt_details(bronze["rt_details"], out["silver_rt_crosswalk"])
    return out


__all__ = ["SPECS", "SilverSpec", "BRONZE_OF", "typed_records", "build_silver", "silver_rt_details",
           "build_all_silver"]

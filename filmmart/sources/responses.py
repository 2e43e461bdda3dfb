"""Captured API responses and pages -> flat records.

Input is a table of responses ``(entity_id, page_no, body)`` or pages
``(page_id, url, html)``; the crawling itself is not part of this library.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import try_bool, try_int
from ..functions.text import last_segment
from ..operators.dedup import top_n_per_group

# Response shapes of the two platforms. The field names, JSON paths and script ids in the
# functions below are input format as well.
MC_ITEM_SCHEMA = (
    "data struct<item: struct<id: string, title: string, slug: string, description: string, "
    "releaseDate: string, premiereYear: string, rating: string, duration: string, inTheaters: string, "
    "tagline: string, imdbId: string, genres: array<struct<name: string>>, "
    "criticScoreSummary: struct<score: string, reviewCount: string, sentiment: string>>>"
)
MC_ITEMS_SCHEMA = "data struct<items: array<string>>"
RT_REVIEWS_SCHEMA = "reviews array<string>, pageInfo struct<hasNextPage: boolean, endCursor: string>"
SCORECARD_SCRIPT = r'(?s)<script[^>]*id="media-scorecard-json"[^>]*>(.*?)</script>'
DETAILS_SCRIPT = r'(?s)<script[^>]*id="mps-page-integration"[^>]*>(.*?)</script>'
OVERLAY_KEYS = ("audienceAll", "audienceVerified", "criticsAll", "criticsTop")
SCORECARD_KEYS = ("overlay", "description")
DETAILS_KEYS = ("title",)
MPSCALL = r"(?s)window\.mpscall\s*=\s*(\{.*?\});"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flatten_movie(df: DataFrame, entity: str = "entity_id", body: str = "body") -> DataFrame:
    """B1: ``data.item`` -> one general record; genre objects -> names (entries without a
    name dropped); a missing score summary or genre list is tolerated."""
    p = df.select(F.col(entity).alias("movie_slug"), F.from_json(F.col(body), MC_ITEM_SCHEMA).alias("_b"))
    it = F.col("_b.data.item")
    genres = F.coalesce(F.transform(F.filter(it["genres"], lambda g: g["name"].isNotNull()), lambda g: g["name"]),
                        F.array().cast("array<string>"))
    return p.select(
        "movie_slug", try_int(it["id"]).alias("id"), it["title"].alias("title"), it["slug"].alias("slug"),
        it["description"].alias("description"), it["releaseDate"].alias("release_date"),
        try_int(it["premiereYear"]).alias("premiere_year"), it["rating"].alias("rating"),
        try_int(it["duration"]).alias("duration"), try_bool(it["inTheaters"]).alias("in_theaters"),
        it["tagline"].alias("tagline"), it["imdbId"].alias("imdb_id"), genres.alias("genres"),
        try_int(it["criticScoreSummary"]["score"]).alias("critic_score"),
        try_int(it["criticScoreSummary"]["reviewCount"]).alias("critic_review_count"),
        it["criticScoreSummary"]["sentiment"].alias("critic_sentiment"))


def _items(df: DataFrame, entity: str, body: str, page: str | None) -> DataFrame:
    keep = [F.col(entity).alias("movie_slug")] + ([F.col(page).alias("page_no")] if page else [])
    p = df.select(*keep, F.from_json(F.col(body), MC_ITEMS_SCHEMA).alias("_b"))
    return p.select(*[c for c in ["movie_slug", "page_no"] if c in p.columns],
                    F.posexplode(F.col("_b.data.items")).alias("item_pos", "_it"))


def flatten_critic_reviews(df: DataFrame, entity: str = "entity_id", body: str = "body",
                           page: str | None = "page_no") -> DataFrame:
    """B2: ``data.items`` -> critic reviews; ``quote`` is '' only if the key is absent, a JSON
    null stays NULL (``review_rejects`` lists those)."""
    it = _items(df, entity, body, page)
    t = it.select("*", F.json_tuple("_it", "quote", "score", "url", "date", "author", "authorSlug",
                                    "publicationName", "publicationSlug").alias(
        "quote", "score", "url", "date", "author", "author_slug", "publication_name", "publication_slug"))
    return t.select(*[c for c in it.columns if c != "_it"], _default("_it", "quote", F.col("quote"), F.lit("")).alias("quote"),
                    try_int("score").alias("score"), "url", "date", "author", "author_slug",
                    "publication_name", "publication_slug")


def flatten_user_reviews(df: DataFrame, entity: str = "entity_id", body: str = "body",
                         page: str | None = "page_no") -> DataFrame:
    """``data.items`` -> user reviews; an absent id is '', an absent spoiler flag false; a JSON null
    stays NULL (``review_rejects`` lists those)."""
    it = _items(df, entity, body, page)
    t = it.select("*", F.json_tuple("_it", "id", "quote", "score", "date", "author", "spoiler", "thumbsUp",
                                    "thumbsDown").alias(
        "id", "quote", "score", "date", "author", "spoiler", "thumbs_up", "thumbs_down"))
    return t.select(*[c for c in it.columns if c != "_it"], _default("_it", "id", F.col("id"), F.lit("")).alias("review_id"),
                    "quote", try_int("score").alias("score"), "date", "author",
                    _default("_it", "spoiler", try_bool("spoiler"), F.lit(False)).alias("spoiler"),
                    try_int("thumbs_up").alias("thumbs_up"), try_int("thumbs_down").alias("thumbs_down"))


def _default(json_obj: str, key: str, value: Column, default: Column) -> Column:
    """``value`` where the key is present (a null included), else ``default``."""
    return F.when(F.coalesce(has_key(json_obj, key), F.lit(False)), value).otherwise(default)


def review_rejects(df: DataFrame, keys=("quote", "id", "spoiler"), entity: str = "entity_id", body: str = "body",
                   page: str | None = "page_no") -> DataFrame:
    """Items of ``data.items`` in which one of ``keys`` is present with a null, which the record
    types do not allow: the items with a ``reason``."""
    it = _items(df, entity, body, page)
    null = [F.when(F.coalesce(has_key("_it", k), F.lit(False)) & F.get_json_object("_it", f"$.{k}").isNull(), F.lit(f"{k}: null"))
            for k in keys]
    reason = F.concat_ws("; ", F.array_compact(F.array(*null)))
    return it.withColumn("reason", reason).filter(F.col("reason") != "").withColumnRenamed("_it", "record")


def _rt_reviews(df: DataFrame, entity: str, body: str, page: str | None) -> DataFrame:
    keep = [F.col(entity).alias("movie_id")] + ([F.col(page).alias("page_no")] if page else [])
    p = df.select(*keep, F.from_json(F.col(body), RT_REVIEWS_SCHEMA).alias("_b"))
    return p.select(*[c for c in ["movie_id", "page_no"] if c in p.columns],
                    F.posexplode(F.col("_b.reviews")).alias("item_pos", "_r"))


def flatten_audience_reviews(df: DataFrame, entity: str = "entity_id", body: str = "body",
                             page: str | None = "page_no") -> DataFrame:
    """RT audience reviews, nested ``user`` lifted, fields renamed to the feed names."""
    r = _rt_reviews(df, entity, body, page)
    j = F.col("_r")
    g = lambda p: F.get_json_object(j, p)
    return r.select(*[c for c in r.columns if c != "_r"],
                    g("$.rating").alias("rating"), g("$.review").alias("quote"), g("$.ratingId").alias("reviewId"),
                    g("$.isVerified").alias("isVerified"), g("$.isSuperReviewer").alias("isSuperReviewer"),
                    g("$.hasSpoilers").alias("hasSpoilers"), g("$.hasProfanity").alias("hasProfanity"),
                    g("$.createDate").alias("creationDate"), g("$.user.profileHandle").alias("userAccountLink"),
                    g("$.displayName").alias("userDisplayName"), g("$.user.realm").alias("userRealm"),
                    g("$.user.encryptedUserId").alias("userId"))


def has_key(json_obj, key: str) -> Column:
    """True when ``key`` is present in the JSON object (even with a null value)."""
    return F.array_contains(F.json_object_keys(_col(json_obj)), key)


def key_fallback(json_obj, first: str, second: str) -> Column:
    """Value of ``first`` if the key is present (a JSON null stays NULL), else ``second``."""
    j = _col(json_obj)
    return F.when(F.coalesce(has_key(j, first), F.lit(False)), F.get_json_object(j, f"$.{first}")) \
            .otherwise(F.get_json_object(j, f"$.{second}"))


def flatten_rt_critic_reviews(df: DataFrame, entity: str = "entity_id", body: str = "body",
                              page: str | None = "page_no") -> DataFrame:
    """RT critic reviews; score = originalScore, or scoreSentiment only when absent."""
    r = _rt_reviews(df, entity, body, page)
    j = F.col("_r")
    return r.select(*[c for c in r.columns if c != "_r"],
                    F.get_json_object(j, "$.reviewId").alias("review_id"),
                    F.get_json_object(j, "$.critic.displayName").alias("critic_name"),
                    F.get_json_object(j, "$.publication.name").alias("publication"),
                    key_fallback(j, "originalScore", "scoreSentiment").alias("score"),
                    F.get_json_object(j, "$.reviewQuote").alias("quote"),
                    F.get_json_object(j, "$.createDate").alias("review_date"))


def script_content(html, pattern: str = SCORECARD_SCRIPT) -> Column:
    """Text of the first script matching ``pattern`` (capture group 1); '' -> NULL."""
    t = F.regexp_extract(_col(html), pattern, 1)
    return F.when(t != "", t)


def page_scorecard(df: DataFrame, movie: str = "movie_id", html: str = "html") -> DataFrame:
    """Score overlay (4 subtrees), description and the movie code of the review link; no row for
    a page without the script or without the required keys (``page_rejects`` has those)."""
    j = script_content(F.col(html))
    g = lambda p: F.get_json_object(j, p)
    return df.filter(_has_all(j, "$.overlay", OVERLAY_KEYS) & _has_all(j, "$", SCORECARD_KEYS)).select(F.col(movie).alias("movie_id"),
                     g("$.overlay.audienceAll").alias("audienceAll"),
                     g("$.overlay.audienceVerified").alias("audienceVerified"),
                     g("$.overlay.criticsAll").alias("criticsAll"), g("$.overlay.criticsTop").alias("criticsTop"),
                     g("$.description").alias("description"),
                     last_segment(g("$.criticReviewHref")).alias("movie_code"))


def js_object(text, pattern: str = MPSCALL) -> Column:
    """The object literal assigned in a script (non-greedy, across lines)."""
    t = F.regexp_extract(_col(text), pattern, 1)
    return F.when(t != "", t)


def page_details(df: DataFrame, movie: str = "movie_id", html: str = "html") -> DataFrame:
    """Details from ``window.mpscall = {...};``; bracketed keys read by literal name; no row for a
    page without the assignment or without a title (``page_rejects`` has those)."""
    o = js_object(script_content(F.col(html), DETAILS_SCRIPT))
    g = lambda k: F.get_json_object(o, f"$['{k}']")
    return df.filter(_has_all(o, "$", DETAILS_KEYS)).select(F.col(movie).alias("movie_id"), g("title").alias("title"), g("cag[rating]").alias("rating"),
                     g("cag[release]").alias("release"), g("field[rtid]").alias("rtid"),
                     g("cag[urlid]").alias("urlid"))


def _has_all(json_text: Column, at: str, keys) -> Column:
    """True if the text is a JSON object that has all the keys at the path."""
    names = F.json_object_keys(F.get_json_object(json_text, at))
    present = F.lit(True)
    for k in keys:
        present = present & F.coalesce(F.array_contains(names, k), F.lit(False))
    return present


def page_rejects(df: DataFrame, movie: str = "movie_id", html: str = "html") -> DataFrame:
    """Pages that give no scorecard or no details (blocked, changed or cut off): movie_id, kind, reason."""
    j = script_content(F.col(html))
    o = js_object(script_content(F.col(html), DETAILS_SCRIPT))

    def bad(kind: str, text: Column, good: Column) -> DataFrame:
        reason = F.when(text.isNull(), F.lit("no embedded data")).otherwise(F.lit("required keys missing"))
        return df.filter(~good).select(F.col(movie).alias("movie_id"), F.lit(kind).alias("kind"), reason.alias("reason"))

    return bad("scorecard", j, _has_all(j, "$.overlay", OVERLAY_KEYS) & _has_all(j, "$", SCORECARD_KEYS)).unionByName(
        bad("details", o, _has_all(o, "$", DETAILS_KEYS)))


def page_cap(df: DataFrame, entity: str = "entity_id", page: str = "page_no", n: int | None = None) -> DataFrame:
    """First ``n`` response pages of each entity, if the caller sets a cap (None or n <= 0: all)."""
    if n is None or n <= 0:
        return df
    return top_n_per_group(df, [entity], [F.col(page).asc_nulls_last()], n)


# Texts and numbers that count as booleans.
BOOLEAN_WORDS = {True: ("true", "t", "yes", "y", "on", "1"), False: ("false", "f", "no", "n", "off", "0")}


def validate_records(df: DataFrame, rules: dict, record: str = "record") -> tuple[DataFrame, DataFrame]:
    """Typed validation of JSON records.

    ``rules``: field -> (kind, required) with kind in text | int | bool. Values convert without
    loss only: an int is a whole number or its text (``85``, ``85.0``, ``"85"``; not ``"85.5"``),
    a text is a JSON string, a bool is true, false or one of ``BOOLEAN_WORDS``. A required field
    that is missing or null, or a present value that does not convert, rejects the record.
    Returns (valid typed rows, rejects with ``reason``).
    """
    return split_tagged(tag_records(df, rules, record), df.columns)


def split_tagged(tagged: DataFrame, base: list[str]) -> tuple[DataFrame, DataFrame]:
    """(valid typed rows, rejects with ``reason`` and the columns ``base``) of ``tag_records``."""
    return tagged.filter(F.col("reason").isNull()).drop("reason"), tagged.filter(F.col("reason").isNotNull()).select(*base, "reason")


def tag_records(df: DataFrame, rules: dict, record: str = "record") -> DataFrame:
    """The rows with their typed values and a ``reason``, null for valid ones."""
    names = list(rules)
    raw = df.select("*", F.json_tuple(F.col(record), *names).alias(*[f"_raw_{n}" for n in names]))
    kinds = F.transform_values(F.from_json(F.col(record), "map<string, variant>"), lambda _, v: F.schema_of_variant(v))
    raw = raw.withColumn("_raw_kinds_of_values", kinds)  # once, not for every field

    def exact(name: str, kind: str) -> Column:
        c, token = F.col(f"_raw_{name}"), F.col("_raw_kinds_of_values")[name]
        if kind == "text":
            return F.when(token == "STRING", c)
        if kind == "bool":
            word = F.lower(F.trim(c))
            return (F.when(word.isin(*BOOLEAN_WORDS[True]), F.lit(True)).when(word.isin(*BOOLEAN_WORDS[False]), F.lit(False)))
        # A number may be written 85.0; text must be digits.
        whole = F.when(token == "STRING", F.trim(c).rlike(r"^[+-]?\d+$")).otherwise(c.rlike(r"^-?\d+(\.0+)?$"))
        return F.when(whole, F.regexp_replace(F.trim(c), r"\.0+$", "").try_cast("int"))

    typed = raw.select("*", *[exact(n, k).alias(n) for n, (k, _) in rules.items()])
    problems = []
    for n, (kind, required) in rules.items():
        rawc, val = F.col(f"_raw_{n}"), F.col(n)
        if required:
            problems.append(F.when(rawc.isNull(), F.lit(f"{n}: missing")))
        problems.append(F.when(rawc.isNotNull() & val.isNull(), F.lit(f"{n}: not {kind}")))
    reason = F.concat_ws("; ", F.array_compact(F.array(*problems)))
    return typed.withColumn("reason", F.when(reason != "", reason)).select(*df.columns, *names, "reason")


def discovery_records(df: DataFrame, method: str, discovered_at, slug: str = "slug", title: str = "title",
                      year: str = "premiere_year") -> DataFrame:
    """Discovered movie records; the clock is an input so re-runs agree."""
    ts = discovered_at if isinstance(discovered_at, Column) else F.lit(discovered_at).cast("timestamp")
    return df.select(F.col(slug).alias("slug"), ts.alias("discovered_at"), F.lit(method).alias("method"),
                     F.col(title).alias("title"), F.col(year).cast("int").alias("premiere_year"))


__all__ = ["flatten_movie", "flatten_critic_reviews", "flatten_user_reviews", "flatten_audience_reviews",
           "flatten_rt_critic_reviews", "key_fallback", "has_key", "script_content", "page_scorecard",
           "js_object", "page_details", "page_rejects", "review_rejects", "page_cap", "validate_records", "tag_records", "split_tagged", "discovery_records"]

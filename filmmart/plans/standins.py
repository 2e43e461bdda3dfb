"""Driver tables rendered as bronze envelopes (tests and registered checks only).

Rows sharing a load time and a file chunk form one file: one envelope row whose ``data``
is the JSON array of their records, sorted by record key. Chunks hold at most ``FILE_ROWS`` consecutive keys, so no file (and no
group in the building aggregate) grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the stand-in layout.
TS0_EPOCH = 1704067200          # 2024-01-01 00:00:00 UTC
DAY_SECONDS = 86400
FILE_ROWS = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def envelope(rows: DataFrame, name: str, epoch: Column, chunk: Column, columns: list[str], record) -> DataFrame:
    """One envelope row per load second ``epoch`` and ``chunk`` of ``rows``. ``record``: from a getter of the named ``columns`` to a record's
    sort value and its fields. The columns are shuffled, not the text: a record becomes JSON where its file is put together."""
    grouped = (rows.select(epoch.cast("long").alias("_epoch"), chunk.cast("long").alias("_chunk"), F.struct(*columns).alias("_r"))
                   .groupBy("_epoch", "_chunk").agg(F.collect_list("_r").alias("_rs")))

    def text(r: Column) -> Column:
        ord_, fields = record(lambda c: r[c])
        return F.struct(ord_.alias("_ord"), F.to_json(F.struct(*fields)).alias("_json"))

    texts = F.transform(F.sort_array(F.transform("_rs", text)), lambda r: r["_json"])
    return grouped.select(
        F.timestamp_seconds("_epoch").alias("_loaded_at"),
        _s(f"{name}/", F.col("_epoch").cast("string"), "_", F.col("_chunk").cast("string"), ".json").alias("_source_file"),
        _s("[", F.array_join(texts, ","), "]").alias("data"),
    )


def _date_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def mc_general(part: DataFrame) -> DataFrame:
    def record(c):
        k = c("p_partkey")
        return k, [
            _s("p-", k.cast("string")).alias("movie_slug"),
            _s("p-", k.cast("string")).alias("slug"),
            k.alias("id"),
            _s(c("_title"), " ", k.cast("string")).alias("title"),
            F.when(k % 23 == 0, F.lit("unknown")).otherwise((F.lit(1970) + c("p_size")).cast("string")).alias("premiere_year"),
            c("p_brand").alias("rating"),
            (c("p_size") + 60).alias("duration"),
            ((k % 2) == 0).alias("in_theaters"),
            F.when(k % 5 != 0, _s("tt", k.cast("string"))).alias("imdb_id"),
            F.when(k % 29 == 0, F.array().cast("array<string>")).otherwise(F.array(c("p_type"))).alias("genres"),
            F.when(k % 19 == 0, F.lit("tbd")).otherwise((c("p_size") * 2).cast("string")).alias("critic_score"),
            (k % 50).alias("critic_review_count"),
        ]

    def copy(title: Column, shift: int) -> DataFrame:
        return part.withColumn("_title", title).withColumn("_shift", F.lit(shift))

    k = F.col("p_partkey")
    copies = copy(F.col("p_name"), 0).unionByName(copy(F.upper("p_name"), DAY_SECONDS))
    return envelope(copies, "mc_general", F.lit(TS0_EPOCH) + F.col("_shift") + F.floor(k / 10), F.floor(k / FILE_ROWS),
                    ["p_partkey", "_title", "p_size", "p_brand", "p_type"], record)


def _by_part(part: DataFrame, name: str, epoch: Column, columns: list[str], record) -> DataFrame:
    return envelope(part, name, epoch, F.floor(F.col("p_partkey") / FILE_ROWS), ["p_partkey", *columns], record)


def _tenth_second() -> Column:
    return F.lit(TS0_EPOCH) + F.floor(F.col("p_partkey") / 10)


def rt_details(part: DataFrame) -> DataFrame:
    def record(c):
        k = c("p_partkey")
        # Every third movie is on this platform only: its id is in no crosswalk.
        return k, [
            _s(F.when(k % 3 == 0, "x_").otherwise("r_"), k.cast("string")).alias("movie_id"),
            _s(c("p_name"), " ", k.cast("string"), " (2001)").alias("title"),
            c("p_brand").alias("rating"),
            k.alias("rtid"),
            _s("r_", k.cast("string")).alias("urlid"),
        ]
    return _by_part(part, "rt_details", _tenth_second(), ["p_name", "p_brand"], record)


def rt_crosswalk(part: DataFrame) -> DataFrame:
    def record(c):
        k = c("p_partkey")
        return k, [
            _s("tt", k.cast("string")).alias("imdb_id"),
            _s(F.when(k % 7 == 0, "gone_").otherwise("r_"), k.cast("string")).alias("rt_slug"),
            _s("p-", k.cast("string")).alias("mc_slug"),
            _s(c("p_name"), " ", k.cast("string")).alias("title"),
        ]
    return _by_part(part, "rt_crosswalk", F.lit(TS0_EPOCH), ["p_name"], record)


def rt_score(part: DataFrame) -> DataFrame:
    def record(c):
        k = c("p_partkey")
        return k, [
            _s(F.when(k % 3 == 0, "y_").otherwise("r_"), k.cast("string")).alias("movie_id"),
            F.struct((k % 97).alias("likedCount"), F.when(k % 37 != 0, k % 13).alias("notLikedCount")).alias("audienceAll"),
            F.struct(F.when(k % 31 == 0, F.lit("n/a")).otherwise((c("p_size") * 2).cast("string")).alias("score"),
                     (k % 50).alias("reviewCount")).alias("criticsAll"),
            c("p_brand").alias("description"),
        ]
    return _by_part(part, "rt_score", _tenth_second(), ["p_size", "p_brand"], record)


def mc_critic_reviews(lineitem: DataFrame) -> DataFrame:
    def record(c):
        o, s, n = c("l_orderkey"), c("l_suppkey"), c("l_linenumber")
        return F.struct(n.alias("l_linenumber"), c("l_partkey").alias("l_partkey"), s.alias("l_suppkey")), [
            _s("p-", c("l_partkey").cast("string")).alias("movie_slug"),
            _s("o", o.cast("string"), " l", n.cast("string")).alias("quote"),
            F.when((o + n) % 11 != 0, c("l_quantity").cast("int") * 2).alias("score"),
            F.when(o % 13 == 0, F.lit("soon")).otherwise(_date_text(c("l_shipdate"))).alias("date"),
            _s("Supplier ", s.cast("string")).alias("author"),
            F.when(s % 17 != 0, _s("s-", s.cast("string"))).alias("author_slug"),
            _s("Pub ", (s % 10).cast("string")).alias("publication_name"),
            _s("pub-", (s % 10).cast("string")).alias("publication_slug"),
        ]
    return envelope(lineitem, "mc_critic_reviews", F.lit(TS0_EPOCH) + F.col("l_orderkey"), F.lit(0),
                    ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"], record)


def rt_critic_reviews(orders: DataFrame) -> DataFrame:
    def record(c):
        o = c("o_orderkey")
        return o, [
            _s("r_", (o % 2000).cast("string")).alias("movie_id"),
            o.alias("review_id"),
            F.when(o % 9 != 0, _s("Critic ", c("o_custkey").cast("string"))).alias("critic_name"),
            c("o_orderstatus").alias("publication"),
            c("o_orderpriority").alias("score"),
            _s("q", o.cast("string")).alias("quote"),
            F.when(o % 8 == 0, F.date_format(c("o_orderdate"), "MMM d, yyyy")).otherwise(_date_text(c("o_orderdate"))).alias("review_date"),
        ]
    return envelope(orders, "rt_critic_reviews", F.lit(TS0_EPOCH) + F.col("o_orderkey"), F.lit(0),
                    ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"], record)


def _hour_epoch() -> Column:
    return F.unix_seconds(F.date_trunc("hour", F.col("ts")))


def mc_user_reviews(events: DataFrame) -> DataFrame:
    def record(c):
        e, u = c("event_id"), c("user_id")
        return e, [
            _s("p-", u.cast("string")).alias("movie_slug"),
            e.cast("string").alias("review_id"),
            _s("u", u.cast("string")).alias("author"),
            F.when(e % 10 == 0, F.lit("bad")).otherwise(F.least(F.lit(10), F.floor(c("value") / 10)).cast("int").cast("string")).alias("score"),
            _date_text(c("ts")).alias("date"),
            (c("event_type") == "error").alias("spoiler"),
            (e % 7).alias("thumbs_up"),
            (e % 5).alias("thumbs_down"),
        ]
    return envelope(events, "mc_user_reviews", _hour_epoch(), F.floor(F.col("event_id") / FILE_ROWS),
                    ["event_id", "user_id", "value", "ts", "event_type"], record)


def rt_reviews(events: DataFrame) -> DataFrame:
    def record(c):
        e, u = c("event_id"), c("user_id")
        return e, [
            _s("r_", u.cast("string")).alias("movie_id"),
            c("event_type").alias("rating"),
            e.cast("string").alias("reviewId"),
            (c("event_type") == "purchase").alias("isVerified"),
            ((e % 4) == 0).alias("isSuperReviewer"),
            _date_text(c("ts")).alias("creationDate"),
            _s("User ", u.cast("string")).alias("userDisplayName"),
            u.cast("string").alias("userId"),
        ]
    return envelope(events, "rt_reviews", _hour_epoch(), F.floor(F.col("event_id") / FILE_ROWS),
                    ["event_id", "user_id", "ts", "event_type"], record)


def bronze_from_driver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All eight bronze tables from the driver tables, lazily."""
    part = table(spark, sf_dir, "part")
    events = table(spark, sf_dir, "events")
    return {
        "mc_general": mc_general(part),
        "rt_details": rt_details(part),
        "rt_crosswalk": rt_crosswalk(part),
        "rt_score": rt_score(part),
        "mc_critic_reviews": mc_critic_reviews(table(spark, sf_dir, "lineitem")),
        "rt_critic_reviews": rt_critic_reviews(table(spark, sf_dir, "orders")),
        "mc_user_reviews": mc_user_reviews(events),
        "rt_reviews": rt_reviews(events),
    }


__all__ = ["bronze_from_driver", "envelope", "table", "TS0_EPOCH", "FILE_ROWS"]

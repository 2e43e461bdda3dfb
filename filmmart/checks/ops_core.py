"""Checks of the JSON, cast, dedup, join, aggregate and data-test operators.

Each entry: name -> (Spark callable (spark, sf_dir) -> DataFrame, DuckDB SQL).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import jsonops as J
from ..functions.casts import try_bool, try_date, try_int
from ..functions.text import name_slug, prefixed, strip_year
from ..operators import quality as Q
from ..operators.dedup import latest_per_key
from ..operators.joins import full_outer_on_nullable, full_outer_split, inner_then_left, left_lookup, routed_lookup
from ..operators.keys import dense_key
from ..plans.standins import table
from ..sources.responses import validate_records
from ..plans import gold as G
from .render import render

CHECKS: dict = {}


def check(name: str, sql: str):
    def deco(fn):
        CHECKS[name] = (fn, sql)
        return fn
    return deco


def grouped_text(df: DataFrame, keys: list[str], order: str, text: Column, sep: str = ",") -> DataFrame:
    """One JSON array text per group of ``keys`` (groups bounded by the caller's keys)."""
    g = df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), text.alias("t"))))
                              .alias("_xs"))
    return g.select(*keys, F.concat(F.lit("["), F.array_join(F.transform("_xs", lambda x: x["t"]), sep),
                                    F.lit("]")).alias("data"))


def props_envelopes(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events").withColumn("chunk", F.floor(F.col("event_id") / 64))
    return grouped_text(ev, ["user_id", "chunk"], "event_id", F.col("props"))


# ---------------------------------------------------------------- JSON

@check("json_unnest", """SELECT user_id, event_id // 64 AS chunk,
  row_number() OVER (PARTITION BY user_id, event_id // 64 ORDER BY event_id) - 1 AS pos,
  replace(props, ': ', ':') AS record FROM events""")
def q_json_unnest(spark, sf):
    env = props_envelopes(spark, sf)
    out = J.unnest_records(env, keep=("user_id", "chunk"), with_position=True)
    return out.select("user_id", F.col("chunk").cast("long").alias("chunk"), F.col("_pos").cast("long").alias("pos"),
                      F.col(J.RECORD).alias("record"))


@check("json_path", """SELECT user_id, event_id // 64 AS chunk,
  row_number() OVER (PARTITION BY user_id, event_id // 64 ORDER BY event_id) - 1 AS pos,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def q_json_path(spark, sf):
    out = J.unnest_records(props_envelopes(spark, sf), keep=("user_id", "chunk"), with_position=True)
    return out.select("user_id", F.col("chunk").cast("long").alias("chunk"), F.col("_pos").cast("long").alias("pos"),
                      try_int(J.path(J.RECORD, "$.k")).alias("k"))


@check("lateral_unnest", """SELECT user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_id
FROM events ORDER BY k DESC, user_id, event_id LIMIT 100""")
def q_lateral_unnest(spark, sf):
    ev = table(spark, sf, "events").withColumn("chunk", F.floor(F.col("event_id") / 64))
    env = grouped_text(ev, ["user_id", "chunk"], "event_id",
                       F.concat(F.lit('{"e":'), F.col("event_id").cast("string"), F.lit(',"p":'), F.col("props"),
                                F.lit("}")))
    view = f"lateral_env_{uuid.uuid4().hex[:12]}"   # unique: concurrent callers do not clash
    env.createOrReplaceTempView(view)
    return spark.sql(f"""
        SELECT user_id, try_cast(get_json_object(r, '$.p.k') AS INT) AS k, CAST(get_json_object(r, '$.e') AS BIGINT) AS event_id
        FROM {view} LATERAL VIEW explode(from_json(data, 'array<string>')) t AS r
        ORDER BY k DESC, user_id, event_id LIMIT 100""")


@check("feed_table", """SELECT user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_id FROM events""")
def q_feed_table(spark, sf):
    """The table function over a bronze table, nested paths named."""
    from ..functions.feed_table import register
    register(spark)
    ev = table(spark, sf, "events").withColumn("chunk", F.floor(F.col("event_id") / 64))
    env = grouped_text(ev, ["user_id", "chunk"], "event_id",
                       F.concat(F.lit('{"e":'), F.col("event_id").cast("string"), F.lit(',"p":'), F.col("props"), F.lit("}")))
    view = f"feed_env_{uuid.uuid4().hex[:12]}"
    env.select(F.col("user_id").cast("string").alias("_source_file"), "data").createOrReplaceTempView(view)
    return spark.sql(f"""SELECT CAST(_source_file AS BIGINT) AS user_id, try_cast(p_k AS INT) AS k, CAST(e AS BIGINT) AS event_id
                         FROM feed(TABLE({view}), 'e', 'p.k')""")


@check("json_subtree", """SELECT 'r_' || p_partkey AS movie_id,
  CASE WHEN p_partkey % 4 IN (0, 1) THEN NULL
       ELSE '{"likedCount":' || (p_partkey % 97) || ',"notLikedCount":' || (p_partkey % 13) || '}' END AS audience_all
FROM part""")
def q_json_subtree(spark, sf):
    k = F.col("p_partkey")
    sub = F.concat(F.lit('{"likedCount": '), (k % 97).cast("string"), F.lit(', "notLikedCount": '),
                   (k % 13).cast("string"), F.lit("}"))
    rec = (F.when(k % 4 == 0, F.concat(F.lit('{"movie_id": "r_'), k.cast("string"), F.lit('", "audienceAll": null}')))
            .when(k % 4 == 1, F.concat(F.lit('{"movie_id": "r_'), k.cast("string"), F.lit('"}')))
            .otherwise(F.concat(F.lit('{"movie_id": "r_'), k.cast("string"), F.lit('", "audienceAll": '), sub,
                                F.lit("}"))))
    recs = table(spark, sf, "part").select(rec.alias("r"))
    return recs.select(J.path("r", "$.movie_id").alias("movie_id"), J.path("r", "$.audienceAll").alias("audience_all"))


def _broken_props(spark, sf) -> DataFrame:
    """Every 10th document broken on purpose (closing brace cut off)."""
    ev = table(spark, sf, "events")
    txt = F.when(F.col("event_id") % 10 == 0, F.expr("substring(props, 1, length(props) - 1)")).otherwise(F.col("props"))
    return ev.select("event_id", txt.alias("value"))


@check("json_canonical", """SELECT event_id, replace(props, ': ', ':') AS data FROM events WHERE event_id % 10 <> 0""")
def q_json_canonical(spark, sf):
    good, _ = J.split_valid(_broken_props(spark, sf), "value")
    return good.select("event_id", J.canonical_json("value").alias("data"))


@check("json_reject", """SELECT event_id, 'malformed JSON' AS reason FROM events WHERE event_id % 10 = 0""")
def q_json_reject(spark, sf):
    _, bad = J.split_valid(_broken_props(spark, sf), "value")
    return bad.select("event_id", "reason")


@check("validate_records", """SELECT event_id,
  CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN NULL ELSE CAST(user_id AS INTEGER) END AS user_id,
  CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN NULL ELSE event_type END AS kind,
  CASE WHEN event_id % 11 = 0 THEN 'user_id: missing'
       WHEN event_id % 7 = 0 THEN 'user_id: not int' END AS reason
FROM events""")
def q_validate_records(spark, sf):
    ev = table(spark, sf, "events")
    e = F.col("event_id").cast("string")
    uid = (F.when(F.col("event_id") % 11 == 0, F.lit(""))
            .when(F.col("event_id") % 7 == 0, F.lit(', "user_id": "u-x"'))
            .otherwise(F.concat(F.lit(', "user_id": "'), F.col("user_id").cast("string"), F.lit('"'))))
    rec = F.concat(F.lit('{"event_id": '), e, uid, F.lit(', "kind": "'), F.col("event_type"), F.lit('"}'))
    src = ev.select("event_id", rec.alias("record"))
    ok, bad = validate_records(src, {"user_id": ("int", True), "kind": ("text", True)})
    return ok.select("event_id", "user_id", "kind", F.lit(None).cast("string").alias("reason")).unionByName(
        bad.select("event_id", F.lit(None).cast("int").alias("user_id"), F.lit(None).cast("string").alias("kind"),
                   "reason"))


# ---------------------------------------------------------------- casts

INT_SPELLINGS_SQL = """CASE event_id % 10
  WHEN 0 THEN CAST(CAST(round(value * 100) AS BIGINT) // 100 AS VARCHAR) || '.' || lpad(CAST(CAST(round(value * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0')
  WHEN 1 THEN ' ' || user_id || ' '
  WHEN 2 THEN user_id || 'e1'
  WHEN 3 THEN '+' || user_id
  WHEN 4 THEN user_id || '.5'
  WHEN 5 THEN '-' || user_id || '.5'
  WHEN 6 THEN user_id || '/4'
  WHEN 7 THEN 'B+'
  WHEN 8 THEN ''
  ELSE user_id || 'd' END"""


def _int_text() -> Column:
    e, u = F.col("event_id"), F.col("user_id").cast("string")
    cents = F.round(F.col("value") * 100).cast("long")
    dec = F.concat(F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))
    m = e % 10
    return (F.when(m == 0, dec).when(m == 1, F.concat(F.lit(" "), u, F.lit(" "))).when(m == 2, F.concat(u, F.lit("e1")))
             .when(m == 3, F.concat(F.lit("+"), u)).when(m == 4, F.concat(u, F.lit(".5")))
             .when(m == 5, F.concat(F.lit("-"), u, F.lit(".5"))).when(m == 6, F.concat(u, F.lit("/4")))
             .when(m == 7, F.lit("B+")).when(m == 8, F.lit("")).otherwise(F.concat(u, F.lit("d"))))


@check("try_int", f"""SELECT event_id, {INT_SPELLINGS_SQL} AS txt, TRY_CAST({INT_SPELLINGS_SQL} AS INTEGER) AS v FROM events""")
def q_try_int(spark, sf):
    ev = table(spark, sf, "events").select("event_id", _int_text().alias("txt"))
    return ev.select("event_id", "txt", try_int("txt").alias("v"))


# Boolean spellings exercised.
BOOL_WORDS = ["true", "FALSE", "t", "No", "1", "0", "yes", "Y", "n", "2", "maybe", "off"]
BOOL_SQL = "CASE event_id % 12 " + " ".join(f"WHEN {i} THEN '{w}'" for i, w in enumerate(BOOL_WORDS)) + " END"


@check("try_bool", f"""SELECT event_id, {BOOL_SQL} AS txt, TRY_CAST({BOOL_SQL} AS BOOLEAN) AS v FROM events""")
def q_try_bool(spark, sf):
    words = F.array(*[F.lit(w) for w in BOOL_WORDS])
    ev = table(spark, sf, "events").select("event_id", F.element_at(words, (F.col("event_id") % 12 + 1).cast("int")).alias("txt"))
    return ev.select("event_id", "txt", try_bool("txt").alias("v"))


DATE_SQL = """CASE o_orderkey % 10
  WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
  WHEN 1 THEN strftime(o_orderdate, '%Y/%m/%d')
  WHEN 2 THEN CAST(year(o_orderdate) AS VARCHAR) || '-' || CAST(month(o_orderdate) AS VARCHAR) || '-' || CAST(day(o_orderdate) AS VARCHAR)
  WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T10:00:00Z'
  WHEN 4 THEN strftime(o_orderdate, '%Y-%m-%d') || ' 10:00:00'
  WHEN 5 THEN strftime(o_orderdate, '%Y %m %d')
  WHEN 6 THEN strftime(o_orderdate, '%Y-%m')
  WHEN 7 THEN strftime(o_orderdate, '%Y-%m-%d') || ' abc'
  WHEN 8 THEN strftime(o_orderdate, '%Y') || '-02-30'
  ELSE '' END"""


@check("try_date", f"""SELECT o_orderkey, {DATE_SQL} AS txt, CAST(TRY_CAST({DATE_SQL} AS DATE) AS VARCHAR) AS v FROM orders""")
def q_try_date(spark, sf):
    d, m = F.col("o_orderdate"), F.col("o_orderkey") % 10
    iso = F.date_format(d, "yyyy-MM-dd")
    txt = (F.when(m == 0, iso).when(m == 1, F.date_format(d, "yyyy/MM/dd"))
            .when(m == 2, F.concat_ws("-", F.year(d).cast("string"), F.month(d).cast("string"), F.dayofmonth(d).cast("string")))
            .when(m == 3, F.concat(iso, F.lit("T10:00:00Z"))).when(m == 4, F.concat(iso, F.lit(" 10:00:00")))
            .when(m == 5, F.date_format(d, "yyyy MM dd")).when(m == 6, F.date_format(d, "yyyy-MM"))
            .when(m == 7, F.concat(iso, F.lit(" abc"))).when(m == 8, F.concat(F.date_format(d, "yyyy"), F.lit("-02-30")))
            .otherwise(F.lit("")))
    o = table(spark, sf, "orders").select("o_orderkey", txt.alias("txt"))
    return render(o.select("o_orderkey", "txt", try_date("txt").alias("v")))


# ---------------------------------------------------------------- latest per key

@check("latest_per_key", """SELECT user_id, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1""")
def q_latest_per_key(spark, sf):
    ev = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type")
    out = latest_per_key(ev, ["user_id"], [F.col("ts").desc(), F.col("event_id").asc()])
    return render(out)


LINEITEM_COLS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
                 "l_returnflag, l_linestatus, l_shipdate")


@check("latest_per_composite_key", f"""SELECT {LINEITEM_COLS.replace('l_shipdate', "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') AS l_shipdate")}
FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey, l_suppkey, CAST(l_shipdate AS DATE)
  ORDER BY l_orderkey DESC, {LINEITEM_COLS}) = 1""")
def q_latest_per_composite_key(spark, sf):
    li = table(spark, sf, "lineitem")
    order = [F.col("l_orderkey").desc()] + [F.col(c.strip()).asc_nulls_last() for c in LINEITEM_COLS.split(",")]
    out = latest_per_key(li, [F.col("l_partkey"), F.col("l_suppkey"), F.to_date("l_shipdate")], order)
    return render(out)


@check("latest_nulls_kept", """SELECT nk, c_custkey, c_name FROM (
  SELECT nullif(c_nationkey, 0) AS nk, c_custkey, c_name FROM customer) c
QUALIFY nk IS NULL OR row_number() OVER (PARTITION BY nk ORDER BY c_custkey DESC) = 1""")
def q_latest_nulls_kept(spark, sf):
    c = table(spark, sf, "customer").select(F.nullif(F.col("c_nationkey"), F.lit(0)).alias("nk"), "c_custkey", "c_name")
    return latest_per_key(c, ["nk"], [F.col("c_custkey").desc()], null_keys="keep")


# ---------------------------------------------------------------- joins

FULL_OUTER_SQL = """WITH c AS (
  SELECT nk AS c_nk, c_custkey FROM (SELECT nullif(c_nationkey, 0) AS nk, c_custkey FROM customer) x
  QUALIFY nk IS NULL OR row_number() OVER (PARTITION BY nk ORDER BY c_custkey DESC) = 1),
s AS (
  SELECT nk AS s_nk, s_suppkey FROM (SELECT CASE WHEN s_nationkey >= 20 THEN s_nationkey + 100 ELSE nullif(s_nationkey, 1) END AS nk, s_suppkey FROM supplier) y
  QUALIFY nk IS NULL OR row_number() OVER (PARTITION BY nk ORDER BY s_suppkey) = 1)
SELECT coalesce(c.c_nk, s.s_nk) AS nation, c.c_custkey, c.c_nk, s.s_suppkey, s.s_nk
FROM c FULL OUTER JOIN s ON c.c_nk = s.s_nk"""


@check("full_outer_match", FULL_OUTER_SQL)
def q_full_outer_match(spark, sf):
    c = table(spark, sf, "customer").select(F.nullif("c_nationkey", F.lit(0)).alias("c_nk"), "c_custkey")
    c = latest_per_key(c, ["c_nk"], [F.col("c_custkey").desc()], null_keys="keep")
    n = F.col("s_nationkey")
    s = table(spark, sf, "supplier").select(
        F.when(n >= 20, n + 100).otherwise(F.nullif(n, F.lit(1))).alias("s_nk"), "s_suppkey")
    s = latest_per_key(s, ["s_nk"], [F.col("s_suppkey").asc()], null_keys="keep")
    j = full_outer_on_nullable(c, s, "c_nk", "s_nk")
    return j.select(F.coalesce("c_nk", "s_nk").alias("nation"), "c_custkey", "c_nk", "s_suppkey", "s_nk")


@check("routed_lookup", """SELECT o.o_orderkey, o.o_orderstatus,
  CASE WHEN o.o_orderstatus = 'F' THEN c.c_nationkey WHEN o.o_orderstatus = 'O' THEN s.s_nationkey END AS nation
FROM orders o
LEFT JOIN customer c ON (CASE WHEN c.c_nationkey < 15 THEN c.c_custkey END) = o.o_custkey AND o.o_orderstatus = 'F'
LEFT JOIN supplier s ON s.s_suppkey = o.o_custkey % 100 AND o.o_orderstatus = 'O'""")
def q_routed_lookup(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_custkey",
                                          (F.col("o_custkey") % 100).alias("_sk"))
    cust = table(spark, sf, "customer").select(
        F.when(F.col("c_nationkey") < 15, F.col("c_custkey")).alias("k"), F.col("c_nationkey").alias("nation"))
    sup = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_nationkey").alias("nation"))
    out = routed_lookup(o, "o_orderstatus", {"F": (cust, "k", "o_custkey"), "O": (sup, "k", "_sk")},
                        take="nation", out="nation")
    return out.select("o_orderkey", "o_orderstatus", "nation")


@check("left_lookup", """SELECT o.o_orderkey, c.c_name FROM orders o
LEFT JOIN customer c ON (CASE WHEN c.c_nationkey < 10 THEN c.c_custkey ELSE -c.c_custkey END) = o.o_custkey""")
def q_left_lookup(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    k = F.col("c_custkey")
    c = table(spark, sf, "customer").select(F.when(F.col("c_nationkey") < 10, k).otherwise(-k).alias("c_custkey"), "c_name")
    return left_lookup(o, c, "o_custkey", "c_custkey", ["c_name"]).select("o_orderkey", "c_name")


@check("inner_left_join", """WITH agg AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)
SELECT c.c_custkey, n.n_name, coalesce(agg.n, 0) AS n_orders
FROM customer c JOIN (SELECT CASE WHEN n_regionkey = 0 THEN -1 - n_nationkey ELSE n_nationkey END AS k, n_name FROM nation) n ON n.k = c.c_nationkey
LEFT JOIN agg ON agg.o_custkey = c.c_custkey""")
def q_inner_left_join(spark, sf):
    agg = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    key = F.col("n_nationkey")
    nat = table(spark, sf, "nation").select(F.when(F.col("n_regionkey") == 0, -1 - key).otherwise(key).alias("k"), "n_name")
    j = inner_then_left(table(spark, sf, "customer"), nat, ("c_nationkey", "k"), agg, ("c_custkey", "o_custkey"))
    return j.select("c_custkey", "n_name", F.coalesce("n", F.lit(0)).cast("long").alias("n_orders"))


@check("hot_key_full_outer", """SELECT e.event_id, c.c_custkey FROM (
  SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 14 WHEN event_id % 11 = 0 THEN NULL ELSE user_id END AS k FROM events) e
FULL OUTER JOIN (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_custkey * 2 END AS ck FROM customer) c ON e.k = c.ck""")
def q_hot_key_full_outer(spark, sf):
    """A third of the left rows on one key that matches, NULL keys on both sides."""
    e = F.col("event_id")
    ev = table(spark, sf, "events").select(
        "event_id", F.when(e % 3 == 0, F.lit(14).cast("long")).when(e % 11 != 0, F.col("user_id").cast("long")).alias("k"))
    c = table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 5 != 0, F.col("c_custkey").cast("long") * 2).alias("ck"))
    return full_outer_split(ev, c, "k", "ck").select("event_id", "c_custkey")


@check("dq_key_bitmaps", """SELECT name, CASE WHEN k > 0 THEN 1 + (k - 1) // 32768 ELSE k // 32768 END AS bucket, count(*) AS n, count(DISTINCT k) AS n_values
FROM (SELECT 'l_orderkey' AS name, l_orderkey AS k FROM lineitem UNION ALL SELECT 'l_partkey', l_partkey FROM lineitem) t GROUP BY 1, 2""")
def q_dq_key_bitmaps(spark, sf):
    maps = Q.key_bitmaps(table(spark, sf, "lineitem"), ["l_orderkey", "l_partkey"])
    return maps.select("name", "bucket", "n", F.bitmap_count("bits").alias("n_values"))


# ---------------------------------------------------------------- aggregates and expressions

@check("group_avg_count", """SELECT user_id, CAST(round(avg(score) * 10) AS INTEGER) AS user_score, count(*) AS n
FROM (SELECT user_id, CASE WHEN event_type <> 'error' THEN CAST(least(10, floor(value / 10)) AS INTEGER) END AS score
      FROM events) e WHERE score IS NOT NULL GROUP BY user_id""")
def q_group_avg_count(spark, sf):
    ev = table(spark, sf, "events").select(
        "user_id", F.when(F.col("event_type") != "error",
                          F.least(F.lit(10), F.floor(F.col("value") / 10)).cast("int")).alias("score"))
    got = G.user_scores(ev.withColumnRenamed("user_id", "movie_slug"))
    return got.select(F.col("movie_slug").alias("user_id"), "user_score", F.col("user_review_count").alias("n"))


@check("guarded_ratio", """SELECT p_partkey,
  CASE WHEN (p_partkey % 97) + (p_partkey % 13) > 0
       THEN CAST(round(100.0 * (p_partkey % 97) / ((p_partkey % 97) + (p_partkey % 13))) AS INTEGER) END AS user_score,
  CAST((p_partkey % 97) + (p_partkey % 13) AS BIGINT) AS votes FROM part""")
def q_guarded_ratio(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", (F.col("p_partkey") % 97).alias("liked"),
                                        (F.col("p_partkey") % 13).alias("not_liked"))
    votes, ratio = G.liked_share(F.col("liked"), F.col("not_liked"))
    return p.select("p_partkey", ratio.alias("user_score"), votes.alias("votes"))


@check("union_widen", """SELECT o_orderkey, 'int' AS branch, CAST(CAST(o_orderkey % 100 AS INTEGER) AS VARCHAR) AS score FROM orders
UNION ALL SELECT o_orderkey, 'text', o_orderpriority FROM orders""")
def q_union_widen(spark, sf):
    o = table(spark, sf, "orders")
    a = o.select("o_orderkey", F.lit("int").alias("branch"), (F.col("o_orderkey") % 100).cast("int").alias("score"))
    b = o.select("o_orderkey", F.lit("text").alias("branch"), F.col("o_orderpriority").alias("score"))
    return G.union_as_text(a, b, "score")


@check("slugify", """SELECT c_custkey, 'rt::' || lower(replace(c_name || ' ' || c_mktsegment, ' ', '_')) AS slug FROM customer""")
def q_slugify(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", prefixed("rt::", name_slug(F.concat_ws(" ", "c_name", "c_mktsegment"))).alias("slug"))


STRIP_TITLE_SQL = """CASE p_partkey % 3 WHEN 0 THEN p_name || ' (' || (1990 + p_size) || ')'
  WHEN 1 THEN p_name || ' (' || (1990 + p_size) || ') ' || p_partkey ELSE '2001: ' || p_name || ' ' || (2000 + p_size) END"""


@check("strip_year", f"""SELECT p_partkey, trim(regexp_replace({STRIP_TITLE_SQL}, '\\s*\\(\\d{{4}}\\)\\s*$', '')) AS title FROM part""")
def q_strip_year(spark, sf):
    k, size = F.col("p_partkey"), F.col("p_size")
    yr = F.concat(F.lit(" ("), (1990 + size).cast("string"), F.lit(")"))
    t = (F.when(k % 3 == 0, F.concat(F.col("p_name"), yr))
          .when(k % 3 == 1, F.concat(F.col("p_name"), yr, F.lit(" "), k.cast("string")))
          .otherwise(F.concat(F.lit("2001: "), F.col("p_name"), F.lit(" "), (2000 + size).cast("string"))))
    return table(spark, sf, "part").select("p_partkey", strip_year(t).alias("title"))


@check("dense_key", """SELECT row_number() OVER (ORDER BY o_orderdate, o_custkey, o_orderkey) AS order_key, o_orderkey FROM orders""")
def q_dense_key(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_custkey")
    out = dense_key(o, [F.col("o_orderdate").asc(), F.col("o_custkey").asc(), F.col("o_orderkey").asc()], "order_key")
    return out.select("order_key", "o_orderkey")


# ---------------------------------------------------------------- data tests

@check("dq_not_null", """SELECT 'orders' AS model, c AS column_name, 'not_null' AS test, CAST(f AS BIGINT) AS failures,
  CASE WHEN f = 0 THEN 'pass' ELSE 'fail' END AS status FROM (
  SELECT 'o_orderkey' AS c, count(*) FILTER (WHERE o_orderkey IS NULL) AS f FROM orders
  UNION ALL SELECT 'o_custkey', count(*) FILTER (WHERE o_custkey IS NULL) FROM orders
  UNION ALL SELECT 'o_bucket', count(*) FILTER (WHERE nullif(o_orderkey % 10, 0) IS NULL) FROM orders) t""")
def q_dq_not_null(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey",
                                          F.nullif(F.col("o_orderkey") % 10, F.lit(0)).alias("o_bucket"))
    return Q.not_null(o, ["o_orderkey", "o_custkey", "o_bucket"], "orders")


@check("dq_unique", """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def q_dq_unique(spark, sf):
    return Q.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@check("dq_relationships", """SELECT l_orderkey, count(*) AS n FROM lineitem
WHERE l_orderkey NOT IN (SELECT CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey ELSE -1 - o_orderkey END FROM orders) GROUP BY l_orderkey""")
def q_dq_relationships(spark, sf):
    k = F.col("o_orderkey")
    o = table(spark, sf, "orders").select(F.when(k % 10 != 0, k).otherwise(-1 - k).alias("o_orderkey"))
    return Q.orphans(table(spark, sf, "lineitem"), "l_orderkey", o, "o_orderkey")


@check("dq_accepted_values", """SELECT o_orderpriority, count(*) AS n FROM orders
WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY o_orderpriority""")
def q_dq_accepted_values(spark, sf):
    return Q.unaccepted_values(table(spark, sf, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"])


@check("dq_row_count", """SELECT 'orders' AS model, count(*) AS n, CAST(1 AS BIGINT) AS min_value,
  CAST(1000000 AS BIGINT) AS max_value, count(*) BETWEEN 1 AND 1000000 AS passed FROM orders""")
def q_dq_row_count(spark, sf):
    return Q.row_count_between(table(spark, sf, "orders"), 1, 1_000_000, "orders")


@check("dq_freshness", """SELECT 'events' AS source, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS max_loaded_at,
  (epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(max(ts))) / 3600000000.0 AS age_hours,
  CASE WHEN max(ts) IS NULL THEN 'error'
       WHEN (epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(max(ts))) / 3600000000.0 > 48 THEN 'error'
       WHEN (epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(max(ts))) / 3600000000.0 > 24 THEN 'warn'
       ELSE 'pass' END AS status FROM events""")
def q_dq_freshness(spark, sf):
    ev = table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("_loaded_at"))
    return render(Q.freshness(ev, "2024-02-01 00:00:00", source="events"))


# ---------------------------------------------------------------- hot keys (a third of all rows on one key)

def _hot_events(spark, sf) -> DataFrame:
    ev = table(spark, sf, "events")
    return ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0).cast("long")).otherwise(F.col("user_id")))


HOT_SQL = "SELECT CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id, event_id, ts, event_type, value FROM events"


@check("hot_key_latest", f"""SELECT user_id, event_id, event_type FROM ({HOT_SQL}) e
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) <= 2""")
def q_hot_key_latest(spark, sf):
    """Latest two events per user when one user holds a third of all events."""
    from ..operators.dedup import top_n_per_group
    ev = _hot_events(spark, sf).select("user_id", "event_id", "event_type", "ts")
    return top_n_per_group(ev, ["user_id"], [F.col("ts").desc(), F.col("event_id")], 2).drop("ts")


@check("hot_key_dense_key", f"""SELECT row_number() OVER (ORDER BY user_id, event_type) AS k, user_id, event_type
FROM ({HOT_SQL}) e""")
def q_hot_key_dense_key(spark, sf):
    """Dense key over an order that is NOT total and hot: a third of the rows share user 0,
    many rows tie on (user, type); tied rows are interchangeable, so the multiset agrees."""
    ev = _hot_events(spark, sf).select("user_id", "event_type")
    return dense_key(ev, [F.col("user_id"), F.col("event_type")], "k").select("k", "user_id", "event_type")


@check("hot_key_top_2000", f"""SELECT user_id, event_id FROM ({HOT_SQL}) e
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) <= 2000""")
def q_hot_key_top_2000(spark, sf):
    """The catalogue's own 2,000 per group, a third of the rows in one group."""
    from ..operators.planning import top_n_per_year
    ev = _hot_events(spark, sf).select("user_id", "event_id", "value")
    return top_n_per_year(ev, "user_id", "value", "event_id", n=2000).select("user_id", "event_id")


@check("hot_key_routed_lookup", f"""SELECT event_id, CASE WHEN event_type = 'click' THEN c.c_nationkey WHEN event_type = 'view' THEN s.s_nationkey END AS nation
FROM ({HOT_SQL}) e LEFT JOIN customer c ON c.c_custkey = e.user_id AND event_type = 'click'
LEFT JOIN supplier s ON s.s_suppkey = e.user_id AND event_type = 'view'""")
def q_hot_key_routed_lookup(spark, sf):
    ev = _hot_events(spark, sf).select("event_id", "user_id", "event_type")
    cust = table(spark, sf, "customer").select(F.col("c_custkey").cast("long").alias("k"), F.col("c_nationkey").alias("nation"))
    sup = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("long").alias("k"), F.col("s_nationkey").alias("nation"))
    out = routed_lookup(ev, "event_type", {"click": (cust, "k", "user_id"), "view": (sup, "k", "user_id")}, take="nation", out="nation")
    return out.select("event_id", "nation")


__all__ = ["CHECKS", "grouped_text", "props_envelopes"]

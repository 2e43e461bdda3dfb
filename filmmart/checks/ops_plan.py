"""Checks of response flattening (B), catalogue selection and planning (C), crosswalk (D)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import last_segment, scrub_strings
from ..operators import planning as P
from ..operators.crosswalk import build_crosswalk, identity_map
from ..operators.keys import dense_key
from ..operators.paging import read_page, write_sorted
from ..operators.title_index import build_title_index, search_titles
from ..plans.standins import TS0_EPOCH, table
from ..session import scratch_path
from ..sources import responses as R
from .ops_core import grouped_text
from .render import render

CHECKS: dict = {}


def check(name: str, sql: str | None):
    def deco(fn):
        CHECKS[name] = (fn, sql)
        return fn
    return deco


def _s(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


# ---------------------------------------------------------------- responses

@check("flatten_nested", """SELECT 'p-' || p_partkey AS movie_slug, CAST(p_partkey AS INTEGER) AS id,
  p_name || ' ' || p_partkey AS title, 'p-' || p_partkey AS slug, CAST(1970 + p_size AS INTEGER) AS premiere_year,
  CASE WHEN p_partkey % 6 = 0 THEN '' ELSE p_type END AS genres,
  CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE CAST(p_size * 2 AS INTEGER) END AS critic_score,
  CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE CAST(p_partkey % 50 AS INTEGER) END AS critic_review_count
FROM part""")
def q_flatten_nested(spark, sf):
    k = F.col("p_partkey")
    ks = k.cast("string")
    ident = F.when(k % 2 == 0, _s('"', ks, '"')).otherwise(ks)  # id as text or number: coercion
    genres = F.when(k % 6 == 0, F.lit("")).otherwise(_s(', "genres": [{"name": "', F.col("p_type"), '"}, {"id": 1}]'))
    summary = F.when(k % 4 == 0, F.lit("")).otherwise(
        _s(', "criticScoreSummary": {"score": ', (F.col("p_size") * 2).cast("string"), ', "reviewCount": ',
           (k % 50).cast("string"), "}"))
    body = _s('{"data": {"item": {"id": ', ident, ', "title": "', F.col("p_name"), " ", ks, '", "slug": "p-', ks,
              '", "premiereYear": ', (F.col("p_size") + 1970).cast("string"), genres, summary, "}}}")
    resp = table(spark, sf, "part").select(_s("p-", ks).alias("entity_id"), body.alias("body"))
    m = R.flatten_movie(resp)
    return m.select("movie_slug", "id", "title", "slug", "premiere_year", F.array_join("genres", ",").alias("genres"),
                    "critic_score", "critic_review_count")


def user_review_pages(spark, sf) -> DataFrame:
    ev = table(spark, sf, "events")
    e = F.col("event_id")
    ident = F.when(e % 9 == 0, F.lit("")).otherwise(_s('"id": "', e.cast("string"), '", '))
    spoiler = F.when(e % 5 == 0, F.lit("")).otherwise(_s(', "spoiler": ', F.when(F.col("event_type") == "error", "true")
                                                          .otherwise("false")))
    item = _s("{", ident, '"score": ', F.least(F.lit(10), F.floor(F.col("value") / 10)).cast("string"),
              ', "author": "u', F.col("user_id").cast("string"), '"', spoiler, "}")
    ev = ev.withColumn("page_no", F.floor(e / 20))
    pages = grouped_text(ev, ["user_id", "page_no"], "event_id", item)
    return pages.select(_s("p-", F.col("user_id").cast("string")).alias("entity_id"), "page_no",
                        _s('{"data": {"items": ', F.col("data"), '}, "links": {}}').alias("body"))


@check("flatten_items", """SELECT 'p-' || user_id AS movie_slug, event_id // 20 AS page_no,
  row_number() OVER (PARTITION BY user_id, event_id // 20 ORDER BY event_id) - 1 AS item_pos,
  CASE WHEN event_id % 9 = 0 THEN '' ELSE CAST(event_id AS VARCHAR) END AS review_id,
  CAST(least(10, floor(value / 10)) AS INTEGER) AS score, 'u' || user_id AS author,
  CASE WHEN event_id % 5 = 0 THEN false ELSE event_type = 'error' END AS spoiler
FROM events""")
def q_flatten_items(spark, sf):
    u = R.flatten_user_reviews(user_review_pages(spark, sf))
    return u.select("movie_slug", F.col("page_no").cast("long").alias("page_no"),
                    F.col("item_pos").cast("long").alias("item_pos"), "review_id", "score", "author", "spoiler")


@check("key_fallback", """SELECT 'r_' || user_id AS movie_id, CAST(event_id AS VARCHAR) AS review_id,
  CASE event_id % 3 WHEN 0 THEN 'v' || (event_id % 100) WHEN 1 THEN NULL ELSE 'NEGATIVE' END AS score,
  'Critic ' || user_id AS critic_name
FROM events""")
def q_key_fallback(spark, sf):
    out = R.flatten_rt_critic_reviews(rt_review_pages(spark, sf))
    return out.select("movie_id", "review_id", "score", "critic_name")


def rt_review_pages(spark, sf) -> DataFrame:
    ev = table(spark, sf, "events")
    e = F.col("event_id")
    es = e.cast("string")
    score = (F.when(e % 3 == 0, _s('"originalScore": "v', (e % 100).cast("string"), '", "scoreSentiment": "POSITIVE"'))
              .when(e % 3 == 1, F.lit('"originalScore": null, "scoreSentiment": "POSITIVE"'))
              .otherwise(F.lit('"scoreSentiment": "NEGATIVE"')))
    item = _s('{"reviewId": "', es, '", "critic": {"displayName": "Critic ', F.col("user_id").cast("string"),
              '"}, "publication": null, ', score, "}")
    ev = ev.withColumn("page_no", F.floor(e / 20))
    pages = grouped_text(ev, ["user_id", "page_no"], "event_id", item)
    return pages.select(_s("r_", F.col("user_id").cast("string")).alias("entity_id"), "page_no",
                        _s('{"reviews": ', F.col("data"), ', "pageInfo": {"hasNextPage": false}}').alias("body"))


@check("page_script", r"""SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title,
  CAST(regexp_extract(regexp_extract(html, '(?s)<script[^>]*>(.*?)</script>', 1), 'track\((\d+)\)', 1) AS INTEGER) AS track
FROM pages""")
def q_page_script(spark, sf):
    p = table(spark, sf, "pages")
    script = R.script_content(F.col("html"), r"(?s)<script[^>]*>(.*?)</script>")
    return p.select("page_id", F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1).alias("title"),
                    F.regexp_extract(script, r"track\((\d+)\)", 1).cast("int").alias("track"))


@check("last_segment", """SELECT page_id, string_split(url, '/')[-1] AS segment FROM pages""")
def q_last_segment(spark, sf):
    return table(spark, sf, "pages").select("page_id", last_segment("url").alias("segment"))


@check("page_cap", """SELECT conv_id, turn, role FROM conversations
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) <= 2""")
def q_page_cap(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    return R.page_cap(c, "conv_id", "turn", 2)


@check("scrub_ctrl", r"""SELECT doc_id, regexp_replace(text, '[\x00-\x1f]', ' ', 'g') AS text,
  regexp_replace(lang, '[\x00-\x1f]', ' ', 'g') AS lang, regexp_replace(source, '[\x00-\x1f]', ' ', 'g') AS source,
  n_chars FROM documents""")
def q_scrub_ctrl(spark, sf):
    return scrub_strings(table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars"))


# ---------------------------------------------------------------- catalogue and planning

def _catalogue(spark, sf) -> DataFrame:
    p = table(spark, sf, "part")
    return p.select(_s("p-", F.col("p_partkey").cast("string")).alias("slug"), "p_partkey",
                    F.col("p_name").alias("title"), (F.col("p_size") + 1970).alias("premiere_year"),
                    F.array(F.col("p_type")).alias("genres"), (F.col("p_size") * 2).alias("critic_score"),
                    F.col("p_brand").alias("type"))


DISCOVERED_AT = "2024-01-01 00:00:00"


@check("catalog_browse", """SELECT 'p-' || p_partkey AS slug, '2024-01-01 00:00:00.000000' AS discovered_at, 'browse' AS method,
  p_name AS title, CAST(1970 + p_size AS INTEGER) AS premiere_year
FROM part WHERE 1970 + p_size BETWEEN 1980 AND 2010 AND p_type IN ('ECONOMY', 'SMALL')
ORDER BY p_size * 2 DESC, p_partkey LIMIT 50 OFFSET 5""")
def q_catalog_browse(spark, sf):
    b = P.browse(_catalogue(spark, sf), "critic", "p_partkey", year_min=1980, year_max=2010,
                 genres=["ECONOMY", "SMALL"], offset=5, max_items=50)
    return render(R.discovery_records(b, "browse", DISCOVERED_AT))


BROWSE_CASES = [  # sort, its SQL order, arguments, their SQL condition
    ("user", "p_size % 11", {"type_": "Brand#11"}, "p_brand = 'Brand#11'"),
    ("release", "p_partkey % 365", {"in_theaters": True}, "p_partkey % 3 = 0"),
    ("critic", "p_size * 2", {"in_theaters": False, "release_type": "r1"}, "p_partkey % 2 = 1"),
    ("critic", "p_size * 2", {"networks": ["n1", "n3"], "offset": 2}, "p_partkey % 4 IN (1, 3)"),
]


@check("catalog_browse_filters", " UNION ALL ".join(f"""SELECT * FROM (SELECT {i} AS browse, p_partkey FROM part WHERE {where}
ORDER BY {order} DESC, p_partkey LIMIT 40 OFFSET {args.get('offset', 0)}) t{i}""" for i, (_, order, args, where) in enumerate(BROWSE_CASES)))
def q_catalog_browse_filters(spark, sf):
    """Every filter and sort of the catalogue; in_theaters=False asks for nothing."""
    k = F.col("p_partkey")
    cat = table(spark, sf, "part").select(
        "p_partkey", F.col("p_brand").alias("type"), (k % 3 == 0).alias("in_theaters"), _s("r", (k % 2).cast("string")).alias("release_type"),
        F.array(_s("n", (k % 4).cast("string"))).alias("networks"), (F.col("p_size") * 2).alias("critic_score"),
        (F.col("p_size") % 11).alias("user_score"), (k % 365).alias("release_date"))
    out = None
    for i, (sort, _, args, _) in enumerate(BROWSE_CASES):
        part = P.browse(cat, sort, "p_partkey", max_items=40, **args).select(F.lit(i).alias("browse"), "p_partkey")
        out = part if out is None else out.unionByName(part)
    return out


@check("title_search", """SELECT 'p-' || p_partkey AS slug, '2024-01-01 00:00:00.000000' AS discovered_at, 'search' AS method,
  p_name AS title, CAST(1970 + p_size AS INTEGER) AS premiere_year
FROM part WHERE contains(lower(p_name), 'ring') ORDER BY p_partkey LIMIT 30""")
def q_title_search(spark, sf):
    s = P.title_search(_catalogue(spark, sf), "RING", "p_partkey", max_items=30)
    return render(R.discovery_records(s, "search", DISCOVERED_AT))


SEARCHES = ["RING", "in", "e", "pinned", "qqq", "ed c"]


@check("title_index", " UNION ALL ".join(f"""SELECT * FROM (SELECT '{q}' AS query, p_partkey, p_name FROM part WHERE contains(lower(p_name), lower('{q}'))
ORDER BY p_partkey LIMIT {n}) t{i}""" for i, (q, n) in enumerate((q, 1_000_000 if i % 2 else 40) for i, q in enumerate(SEARCHES))))
def q_title_index(spark, sf):
    """Queries of all lengths through the postings; every other one without a cap."""
    path = scratch_path(spark, "titles")
    build_title_index(table(spark, sf, "part").select("p_partkey", "p_name"), path, "p_name", folders=8)
    out = None
    for i, q in enumerate(SEARCHES):
        found = search_titles(spark, path, q, "p_partkey", None if i % 2 else 40, "p_name", folders=8)
        part = found.select(F.lit(q).alias("query"), "p_partkey", "p_name")
        out = part if out is None else out.unionByName(part)
    return out


PAGES = [(0, 20), (37, 50), (150, 25), (1_000_000_000, 5)]


@check("sorted_pages", " UNION ALL ".join(f"""SELECT * FROM (SELECT {o} AS page_offset, c_custkey FROM customer ORDER BY c_acctbal DESC, c_custkey
LIMIT {n} OFFSET {o}) t{i}""" for i, (o, n) in enumerate(PAGES)))
def q_sorted_pages(spark, sf):
    path = scratch_path(spark, "pages")
    write_sorted(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", "c_custkey", path)
    out = None
    for offset, n in PAGES:
        part = read_page(spark, path, offset, n).select(F.lit(offset).alias("page_offset"), "c_custkey")
        out = part if out is None else out.unionByName(part)
    return out


@check("optional_cap", """SELECT '0' AS cap, c_custkey FROM customer
UNION ALL SELECT '25', c_custkey FROM (SELECT c_custkey FROM customer ORDER BY c_custkey LIMIT 25) t""")
def q_optional_cap(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey")
    a = P.optional_cap(c, 0, [F.col("c_custkey")]).select(F.lit("0").alias("cap"), "c_custkey")
    b = P.optional_cap(c, 25, [F.col("c_custkey")]).select(F.lit("25").alias("cap"), "c_custkey")
    return a.unionByName(b)


@check("top_n_per_group", """SELECT year(o_orderdate) AS year, o_orderkey,
  row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_totalprice DESC, o_orderkey) AS rank_in_year
FROM orders QUALIFY rank_in_year <= 3""")
def q_top_n_per_group(spark, sf):
    o = table(spark, sf, "orders").select(F.year("o_orderdate").cast("long").alias("year"), "o_orderkey", "o_totalprice")
    return P.top_n_per_year(o, "year", "o_totalprice", "o_orderkey", n=3).select("year", "o_orderkey", "rank_in_year")


@check("ordered_distinct", """WITH p1 AS (
  SELECT CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN o_custkey ELSE o_custkey % 100 END AS o_custkey, 0 AS pass,
    row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS pos FROM orders),
p2 AS (SELECT o_custkey, 1 AS pass, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS pos FROM orders),
firsts AS (SELECT o_custkey, min((pass, pos)) AS o FROM (SELECT * FROM p1 UNION ALL SELECT * FROM p2) u GROUP BY o_custkey)
SELECT row_number() OVER (ORDER BY o) AS position, o_custkey FROM firsts""")
def q_ordered_distinct(spark, sf):
    o = table(spark, sf, "orders")
    late = F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp")
    p1 = dense_key(o.select(F.when(late, F.col("o_custkey")).otherwise(F.col("o_custkey") % 100).alias("o_custkey"), "o_orderdate", "o_orderkey"),
                   [F.col("o_orderdate"), F.col("o_orderkey")], "pos")
    p2 = dense_key(o.select("o_custkey", "o_totalprice", "o_orderkey"),
                   [F.col("o_totalprice").desc(), F.col("o_orderkey")], "pos")
    return P.ordered_distinct([p1, p2], "o_custkey")


@check("resume_anti", """SELECT c_custkey FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000)""")
def q_resume_anti(spark, sf):
    todo = table(spark, sf, "customer").select("c_custkey")
    done = table(spark, sf, "orders").filter((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 200000))
    ledger = done.select(F.col("o_custkey").alias("c_custkey"))
    return P.resume_filter(todo, ledger, ["c_custkey"])


@check("mark_done", """SELECT c.c_custkey AS movie, 'orders' AS action, count(o.o_orderkey) AS items
FROM customer c LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 200000) o
  ON o.o_custkey = c.c_custkey GROUP BY c.c_custkey HAVING count(o.o_orderkey) > 0""")
def q_mark_done(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("movie"))
    o = table(spark, sf, "orders").filter((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 200000)).select(
        F.col("o_custkey").alias("_c"), F.col("o_orderkey").alias("item"))
    results = c.join(o, F.col("_c") == F.col("movie"), "left").select("movie", F.lit("orders").alias("action"), "item")
    return P.mark_done(results, ["movie", "action"], require_items=True)


@check("batch_commands", """WITH w AS (
  SELECT 'scrape c' || c_custkey AS cmd, row_number() OVER (ORDER BY c_custkey) AS k, count(*) OVER () AS n FROM customer)
SELECT CAST((k - 1) // greatest(50, CAST(ceil(n / 1000) AS BIGINT)) AS BIGINT) AS batch,
  string_agg(cmd, '; ' ORDER BY k) AS commands, count(*) AS n_commands
FROM w GROUP BY 1""")
def q_batch_commands(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey")
    return P.batch_commands(c, [F.col("c_custkey")], _s("scrape c", F.col("c_custkey").cast("string")),
                            noop="echo nothing to do")


@check("work_batches", """WITH firsts AS (
  SELECT 'r_' || (l_partkey % 3000) AS slug, min((l_orderkey, l_linenumber, l_suppkey, l_partkey)) AS o
  FROM lineitem GROUP BY 1),
ordered AS (SELECT slug, row_number() OVER (ORDER BY o) AS position FROM firsts),
todo AS (SELECT slug, position FROM ordered WHERE slug NOT IN (SELECT 'r_' || p_partkey FROM part WHERE p_size > 25)),
w AS (SELECT 'crawl movie=' || slug || ' action=details' AS cmd, row_number() OVER (ORDER BY position) AS k,
             count(*) OVER () AS n FROM todo)
SELECT CAST((k - 1) // greatest(50, CAST(ceil(n / 1000) AS BIGINT)) AS BIGINT) AS batch,
  string_agg(cmd, '; ' ORDER BY k) AS commands, count(*) AS n_commands FROM w GROUP BY 1""")
def q_work_batches(spark, sf):
    """Slugs in order of first appearance (lineitem order), done = parts with size > 25
    for 'details' (and all parts for another action, which must not count)."""
    li = table(spark, sf, "lineitem").select(
        _s("r_", (F.col("l_partkey") % 3000).cast("string")).alias("slug"),
        F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey").alias("pos"))   # total: ties share a slug
    slugs = P.ordered_distinct([li], "slug")
    p = table(spark, sf, "part")
    ledger = (p.filter(F.col("p_size") > 25).select(_s("r_", F.col("p_partkey").cast("string")).alias("slug"),
                                                    F.lit("details").alias("action"))
               .unionByName(p.select(_s("r_", F.col("p_partkey").cast("string")).alias("slug"),
                                     F.lit("score").alias("action"))))
    return P.work_batches(slugs, ledger, "details", "crawl movie={slug} action={action}")


# ---------------------------------------------------------------- crosswalk

def _identity_bronze(spark, sf) -> DataFrame:
    """Part as mc_general envelopes: arrays per 64 keys, plus every 13th record as a bare
    object file; empty strings for some ids and slugs."""
    k = F.col("p_partkey")
    ks = k.cast("string")
    imdb = F.when(k % 11 == 0, F.lit("")).otherwise(F.col("p_brand"))
    mslug = F.when(k % 5 == 0, F.lit("")).otherwise(_s("p-", ks))
    rec = _s('{"imdb_id": "', imdb, '", "movie_slug": "', mslug, '", "slug": "s-', ks, '", "title": "',
             F.col("p_name"), '"}')
    p = table(spark, sf, "part").select(k.alias("k"), F.floor(k / 64).alias("chunk"), rec.alias("rec"))
    arrays = grouped_text(p.filter(k % 13 != 0), ["chunk"], "k", F.col("rec")).select(
        F.timestamp_seconds(F.lit(TS0_EPOCH) + F.col("chunk")).alias("_loaded_at"),
        _s("id/", F.col("chunk").cast("string"), "_a.json").alias("_source_file"), "data")
    objects = p.filter(k % 13 == 0).select(
        F.timestamp_seconds(F.lit(TS0_EPOCH) + F.col("chunk")).alias("_loaded_at"),
        _s("id/", F.col("chunk").cast("string"), "_o", F.col("k").cast("string"), ".json").alias("_source_file"),
        F.col("rec").alias("data"))
    return arrays.unionByName(objects)


IDENTITY_SQL = """recs AS (
  SELECT p_partkey // 64 AS chunk,
    CASE WHEN p_partkey % 13 = 0 THEN 'id/' || (p_partkey // 64) || '_o' || p_partkey || '.json'
         ELSE 'id/' || (p_partkey // 64) || '_a.json' END AS file,
    CASE WHEN p_partkey % 13 = 0 THEN 0
         ELSE row_number() OVER (PARTITION BY p_partkey // 64, p_partkey % 13 = 0 ORDER BY p_partkey) - 1 END AS pos,
    nullif(CASE WHEN p_partkey % 11 = 0 THEN '' ELSE p_brand END, '') AS imdb_id,
    coalesce(nullif(CASE WHEN p_partkey % 5 = 0 THEN '' ELSE 'p-' || p_partkey END, ''), 's-' || p_partkey) AS mc_slug,
    p_name AS title
  FROM part),
ids AS (
  SELECT imdb_id, mc_slug, title FROM recs WHERE imdb_id IS NOT NULL AND mc_slug IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY imdb_id ORDER BY chunk, file, pos) = 1)"""


@check("identity_map", f"WITH {IDENTITY_SQL}\nSELECT * FROM ids")
def q_identity_map(spark, sf):
    return identity_map(_identity_bronze(spark, sf))


@check("crosswalk_build", f"""WITH {IDENTITY_SQL},
mapping AS (SELECT 'Brand#' || (s_suppkey % 30) AS imdb_id,
  CASE s_suppkey % 4 WHEN 0 THEN 'tv/show_' || s_suppkey WHEN 1 THEN 'm/m/sup_' || s_suppkey
       ELSE 'm/sup_' || s_suppkey END AS rt_raw FROM supplier)
SELECT m.imdb_id, CASE WHEN starts_with(m.rt_raw, 'm/') THEN substr(m.rt_raw, 3) ELSE m.rt_raw END AS rt_slug,
  i.mc_slug, i.title
FROM mapping m JOIN ids i ON i.imdb_id = m.imdb_id WHERE NOT starts_with(m.rt_raw, 'tv/')""")
def q_crosswalk_build(spark, sf):
    s = F.col("s_suppkey")
    ss = s.cast("string")
    raw = (F.when(s % 4 == 0, _s("tv/show_", ss)).when(s % 4 == 1, _s("m/m/sup_", ss)).otherwise(_s("m/sup_", ss)))
    mapping = table(spark, sf, "supplier").select(_s("Brand#", (s % 30).cast("string")).alias("imdb_id"),
                                                  raw.alias("rt_raw"))
    return build_crosswalk(identity_map(_identity_bronze(spark, sf)), mapping)


__all__ = ["CHECKS"]


# ---------------------------------------------------------------- more response shapes

@check("flatten_critic_items", """SELECT 'p-' || l_partkey AS movie_slug, l_orderkey // 16 AS page_no,
  CASE WHEN l_linenumber = 1 THEN '' ELSE 'o' || l_orderkey || ' l' || l_linenumber END AS quote,
  CAST(floor(l_quantity) * 2 AS INTEGER) AS score, strftime(l_shipdate, '%Y-%m-%d') AS date,
  'Supplier ' || l_suppkey AS author, 's-' || l_suppkey AS author_slug
FROM lineitem""")
def q_flatten_critic_items(spark, sf):
    li = table(spark, sf, "lineitem")
    quote = F.when(F.col("l_linenumber") == 1, F.lit("")).otherwise(
        _s('"quote": "o', F.col("l_orderkey").cast("string"), " l", F.col("l_linenumber").cast("string"), '", '))
    item = _s("{", quote, '"score": ', (F.col("l_quantity").cast("int") * 2).cast("string"), ', "date": "',
              F.date_format("l_shipdate", "yyyy-MM-dd"), '", "author": "Supplier ', F.col("l_suppkey").cast("string"),
              '", "authorSlug": "s-', F.col("l_suppkey").cast("string"), '"}')
    li = li.withColumn("page_no", F.floor(F.col("l_orderkey") / 16)).withColumn(
        "_ord", F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"))
    # one captured page = the items of one movie on one page of 16 orders
    pages = grouped_text(li, ["l_partkey", "page_no"], "_ord", item)
    resp = pages.select(_s("p-", F.col("l_partkey").cast("string")).alias("entity_id"), "page_no",
                        _s('{"data": {"items": ', F.col("data"), "}}").alias("body"))
    out = R.flatten_critic_reviews(resp)
    return out.select("movie_slug", F.col("page_no").cast("long").alias("page_no"), "quote", "score", "date",
                      "author", "author_slug")


@check("flatten_audience", """SELECT 'r_' || user_id AS movie_id, CAST(event_id AS VARCHAR) AS reviewId,
  event_type AS rating, CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'h' || user_id END AS userAccountLink,
  CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'RT' END AS userRealm,
  CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'enc' || user_id END AS userId,
  CAST(event_type = 'purchase' AS VARCHAR) AS isVerified, strftime(ts, '%Y-%m-%d') AS creationDate
FROM events""")
def q_flatten_audience(spark, sf):
    ev = table(spark, sf, "events")
    e, u = F.col("event_id"), F.col("user_id").cast("string")
    user = F.when(e % 4 == 0, F.lit("")).otherwise(
        _s(', "user": {"profileHandle": "h', u, '", "realm": "RT", "encryptedUserId": "enc', u, '"}'))
    item = _s('{"rating": "', F.col("event_type"), '", "ratingId": "', e.cast("string"), '", "isVerified": ',
              F.when(F.col("event_type") == "purchase", "true").otherwise("false"), ', "createDate": "',
              F.date_format("ts", "yyyy-MM-dd"), '"', user, "}")
    ev = ev.withColumn("page_no", F.floor(e / 20))
    pages = grouped_text(ev, ["user_id", "page_no"], "event_id", item)
    resp = pages.select(_s("r_", F.col("user_id").cast("string")).alias("entity_id"), "page_no",
                        _s('{"reviews": ', F.col("data"), ', "pageInfo": {"hasNextPage": true, "endCursor": "c"}}')
                        .alias("body"))
    out = R.flatten_audience_reviews(resp)
    return out.select("movie_id", "reviewId", "rating", "userAccountLink", "userRealm", "userId", "isVerified",
                      "creationDate")


def _rt_pages(spark, sf) -> DataFrame:
    """Part rendered as captured RT movie pages with both embedded scripts."""
    k = F.col("p_partkey")
    ks = k.cast("string")
    score = _s('<script id="media-scorecard-json" data-x="1">{"overlay": {"audienceAll": {"likedCount": ',
               (k % 97).cast("string"), '}, "audienceVerified": null, "criticsTop": null, "criticsAll": {"score": ', (F.col("p_size") * 2).cast("string"),
               '}}, "description": "', F.col("p_brand"), '", "criticReviewHref": "/m/p', ks, '/reviews/code', ks,
               '"}</script>')
    rating = F.when(k % 5 == 0, F.lit("")).otherwise(_s('"cag[rating]": "', F.col("p_type"), '",\n  '))
    details = _s('<script id="mps-page-integration">\nwindow.mpscall = {"title": "', F.col("p_name"), '",\n  ', rating,
                 '"field[rtid]": ', ks, ', "cag[urlid]": "u', ks, '"};\nvar later = {"x": 1};\n</script>')
    html = _s("<html><head>", score, "</head><body>", details, "</body></html>")
    blocked = F.when(k % 17 == 0, F.lit("<html>captcha</html>")).when(
        k % 17 == 1, F.regexp_replace(F.regexp_replace(html, '"description"', '"other"'), '"title"', '"other"'))
    return table(spark, sf, "part").select(_s("r_", ks).alias("movie_id"), F.coalesce(blocked, html).alias("html"))


@check("page_scorecard", """SELECT 'r_' || p_partkey AS movie_id, '{"likedCount":' || (p_partkey % 97) || '}' AS audienceAll,
  '{"score":' || (p_size * 2) || '}' AS criticsAll, p_brand AS description, 'code' || p_partkey AS movie_code
FROM part WHERE p_partkey % 17 > 1""")
def q_page_scorecard(spark, sf):
    return R.page_scorecard(_rt_pages(spark, sf)).select("movie_id", "audienceAll", "criticsAll", "description",
                                                         "movie_code")


@check("page_details", """SELECT 'r_' || p_partkey AS movie_id, p_name AS title,
  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_type END AS rating, CAST(p_partkey AS VARCHAR) AS rtid,
  'u' || p_partkey AS urlid FROM part WHERE p_partkey % 17 > 1""")

def q_page_details(spark, sf):
    return R.page_details(_rt_pages(spark, sf)).select("movie_id", "title", "rating", "rtid", "urlid")


@check("page_rejects", """SELECT 'r_' || p_partkey AS movie_id, kind,
  CASE p_partkey % 17 WHEN 0 THEN 'no embedded data' ELSE 'required keys missing' END AS reason
FROM part, (SELECT unnest(['scorecard', 'details']) AS kind) t WHERE p_partkey % 17 <= 1""")
def q_page_rejects(spark, sf):
    return R.page_rejects(_rt_pages(spark, sf))


@check("validate_lossless", """SELECT p_partkey, CASE WHEN p_partkey % 4 = 3 THEN NULL ELSE CAST(p_partkey AS INTEGER) END AS id,
  CASE p_partkey % 4 WHEN 3 THEN 'id: not int; title: not text' END AS reason FROM part""")
def q_validate_records(spark, sf):
    """Ids as number, text and 7.0 convert; "7.5" and a numeric title are rejected."""
    k = F.col("p_partkey")
    ks = k.cast("string")
    rec = (F.when(k % 4 == 0, _s('{"id": ', ks, ', "title": "t"}')).when(k % 4 == 1, _s('{"id": "', ks, '", "title": "t"}'))
            .when(k % 4 == 2, _s('{"id": ', ks, '.0, "title": "t"}')).otherwise(_s('{"id": "', ks, '.5", "title": 5}')))
    ok, bad = R.validate_records(table(spark, sf, "part").select("p_partkey", rec.alias("record")), {"id": ("int", True), "title": ("text", True)})
    none = F.lit(None)
    return ok.select("p_partkey", "id", none.cast("string").alias("reason")).unionByName(
        bad.select("p_partkey", none.cast("int").alias("id"), "reason"))



@check("json_unnest_rejects", """SELECT 'f' || p_partkey AS _source_file, 'not a JSON array' AS reason
FROM part WHERE p_partkey % 7 = 0""")
def q_json_unnest_rejects(spark, sf):
    from ..functions.jsonops import unnest_rejects
    k = F.col("p_partkey")
    rec = _s('{"movie_slug": "p-', k.cast("string"), '"}')
    data = (F.when(k % 7 == 0, rec).when(k % 7 == 1, F.lit("null")).when(k % 7 == 2, F.lit("[]"))
             .otherwise(_s("[", rec, "]")))
    env = table(spark, sf, "part").select(_s("f", k.cast("string")).alias("_source_file"), data.alias("data"))
    return unnest_rejects(env).select("_source_file", "reason")

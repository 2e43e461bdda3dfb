"""DuckDB SQL for the silver and gold checks, computed straight from the driver tables.

The stand-in records are rebuilt here as plain relational rows (no JSON), then the
model logic is stated in SQL with the same total orders the Spark code uses.
"""

TS = "strftime(TIMESTAMP '1970-01-01 00:00:00' + to_seconds({e}), '%Y-%m-%d %H:%M:%S.%f')"


def ts(e: str) -> str:
    return TS.format(e=e)


def _mc_general_copy(title: str, shift: int) -> str:
    e = f"(1704067200 + {shift} + p_partkey // 10)"
    return f"""SELECT 'p-' || p_partkey AS movie_slug, 'p-' || p_partkey AS slug, CAST(p_partkey AS INTEGER) AS id,
    {title} || ' ' || p_partkey AS title, CAST(NULL AS VARCHAR) AS description, CAST(NULL AS VARCHAR) AS release_date,
    CASE WHEN p_partkey % 23 <> 0 THEN CAST(1970 + p_size AS INTEGER) END AS premiere_year, p_brand AS rating, CAST(p_size + 60 AS INTEGER) AS duration_minutes,
    (p_partkey % 2 = 0) AS in_theaters, CAST(NULL AS VARCHAR) AS tagline,
    CASE WHEN p_partkey % 5 <> 0 THEN 'tt' || p_partkey END AS imdb_id,
    CASE WHEN p_partkey % 29 = 0 THEN '[]' ELSE '["' || p_type || '"]' END AS genres,
    CASE WHEN p_partkey % 19 <> 0 THEN CAST(p_size * 2 AS INTEGER) END AS critic_score,
    CAST(p_partkey % 50 AS INTEGER) AS critic_review_count, CAST(NULL AS VARCHAR) AS critic_sentiment,
    {e} AS _epoch, 'mc_general/' || {e} || '_' || (p_partkey // 64) || '.json' AS _source_file
  FROM part"""


SRC = {
    "mc_general": f"""{_mc_general_copy('p_name', 0)}
  UNION ALL
  {_mc_general_copy('upper(p_name)', 86400)}""",
    "rt_details": """SELECT CASE WHEN p_partkey % 3 = 0 THEN 'x_' ELSE 'r_' END || p_partkey AS movie_id, p_name || ' ' || p_partkey || ' (2001)' AS title,
    p_brand AS rating, CAST(NULL AS VARCHAR) AS release_date, CAST(p_partkey AS VARCHAR) AS rtid,
    'r_' || p_partkey AS urlid, (1704067200 + p_partkey // 10) AS _epoch,
    'rt_details/' || (1704067200 + p_partkey // 10) || '_' || (p_partkey // 64) || '.json' AS _source_file
  FROM part""",
    "rt_crosswalk": """SELECT 'tt' || p_partkey AS imdb_id,
    CASE WHEN p_partkey % 7 = 0 THEN 'gone_' ELSE 'r_' END || p_partkey AS rt_slug, 'p-' || p_partkey AS mc_slug,
    p_name || ' ' || p_partkey AS title, 1704067200 AS _epoch,
    'rt_crosswalk/1704067200_' || (p_partkey // 64) || '.json' AS _source_file
  FROM part""",
    "rt_score": """SELECT CASE WHEN p_partkey % 3 = 0 THEN 'y_' ELSE 'r_' END || p_partkey AS movie_id, p_brand AS description,
    '{"likedCount":' || (p_partkey % 97) || CASE WHEN p_partkey % 37 = 0 THEN '' ELSE ',"notLikedCount":' || (p_partkey % 13) END || '}' AS audience_all,
    CAST(NULL AS VARCHAR) AS audience_verified,
    '{"score":' || CASE WHEN p_partkey % 31 = 0 THEN '"n/a"' ELSE '"' || (p_size * 2) || '"' END || ',"reviewCount":' || (p_partkey % 50) || '}' AS critics_all,
    CAST(NULL AS VARCHAR) AS critics_top, (1704067200 + p_partkey // 10) AS _epoch,
    'rt_score/' || (1704067200 + p_partkey // 10) || '_' || (p_partkey // 64) || '.json' AS _source_file
  FROM part""",
    "mc_critic_reviews": """SELECT 'p-' || l_partkey AS movie_slug, 'Supplier ' || l_suppkey AS author,
    CASE WHEN l_suppkey % 17 <> 0 THEN 's-' || l_suppkey END AS author_slug, 'Pub ' || (l_suppkey % 10) AS publication_name,
    'pub-' || (l_suppkey % 10) AS publication_slug, 'o' || l_orderkey || ' l' || l_linenumber AS quote,
    CASE WHEN (l_orderkey + l_linenumber) % 11 <> 0 THEN CAST(floor(l_quantity) * 2 AS INTEGER) END AS score, CAST(NULL AS VARCHAR) AS url,
    CASE WHEN l_orderkey % 13 = 0 THEN 'soon' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS review_date, (1704067200 + l_orderkey) AS _epoch,
    'mc_critic_reviews/' || (1704067200 + l_orderkey) || '_0.json' AS _source_file
  FROM lineitem""",
    "rt_critic_reviews": """SELECT 'r_' || (o_orderkey % 2000) AS movie_id, CAST(o_orderkey AS VARCHAR) AS review_id,
    CASE WHEN o_orderkey % 9 <> 0 THEN 'Critic ' || o_custkey END AS critic_name, o_orderstatus AS publication, o_orderpriority AS score,
    'q' || o_orderkey AS quote,
    CASE WHEN o_orderkey % 8 = 0 THEN strftime(o_orderdate, '%b %-d, %Y') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS review_date,
    (1704067200 + o_orderkey) AS _epoch,
    'rt_critic_reviews/' || (1704067200 + o_orderkey) || '_0.json' AS _source_file
  FROM orders""",
    "mc_user_reviews": """SELECT 'p-' || user_id AS movie_slug, CAST(event_id AS VARCHAR) AS review_id,
    'u' || user_id AS author, CAST(NULL AS VARCHAR) AS quote,
    CASE WHEN event_id % 10 <> 0 THEN CAST(least(10, floor(value / 10)) AS INTEGER) END AS score, strftime(ts, '%Y-%m-%d') AS review_date,
    (event_type = 'error') AS spoiler, CAST(event_id % 7 AS INTEGER) AS thumbs_up,
    CAST(event_id % 5 AS INTEGER) AS thumbs_down,
    CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS _epoch,
    'mc_user_reviews/' || CAST(epoch(date_trunc('hour', ts)) AS BIGINT) || '_' || (event_id // 64) || '.json' AS _source_file
  FROM events""",
    "rt_reviews": """SELECT 'r_' || user_id AS movie_id, CAST(event_id AS VARCHAR) AS review_id,
    CAST(NULL AS VARCHAR) AS quote, event_type AS rating, (event_type = 'purchase') AS is_verified,
    (event_id % 4 = 0) AS is_super_reviewer, CAST(NULL AS BOOLEAN) AS has_spoilers,
    CAST(NULL AS BOOLEAN) AS has_profanity, strftime(ts, '%Y-%m-%d') AS created_at,
    'User ' || user_id AS user_display_name, CAST(NULL AS VARCHAR) AS user_account_link,
    CAST(NULL AS VARCHAR) AS user_realm, CAST(user_id AS VARCHAR) AS user_id,
    CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS _epoch,
    'rt_reviews/' || CAST(epoch(date_trunc('hour', ts)) AS BIGINT) || '_' || (event_id // 64) || '.json' AS _source_file
  FROM events""",
}

# (columns in declared order, natural key, keep _source_file)
SILVER = {
    "silver_mc_general": ("movie_slug, slug, id, title, description, release_date, premiere_year, rating, "
                          "duration_minutes, in_theaters, tagline, imdb_id, genres, critic_score, "
                          "critic_review_count, critic_sentiment", "movie_slug", True, "mc_general"),
    "silver_mc_critic_reviews": ("movie_slug, author, author_slug, publication_name, publication_slug, quote, "
                                 "score, url, review_date", "movie_slug, author_slug, review_date", True,
                                 "mc_critic_reviews"),
    "silver_mc_user_reviews": ("movie_slug, review_id, author, quote, score, review_date, spoiler, thumbs_up, "
                               "thumbs_down", "review_id", True, "mc_user_reviews"),
    "silver_rt_critic_reviews": ("movie_id, review_id, critic_name, publication, score, quote, review_date",
                                 "review_id", False, "rt_critic_reviews"),
    "silver_rt_crosswalk": ("imdb_id, rt_slug, mc_slug, title", "rt_slug", False, "rt_crosswalk"),
    "silver_rt_details_base": ("movie_id, title, rating, release_date, rtid, urlid", "movie_id", True,
                               "rt_details"),
    "silver_rt_reviews": ("movie_id, review_id, quote, rating, is_verified, is_super_reviewer, has_spoilers, "
                          "has_profanity, created_at, user_display_name, user_account_link, user_realm, user_id",
                          "review_id", True, "rt_reviews"),
    "silver_rt_score": ("movie_id, description, audience_all, audience_verified, critics_all, critics_top",
                        "movie_id", True, "rt_score"),
}


def silver_cte(name: str) -> str:
    """Silver rows with ``_epoch`` (load second) and ``_source_file`` kept for later ordering."""
    cols, key, _, src = SILVER[name]
    return f"""{name} AS (
  SELECT {cols}, _epoch, _source_file FROM ({SRC[src]}) s
  WHERE {cols.split(',')[0] if name != 'silver_rt_crosswalk' else 'rt_slug'} IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY _epoch DESC, _source_file DESC, {cols}) = 1
)"""


RT_DETAILS_CTE = """silver_rt_details AS (
  SELECT d.movie_id, d.title, d.rating, d.release_date, d.rtid, d.urlid, xw.imdb_id, d._epoch, d._source_file
  FROM silver_rt_details_base d LEFT JOIN silver_rt_crosswalk xw ON xw.rt_slug = d.movie_id
)"""


def silver_ctes(*names: str) -> str:
    need = []
    for n in names:
        if n == "silver_rt_details":
            for m in ("silver_rt_crosswalk", "silver_rt_details_base"):
                if m not in need:
                    need.append(m)
        elif n not in need:
            need.append(n)
    parts = [silver_cte(n) for n in need]
    if "silver_rt_details" in names:
        parts.append(RT_DETAILS_CTE)
    return ",\n".join(parts)


def silver_sql(name: str) -> str:
    if name == "silver_rt_details":
        return f"""WITH {silver_ctes(name)}
SELECT movie_id, title, rating, release_date, rtid, urlid, imdb_id, {ts('_epoch')} AS _loaded_at, _source_file
FROM silver_rt_details"""
    cols, _, keep_file, _ = SILVER[name]
    tail = ", _source_file" if keep_file else ""
    return f"""WITH {silver_ctes(name)}
SELECT {cols}, {ts('_epoch')} AS _loaded_at{tail} FROM {name}"""


# Gold, stated on the driver keys: which movies, critics and reviews there are follows from arithmetic
# on p_partkey, l_suppkey and o_orderkey, without the models' steps. Output names are fixed values.

DAYS = """CAST(row_number() OVER (ORDER BY day) AS BIGINT) AS date_key, CAST(day AS DATE) AS date_day, year(day) AS year, quarter(day) AS quarter,
  month(day) AS month_number, monthname(day) AS month_name, day(day) AS day_of_month, dayofweek(day) AS day_of_week,
  dayname(day) AS day_name, weekofyear(day) AS week_of_year, year(day) || '-Q' || quarter(day) AS year_quarter"""

# A part is listed on one platform, on the other under an id of its own, and the two are one movie
# when both ids are in the crosswalk.
MOVIES = """SELECT CAST(row_number() OVER (ORDER BY title, release_year, movie_natural_key, mc_slug, rt_movie_id) AS BIGINT) AS movie_key, *
FROM (
  SELECT 'p-' || k AS movie_natural_key, 'p-' || k AS mc_slug, CASE WHEN paired THEN other END AS rt_movie_id,
    upper(p_name) || ' ' || k AS title, CASE WHEN k % 23 <> 0 THEN CAST(1970 + p_size AS INTEGER) END AS release_year, p_brand AS rating,
    CAST(p_size + 60 AS INTEGER) AS duration_minutes, CASE WHEN k % 5 <> 0 THEN 'tt' || k END AS imdb_id,
    CASE WHEN k % 29 <> 0 THEN p_type END AS primary_genre, CASE WHEN paired THEN 'r_' || k END AS rt_urlid
  FROM listed
  UNION ALL
  SELECT other, NULL, other, p_name || ' ' || k, NULL, NULL, NULL, CASE WHEN crossed THEN 'tt' || k END, NULL, 'r_' || k
  FROM listed WHERE NOT paired) m"""
LISTED = """SELECT p_partkey AS k, p_name, p_size, p_brand, p_type, CASE WHEN p_partkey % 3 = 0 THEN 'x_' ELSE 'r_' END || p_partkey AS other,
    p_partkey % 3 <> 0 AND p_partkey % 7 <> 0 AS crossed,
    p_partkey % 3 <> 0 AND p_partkey % 7 <> 0 AND p_partkey % 5 <> 0 AS paired FROM part"""

CRITICS = """SELECT CAST(row_number() OVER (ORDER BY author_slug) AS BIGINT) AS critic_key, * FROM (
  SELECT DISTINCT 'mc::s-' || l_suppkey AS author_slug, 'Supplier ' || l_suppkey AS critic_name,
    'Pub ' || (l_suppkey % 10) AS publication_name, 'pub-' || (l_suppkey % 10) AS publication_slug
  FROM lineitem WHERE l_suppkey % 17 <> 0
  UNION ALL
  SELECT 'rt::critic_' || o_custkey, 'Critic ' || o_custkey, arg_max(o_orderstatus, o_orderkey), NULL
  FROM orders WHERE o_orderkey % 9 <> 0 GROUP BY o_custkey) c"""

SCORES = """SELECT CAST(row_number() OVER (ORDER BY movie_key, platform, critic_score, user_score, critic_review_count, user_review_count) AS BIGINT) AS score_key, *
FROM (
  SELECT movie_key, 'metacritic' AS platform, CASE WHEN k % 19 <> 0 THEN CAST(p_size * 2 AS INTEGER) END AS critic_score,
    CAST(round(10 * mean) AS INTEGER) AS user_score, CAST(k % 50 AS INTEGER) AS critic_review_count, CAST(coalesce(n, 0) AS BIGINT) AS user_review_count
  FROM listed JOIN movies ON mc_slug = 'p-' || k
  LEFT JOIN (SELECT user_id, avg(CAST(least(10, floor(value / 10)) AS INTEGER)) AS mean, count(*) AS n
             FROM events WHERE event_id % 10 <> 0 GROUP BY user_id) u ON user_id = k
  UNION ALL
  SELECT movie_key, 'rottentomatoes', CASE WHEN k % 31 <> 0 THEN CAST(p_size * 2 AS INTEGER) END,
    CASE WHEN k % 37 <> 0 AND k % 97 + k % 13 > 0 THEN CAST(round(100.0 * (k % 97) / (k % 97 + k % 13)) AS INTEGER) END,
    CAST(k % 50 AS INTEGER), CASE WHEN k % 37 <> 0 THEN CAST(k % 97 + k % 13 AS BIGINT) END
  FROM listed JOIN movies ON rt_movie_id = other WHERE k % 3 <> 0) f"""

REVIEWS = """SELECT CAST(row_number() OVER (ORDER BY movie_key, critic_key, date_key, platform, score, quote) AS BIGINT) AS critic_review_key, *
FROM (
  SELECT movie_key, critic_key, date_diff('day', DATE '1970-01-01', day) + 1 AS date_key, platform, score, quote FROM (
    SELECT 'metacritic' AS platform, CAST(score AS VARCHAR) AS score, quote, day, 'p-' || l_partkey AS mc, NULL AS rt, 'mc::s-' || s AS slug FROM (
      SELECT l_partkey, CASE WHEN l_suppkey % 17 <> 0 THEN l_suppkey END AS s, CASE WHEN l_orderkey % 13 <> 0 THEN CAST(l_shipdate AS DATE) END AS day,
        'o' || l_orderkey || ' l' || l_linenumber AS quote,
        CASE WHEN (l_orderkey + l_linenumber) % 11 <> 0 THEN CAST(floor(l_quantity) * 2 AS INTEGER) END AS score
      FROM lineitem
      QUALIFY row_number() OVER (PARTITION BY l_partkey, s, day ORDER BY l_orderkey DESC, 'Supplier ' || l_suppkey, quote, score) = 1) last
    WHERE score IS NOT NULL
    UNION ALL
    SELECT 'rottentomatoes', o_orderpriority, 'q' || o_orderkey, CASE WHEN o_orderkey % 8 <> 0 THEN CAST(o_orderdate AS DATE) END, NULL,
      'r_' || (o_orderkey % 2000), 'rt::critic_' || o_custkey
    FROM orders WHERE o_orderkey % 9 <> 0) r
  LEFT JOIN (SELECT movie_key, mc_slug, rt_movie_id FROM movies) m ON CASE WHEN mc IS NULL THEN rt_movie_id = rt ELSE mc_slug = mc END
  LEFT JOIN (SELECT critic_key, author_slug FROM critics) c ON author_slug = slug) f"""

_WITH_MOVIES = f"WITH listed AS ({LISTED}), movies AS ({MOVIES})"

GOLD = {
    "dim_date": f"""WITH days AS (SELECT {DAYS} FROM (SELECT range AS day FROM range(DATE '1970-01-01', DATE '2031-01-01', INTERVAL 1 DAY)) r)
SELECT o_orderkey, days.* REPLACE (CAST(date_day AS VARCHAR) AS date_day) FROM orders LEFT JOIN days ON date_day = CAST(o_orderdate AS DATE)""",
    "dim_movie": f"{_WITH_MOVIES} SELECT * FROM movies",
    "dim_critic": CRITICS,
    "fact_movie_score": f"{_WITH_MOVIES} {SCORES}",
    "fact_critic_review": f"{_WITH_MOVIES}, critics AS ({CRITICS}) {REVIEWS}",
}


VERDICTS = """WITH v(model, column_name, test) AS (VALUES
  ('dim_date', 'date_key', 'unique'), ('dim_date', 'date_key', 'not_null'), ('dim_movie', 'movie_key', 'unique'), ('dim_movie', 'movie_key', 'not_null'),
  ('dim_critic', 'critic_key', 'unique'), ('dim_critic', 'critic_key', 'not_null'), ('fact_movie_score', 'score_key', 'unique'),
  ('fact_movie_score', 'score_key', 'not_null'), ('fact_movie_score', 'movie_key', 'not_null'), ('fact_movie_score', 'movie_key', 'relationships'),
  ('fact_movie_score', 'platform', 'accepted_values'), ('fact_critic_review', 'critic_review_key', 'unique'),
  ('fact_critic_review', 'critic_review_key', 'not_null'), ('fact_critic_review', 'movie_key', 'relationships'),
  ('fact_critic_review', 'critic_key', 'relationships'), ('fact_critic_review', 'date_key', 'relationships'))
SELECT model, column_name, test, CAST(0 AS BIGINT) AS failures, 'pass' AS status FROM v
UNION ALL SELECT 'dim_movie', '*', 'row_count_between', CAST(CASE WHEN count(*) BETWEEN 1 AND 1000000 THEN 0 ELSE 1 END AS BIGINT),
  CASE WHEN count(*) BETWEEN 1 AND 1000000 THEN 'pass' ELSE 'fail' END FROM part
UNION ALL SELECT unnest(['mc_general', 'rt_details', 'rt_crosswalk', 'rt_score', 'mc_critic_reviews', 'rt_critic_reviews', 'mc_user_reviews',
  'rt_reviews']), 'data', 'json_array', 0, 'pass'"""

_AGE = "(epoch_us(TIMESTAMP '2024-01-03 12:00:00') - max(CAST(_epoch AS BIGINT)) * 1000000) / 3600000000.0"
FRESHNESS = " UNION ALL ".join(f"""SELECT '{name}' AS source, {ts('max(_epoch)')} AS max_loaded_at, {_AGE} AS age_hours,
  CASE WHEN {_AGE} > 48 THEN 'error' WHEN {_AGE} > 24 THEN 'warn' ELSE 'pass' END AS status FROM ({sql}) s""" for name, sql in SRC.items())


def model_sql() -> dict[str, str]:
    out = {n: silver_sql(n) for n in ["silver_mc_general", "silver_mc_critic_reviews", "silver_mc_user_reviews",
                                       "silver_rt_critic_reviews", "silver_rt_crosswalk", "silver_rt_details",
                                       "silver_rt_reviews", "silver_rt_score"]}
    out.update(GOLD)
    out.update({"gold_tests": VERDICTS, "sources_freshness": FRESHNESS})
    return out

"""Hand-made golden cases for the silver and gold models (FIXTURES 2)."""

import datetime as dt
import json

import pytest

from filmmart.plans import gold as G
from filmmart.plans import silver as S
from filmmart.schemas import BRONZE_SCHEMA, BRONZE_TABLES

T0 = dt.datetime(2024, 1, 1)


def envelope(spark, files):
    """files: list of (seconds after T0, file name, list of records or raw text)."""
    rows = [(T0 + dt.timedelta(seconds=s), f, d if isinstance(d, str) else json.dumps(d)) for s, f, d in files]
    return spark.createDataFrame(rows, BRONZE_SCHEMA)


def bronze(spark, **tables):
    out = {t: spark.createDataFrame([], BRONZE_SCHEMA) for t in BRONZE_TABLES}
    out.update({k: envelope(spark, v) for k, v in tables.items()})
    return out


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_latest_load_wins_and_ties_are_total(spark):
    b = bronze(spark, mc_general=[
        (0, "a.json", [{"movie_slug": "m1", "title": "Old"}, {"movie_slug": "m2", "title": "B"}]),
        (10, "b.json", [{"movie_slug": "m1", "title": "New"}]),
        (10, "c.json", [{"movie_slug": "m2", "title": "Z"}]),
        (10, "c2.json", [{"movie_slug": "m2", "title": "A"}]),
    ])
    s = S.build_silver(b["mc_general"], S.SPECS["silver_mc_general"])
    # m2: same _loaded_at in two files -> the newer file (names carry the time of the crawl) wins
    assert rows(s, "movie_slug", "title") == [("m1", "New"), ("m2", "A")]


def test_null_and_empty_review_ids_collapse(spark):
    b = bronze(spark, rt_reviews=[(0, "r.json", [{"movie_id": "x", "quote": "a"}, {"movie_id": "x", "quote": "b"}])],
               mc_user_reviews=[(0, "u.json", [{"movie_slug": "m", "review_id": "", "score": 5},
                                               {"movie_slug": "m", "review_id": "", "score": 7}])])
    assert S.build_silver(b["rt_reviews"], S.SPECS["silver_rt_reviews"]).count() == 1
    assert S.build_silver(b["mc_user_reviews"], S.SPECS["silver_mc_user_reviews"]).count() == 1


@pytest.fixture(scope="module")
def mart(spark):
    b = bronze(
        spark,
        mc_general=[(0, "g.json", [
            {"movie_slug": "both", "title": "Both MC", "premiere_year": "2001", "imdb_id": "tt1", "genres": ["Drama", "X"],
             "critic_score": 80},
            {"movie_slug": "mc-only", "title": "Solo", "imdb_id": None, "genres": []},
            {"movie_slug": "dup-a", "title": "Dup A", "imdb_id": "tt9"},
        ]), (5, "g2.json", [{"movie_slug": "dup-b", "title": "Dup B", "imdb_id": "tt9"}])],
        rt_details=[(0, "d.json", [{"movie_id": "rt_both", "title": "Both RT (2001)"},
                                   {"movie_id": "rt_only", "title": "Magic Hour (2025)"},
                                   {"movie_id": "rt_null", "title": "Blade Runner 2049"}])],
        rt_crosswalk=[(0, "x.json", [{"imdb_id": "tt1", "rt_slug": "rt_both"}, {"imdb_id": "tt5", "rt_slug": "rt_only"}])],
        rt_score=[(0, "s.json", [{"movie_id": "rt_both", "audienceAll": {"likedCount": 0, "notLikedCount": 0},
                                  "criticsAll": {"score": 90, "reviewCount": 3}},
                                 {"movie_id": "rt_only", "audienceAll": {"likedCount": 1},
                                  "criticsAll": {"score": "n/a"}}])],
        mc_user_reviews=[(0, "u.json", [{"movie_slug": "both", "review_id": "1", "score": 8},
                                        {"movie_slug": "both", "review_id": "2", "score": 7},
                                        {"movie_slug": "both", "review_id": "3"}])],
        mc_critic_reviews=[(0, "c.json", [
            {"movie_slug": "both", "author_slug": "jane-doe", "author": "Jane", "publication_name": "P1", "score": 85,
             "date": "2024-03-05", "quote": "q1"},
            {"movie_slug": "dup-a", "author_slug": "jane-doe", "author": "Jane", "publication_name": "P2", "score": 70,
             "date": "1969-12-31", "quote": "q2"},
            {"movie_slug": "both", "author_slug": "nobody", "score": None, "date": "2024-03-05"},
        ])],
        rt_critic_reviews=[(0, "rc.json", [
            {"movie_id": "rt_both", "review_id": "r1", "critic_name": "Jane Doe", "publication": "Paper",
             "score": "3.5/5", "review_date": "Jan 5, 2024", "quote": "x"},
            {"movie_id": "rt_only", "review_id": "r2", "critic_name": "Jane Doe", "publication": "Zine",
             "score": "B+", "review_date": "2024-01-05", "quote": "y"},
            {"movie_id": "rt_only", "review_id": "r3", "critic_name": None, "score": "fresh"},
        ])],
    )
    s = S.build_all_silver(b)
    return s, G.build_gold(spark, s)


def test_dim_movie_matching(mart):
    _, g = mart
    got = rows(g["dim_movie"], "movie_natural_key", "mc_slug", "rt_movie_id", "title", "imdb_id", "primary_genre")
    assert got == [
        ("both", "both", "rt_both", "Both MC", "tt1", "Drama"),
        ("dup-b", "dup-b", None, "Dup B", "tt9", None),       # latest of the two MC rows with tt9
        ("mc-only", "mc-only", None, "Solo", None, None),
        ("rt_null", None, "rt_null", "Blade Runner 2049", None, None),
        ("rt_only", None, "rt_only", "Magic Hour", "tt5", None),
    ]
    keys = sorted(r["movie_key"] for r in g["dim_movie"].collect())
    assert keys == [1, 2, 3, 4, 5]


def test_dim_critic(mart):
    _, g = mart
    assert rows(g["dim_critic"], "critic_key", "author_slug", "publication_name") == [
        (1, "mc::jane-doe", "P1"), (2, "mc::nobody", None),
        (3, "rt::jane_doe", "Paper")]   # same load: the total order picks movie rt_both's row


def test_fact_movie_score(mart):
    _, g = mart
    dm = {r["movie_natural_key"]: r["movie_key"] for r in g["dim_movie"].collect()}
    got = {(r["movie_key"], r["platform"]): (r["critic_score"], r["user_score"], r["critic_review_count"],
                                             r["user_review_count"]) for r in g["fact_movie_score"].collect()}
    assert got[(dm["both"], "metacritic")] == (80, 75, None, 2)
    assert got[(dm["mc-only"], "metacritic")] == (None, None, None, 0)
    assert got[(dm["both"], "rottentomatoes")] == (90, None, 3, 0)        # 0 + 0 votes: no ratio
    assert got[(dm["rt_only"], "rottentomatoes")] == (None, None, None, None)  # a count missing: NULL total


def test_fact_critic_review(mart):
    _, g = mart
    dm = {r["movie_natural_key"]: r["movie_key"] for r in g["dim_movie"].collect()}
    f = g["fact_critic_review"].collect()
    by_quote = {r["quote"]: r for r in f}
    assert set(by_quote) == {"q1", "q2", "x", "y"}            # MC needs a score, RT needs a name
    assert by_quote["q1"]["movie_key"] == dm["both"] and by_quote["q1"]["date_key"] is not None
    assert by_quote["q2"]["movie_key"] is None                # dup-a lost to dup-b on tt9
    assert by_quote["q2"]["date_key"] is None                 # before the spine
    assert by_quote["x"]["date_key"] is None and by_quote["x"]["score"] == "3.5/5"
    assert by_quote["y"]["movie_key"] == dm["rt_only"] and by_quote["y"]["score"] == "B+"
    assert by_quote["q1"]["score"] == "85"
    assert sorted(r["critic_review_key"] for r in f) == [1, 2, 3, 4]


def test_dim_date(spark):
    d = G.dim_date(spark)
    assert d.count() == 22280
    r = d.filter("date_day = date'2021-01-01'").first()
    assert (r["day_of_week"], r["day_name"], r["month_name"], r["week_of_year"], r["year_quarter"]) == \
        (5, "Friday", "January", 53, "2021-Q1")
    first = d.filter("date_key = 1").first()
    assert first["date_day"] == dt.date(1970, 1, 1) and first["day_of_week"] == 4


def test_gold_tests_pass(mart):
    from filmmart.operators.quality import gold_tests
    _, g = mart
    bad = gold_tests(g).filter("status <> 'pass'").collect()
    assert bad == []

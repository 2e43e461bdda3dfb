"""Work planning (C) and response flattening (B) on small hand-made inputs."""

import json

import pytest
from pyspark.sql import functions as F

from filmmart.operators import planning as P
from filmmart.sources import responses as R


@pytest.mark.parametrize("n,batches,size", [(0, 1, 0), (1, 1, 1), (49, 1, 49), (50, 1, 50), (51, 2, 50),
                                            (60000, 1000, 60)])
def test_batch_commands(spark, n, batches, size):
    work = spark.range(n).select(F.col("id").alias("k"))
    out = P.batch_commands(work, [F.col("k")], F.concat(F.lit("run "), F.col("k").cast("string")), noop="echo none")
    rows = out.orderBy("batch").collect()
    assert len(rows) == batches
    if n == 0:
        assert rows[0]["commands"] == "echo none"
        return
    assert rows[0]["n_commands"] == size
    assert rows[0]["commands"].split("; ")[:2] == ["run 0", "run 1"][:min(2, n)]
    assert sum(r["n_commands"] for r in rows) == n


def test_discovery_rejects(spark):
    feed = spark.createDataFrame([("a", '[{"slug": "x"}]'), ("b", '[{"slug": "y"')], "_source_file string, value string")
    assert [r["_source_file"] for r in P.discovery_rejects(feed).collect()] == ["b"]
    assert [r["slug"] for r in P.discovered_slugs(feed).collect()] == ["x"]


def test_browse_out_of_theatres_is_no_filter(spark):
    df = spark.createDataFrame([("a", 1, True), ("b", 2, False)], "slug string, critic_score int, in_theaters boolean")
    assert P.browse(df, "critic", "slug", in_theaters=False).count() == 2
    assert [r["slug"] for r in P.browse(df, "critic", "slug", in_theaters=True).collect()] == ["a"]


def test_ordered_distinct(spark):
    p1 = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3)], "slug string, pos long")
    p2 = spark.createDataFrame([("c", 1), ("a", 2)], "slug string, pos long")
    got = [r["slug"] for r in P.ordered_distinct([p1, p2], "slug").orderBy("position").collect()]
    assert got == ["b", "a", "c"]


def test_flatten_one_item(spark):
    movie = {"data": {"item": {"id": 77, "slug": "night-train", "title": "Night Train", "genres": [{"name": "Noir"}, {}]}}}
    reviews = {"data": {"items": [{"author": "A. Writer", "score": "61", "quote": None}, {"author": "B", "score": 9}]}}
    user = {"data": {"items": [{"score": 3, "id": None, "spoiler": None}, {"score": 4}]}}
    df = spark.createDataFrame([("night-train", 1, json.dumps(movie))], "entity_id string, page_no int, body string")
    m = R.flatten_movie(df).first()
    assert (m["id"], m["slug"], m["title"], m["genres"], m["critic_score"]) == (77, "night-train", "Night Train", ["Noir"], None)
    c = R.flatten_critic_reviews(df.withColumn("body", F.lit(json.dumps(reviews)))).orderBy("item_pos").collect()
    assert [(r["author"], r["score"], r["quote"]) for r in c] == [("A. Writer", 61, None), ("B", 9, "")]
    u = df.withColumn("body", F.lit(json.dumps(user)))
    got = R.flatten_user_reviews(u).orderBy("item_pos").collect()
    assert [(r["review_id"], r["spoiler"]) for r in got] == [(None, None), ("", False)]
    assert [r["reason"] for r in R.review_rejects(u).collect()] == ["id: null; spoiler: null"]


def test_key_fallback(spark):
    recs = ['{"originalScore": "3/4", "scoreSentiment": "POSITIVE"}', '{"originalScore": null, "scoreSentiment": "P"}',
            '{"scoreSentiment": "NEGATIVE"}']
    df = spark.createDataFrame([(r,) for r in recs], "r string")
    got = [x["s"] for x in df.select(R.key_fallback("r", "originalScore", "scoreSentiment").alias("s")).collect()]
    assert got == ["3/4", None, "NEGATIVE"]


def test_page_extraction(spark):
    html = ('<html><script id="media-scorecard-json" type="application/json">{"overlay": {"audienceAll": {"a": 1},'
            ' "criticsAll": {"c": 2}, "audienceVerified": null, "criticsTop": null}, "description": "D", "criticReviewHref": "/m/x/reviews/abc"}</script>'
            '<script id="mps-page-integration">\nwindow.mpscall = {"title": "T", "cag[rating]": "PG",\n'
            '"field[rtid]": 7};\nother = {"x": 1};</script></html>')
    df = spark.createDataFrame([("x", html)], "movie_id string, html string")
    s = R.page_scorecard(df).first()
    assert (s["audienceAll"], s["criticsAll"], s["audienceVerified"], s["description"], s["movie_code"]) == \
        ('{"a":1}', '{"c":2}', None, "D", "abc")
    blocked = df.withColumn("html", F.lit("<html>captcha</html>"))
    assert R.page_scorecard(blocked).count() == R.page_details(blocked).count() == 0
    assert {r["reason"] for r in R.page_rejects(blocked).collect()} == {"no embedded data"} and R.page_rejects(df).count() == 0
    d = R.page_details(df).first()
    assert (d["title"], d["rating"], d["rtid"], d["urlid"]) == ("T", "PG", "7", None)


def test_validate_records(spark):
    df = spark.createDataFrame([('{"id": "123", "title": "A"}',), ('{"title": "B"}',), ('{"id": "x", "title": "C"}',)],
                               "record string")
    ok, bad = R.validate_records(df, {"id": ("int", True), "title": ("text", True)})
    assert [(r["id"], r["title"]) for r in ok.collect()] == [(123, "A")]
    assert sorted(r["reason"] for r in bad.collect()) == ["id: missing", "id: not int"]
    recs = ['{"id": 85.0, "title": "A"}', '{"id": "85.5", "title": "A"}', '{"id": 85.5, "title": "A"}', '{"id": 1, "title": 5}',
            '{"id": "85.0", "title": "A"}', '{"id": null, "title": "A"}']
    ok, bad = R.validate_records(spark.createDataFrame([(r,) for r in recs], "record string"), {"id": ("int", True), "title": ("text", True)})
    assert [r["id"] for r in ok.collect()] == [85]
    assert sorted(r["reason"] for r in bad.collect()) == ["id: missing", "id: not int", "id: not int", "id: not int", "title: not text"]


def test_work_batches_resume_and_force(spark):
    slugs = spark.createDataFrame([("b", 1), ("a", 2), ("c", 3)], "slug string, position long")
    ledger = spark.createDataFrame([("a", "details"), ("c", "score")], "slug string, action string")
    one = P.work_batches(slugs, ledger, "details", "run {slug} {action}").collect()
    assert [r["commands"] for r in one] == ["run b details; run c details"]
    forced = P.work_batches(slugs, ledger, "details", "run {slug}", force=True).collect()
    assert [r["commands"] for r in forced] == ["run b; run a; run c"]
    empty = P.work_batches(slugs, slugs.select("slug", F.lit("x").alias("action")), "x", "run {slug}").collect()
    assert [r["commands"] for r in empty] == ["echo nothing to do"]


def test_mark_done_rules(spark):
    """RT: done only if the run finished and gave items; MC: done once finished, even with 0 items."""
    res = spark.createDataFrame([("m1", "details", "i1", True), ("m1", "details", "i2", True),
                                 ("m2", "details", None, True), ("m3", "details", "i3", False)],
                                "movie string, action string, item string, finished boolean")
    rt = {(r["movie"], r["items"]) for r in P.mark_done(res, ["movie", "action"], True, "finished").collect()}
    mc = {(r["movie"], r["items"]) for r in P.mark_done(res, ["movie", "action"], False, "finished").collect()}
    assert rt == {("m1", 2)}
    assert mc == {("m1", 2), ("m2", 0)}

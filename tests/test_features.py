"""Captured responses as one job, keyed containers, observed tests, split joins, the entry without the optional part."""

import json
import os
import random
import subprocess
import sys

from pyspark.sql import functions as F

from filmmart.operators import quality as Q
from filmmart.operators.joins import full_outer_on_nullable, full_outer_split
from filmmart.plans import capture as C
from filmmart.session import child_dirs, scratch_path
from filmmart.sources import containers as K
from filmmart.sources import feeds as A

PAGE = ('<html><script id="media-scorecard-json">{"overlay": {"audienceAll": {"score": "9"}, "audienceVerified": null, "criticsAll": {}, "criticsTop": null}, '
        '"description": "d", "criticReviewHref": "/m/x/code"}</script><script id="mps-page-integration">window.mpscall = {"title": "T", "cag[rating]": "PG"};</script>')


def test_captures_of_every_kind(spark):
    rows = [
        ("mc", "general", "m1", 1, '{"data": {"item": {"id": 7, "title": "a\\u0001b"}}}'), ("mc", "general", "m2", 1, "<html>"),
        ("mc", "critic_reviews", "m1", 1, '{"data": {"items": [{"quote": "q"}, {"quote": null, "score": 5}, {"score": "80"}]}}'),
        ("mc", "critic_reviews", "m1", 2, '{"data": {"items": []}}'), ("mc", "critic_reviews", "m1", 3, '{"data": {"items": [{"quote": "late"}]}}'),
        ("mc", "user_reviews", "m1", 1, '{"data": {"items": [{"id": "u1", "spoiler": "yes"}, {"id": null}]}}'),
        ("rt", "score", "r1", 0, PAGE), ("rt", "score", "r2", 0, "<html>blocked"), ("rt", "details", "r1", 0, PAGE), ("rt", "details", "r2", 0, None),
        ("rt", "reviews", "r1", 1, '{"reviews": [{"ratingId": "x", "user": {"realm": "RT"}}, {"ratingId": "y"}]}'),
        ("rt", "critic_reviews", "r1", 1, '{"reviews": [{"reviewId": "c", "scoreSentiment": "P"}]}'), ("rt", "critic_reviews", "r1", 2, "{}"),
        ("rt", "other", "r1", 1, "{}"), (None, None, None, None, None)]
    captured = spark.createDataFrame(rows, C.CAPTURED_DDL)
    root = scratch_path(spark, "t-capture")
    globs = C.write_feeds(captured, f"{root}/feeds", f"{root}/rejects", max_pages=2)
    read = {}
    for name, glob in globs.items():
        A.load_batch(spark, glob, f"{root}/bronze/{name}", json_lines=True)
        read[name] = [r for d in A.read_bronze(spark, f"{root}/bronze/{name}").collect() for r in json.loads(d["data"])]
    assert [(r["movie_slug"], r["id"], r["title"]) for r in read["mc_general"]] == [("m1", 7, "a b")]
    assert [(r["quote"], r.get("score")) for r in read["mc_critic_reviews"]] == [("q", None), ("", 80)]  # page 3 is beyond the cap
    assert [(r["review_id"], r["spoiler"]) for r in read["mc_user_reviews"]] == [("u1", True)]
    assert read["rt_score"][0]["movie_id"] == "r1" and json.loads(read["rt_score"][0]["audienceAll"]) == {"score": "9"}
    assert read["rt_details"] == [{"movie_id": "r1", "title": "T", "rating": "PG"}]
    assert {r["reviewId"] for r in read["rt_reviews"]} == {"x", "y"} and read["rt_critic_reviews"][0]["score"] == "P"
    bad = {(r["platform"], r["action"], r["entity_id"], r["reason"]) for r in spark.read.parquet(f"{root}/rejects").collect()}
    assert bad == {("mc", "general", "m2", "no $.data.item"), ("mc", "critic_reviews", "m1", "quote: null"), ("mc", "user_reviews", "m1", "id: null"),
                   ("rt", "score", "r2", "no embedded data"), ("rt", "details", "r2", "no embedded data"), ("rt", "critic_reviews", "r1", "no $.reviews"),
                   ("rt", "other", "r1", "unknown kind of capture"), (None, None, None, "unknown kind of capture")}


def test_containers_replace_keys_whole(spark):
    path = scratch_path(spark, "t-containers")
    df = spark.createDataFrame([("d", f"m{i % 50}", i) for i in range(500)], "action string, movie string, v int")
    K.container_write(df, path, buckets=4)
    K.container_write(df.filter("movie = 'm7'").limit(2).withColumn("v", F.lit(-1)), path, buckets=4)
    K.container_write(df.filter("false"), path, buckets=4)
    rows = sorted(tuple(r) for r in K.container_read(spark, path).select("movie", "v").collect())
    assert rows == sorted([(f"m{i % 50}", i) for i in range(500) if i % 50 != 7] + [("m7", -1)] * 2)
    got = K.container_get(spark, path, {"action": "d", "movie": "m7"}, buckets=4)
    assert sorted(tuple(r) for r in got.collect()) == [("d", "m7", -1)] * 2 and len(got.inputFiles()) == 1
    assert K.container_get(spark, path, {"action": "d", "movie": "none"}, buckets=4).count() == 0
    assert len(child_dirs(spark, f"{path}/data", "_bucket=")) == 4
    index = spark.read.parquet(f"{path}/index")
    assert index.count() == 50 and index.agg(F.sum("n_rows")).first()[0] == 492


def test_observed_tests_equal_the_scans(spark):
    key = lambda r: (r["model"], r["column_name"], r["test"], r["failures"], r["status"])
    for broken in (False, True):
        n = 40_000  # more than one bitmap
        odd = F.lit(broken)
        ids = spark.range(1, n + 1)
        g = {"dim_date": ids.select(F.col("id").alias("date_key")), "dim_movie": ids.select(F.when(~odd | (F.col("id") != 9), F.col("id")).alias("movie_key")),
             "dim_critic": ids.select(F.when(odd & (F.col("id") % 3 == 0), F.lit(3)).otherwise(F.col("id")).alias("critic_key")),
             "fact_movie_score": ids.select(F.col("id").alias("score_key"), F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(5).alias("movie_key"),
                                            F.when(odd & (F.col("id") < 4), F.lit("x")).otherwise("metacritic").alias("platform")),
             "fact_critic_review": ids.select(F.col("id").alias("critic_review_key"), F.when(F.col("id") % 5 != 0, F.col("id")).alias("movie_key"),
                                              F.when(odd, F.col("id") + 2).otherwise(F.col("id")).alias("critic_key"),
                                              F.when(odd & (F.col("id") == 1), F.lit(-4)).otherwise(F.col("id")).alias("date_key"))}
        root, tables, noted = scratch_path(spark, "t-observed"), {}, {}
        for name, df in g.items():
            tables[name], noted[name] = A.rebuild_table(df, f"{root}/{name}", Q.observed(name))
        got = Q.gold_tests_from(tables, noted, lambda df, name: A.rebuild_table(df, f"{root}/{name}"), (1, n))
        want = sorted(map(key, Q.gold_tests(tables, (1, n)).collect()))
        assert sorted(map(key, got.collect())) == want
        assert any(w[4] == "fail" for w in want) == broken


def test_split_join_equals_the_plain_one(spark):
    rng = random.Random(8)
    left = spark.createDataFrame([(i, rng.choice([None, 1, 1, 1, rng.randrange(40)])) for i in range(300)], "i int, a int")
    right = spark.createDataFrame([(j, rng.choice([None, 1, rng.randrange(60)])) for j in range(80)], "j int, b int")
    key = lambda r: str(tuple(r))
    assert sorted(map(key, full_outer_split(left, right, "a", "b").collect())) == sorted(map(key, full_outer_on_nullable(left, right, "a", "b").collect()))
    hot = spark.range(0, 200_000, 1, 12).select("id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    dims = spark.range(0, 200_000, 2).select(F.col("id").alias("d"), F.sha2(F.concat(F.col("id").cast("string"), F.lit("y")), 256).alias("more"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = full_outer_split(hot, dims, "k", "d")
        df.write.format("noop").mode("overwrite").save()
        df.count()
        sizes = [r["n"] for r in df.select("id", "pad", "more").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max("pad"), F.max("more")).collect()]
        assert df.count() == 200_000 + 100_000 - (hot.join(dims, F.col("k") == F.col("d"), "left_semi").select("k").distinct().count())
        assert max(sizes) < 200_000 / 3  # the hot key's rows don't meet
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_entry_without_a_library_of_the_optional_part():
    """Where a library that only the training-data operators need is missing, all other queries stay."""
    code = ("import sys; sys.modules['xxhash'] = None; sys.path.insert(0, '.'); import warnings; warnings.simplefilter('ignore'); "
            "import __spark_entry__ as e; q = e.queries(); print(len(q) > 80, 'pipeline' in q, 'fact_critic_review' in q)")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout
    assert out.split()[-3:] == ["True", "False", "True"]


def test_title_index_reads_the_postings_it_names(spark):
    from filmmart.operators import title_index as T
    from filmmart.operators.planning import title_search
    rng = random.Random(2)
    titles = ["".join(rng.choices("abé I", k=rng.randrange(9))) for _ in range(200)] + [None, "", "a", "İx", "100%_a"]
    cat = spark.createDataFrame(list(enumerate(titles)), "i int, title string")
    path = scratch_path(spark, "t-titles")
    T.build_title_index(cat, path, folders=4)
    for q in ["a", "ab", "abé", "ab a", "É", "", "zzz", "i", "%_", "b abb"]:
        assert [r["i"] for r in T.search_titles(spark, path, q, "i", folders=4).collect()] == [r["i"] for r in title_search(cat, q, "i").collect()]
    read = T.postings_of(spark, path, ["abé"], 4)
    assert "PartitionFilters: [" in read._jdf.queryExecution().toString() and {r["gram"] for r in read.collect()} == {"abé"}


def test_pages_read_few_files(spark):
    from filmmart.operators import paging as P
    cat = spark.createDataFrame([(i, i % 50 if i % 7 else None) for i in range(2000)], "slug int, critic_score int")
    path = scratch_path(spark, "t-pages")
    P.write_sorted(cat, "critic", "slug", path, partitions=8)
    from filmmart.operators.planning import browse
    for offset in (0, 777, 1990, 5000):
        page = P.read_page(spark, path, offset, 15)
        assert [r["slug"] for r in page.collect()] == [r["slug"] for r in browse(cat, "critic", "slug", offset=offset, max_items=15).collect()]
        assert offset > 2000 or len(page.inputFiles()) <= 2


def test_feed_table_function(spark):
    from filmmart.functions.feed_table import register
    register(spark)
    spark.createDataFrame([("f", '[{"a": 1, "b": {"c": [1, "é"]}}, 5, {"b": null}]'), ("g", "null"), ("h", None), ("o", '{"a": 1}')],
                          "_source_file string, data string").createOrReplaceTempView("t_feed")
    got = spark.sql("SELECT * FROM feed(TABLE(t_feed), 'a', 'b.c', 'b') LIMIT 10")
    assert got.columns == ["_source_file", "a", "b_c", "b"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [("f", "1", '[1,"é"]', '{"c":[1,"é"]}'), ("f", None, None, None), ("f", None, None, None)], key=str)

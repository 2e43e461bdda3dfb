"""Feeds of many small files: listed, read and written by tasks, with the results of Spark's own sources and writers."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from filmmart.session import local_path, path_exists, scratch_path
from filmmart.sources import feeds as A
from filmmart.sources import small_files as T
from filmmart.streaming import feed_stream as S

ODD = ["plain", "a b", "50%", "x=1", "a/b", "q?", "st*r", "[k]", "é:ü", "{c}", "t\tt", "", None, "a#b"]


def _put(path, data):
    path = local_path(path)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode())


def _keyed(spark, n=2):
    rows = [(a, k, i) for i, k in enumerate(ODD) for a in ("x", None)] * n
    return spark.createDataFrame(rows, "action string, movie string, v int")


def test_files_and_versions_as_spark_lists_them(spark):
    root = scratch_path(spark, "t-small")
    for name in ("k=1/a.txt", "k=2/b c.txt", "k=3/.hidden.txt", "k=4/_side.txt", "k=5/é%41#.txt", "k=6/no.csv", "m=1/z.txt"):
        _put(f"{root}/{name}", name)
    _put(f"{root}/k=7/empty.txt", b"")
    _put(f"{root}/k=8/bad.txt", b"\xff\xfe[1]")
    _put(f"{root}/k=9/packed.txt.gz", gzip.compress(b"[2]"))
    for pattern in ("k=*/*.txt*", "k=[1-2]/*", "{k,m}=1/?.txt", "k=2", "k=9/packed.txt.gz", "k=[^1]/*.txt"):
        raw = spark.read.text(f"{root}/{pattern}", wholetext=True)
        want = raw.select(F.col("_metadata.file_path").alias("_source_file"), F.make_valid_utf8("value").alias("value"), *A.file_version())
        got = A.read_feed(spark, f"{root}/{pattern}")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []
        assert not got.inputFiles()  # the driver has no list of files
        listed = A.list_feed(spark, f"{root}/{pattern}")
        assert sorted(map(tuple, listed.collect())) == sorted(map(tuple, want.drop("value").collect())) and not listed.inputFiles()
    assert A.read_feed(spark, f"{root}/none=*/*.txt").count() == 0 and A.read_feed(spark, f"{root}/none/x/*.txt").count() == 0


def test_keyed_feed_equals_the_partitioned_writer(spark):
    root = scratch_path(spark, "t-keyed-small")
    df, ddl = _keyed(spark), "v int, action string, movie string"
    df.write.partitionBy("action", "movie").json(f"{root}/spark")
    A.keyed_feed_write(df, f"{root}/own")
    again = df.filter("movie in ('a b', 'a/b') or movie is null").withColumn("v", F.col("v") + 100).limit(7)
    again = spark.createDataFrame(again.collect(), again.schema)
    again.write.partitionBy("action", "movie").mode("overwrite").option("partitionOverwriteMode", "dynamic").json(f"{root}/spark")
    A.keyed_feed_write(again, f"{root}/own")
    A.keyed_feed_write(df.filter("false"), f"{root}/own")
    assert not path_exists(spark, f"{root}/own/_SUCCESS")  # no job moves a folder per key
    rows = lambda d: sorted(map(str, d.select("action", "movie", "v").collect()))
    want = rows(spark.read.schema(ddl).json(f"{root}/spark"))
    own = A.read_keyed_feed(spark, f"{root}/own", ddl)
    assert rows(own) == rows(A.read_keyed_feed(spark, f"{root}/spark", ddl)) == rows(spark.read.schema(ddl).json(f"{root}/own")) == want
    assert own.columns == ["v", "action", "movie"] and not own.inputFiles()
    folders = lambda at: sorted(os.path.relpath(d, at) for d, _, names in os.walk(at) if any(n.endswith(".json") for n in names))
    assert folders(local_path(f"{root}/own")) == folders(local_path(f"{root}/spark"))


def test_a_hot_key_has_several_files(spark):
    path = scratch_path(spark, "t-hot-small")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        A.keyed_feed_write(spark.range(0, 20_000, 1, 4).select(F.lit("a").alias("action"), F.lit("m").alias("movie"), "id", F.sha2(F.col("id").cast("string"), 256).alias("t")), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len([n for n in os.listdir(local_path(f"{path}/action=a/movie=m")) if n.endswith(".json") and n[0] != "."]) > 1
    assert A.read_keyed_feed(spark, path, "id long, t string, action string, movie string").agg(F.count_distinct("id")).first()[0] == 20_000


def test_loads_keep_names_off_the_driver(spark, monkeypatch):
    def never(*a, **k):
        raise AssertionError("file names on the driver")
    monkeypatch.setattr(A, "new_files", never)
    monkeypatch.setattr(S, "literal_path", never)
    root = scratch_path(spark, "t-load-small")
    for i in range(60):
        _put(f"{root}/feed/k={i}/f %.json", f"[{i}]" if i % 6 else "[1] x")
    load = lambda: A.load_batch(spark, f"{root}/feed/k=*/*.json", f"{root}/bronze", f"{root}/rejects")
    stream = lambda: S.load_stream(spark, f"{root}/feed", f"{root}/sb", f"{root}/sr", f"{root}/ck")
    for run, good, bad in ((load, "bronze", "rejects"), (stream, "sb", "sr")):
        run()
        run()
        assert A.read_bronze(spark, f"{root}/{good}").count() == 50
        assert A.read_rejects(spark, f"{root}/{bad}").count() == (20 if run is load else 10)  # a load offers rejected files again
    _put(f"{root}/feed/k=0/f %.json", "[70]")
    _put(f"{root}/feed/k=1/f %.json", "[1, 71]")
    load()
    stream()
    for good in ("bronze", "sb"):
        want = sorted([f"[{i}]" for i in range(60) if i % 6] + ["[70]", "[1,71]"])
        assert sorted(r["data"] for r in A.read_bronze(spark, f"{root}/{good}").collect()) == want
    S.replay_rejects(spark, f"{root}/feed/k=*/*.json", f"{root}/sr", f"{root}/replayed", "r1")
    assert A.read_bronze(spark, f"{root}/replayed").count() == 1


def test_a_file_gone_since_it_was_listed_has_no_row(spark):
    root = scratch_path(spark, "t-gone")
    for i in range(3):
        _put(f"{root}/{i}.json", "[1]")
    files = T.kept_list(A.list_feed(spark, f"{root}/*.json"))
    os.remove(local_path(f"{root}/1.json"))
    assert A.read_listed(files).count() == 2


@pytest.mark.parametrize("schema", [None, "a long, b string"])
def test_inferred_json_of_many_files(spark, schema, monkeypatch):
    root = scratch_path(spark, "t-infer")
    docs = [json.dumps([{"a": i, "b": "é"}, {"a": i}], indent=1, ensure_ascii=False) for i in range(5)]
    for i, d in enumerate(docs):
        _put(f"{root}/k={i}/d.json", d.encode("utf-16") if i == 3 else d)
    _put(f"{root}/k=8/d.json", '{"a": 9}')
    reader = spark.read.option("multiLine", True)
    want = (reader.schema(schema) if schema else reader).json(f"{root}/k=*/*.json")
    got = A.read_inferred_json(spark, f"{root}/k=*/*.json", schema)
    assert got.schema == want.schema and not got.inputFiles()
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 11


def test_captures_are_written_and_loaded_by_tasks(spark, monkeypatch):
    from filmmart.plans import capture as C

    def never(*a, **k):
        raise AssertionError("file names on the driver")
    monkeypatch.setattr(A, "new_files", never)
    rows = [("mc", "general", f"m/{i}", 0, f'{{"data": {{"item": {{"id": {i}, "title": "t"}}}}}}') for i in range(40)]
    root = scratch_path(spark, "t-capture-small")
    globs = C.write_feeds(spark.createDataFrame(rows, C.CAPTURED_DDL), f"{root}/feeds", f"{root}/rejects")
    assert not path_exists(spark, f"{root}/feeds/mc_general/_SUCCESS")
    A.load_batch(spark, globs["mc_general"], f"{root}/bronze", json_lines=True)
    got = [r for d in A.read_bronze(spark, f"{root}/bronze").collect() for r in json.loads(d["data"])]
    assert sorted((r["id"], r["movie_slug"]) for r in got) == [(i, f"m/{i}") for i in range(40)]


def test_captures_are_made_once(spark):
    """However many feeds and rejects are made of them, each captured row is computed once."""
    from filmmart.plans import capture as C
    made = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b
    body = '{"data": {"items": [{"id": 1, "score": 5}, {"id": null}, {"score": "x"}]}}'
    rows = [("mc", "user_reviews", f"m{i}", 0, body) for i in range(30)] + [("mc", "general", "g", 0, "<html>"), ("mc", "none", "o", 1, "")]
    root = scratch_path(spark, "t-capture-once")
    C.write_feeds(spark.createDataFrame(rows, C.CAPTURED_DDL).mapInArrow(seen, C.CAPTURED_DDL), f"{root}/feeds", f"{root}/rejects")
    assert made.value == 32
    reasons = [r["reason"] for r in spark.read.parquet(f"{root}/rejects").collect()]
    assert sorted(set(reasons)) == ["id: null", "no $.data.item", "unknown kind of capture"] and reasons.count("id: null") == 30
    feed = A.read_keyed_feed(spark, f"{root}/feeds/mc_user_reviews", "review_id string, score int, action string, movie string")
    assert feed.count() == 60

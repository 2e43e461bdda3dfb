"""Packed feeds: few files on the disk, listed, read, loaded and replaced like a file per key."""

import json
import os

from pyspark.sql import functions as F

from filmmart.plans import capture as C
from filmmart.session import local_path, path_exists, scratch_path
from filmmart.sources import feeds as A
from filmmart.sources import packs as P
from filmmart.sources import small_files as T
from filmmart.streaming import feed_stream as S

ODD = ["plain", "a b", "50%", "x=1", "a/b", "q?", "st*r", "[k]", "é:ü", "{c}", "t\tt", "", None, "a#b", T.NO_VALUE]
DDL = "v int, action string, movie string"


def _on_disk(path):
    return sum(1 + len(names) for _, _, names in os.walk(local_path(path)))


def _odd(spark):
    return spark.createDataFrame([(a, k, i) for i, k in enumerate(ODD) for a in ("x", "y=z", None)] * 2, "action string, movie string, v int")


def _lines(spark, path):
    """Folder and lines of every file of a feed, whatever its layout."""
    root = local_path(path)
    return sorted((os.path.dirname(T.from_uri(r["_source_file"]))[len(root):], *sorted(r["value"].splitlines()), r["_length"])
                  for r in A.read_feed(spark, f"{path}/action=*/movie=*/*.json").collect())


def test_captures_take_few_files_of_the_disk(spark):
    """A folder and a file per key took two blocks and two inodes each: 61 GB at six times the driver's 1 GB."""
    rows = [("mc", "general", f"m{i}", 0, f'{{"data": {{"item": {{"id": {i}}}}}}}') for i in range(200)]
    root = scratch_path(spark, "t-few")
    globs = C.write_feeds(spark.createDataFrame(rows, C.CAPTURED_DDL), f"{root}/feeds", f"{root}/rejects")
    assert _on_disk(f"{root}/feeds") < 40
    files = A.list_feed(spark, globs["mc_general"]).collect()
    assert len(files) == 200 and {os.path.dirname(r["_source_file"]).rpartition("/")[2] for r in files} == {f"movie=m{i}" for i in range(200)}
    load = lambda: A.load_batch(spark, globs["mc_general"], f"{root}/bronze", json_lines=True)
    load()
    load()  # nothing new
    assert sorted(json.loads(r["data"])[0]["id"] for r in A.read_bronze(spark, f"{root}/bronze").collect()) == list(range(200))
    C.write_feeds(spark.createDataFrame(rows[:3], C.CAPTURED_DDL).withColumn("body", F.lit('{"data": {"item": {"id": 7000}}}')), f"{root}/feeds")
    load()  # three new versions
    assert A.read_bronze(spark, f"{root}/bronze").count() == 203 and A.list_feed(spark, globs["mc_general"]).count() == 200
    assert _on_disk(f"{root}/feeds") < 60


def test_captures_leave_no_scratch(spark):
    base = f"{local_path(scratch_path(spark, 'x')).rpartition('/')[0]}"
    os.makedirs(base, exist_ok=True)
    before, root = {n for n in os.listdir(base) if n.startswith("captured-")}, scratch_path(spark, "t-no-scratch")
    C.write_feeds(spark.createDataFrame([("mc", "user_reviews", "m", 0, '{"data": {"items": [{"id": 1}, {"id": null}]}}')], C.CAPTURED_DDL), f"{root}/feeds", f"{root}/rejects")
    assert {n for n in os.listdir(base) if n.startswith("captured-")} == before
    assert spark.read.parquet(f"{root}/rejects").count() == 1


def test_packed_feed_equals_a_file_per_key(spark):
    root, df = scratch_path(spark, "t-packed"), _odd(spark)
    again = spark.createDataFrame([(r["action"], r["movie"], r["v"] + 100) for r in df.collect() if r["movie"] in ("a b", "a/b", None, "")][:7], df.schema)
    for packed in (True, False):
        path = f"{root}/{packed}"
        A.keyed_feed_write(df, path, packed=packed)
        A.keyed_feed_write(again, path, packed=packed)
        A.keyed_feed_write(df.filter("false"), path, packed=packed)
    assert _on_disk(f"{root}/True") < _on_disk(f"{root}/False") / 2
    assert _lines(spark, f"{root}/True") == _lines(spark, f"{root}/False") != []
    rows = lambda p, ddl: sorted(map(str, A.read_keyed_feed(spark, f"{root}/{p}", ddl).select("action", "movie", "v").collect()))
    assert rows(True, DDL) == rows(False, DDL) and rows(True, "v int") == rows(True, DDL)
    own = lambda r: (r["action"], None if r["movie"] in ("", T.NO_VALUE) else r["movie"])
    new = again.collect()
    assert len(rows(True, DDL)) == len(new) + sum(own(r) not in set(map(own, new)) for r in df.collect())
    for pattern in ("", "action=*", "action=x", "action=x/movie=*", "action=x/movie=a b", "action=*/movie=a*/*.json", "{action,b}=x/movie=?lain/*", "*/*/part-*", "*/*/*.txt", "a/b"):
        paths = lambda p: sorted((os.path.dirname(r["_source_file"])[-20:], r["_length"]) for r in A.list_feed(spark, f"{root}/{p}/{pattern}".rstrip("/")).collect())  # noqa: E731, B023
        assert paths(True) == paths(False), pattern


def test_packs_and_folders_replace_each_other(spark):
    root = scratch_path(spark, "t-layouts")
    frame = lambda ks, v: spark.createDataFrame([("a", f"m{k}", v) for k in ks], "action string, movie string, v int")
    for first in (True, False):
        path = f"{root}/{first}"
        A.keyed_feed_write(frame(range(20), 1), path, packed=first)
        A.keyed_feed_write(frame(range(5), 2), path, packed=not first)
        got = {r["movie"]: r["value"] for r in A.read_feed(spark, f"{path}/action=a/movie=*/*.json").select(
            F.regexp_extract("_source_file", "movie=([^/]+)/", 1).alias("movie"), "value").collect()}
        assert got == {f"m{k}": f'{{"v":{2 if k < 5 else 1}}}\n' for k in range(20)}
        assert A.read_feed(spark, f"{path}/action=a/movie=*/*.json").count() == 20
    packed = f"{root}/whole"
    for v in (1, 2):
        A.keyed_feed_write(frame(range(20), v), packed, packed=True)
        assert not P.unfinished(local_path(packed))
        with open(local_path(f"{packed}/{P.PACKS}/.side-left"), "w") as f:  # by a job that failed
            f.write("x")
        assert A.read_keyed_feed(spark, packed, DDL).groupBy("v").count().collect() == [(v, 20)]
    assert len(P.packs(local_path(packed))) <= 4 and not path_exists(spark, f"{packed}/_SUCCESS")  # the old packs are gone


def test_a_stream_takes_each_version_of_a_packed_file_once(spark):
    root = scratch_path(spark, "t-packed-stream")
    frame = lambda ks, v: spark.createDataFrame([("a", f"m {k}", v) for k in ks], "action string, movie string, v int")
    run = lambda: S.load_stream(spark, f"{root}/feed", f"{root}/b", f"{root}/r", f"{root}/ck", json_lines=True)
    A.keyed_feed_write(frame(range(12), 1), f"{root}/feed", packed=True)
    run()
    A.keyed_feed_write(frame(range(4), 2), f"{root}/feed", packed=True)
    run()
    run()
    got = [json.loads(r["data"])[0]["v"] for r in A.read_bronze(spark, f"{root}/b").collect()]
    assert sorted(got) == [1] * 12 + [2] * 4 and A.read_rejects(spark, f"{root}/r").count() == 0


def test_a_hot_key_is_dealt_over_packs(spark, monkeypatch):
    root = local_path(scratch_path(spark, "t-hot-pack"))
    monkeypatch.setattr(P, "PACK_BYTES", 100)
    monkeypatch.setattr(P, "GROUP_BYTES", 30)
    out = P.PackWriter(lambda n: f"{root}/{P.PACKS}/{P.pack_name(0, n, 'f' * 32, '.json')}{P.ENDING}")
    lines = [("k=a", b"%02d\n" % i) for i in range(3)] + [("k=hot", b"%09d\n" % i) for i in range(50)] + [("k=z", b"1\n")]
    for folder, line in lines:
        out.add(folder, line)
    assert out.close() == P.packs(root) and len(P.packs(root)) == 6
    files = T.list_files(spark, f"{root}/k=*/*.json")
    listed = files.collect()
    assert len({r["_source_file"] for r in listed}) == len(listed) == 7
    files = spark.createDataFrame(listed, files.schema)
    got = [(r["_source_file"].split("/")[-2], x + b"\n") for r in T.read_files(files).collect() for x in bytes(r["content"]).splitlines()]
    assert sorted(got) == sorted(lines)
    os.remove(P.packs(root)[-1])  # since it was listed
    assert T.read_files(files).count() == 6

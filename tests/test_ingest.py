"""Feed loading: rejects, load-once (batch and stream), snapshot replace, bootstrap, keyed writes."""

import os

from pyspark.sql import functions as F

from filmmart.plans.mart import build_from_root
from filmmart.schemas import BRONZE_TABLES
from filmmart.session import local_path, scratch_path
from filmmart.sources import feeds as A
from filmmart.streaming.feed_stream import load_stream, replay_rejects

FILES = {
    "good.json": '[{"movie_slug": "m1", "title": "A"}]',
    "broken.json": '[{"movie_slug": "m1"',
    "trailing.json": "[1] x",
    "empty.json": "[]",
    "object.json": '{"movie_slug": "m2"}',
    "null.json": "null",
    "newline.json": '[{"movie_slug": "m\n3"}]',
}


def _write(folder: str, files: dict) -> None:
    d = local_path(folder)
    os.makedirs(d, exist_ok=True)
    for name, text in files.items():
        with open(os.path.join(d, name), "wb") as f:
            f.write(text if isinstance(text, bytes) else text.encode())


def test_rejects_and_load_once(spark):
    root = scratch_path(spark, "t-ingest")
    _write(f"{root}/feed", FILES)
    glob = f"{root}/feed/*.json"
    A.load_batch(spark, glob, f"{root}/bronze", f"{root}/rejects")
    A.load_batch(spark, glob, f"{root}/bronze", f"{root}/rejects")
    b = A.read_bronze(spark, f"{root}/bronze")
    names = sorted(r["_source_file"].rsplit("/", 1)[-1] for r in b.collect())
    assert names == ["empty.json", "good.json", "null.json", "object.json"]
    rej = A.read_rejects(spark, f"{root}/rejects")
    assert sorted({r["_source_file"].rsplit("/", 1)[-1] for r in rej.collect()}) == \
        ["broken.json", "newline.json", "trailing.json"]
    # a repaired file is picked up by the next load
    _write(f"{root}/feed", {"broken.json": '[{"movie_slug": "m1"}]'})
    A.load_batch(spark, glob, f"{root}/bronze", f"{root}/rejects")
    assert A.read_bronze(spark, f"{root}/bronze").count() == 5


def test_invalid_utf8_is_replaced(spark):
    root = scratch_path(spark, "t-utf8")
    _write(root, {"bad.json": b'[{"movie_slug": "caf\xe9"}]'})
    r = A.read_feed(spark, f"{root}/*.json").first()
    assert r["value"] == '[{"movie_slug": "caf�"}]'


def test_stream_load_once_and_replay(spark):
    root = scratch_path(spark, "t-stream")
    feed, bronze, rej, ck = f"{root}/feed", f"{root}/bronze", f"{root}/rejects", f"{root}/ck"
    _write(feed, {"a.json": "[1]", "b.json": "[2] x"})
    load_stream(spark, feed, bronze, rej, ck)
    load_stream(spark, feed, bronze, rej, ck)
    assert A.read_bronze(spark, bronze).count() == 1
    _write(feed, {"c.json": "[3]", "b.json": "[2]"})
    load_stream(spark, feed, bronze, rej, ck)
    assert A.read_bronze(spark, bronze).count() == 3          # c is new, and so is the repaired version of b
    replay_rejects(spark, f"{feed}/*.json", rej, bronze, "replay-1")   # nothing is left to reload
    assert sorted(r["data"] for r in A.read_bronze(spark, bronze).collect()) == ["[1]", "[2]", "[3]"]


def test_stream_takes_each_version_once(spark):
    """A broken version is rejected once over any number of runs; names that look like patterns are read."""
    root = scratch_path(spark, "t-versions")
    feed, bronze, rej, ck = f"{root}/feed", f"{root}/bronze", f"{root}/rejects", f"{root}/ck"
    run = lambda: load_stream(spark, feed, bronze, rej, ck)
    _write(feed, {"a b+[1]*é%20.json": "[1]", "b.json": "[2] x", ".hidden.json": "[9]", "c.txt": "[9]"})
    _write(f"{feed}/action=x", {"d.json": "[4]"})
    for _ in range(3):
        run()
    assert A.read_rejects(spark, rej).count() == 1 and A.read_bronze(spark, bronze).count() == 2
    _write(feed, {"b.json": "[2] xy"})                     # still broken: another version, one more reject
    for _ in range(2):
        run()
    assert A.read_rejects(spark, rej).count() == 2
    _write(feed, {"b.json": "[2]", "a b+[1]*é%20.json": "[10]"})
    run()
    run()
    assert sorted(r["data"] for r in A.read_bronze(spark, bronze).collect()) == ["[10]", "[1]", "[2]", "[4]"]
    _write(feed, {"e.json": "[5] x"})
    run()
    _write(feed, {"e.json": "[50]"})
    replay_rejects(spark, f"{feed}/*.json", rej, bronze, "replay-2")
    assert "[50]" in {r["data"] for r in A.read_bronze(spark, bronze).collect()}


def test_batch_load_reads_odd_names(spark):
    root = scratch_path(spark, "t-names")
    _write(f"{root}/feed", {"a b+[1]*é%20{x}?.json": "[1]", "p.json": "[2]"})
    A.load_batch(spark, f"{root}/feed/*.json", f"{root}/bronze", f"{root}/rejects")
    A.load_batch(spark, f"{root}/feed/*.json", f"{root}/bronze", f"{root}/rejects")
    assert sorted(r["data"] for r in A.read_bronze(spark, f"{root}/bronze").collect()) == ["[1]", "[2]"]


def test_snapshot_replace(spark):
    root = scratch_path(spark, "t-snap")
    _write(f"{root}/v1", {"crosswalk.json": '[{"rt_slug": "a"}]'})
    _write(f"{root}/v2", {"crosswalk.json": '[{"rt_slug": "b"'})
    bronze = f"{root}/bronze"
    assert A.replace_snapshot(spark, f"{root}/v1/*.json", bronze) == "replaced"
    assert A.replace_snapshot(spark, f"{root}/v2/*.json", bronze) == "kept: malformed JSON"
    assert A.replace_snapshot(spark, f"{root}/none/*.json", bronze) == "kept: no file"
    assert [r["data"] for r in A.read_bronze(spark, bronze).collect()] == ['[{"rt_slug":"a"}]']
    _write(f"{root}/v3", {"crosswalk.json": '[{"rt_slug": "c"}]'})
    assert A.replace_snapshot(spark, f"{root}/v3/*.json", bronze) == "replaced"
    from filmmart.session import child_dirs
    assert len(child_dirs(spark, bronze, "load_id=")) == 2          # the version before stays for its readers
    _write(f"{root}/v4", {"crosswalk.json": '[{"rt_slug": "d"}]'})
    assert A.replace_snapshot(spark, f"{root}/v4/*.json", bronze) == "replaced"
    assert A.replace_snapshot(spark, f"{root}/v3/*.json", bronze, keep=0) == "replaced"
    assert len(child_dirs(spark, bronze, "load_id=")) == 1          # none stays if none is to
    assert [r["data"] for r in A.read_bronze(spark, bronze).collect()] == ['[{"rt_slug":"c"}]']


def test_empty_bronze_builds_empty_mart(spark):
    root = scratch_path(spark, "t-empty")
    out = build_from_root(spark, f"{root}/bronze", f"{root}/mart")
    for t in BRONZE_TABLES:
        assert os.path.isdir(local_path(f"{root}/bronze/{t}"))
    assert out["dim_date"].count() == 22280
    for t in ["dim_movie", "dim_critic", "fact_movie_score", "fact_critic_review", "silver_mc_general"]:
        assert out[t].count() == 0
    verdicts = {(r["model"], r["test"]): r["status"] for r in out["tests"].collect()}
    assert verdicts[("dim_movie", "row_count_between")] == "fail"   # the floor guards an empty dimension


def test_large_valid_files_are_loaded(spark):
    """Validity has no size limit: 140 MB and 300 MB arrays reach bronze."""
    root = scratch_path(spark, "t-large")
    d = local_path(f"{root}/feed")
    os.makedirs(d)
    for mb in (140, 300):
        with open(f"{d}/f{mb}.json", "w") as f:
            f.write('[{"movie_slug": "m%d", "title": "' % mb + "x" * 1000 + '"}')
            part = ',{"movie_slug": "m", "title": "' + "y" * 1_000_000 + '"}'
            for _ in range(mb):
                f.write(part)
            f.write("]")
    A.load_batch(spark, f"{root}/feed/*.json", f"{root}/bronze", f"{root}/rejects")
    sizes = sorted(r["n"] for r in A.read_bronze(spark, f"{root}/bronze").select(F.length("data").alias("n")).collect())
    assert [n // 1_000_000 for n in sizes] == [140, 300]
    assert A.read_rejects(spark, f"{root}/rejects").count() == 0


def test_replayed_batch_and_interrupted_snapshot(spark):
    root = scratch_path(spark, "t-replay")
    feed, bronze, rej, ck = f"{root}/feed", f"{root}/bronze", f"{root}/rejects", f"{root}/ck"
    _write(feed, {"a.json": "[1]", "b.json": "[2]"})
    load_stream(spark, feed, bronze, rej, ck)
    commits = [f for f in os.listdir(local_path(f"{ck}/commits")) if f in ("0", ".0.crc")]
    for f in commits:  # the batch was written, its commit was not
        os.remove(local_path(f"{ck}/commits/{f}"))
    load_stream(spark, feed, bronze, rej, ck)
    assert A.read_bronze(spark, bronze).count() == 2
    snap = f"{root}/snap"
    _write(f"{root}/v1", {"x.json": '[{"rt_slug": "a"}]'})
    A.replace_snapshot(spark, f"{root}/v1/*.json", snap)
    A.good(A.to_bronze(A.read_feed(spark, f"{root}/v1/*.json"))).write.parquet(f"{snap}/load_id=snapshot-died-before-the-pointer")
    assert A.read_bronze(spark, snap).count() == 1


def test_an_idle_load_writes_nothing(spark):
    from filmmart.session import child_dirs
    root = scratch_path(spark, "t-idle")
    _write(f"{root}/feed", {"a.json": "[1]"})
    for _ in range(3):
        A.load_batch(spark, f"{root}/feed/*.json", f"{root}/bronze")
    assert len(child_dirs(spark, f"{root}/bronze", "load_id=")) == 1


def test_bare_object_fails_a_verdict(spark):
    root = scratch_path(spark, "t-object")
    _write(f"{root}/feed", {"a.json": '{"movie_id": "x"}'})
    A.load_batch(spark, f"{root}/feed/*.json", f"{root}/bronze/rt_details")
    out = build_from_root(spark, f"{root}/bronze", f"{root}/mart")
    bad = {r["model"]: r["failures"] for r in out["tests"].filter("test = 'json_array' and status = 'fail'").collect()}
    assert bad == {"rt_details": 1} and out["silver_rejects"].count() == 1


def test_cli_mark_and_replay(spark):
    from filmmart.__main__ import main
    root = scratch_path(spark, "t-mark")
    done = spark.createDataFrame([("a", "details", "i", True), ("b", "details", None, True), ("c", "details", "i", False)],
                                 "slug string, action string, item string, finished boolean")
    done.write.parquet(f"{root}/results")
    for _ in range(2):
        assert main(["mark", "--results", f"{root}/results", "--ledger", f"{root}/ledger", "--require-items"]) == 0
    assert [tuple(r) for r in spark.read.parquet(f"{root}/ledger").collect()] == [("a", "details")]
    _write(f"{root}/feed", {"a.json": "[1] x"})
    A.load_batch(spark, f"{root}/feed/*.json", f"{root}/bronze", f"{root}/rejects")
    _write(f"{root}/feed", {"a.json": "[1]"})
    assert main(["replay", "--feed", f"{root}/feed/*.json", "--bronze", f"{root}/bronze", "--rejects", f"{root}/rejects"]) == 0
    assert A.read_bronze(spark, f"{root}/bronze").count() == 1


def test_keyed_write_keeps_digit_slugs(spark):
    path = f"{scratch_path(spark, 't-keyed')}/feed"
    df = spark.createDataFrame([("details", "007", 1), ("details", "42", 2), ("score", "007", 3)],
                               "action string, movie string, v int")
    A.keyed_feed_write(df, path)
    A.keyed_feed_write(df.filter("movie = '42'").withColumn("v", F.lit(9)), path)
    back = A.read_keyed_feed(spark, path, "v int, action string, movie string")
    assert sorted(tuple(r) for r in back.select("action", "movie", "v").collect()) == \
        [("details", "007", 1), ("details", "42", 9), ("score", "007", 3)]


def test_cli_build_and_freshness(spark, capsys):
    from filmmart.__main__ import main
    from filmmart.operators.quality import sources_freshness
    root = scratch_path(spark, "t-cli")
    _write(f"{root}/feed", {"m.json": '[{"movie_slug": "m1", "title": "T", "imdb_id": "tt1"}]'})
    assert main(["load", "--feed", f"{root}/feed/*.json", "--bronze", f"{root}/bronze/mc_general"]) == 0
    assert main(["build", "--bronze-root", f"{root}/bronze", "--out", f"{root}/mart",
                 "--sql", "select title from dim_movie"]) == 0
    assert "T" in capsys.readouterr().out
    fresh = sources_freshness(A.read_bronze_root(spark, f"{root}/bronze"), "2099-01-01 00:00:00")
    status = {r["source"]: r["status"] for r in fresh.collect()}
    assert status["mc_general"] == "error" and status["rt_score"] == "error"   # stale / never loaded


def test_cli_crosswalk_and_plan(spark):
    """The crawl-side flow: bronze mc_general + id mapping -> crosswalk feed -> snapshot ->
    ordered slugs minus the ledger -> command batches."""
    from filmmart.__main__ import main
    root = scratch_path(spark, "t-cli-plan")
    _write(f"{root}/feed", {"g1.json": '[{"movie_slug": "a", "imdb_id": "tt1"}, {"slug": "b", "imdb_id": "tt2"}]',
                            "g2.json": '[{"movie_slug": "c", "imdb_id": "tt3"}, {"movie_slug": "z", "imdb_id": "tt1"}]'})
    assert main(["load", "--feed", f"{root}/feed/*.json", "--bronze", f"{root}/bronze/mc_general"]) == 0
    spark.createDataFrame([("tt1", "m/alpha"), ("tt2", "tv/show/s01"), ("tt3", "m/gamma")],
                          "imdb_id string, rt_raw string").write.parquet(f"{root}/mapping")
    assert main(["crosswalk", "--bronze-root", f"{root}/bronze", "--mapping", f"{root}/mapping",
                 "--out", f"{root}/xw"]) == 0
    xw = {r["rt_slug"]: r["mc_slug"] for r in spark.read.json(f"{root}/xw").collect()}
    assert xw == {"alpha": "a", "gamma": "c"}                    # first wins for tt1; tv/ dropped
    assert main(["snapshot", "--feed", f"{root}/xw/*.json", "--bronze", f"{root}/bronze/rt_crosswalk",
                 "--json-lines"]) == 0
    spark.createDataFrame([("gamma", "details")], "slug string, action string").write.parquet(f"{root}/ledger")
    assert main(["plan", "--bronze-root", f"{root}/bronze", "--ledger", f"{root}/ledger", "--action", "details",
                 "--out", f"{root}/plan"]) == 0
    assert [r["commands"] for r in spark.read.json(f"{root}/plan").collect()] == ["crawl movie=alpha action=details"]

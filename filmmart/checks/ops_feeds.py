"""Checks of feed ingest (A1-A11) and the streaming load.

Each check writes a feed derived from a driver table into a fresh folder under the
shared checkpoint location, runs the operator on it (twice where repetition matters)
and returns what was loaded. Feed files are keyed ``key=<k>/part-*.txt``, one file per
key: the JSON array of that key's records.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsonops import unnest_records
from ..plans import silver as S
from ..plans.capture import write_feeds
from ..plans.standins import mc_general, table
from ..session import scratch_path
from ..sources import feeds as A
from ..sources import small_files as T
from ..sources.containers import container_read, container_write
from ..sources.json_array import load_arrays
from ..streaming.feed_stream import load_stream
from ..streaming.silver_stream import compact, read_silver, update_silver
from ..streaming.versions import opened
from .oracle_models import model_sql
from .ops_core import grouped_text
from .render import render

CHECKS: dict = {}


def check(name: str, sql: str | None):
    def deco(fn):
        CHECKS[name] = (fn, sql)
        return fn
    return deco


CHUNK = 256


def load_ts() -> Column:
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


def feed_key() -> Column:
    return F.regexp_extract(F.col("_source_file"), r"key=([^/]+)/", 1)


def _feed_text(spark: SparkSession, sf: str) -> DataFrame:
    """Events as feed files: one per chunk of 256 event ids; every 10th file has trailing text."""
    ev = table(spark, sf, "events").withColumn("chunk", F.floor(F.col("event_id") / CHUNK))
    g = grouped_text(ev, ["chunk"], "event_id", F.col("props"), sep=", ")
    broken = F.col("chunk") % 10 == 0
    return g.select(F.col("chunk").cast("string").alias("key"), F.col("chunk"),
                    F.when(broken, F.concat("data", F.lit(" x"))).otherwise(F.col("data")).alias("value"))


def write_feed(files: DataFrame, folder: str, mode: str = "overwrite") -> str:
    """One text file per ``key`` holding ``value``; returns the glob of the files."""
    spark, keyed = files.sparkSession, files.select("key", "value").repartition("key")
    if T.by_tasks(spark, folder):
        if mode == "overwrite":
            T.fresh_folder(spark, folder)
        T.write_folders(keyed, folder, ["key"], F.col("value"), ".txt", replace=False)
    else:
        keyed.write.mode(mode).partitionBy("key").text(folder)
    return f"{folder}/key=*/*.txt"


FEED_SQL = """SELECT CAST(event_id // 256 AS VARCHAR) AS key, (event_id // 256) % 10 = 0 AS broken,
  string_agg(props, ', ' ORDER BY event_id) AS body, string_agg(replace(props, ': ', ':'), ',' ORDER BY event_id) AS canon
FROM events GROUP BY event_id // 256"""


@check("feed_scan", f"""SELECT key AS file_key, '[' || body || ']' || CASE WHEN broken THEN ' x' ELSE '' END || chr(10) AS value
FROM ({FEED_SQL}) f""")
def q_feed_scan(spark, sf):
    glob = write_feed(_feed_text(spark, sf), scratch_path(spark, "feed_scan"))
    return A.read_feed(spark, glob).select(feed_key().alias("file_key"), "value")


@check("bronze_envelope", f"""SELECT '2024-01-01 00:00:00.000000' AS _loaded_at, key AS file_key, '[' || canon || ']' AS data
FROM ({FEED_SQL}) f WHERE NOT broken""")
def q_bronze_envelope(spark, sf):
    glob = write_feed(_feed_text(spark, sf), scratch_path(spark, "bronze_envelope"))
    env = A.good(A.to_bronze(A.read_feed(spark, glob), load_ts()))
    return render(env.select("_loaded_at", feed_key().alias("file_key"), "data"))


def _copies(spark, bronze_path: str) -> DataFrame:
    b = A.read_bronze(spark, bronze_path)
    return b.groupBy(feed_key().alias("file_key")).agg(F.count(F.lit(1)).alias("copies"))


@check("load_once", f"""SELECT key AS file_key, CAST(1 AS BIGINT) AS copies FROM ({FEED_SQL}) f WHERE NOT broken""")
def q_load_once(spark, sf):
    root = scratch_path(spark, "load_once")
    feed, bronze, rej = f"{root}/feed", f"{root}/bronze", f"{root}/rejects"
    files = _feed_text(spark, sf)
    glob = write_feed(files.filter(F.col("chunk") % 2 == 0), feed)
    A.load_batch(spark, glob, bronze, rej)                       # ledger: the even users' files
    write_feed(files.filter(F.col("chunk") % 2 == 1), feed, mode="append")
    A.load_batch(spark, glob, bronze, rej)                       # only the new (odd) files
    A.load_batch(spark, glob, bronze, rej)                       # nothing new: no change
    return _copies(spark, bronze)


@check("append_load", f"""SELECT key AS file_key, CAST(2 AS BIGINT) AS copies FROM ({FEED_SQL}) f WHERE NOT broken""")
def q_append_load(spark, sf):
    root = scratch_path(spark, "append_load")
    glob = write_feed(_feed_text(spark, sf), f"{root}/feed")
    A.load_batch(spark, glob, f"{root}/bronze", only_new=False)
    A.load_batch(spark, glob, f"{root}/bronze", only_new=False)
    return _copies(spark, f"{root}/bronze")


@check("load_stream_once", f"""SELECT key AS file_key, CAST(1 AS BIGINT) AS copies FROM ({FEED_SQL}) f WHERE NOT broken""")
def q_load_stream_once(spark, sf):
    root = scratch_path(spark, "load_stream_once")
    feed, bronze, rej, ck = f"{root}/feed", f"{root}/bronze", f"{root}/rejects", f"{root}/checkpoint"
    files = _feed_text(spark, sf)
    write_feed(files.filter(F.col("chunk") % 2 == 0), feed)
    load_stream(spark, feed, bronze, rej, ck, glob="*.txt")
    write_feed(files.filter(F.col("chunk") % 2 == 1), feed, mode="append")
    load_stream(spark, feed, bronze, rej, ck, glob="*.txt")
    load_stream(spark, feed, bronze, rej, ck, glob="*.txt")
    return _copies(spark, bronze)


REWRITTEN_SQL = f"""SELECT key AS file_key, v AS copies_rank FROM ({FEED_SQL}) f, (SELECT unnest([1, 2]) AS v) t
WHERE NOT broken AND (v = 1 OR (CAST(key AS BIGINT)) % 3 = 0)"""


def _rewrite(files: DataFrame, feed: str) -> None:
    """Every third file anew at its old path, longer by white space, as a later crawl writes it: written aside, then moved onto the
    old paths by tasks."""
    again = files.filter(F.col("chunk") % 3 == 0).withColumn("value", F.concat(F.lit("  "), "value"))
    spark = files.sparkSession
    side = scratch_path(spark, "rewrite")
    write_feed(again, side)
    named = lambda folder, name: A.list_feed(spark, f"{folder}/key=*/*.txt").select(feed_key().alias("key"), F.col("_source_file").alias(name))
    moves = named(side, "made").join(named(feed, "old"), "key").select("made", "old")
    moves.mapInArrow(_move, "moved long").agg(F.sum("moved")).collect()


def _move(batches):
    for b in batches:
        for made, old in zip(b.column("made").to_pylist(), b.column("old").to_pylist(), strict=True):
            (system, source), (_, target) = opened(made), opened(old)
            beside = lambda path: "{}/.{}.crc".format(*path.rsplit("/", 1))  # noqa: E731  Hadoop's checksum of a local file
            if system.get_file_info(beside(source)).is_file:
                system.move(beside(source), beside(target))
            system.move(source, target)
        yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["moved"])


def _versions(spark, bronze_path: str) -> DataFrame:
    b = A.read_bronze(spark, bronze_path).groupBy(feed_key().alias("file_key")).agg(F.count(F.lit(1)).alias("n"))
    return b.select("file_key", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copies_rank"))


@check("load_rewritten_file", REWRITTEN_SQL)
def q_load_rewritten_file(spark, sf):
    """A file rewritten by a later crawl is loaded again, once; all others stay loaded once."""
    root = scratch_path(spark, "load_rewritten")
    files = _feed_text(spark, sf)
    glob = write_feed(files, f"{root}/feed")
    A.load_batch(spark, glob, f"{root}/bronze", f"{root}/rejects")
    _rewrite(files, f"{root}/feed")
    A.load_batch(spark, glob, f"{root}/bronze", f"{root}/rejects")
    A.load_batch(spark, glob, f"{root}/bronze", f"{root}/rejects")
    return _versions(spark, f"{root}/bronze")


@check("stream_rewritten_file", REWRITTEN_SQL)
def q_stream_rewritten_file(spark, sf):
    root = scratch_path(spark, "stream_rewritten")
    files = _feed_text(spark, sf)
    write_feed(files, f"{root}/feed")
    load = lambda: load_stream(spark, f"{root}/feed", f"{root}/bronze", f"{root}/rejects", f"{root}/ck", glob="*.txt")
    load()
    _rewrite(files, f"{root}/feed")
    load()
    load()
    return _versions(spark, f"{root}/bronze")


@check("stream_rejects_once", f"""SELECT key AS file_key, CAST(1 + CAST(CAST(key AS BIGINT) % 3 = 0 AS INTEGER) AS BIGINT) AS rejected
FROM ({FEED_SQL}) f WHERE broken""")
def q_stream_rejects_once(spark, sf):
    """A broken version is rejected once, over any number of runs; written again and still broken, once more."""
    root = scratch_path(spark, "stream_rejects")
    files = _feed_text(spark, sf)
    write_feed(files, f"{root}/feed")
    load = lambda: load_stream(spark, f"{root}/feed", f"{root}/bronze", f"{root}/rejects", f"{root}/ck", glob="*.txt")
    load()
    load()
    _rewrite(files, f"{root}/feed")
    load()
    load()
    return A.read_rejects(spark, f"{root}/rejects").groupBy(feed_key().alias("file_key")).agg(F.count(F.lit(1)).alias("rejected"))


@check("array_ranges", """SELECT CAST(event_id // 4096 AS VARCHAR) AS file_key, replace(props, ': ', ':') AS record
FROM events WHERE (event_id // 4096) % 3 <> 1""")
def q_array_ranges(spark, sf):
    """Array files cut into ranges of 20,000 bytes, in the middle of records; every third file has trailing text and goes whole."""
    ev = table(spark, sf, "events").withColumn("chunk", F.floor(F.col("event_id") / 4096))
    g = grouped_text(ev, ["chunk"], "event_id", F.col("props"), sep=", ")
    files = g.select(F.col("chunk").cast("string").alias("key"),
                     F.when(F.col("chunk") % 3 == 1, F.concat("data", F.lit(" x"))).otherwise(F.col("data")).alias("value"))
    root = scratch_path(spark, "array_ranges")
    load_arrays(spark, write_feed(files, f"{root}/feed"), f"{root}/bronze", f"{root}/rejects", range_bytes=20_000)
    return unnest_records(A.read_bronze(spark, f"{root}/bronze"), keep=("_source_file",)).select(feed_key().alias("file_key"), "record")


@check("silver_kept_up_to_date", model_sql()["silver_mc_user_reviews"])
def q_silver_kept_up_to_date(spark, sf):
    """Bronze loads taken by micro-batches, the newest files first, one load twice, compacted in between."""
    from ..plans.standins import bronze_from_driver
    spec, root = S.SPECS["silver_mc_user_reviews"], scratch_path(spark, "kept")
    bronze = bronze_from_driver(spark, sf)["mc_user_reviews"]
    for i in (2, 0, 1, 0):
        A.write_load(bronze.filter(F.pmod(F.xxhash64("_source_file", "_loaded_at"), F.lit(3)) == i), f"{root}/bronze", f"load{i}-{uuid.uuid4().hex}")
        update_silver(spark, f"{root}/bronze", f"{root}/silver", spec, f"{root}/ck")
        if i == 1:
            compact(spark, f"{root}/silver", spec)
    return render(read_silver(spark, f"{root}/silver", spec))


@check("two_streams_one_table", f"""SELECT key AS file_key, CAST(1 AS BIGINT) AS copies FROM ({FEED_SQL}) f WHERE NOT broken""")
def q_two_streams_one_table(spark, sf):
    """Two feeds, each with a stream and checkpoint of its own, into one bronze table."""
    root = scratch_path(spark, "two_streams")
    files = _feed_text(spark, sf)
    for i in range(2):
        write_feed(files.filter(F.col("chunk") % 2 == i), f"{root}/feed{i}")
        load_stream(spark, f"{root}/feed{i}", f"{root}/bronze", f"{root}/rejects", f"{root}/ck{i}", glob="*.txt")
    return _copies(spark, f"{root}/bronze")


@check("silver_rejects", """SELECT 'rt_details' AS bronze_table, 'f' || p_partkey AS _source_file, 'not a JSON array' AS reason
FROM part WHERE p_partkey % 7 = 0""")
def q_silver_rejects(spark, sf):
    from ..plans.mart import silver_rejects
    k = F.col("p_partkey")
    rec = F.concat(F.lit('{"movie_id": "r_'), k.cast("string"), F.lit('"}'))
    env = table(spark, sf, "part").select(load_ts().alias("_loaded_at"), F.concat(F.lit("f"), k.cast("string")).alias("_source_file"),
                                          F.when(k % 7 == 0, rec).otherwise(F.concat(F.lit("["), rec, F.lit("]"))).alias("data"))
    return silver_rejects({"rt_details": env, "rt_score": env.filter("data like '[%'")}).select(
        "bronze_table", "_source_file", "reason")


def _supplier_snapshot(spark, sf, name_expr: Column, broken: bool = False) -> DataFrame:
    """Supplier rows as a snapshot split into files of 64 records; ``broken`` cuts one file short."""
    k = F.col("s_suppkey")
    n = table(spark, sf, "supplier").select(
        F.floor(k / 64).cast("string").alias("key"), k.alias("s_suppkey"),
        F.concat(F.lit('{"s_suppkey": '), k.cast("string"), F.lit(', "s_name": "'), name_expr,
                 F.lit('"}')).alias("rec"))
    g = grouped_text(n, ["key"], "s_suppkey", F.col("rec"))
    value = F.when(F.lit(broken) & (F.col("key") == "0"), F.concat("data", F.lit("]"))).otherwise(F.col("data"))
    return g.select("key", value.alias("value"))


@check("snapshot_replace", """SELECT s_suppkey, lower(s_name) AS s_name FROM supplier""")
def q_snapshot_replace(spark, sf):
    """A snapshot is replaced only when every file of the new version is valid: v2 has one
    broken file and a missing version changes nothing; v3 replaces v1 whole."""
    root = scratch_path(spark, "snapshot_replace")
    bronze = f"{root}/bronze"
    v1 = write_feed(_supplier_snapshot(spark, sf, F.col("s_name")), f"{root}/v1")
    v2 = write_feed(_supplier_snapshot(spark, sf, F.upper("s_name"), broken=True), f"{root}/v2")
    v3 = write_feed(_supplier_snapshot(spark, sf, F.lower("s_name")), f"{root}/v3")
    steps = [A.replace_snapshot(spark, v1, bronze), A.replace_snapshot(spark, v2, bronze),
             A.replace_snapshot(spark, f"{root}/absent/*.txt", bronze), A.replace_snapshot(spark, v3, bronze)]
    assert steps == ["replaced", "kept: malformed JSON", "kept: no file", "replaced"], steps
    recs = unnest_records(A.read_bronze(spark, bronze), keep=())
    return recs.select(F.get_json_object("record", "$.s_suppkey").cast("long").alias("s_suppkey"),
                       F.get_json_object("record", "$.s_name").alias("s_name"))


@check("bootstrap_empty", """SELECT t AS table_name, n AS n_rows FROM (
  SELECT 'mc_general' AS t, count(DISTINCT (k // 10, k // 64, c)) AS n
  FROM (SELECT p_partkey AS k, 0 AS c FROM part UNION ALL SELECT p_partkey, 1 FROM part) x
  UNION ALL SELECT 'silver_mc_general', count(*) FROM part
  UNION ALL SELECT unnest(['rt_details', 'rt_score', 'rt_reviews', 'rt_critic_reviews', 'rt_crosswalk',
      'mc_critic_reviews', 'mc_user_reviews', 'silver_mc_critic_reviews', 'silver_mc_user_reviews',
      'silver_rt_critic_reviews', 'silver_rt_crosswalk', 'silver_rt_details', 'silver_rt_reviews', 'silver_rt_score']), 0)""")
def q_bootstrap_empty(spark, sf):
    root = scratch_path(spark, "bootstrap_empty")
    mc_general(table(spark, sf, "part")).write.parquet(f"{root}/mc_general/load_id=driver")
    A.bootstrap(spark, root)
    bronze = A.read_bronze_root(spark, root)
    silver = S.build_all_silver(bronze)
    counts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
              for name, df in list(bronze.items()) + list(silver.items())]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@check("rebuild_table", """SELECT s_suppkey, lower(s_name) AS s_name FROM supplier""")
def q_rebuild_table(spark, sf):
    path = f"{scratch_path(spark, 'rebuild_table')}/supplier_dim"
    n = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    A.rebuild_table(n, path)
    out, noted = A.rebuild_table(n.withColumn("s_name", F.lower("s_name")), path, {"rows": F.count(F.lit(1))})
    assert noted["rows"] == out.count()
    return out.select("s_suppkey", "s_name")


@check("read_inferred_json", """SELECT event_id, user_id, event_type FROM events WHERE event_type = 'purchase'""")
def q_read_inferred_json(spark, sf):
    ev = table(spark, sf, "events").withColumn("chunk", F.floor(F.col("event_id") / CHUNK))
    rec = F.concat(F.lit('{\n  "event_id": '), F.col("event_id").cast("string"), F.lit(',\n  "user_id": '),
                   F.col("user_id").cast("string"), F.lit(',\n  "event_type": "'), F.col("event_type"), F.lit('"\n}'))
    g = grouped_text(ev, ["chunk"], "event_id", rec, sep=",\n")
    files = g.select(F.col("chunk").cast("string").alias("key"), F.col("data").alias("value"))
    glob = write_feed(files, scratch_path(spark, "read_inferred_json"))
    df = A.read_inferred_json(spark, glob)
    return df.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "event_type")


@check("keyed_feed_write", """SELECT event_type AS action, lpad(CAST(user_id AS VARCHAR), 4, '0') AS movie, event_id,
  CASE WHEN event_type = 'click' THEN 'second' ELSE 'first' END AS v FROM events""")
def q_keyed_feed_write(spark, sf):
    path = f"{scratch_path(spark, 'keyed_feed_write')}/feed"
    ev = table(spark, sf, "events").select(F.col("event_type").alias("action"),
                                           F.lpad(F.col("user_id").cast("string"), 4, "0").alias("movie"), "event_id")
    A.keyed_feed_write(ev.withColumn("v", F.lit("first")), path)
    A.keyed_feed_write(ev.filter(F.col("action") == "click").withColumn("v", F.lit("second")), path)
    A.keyed_feed_write(ev.filter(F.lit(False)).withColumn("v", F.lit("third")), path)   # empty: touches nothing
    back = A.read_keyed_feed(spark, path, "event_id bigint, v string, action string, movie string")
    return back.select("action", "movie", "event_id", "v")


@check("keyed_containers", """SELECT event_type AS action, lpad(CAST(user_id AS VARCHAR), 4, '0') AS movie, event_id,
  CASE WHEN event_type = 'click' THEN 'second' ELSE 'first' END AS v FROM events""")
def q_keyed_containers(spark, sf):
    """The same replacements as ``keyed_feed_write``, in 16 folders whatever the number of movies."""
    path = f"{scratch_path(spark, 'containers')}/feed"
    ev = table(spark, sf, "events").select(F.col("event_type").alias("action"),
                                           F.lpad(F.col("user_id").cast("string"), 4, "0").alias("movie"), "event_id")
    container_write(ev.withColumn("v", F.lit("first")), path, buckets=16)
    container_write(ev.filter(F.col("action") == "click").withColumn("v", F.lit("second")), path, buckets=16)
    container_write(ev.filter(F.lit(False)).withColumn("v", F.lit("third")), path, buckets=16)
    return container_read(spark, path).select("action", "movie", "event_id", "v")


@check("flatten_captured", """SELECT 'mc_general' AS feed, 'p-' || p_partkey AS movie, CAST(1 AS BIGINT) AS n, CAST(p_size AS BIGINT) AS total
FROM part WHERE p_partkey % 10 <> 0
UNION ALL SELECT 'mc_user_reviews', 'p-' || user_id, count(*), CAST(sum(least(10, floor(value / 10))) AS BIGINT) FROM events GROUP BY user_id
UNION ALL SELECT 'rt_critic_reviews', 'r_' || user_id, count(*), CAST(sum(event_id) AS BIGINT) FROM events GROUP BY user_id
UNION ALL SELECT 'rejects', 'p-' || p_partkey, 1, 0 FROM part WHERE p_partkey % 10 = 0""")
def q_flatten_captured(spark, sf):
    """Captured bodies of three kinds through the whole job: flattened, checked, written as feeds, loaded into bronze and counted."""
    from .ops_plan import rt_review_pages, user_review_pages
    root = scratch_path(spark, "captured")
    k = F.col("p_partkey").cast("string")
    whole = F.concat(F.lit('{"data": {"item": {"id": '), k, F.lit(', "title": "a\\u0007b", "duration": "'), F.col("p_size").cast("string"), F.lit('"}}}'))
    general = table(spark, sf, "part").select(
        F.lit("mc").alias("platform"), F.lit("general").alias("action"), F.concat(F.lit("p-"), k).alias("entity_id"), F.lit(0).cast("long").alias("page_no"),
        F.when(F.col("p_partkey") % 10 == 0, F.lit("<html>")).otherwise(whole).alias("body"))
    users = user_review_pages(spark, sf).select(F.lit("mc").alias("platform"), F.lit("user_reviews").alias("action"), "entity_id", "page_no", "body")
    critics = rt_review_pages(spark, sf).select(F.lit("rt").alias("platform"), F.lit("critic_reviews").alias("action"), "entity_id", "page_no", "body")
    globs = write_feeds(general.unionByName(users).unionByName(critics), f"{root}/feeds", f"{root}/rejects")
    value = {"mc_general": "duration", "mc_user_reviews": "score", "rt_critic_reviews": "review_id"}
    out = spark.read.parquet(f"{root}/rejects").select(F.lit("rejects").alias("feed"), F.col("entity_id").alias("movie"), F.lit(1).cast("long").alias("n"),
                                                       F.lit(0).cast("long").alias("total"))
    for feed, field in value.items():
        A.load_batch(spark, globs[feed], f"{root}/bronze/{feed}", json_lines=True)
        recs = unnest_records(A.read_bronze(spark, f"{root}/bronze/{feed}"), keep=("_source_file",))
        movie = F.regexp_extract("_source_file", r"movie=([^/]+)/", 1)
        out = out.unionByName(recs.groupBy(F.lit(feed).alias("feed"), movie.alias("movie")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.get_json_object("record", f"$.{field}").cast("long")).alias("total")))
    return out


@check("hot_key_feed_write", """SELECT CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE event_type END AS action, CAST(user_id AS VARCHAR) AS movie, event_id FROM events""")
def q_hot_key_feed_write(spark, sf):
    """A third of all rows under one action; all come back from the keyed folders."""
    path = f"{scratch_path(spark, 'hot_feed')}/feed"
    ev = table(spark, sf, "events").select(F.when(F.col("event_id") % 3 == 0, F.lit("hot")).otherwise(F.col("event_type")).alias("action"),
                                           F.col("user_id").cast("string").alias("movie"), "event_id")
    A.keyed_feed_write(ev, path)
    return A.read_keyed_feed(spark, path, "event_id bigint, action string, movie string").select("action", "movie", "event_id")


@check("discovered_slugs", """WITH recs AS (
  SELECT 'p-' || (p_partkey % 500) AS slug, p_partkey // 100 AS file, p_partkey % 100 AS pos FROM part
  UNION ALL SELECT 'p-' || (p_partkey % 700), 1000000 + p_partkey // 100, p_partkey % 100 FROM part)
SELECT row_number() OVER (ORDER BY min((lpad(CAST(file AS VARCHAR), 8, '0'), pos))) AS position, slug
FROM recs GROUP BY slug QUALIFY position <= 600""")
def q_discovered_slugs(spark, sf):
    """Two discovery passes over the catalogue written as files of 100 records (some titles
    carry a raw tab, which the lenient parser accepts); first 600 distinct slugs."""
    from ..operators.planning import discovered_slugs
    k = F.col("p_partkey")

    def pass_files(mod: int, base: int) -> DataFrame:
        p = table(spark, sf, "part").select(
            F.lpad((F.lit(base) + F.floor(k / 100)).cast("string"), 8, "0").alias("key"), (k % 100).alias("pos"),
            F.concat(F.lit('{"slug": "p-'), (k % mod).cast("string"), F.lit('", "method": "browse", "title": "'),
                     F.col("p_name"), F.when(k % 9 == 0, F.lit("\t")).otherwise(F.lit("")), F.lit('"}')).alias("rec"))
        return grouped_text(p, ["key"], "pos", F.col("rec"))
    files = pass_files(500, 0).unionByName(pass_files(700, 1000000)).select("key", F.col("data").alias("value"))
    glob = write_feed(files, scratch_path(spark, "discovered"))
    return discovered_slugs(A.read_feed(spark, glob), limit=600)


@check("keyed_feed_load", """SELECT event_type AS action, lpad(CAST(user_id AS VARCHAR), 4, '0') AS movie,
  count(*) AS n_records, CAST(sum(event_id) AS BIGINT) AS id_sum FROM events GROUP BY 1, 2""")
def q_keyed_feed_load(spark, sf):
    """Keyed feed (one JSON-lines output per action and movie) loaded into bronze, unnested."""
    root = scratch_path(spark, "keyed_feed_load")
    ev = table(spark, sf, "events").select(F.col("event_type").alias("action"),
                                           F.lpad(F.col("user_id").cast("string"), 4, "0").alias("movie"), "event_id")
    A.keyed_feed_write(ev, f"{root}/feed")
    A.load_batch(spark, f"{root}/feed/action=*/movie=*/*.json", f"{root}/bronze", f"{root}/rejects", json_lines=True)
    recs = unnest_records(A.read_bronze(spark, f"{root}/bronze"), keep=("_source_file",))
    keyed = recs.select(F.regexp_extract("_source_file", r"action=([^/]+)/", 1).alias("action"),
                        F.regexp_extract("_source_file", r"movie=([^/]+)/", 1).alias("movie"),
                        F.get_json_object("record", "$.event_id").cast("long").alias("event_id"))
    return keyed.groupBy("action", "movie").agg(F.count(F.lit(1)).alias("n_records"),
                                                F.sum("event_id").alias("id_sum"))


__all__ = ["CHECKS", "write_feed"]

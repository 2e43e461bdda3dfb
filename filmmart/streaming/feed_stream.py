"""A6, stream form: each version of a feed file is taken exactly once.

The stream's source hands out file versions (``versions.py``), so a file that a later crawl writes again is a new
row of the stream, and a broken version is rejected once, however often the job runs.
``trigger(availableNow=True)`` consumes everything present and stops, so a daily job is a
bounded run. Each micro-batch reads its files with Spark and writes its own
``load_id=stream-<id>-<batch>`` partition with overwrite (the id is
kept in the checkpoint), so a batch replayed after a failure replaces its output rather than
duplicating it, and another stream into the same table never touches it.
Rejected versions land in the rejects table with their text, from which ``replay_rejects`` reloads repaired content.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import child_dirs, make_dir
from ..sources import small_files as T
from ..sources.feeds import list_feed, literal_path, loaded_versions, read_feed, read_listed, read_rejects, to_bronze, write_tagged
from .versions import version_stream


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The stream's own id, kept beside its offsets: the same for every run on this checkpoint, another
    for any other checkpoint."""
    folder = f"{checkpoint.rstrip('/')}/load_stream_id"
    if not child_dirs(spark, folder):
        make_dir(spark, f"{folder}/{uuid.uuid4().hex}")
    return min(child_dirs(spark, folder))


def load_stream(spark: SparkSession, feed_dir: str, bronze_path: str, rejects_path: str, checkpoint: str,
                glob: str = "*.json", json_lines: bool = False) -> None:
    """Loads the file versions that the stream has not seen, in this folder and below it."""
    own = stream_id(spark, checkpoint)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        if T.by_tasks(spark, feed_dir):
            listed = T.kept_list(batch)
            if not listed.isEmpty():
                feed = read_listed(T.paths_as_uris(listed), json_lines)
                write_tagged(to_bronze(as_listed(feed, listed)), bronze_path, rejects_path, f"stream-{own}-{batch_id}")
            return
        listed = batch.collect()  # names and versions of new files, as Spark's file source holds them on the driver
        if listed:
            feed = read_feed(spark, [literal_path(r["path"]) for r in listed], json_lines)
            write_tagged(to_bronze(as_listed(feed, batch)), bronze_path, rejects_path, f"stream-{own}-{batch_id}")

    q = (version_stream(spark, feed_dir, f"{checkpoint.rstrip('/')}/versions", glob).writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def as_listed(feed: DataFrame, listed: DataFrame) -> DataFrame:
    """The files without those that were written again since they were listed: their new version has a row of its own to come."""
    newest = listed.groupBy("path").agg(F.max("modified").alias("_listed"))
    own = F.regexp_replace(F.try_url_decode(F.replace(F.col("_source_file"), F.lit("+"), F.lit("%2B"))), "^[a-z0-9]+:/+", "/")
    joined = feed.withColumn("_path", own).join(newest.select(F.regexp_replace("path", "^([a-z0-9]+:)?/*", "/").alias("_path"), "_listed"), "_path", "left")
    return joined.filter("_listed is null or _modified <= _listed").drop("_path", "_listed")


def replay_rejects(spark: SparkSession, pattern: str, rejects_path: str, bronze_path: str, load_id: str) -> None:
    """Reload files that were rejected and have been repaired since: the files whose path was rejected and whose present
    version is not in bronze, read again (still-broken files are simply rejected again)."""
    rejected = read_rejects(spark, rejects_path).select("_source_file").distinct()
    files = list_feed(spark, pattern).join(rejected, "_source_file", "left_semi")
    files = files.join(loaded_versions(spark, bronze_path), ["_source_file", "_modified", "_length"], "left_anti")
    if T.by_tasks(spark, pattern):
        todo = T.kept_list(files)
        if not todo.isEmpty():
            write_tagged(to_bronze(read_listed(todo)), bronze_path, None, load_id)
        return
    todo = [literal_path(r["_source_file"], encoded=True) for r in files.select("_source_file").collect()]
    if todo:
        write_tagged(to_bronze(read_feed(spark, todo)), bronze_path, None, load_id)


__all__ = ["stream_id", "load_stream", "replay_rejects"]

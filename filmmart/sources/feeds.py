"""Feed files -> bronze envelope tables.

Bronze layout: parquet under ``<root>/<table>``, partitioned by ``load_id``; every load
writes its own partition (``overwrite`` of that partition only), so a retried load
replaces its own output instead of appending a second copy.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from ..functions.jsonops import canonical_json, lines_as_array, reject_reason
from ..schemas import BRONZE_SCHEMA, BRONZE_TABLES, REJECT_SCHEMA
from ..session import child_dirs, make_dir, path_exists, remove_dir, scratch_path
from . import small_files as T

ENVELOPE = ["_loaded_at", "_source_file", "data"]
#: What tells one version of a feed file from the next at the same path.
VERSION = ["_modified", "_length"]
FEED_DDL = "_source_file string, value string, _modified timestamp, _length long"
LOADED_DDL = "_loaded_at timestamp, _source_file string, data string, _modified timestamp, _length long"
CURRENT = "_current"  # folder whose (latest) entry names the current version of a snapshot


def read_feed(spark: SparkSession, pattern: str | list[str], json_lines: bool = False) -> DataFrame:
    """A1: one row per file matching ``pattern`` (or per listed file): ``_source_file``, its whole
    text with undecodable bytes replaced, and the version that was read (``_modified``, ``_length``).
    No match gives an empty frame, not an error.
    ``json_lines``: files hold one document per line (e.g. written by ``keyed_feed_write``);
    each file's lines become one JSON array, the shape bronze stores."""
    if pattern and T.by_tasks(spark, pattern):
        return read_listed(T.list_files(spark, pattern), json_lines)
    try:
        raw = spark.read.text(pattern, wholetext=True) if pattern else spark.createDataFrame([], FEED_DDL)
        if not pattern:
            return raw
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], FEED_DDL)
        raise
    value = F.make_valid_utf8(F.col("value"))
    if json_lines:
        value = lines_as_array(value)
    return raw.select(F.col("_metadata.file_path").alias("_source_file"), value.alias("value"), *file_version())


def read_listed(files: DataFrame, json_lines: bool = False) -> DataFrame:
    """``read_feed`` of listed files (``_source_file``): names stay in the frame, tasks read the contents."""
    value = F.make_valid_utf8(F.col("content").cast("string"))
    if json_lines:
        value = lines_as_array(value)
    return T.read_files(files).select("_source_file", value.alias("value"), *VERSION)


def file_version() -> list[Column]:
    return [F.col("_metadata.file_modification_time").alias("_modified"), F.col("_metadata.file_size").alias("_length")]


def to_bronze(feed: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """A2-A4 in one projection: each file gets a reject ``reason`` (NULL when valid) and,
    when valid, its canonical JSON as ``data``; the raw text is kept for rejects only.
    Split with ``good`` / ``rejects``."""
    ts = loaded_at if loaded_at is not None else F.current_timestamp()
    version = [c for c in VERSION if c in feed.columns]
    parsed = feed.select(ts.cast("timestamp").alias("_loaded_at"), "_source_file", "value", *version, canonical_json("value").alias("data"))
    reason = reject_reason("value", "data")
    return parsed.select("_loaded_at", "_source_file", "data", reason.alias("reason"),
                         F.when(reason.isNotNull(), F.col("value")).alias("raw"), *version)


def good(tagged: DataFrame, version: bool = False) -> DataFrame:
    """The accepted files; ``version``: with what identifies the loaded version of each."""
    cols = [*ENVELOPE, *(c for c in VERSION if version and c in tagged.columns)]
    return tagged.filter(F.col("reason").isNull()).select(*cols)


def rejects(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("reason").isNotNull()).select("_loaded_at", "_source_file", "reason", "raw")


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """The envelope columns of a bronze table; an absent table reads as empty."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], BRONZE_SCHEMA)
    current = child_dirs(spark, f"{path.rstrip('/')}/{CURRENT}")
    if current:
        path = f"{path.rstrip('/')}/load_id={max(current)}"
    return spark.read.parquet(path).select(*ENVELOPE)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], REJECT_SCHEMA)
    return spark.read.parquet(path).select(*REJECT_SCHEMA.fieldNames())


def write_load(df: DataFrame, path: str, load_id: str) -> None:
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/load_id={load_id}")


def write_tagged(tagged: DataFrame, bronze_path: str, rejects_path: str | None, load_id: str) -> None:
    """Good rows to bronze, rejects to their table; the tagged input is cached around the
    two writes so the feed is read once (it is also recomputable from the files)."""
    tagged = tagged.persist()
    try:
        write_load(good(tagged, version=True), bronze_path, load_id)
        if rejects_path:
            write_load(rejects(tagged), rejects_path, load_id)
    finally:
        tagged.unpersist()


def list_feed(spark: SparkSession, pattern: str) -> DataFrame:
    """The files matching ``pattern`` with their versions; no content is read."""
    if T.by_tasks(spark, pattern):
        return T.list_files(spark, pattern)
    try:
        files = spark.read.format("binaryFile").load(pattern)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], "_source_file string, _modified timestamp, _length long")
        raise
    return files.select(F.col("_metadata.file_path").alias("_source_file"), F.col("modificationTime").alias("_modified"),
                        F.col("length").alias("_length"))


def loaded_versions(spark: SparkSession, bronze_path: str) -> DataFrame:
    """Files in bronze with the version that was loaded (NULL where it was not noted)."""
    if not path_exists(spark, bronze_path):
        return spark.createDataFrame([], LOADED_DDL).select("_source_file", *VERSION)
    return spark.read.schema(LOADED_DDL).parquet(bronze_path).select("_source_file", *VERSION).distinct()


def literal_path(path: str, encoded: bool = False) -> str:
    """A file's name as a pattern that matches it alone. ``encoded``: it comes from file metadata, with %-escapes."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", unquote(path) if encoded else path)


def files_to_load(spark: SparkSession, pattern: str, bronze_path: str) -> DataFrame:
    """The files to load: those whose version (path, modification time, length) is not in bronze.
    A file rewritten by a new crawl is a new version. Rejected files never reach bronze, so they are
    offered again on the next load. Only names and versions are compared."""
    files, loaded = list_feed(spark, pattern), loaded_versions(spark, bronze_path)
    known = loaded.select(F.col("_source_file").alias("_f"), F.col("_modified").alias("_m"), F.col("_length").alias("_l"))
    same = (F.col("_source_file") == F.col("_f")) & (F.col("_m").isNull() | (F.col("_m") == F.col("_modified"))) & (
        F.col("_l").isNull() | (F.col("_l") == F.col("_length")))
    return files.join(known, same, "left_anti")


def new_files(spark: SparkSession, pattern: str, bronze_path: str) -> list[str]:
    """The names of ``files_to_load`` on the driver, each as a pattern that matches it alone."""
    return [literal_path(r["_source_file"], encoded=True) for r in files_to_load(spark, pattern, bronze_path).select("_source_file").collect()]


def load_batch(spark: SparkSession, pattern: str, bronze_path: str, rejects_path: str | None = None,
               loaded_at: Column | None = None, only_new: bool = True, load_id: str | None = None,
               json_lines: bool = False) -> str:
    """Append the feed files to bronze (only versions not loaded before unless
    ``only_new=False``, which appends duplicates as the reference accepts). Returns the load id;
    a run that finds nothing new writes nothing."""
    load_id = load_id or uuid.uuid4().hex
    if only_new and T.by_tasks(spark, pattern):
        todo = T.kept_list(files_to_load(spark, pattern, bronze_path))
        if todo.isEmpty() and path_exists(spark, bronze_path):
            return load_id
        feed = read_listed(todo, json_lines)
    elif only_new:
        todo = new_files(spark, pattern, bronze_path)
        if not todo and path_exists(spark, bronze_path):
            return load_id
        feed = read_feed(spark, todo, json_lines)
    else:
        feed = read_feed(spark, pattern, json_lines)
    write_tagged(to_bronze(feed, loaded_at), bronze_path, rejects_path, load_id)
    return load_id


def replace_snapshot(spark: SparkSession, pattern: str, bronze_path: str, loaded_at: Column | None = None,
                     json_lines: bool = False, keep: int = 1) -> str:
    """Replace a snapshot table only with a fully valid new version.

    A missing or broken file keeps the old content. The feed is read once, into a written copy from which it is
    judged and loaded, so a file that changes meanwhile can't be judged in one state and loaded in another. The new version is a new
    ``load_id`` partition; readers follow the pointer in ``_current``, which is set last, in one
    step: they see the old version whole or the new one whole, also if the job dies in between.
    ``keep`` earlier versions stay for readers still on them, older ones are dropped. Returns ``replaced`` or the reason the old
    content was kept."""
    staged = rebuild_table(to_bronze(read_feed(spark, pattern, json_lines), loaded_at), scratch_path(spark, "snapshot"))
    stats = staged.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("reason").isNotNull()).alias("bad")).first()
    if stats["n"] == 0:
        return "kept: no file"
    if stats["bad"] > 0:
        return "kept: malformed JSON"
    version = f"snapshot-{time.time_ns():020d}-{uuid.uuid4().hex}"
    root = bronze_path.rstrip("/")
    old, pointers = child_dirs(spark, root, "load_id="), child_dirs(spark, f"{root}/{CURRENT}")
    write_load(good(staged), root, version)
    make_dir(spark, f"{root}/{CURRENT}/{version}")
    for name in pointers:
        remove_dir(spark, f"{root}/{CURRENT}/{name}")
    if pointers:  # what came after the last pointer was never served
        served = sorted(n for n in old if n <= f"load_id={max(pointers)}")
        for name in set(old) - set(served[len(served) - keep:] if keep else ()):
            remove_dir(spark, f"{root}/{name}")
    return "replaced"


def bootstrap(spark: SparkSession, root: str, tables: Sequence[str] = BRONZE_TABLES) -> list[str]:
    """Every bronze table exists (empty if it was absent). Returns the tables created."""
    made = []
    for t in tables:
        p = f"{root.rstrip('/')}/{t}"
        if not path_exists(spark, p):
            # same layout as a load: one load_id partition (here empty)
            write_load(spark.createDataFrame([], BRONZE_SCHEMA), p, "bootstrap")
            made.append(t)
    return made


def read_bronze_root(spark: SparkSession, root: str, tables: Sequence[str] = BRONZE_TABLES) -> dict[str, DataFrame]:
    return {t: read_bronze(spark, f"{root.rstrip('/')}/{t}") for t in tables}


def rebuild_table(df: DataFrame, path: str, observe: dict[str, Column] | None = None) -> DataFrame | tuple[DataFrame, dict]:
    """Full rebuild (overwrite) and the written table read back. ``observe``: aggregates gathered by the write itself; they
    are returned with the table."""
    if not observe:
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return df.sparkSession.read.parquet(path)
    notes = Observation()
    df.observe(notes, *[c.alias(name) for name, c in observe.items()]).write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path), notes.get


def read_inferred_json(spark: SparkSession, pattern: str, schema: str | None = None) -> DataFrame:
    """A10: JSON documents spanning lines (arrays of records) with an inferred schema."""
    reader = spark.read.option("multiLine", True)
    if schema:
        reader = reader.schema(schema)
    if T.by_tasks(spark, pattern):
        files = T.kept_list(T.list_files(spark, pattern))
        if not files.isEmpty():
            return reader.json(T.decoded(T.read_files(files)).rdd.map(lambda r: r["value"]))
    return reader.json(pattern)


def keyed_feed_write(df: DataFrame, path: str, keys: Sequence[str] = ("action", "movie"), packed: bool = False) -> None:
    """One output per key, rewritten whole; keys absent from ``df`` are untouched
    (dynamic partition overwrite), and an empty ``df`` writes nothing. ``packed``: on a mounted file system the outputs of many
    keys share files, from which this module's readers take them by the same paths."""
    # Rebalanced, not repartitioned: a hot key is split into several files of its folder.
    if T.by_tasks(df.sparkSession, path):
        fields = F.to_json(F.struct(*[c for c in df.columns if c not in keys]))
        return T.write_folders(df.select(*keys, fields.alias("_line")).hint("rebalance", *keys), path, list(keys), F.col("_line"), ".json", packed=packed)
    (df.hint("rebalance", *keys).write.partitionBy(*keys).mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").json(path))


def read_keyed_feed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read back with the key columns typed by ``schema`` (a slug made of digits stays text)."""
    if T.by_tasks(spark, path) and path_exists(spark, path):
        wanted, keys = spark.createDataFrame([], schema).schema, T.folder_keys(spark, path)
        if set(keys) <= set(wanted.names) or T.in_packs(spark, path):
            own = StructType([f for f in wanted if f.name not in keys])
            read = T.read_folders(spark, path).select(F.from_json("line", own).alias("_r"), "keys")
            return read.select("_r.*", *[F.col("keys")[k].cast(wanted[k].dataType if k in wanted.names else "string").alias(k) for k in keys])
    return spark.read.schema(schema).json(path)


__all__ = ["read_feed", "to_bronze", "good", "rejects", "read_bronze", "read_rejects", "write_tagged", "write_load",
           "new_files", "files_to_load", "read_listed", "literal_path", "list_feed", "loaded_versions", "file_version", "load_batch", "replace_snapshot", "bootstrap", "read_bronze_root", "rebuild_table",
           "read_inferred_json", "keyed_feed_write", "read_keyed_feed", "ENVELOPE"]

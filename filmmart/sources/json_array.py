"""A1 for files of any size: a JSON array file read by many tasks, element by element.

A file is cut into byte ranges. Where a range begins inside a string or an element cannot be seen from its
own bytes, so a first pass notes for each range what it does to a reader in any state (outside a string,
inside one, behind a backslash): the state after it and the change of depth. Composed over the ranges of a
file (one small row each) that gives the exact state at each range's first byte. The second pass finds the
commas at depth one and yields the elements whose leading comma or bracket lies in its range, reading on
past the range's end for the last one. Quotes, braces and commas inside strings are therefore never
mistaken for structure, wherever a range is cut.

Files are opened by path in the tasks (local, S3, GCS, HDFS where its native library is installed). Text beside the array, unclosed
strings or brackets and elements that are no JSON reject the whole file, as for files read whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsonops import canonical_json, reject_reason
from ..session import path_exists, scratch_path
from .feeds import ENVELOPE, VERSION, list_feed, new_files, write_load

RANGE_BYTES = 16 << 20
CHUNK_BYTES = 8 << 20  # of elements in a bronze row
OUTSIDE, INSIDE, BACKSLASH = 0, 1, 2  # reader states
_QUOTE, _SLASH, _COMMA, _OPEN, _CLOSE = 0x22, 0x5C, 0x2C, 0x5B, 0x5D
_WHITE = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0D])
_STEP = np.zeros(256, dtype=np.int8)
_STEP[[0x5B, 0x7B]] = 1   # [ {
_STEP[[0x5D, 0x7D]] = -1  # ] }


# ---- one range

def _quotes(raw: np.ndarray, escaped: bool) -> tuple[np.ndarray, bool]:
    """Where strings begin or end, and whether the last byte is a backslash that escapes the next one.
    ``escaped``: the first byte is taken literally."""
    slash = raw == _SLASH
    if escaped and len(raw):
        slash[0] = False
    quote = raw == _QUOTE
    if escaped and len(raw):
        quote[0] = False
    if not slash.any():
        return quote, False
    # A byte is escaped behind an odd number of backslashes in a row.
    at = np.arange(len(raw))
    last_other = np.maximum.accumulate(np.where(slash, -1, at))
    odd = slash & ((at - last_other) % 2 == 1)
    quote[1:] &= ~odd[:-1]
    return quote, bool(odd[-1])


def range_effect(raw: bytes) -> list[tuple[int, int]]:
    """For each state before: the state after and the change of depth."""
    a = np.frombuffer(raw, dtype=np.uint8)
    if not len(a):
        return [(s, 0) for s in (OUTSIDE, INSIDE, BACKSLASH)]
    out = []
    for before in (OUTSIDE, INSIDE, BACKSLASH):
        quote, escaping = _quotes(a, before == BACKSLASH)
        inside = (np.cumsum(quote) + (before != OUTSIDE)) % 2 == 1
        depth = int(_STEP[a][~inside].sum())
        out.append((BACKSLASH if inside[-1] and escaping else INSIDE if inside[-1] else OUTSIDE, depth))
    return out


class Malformed(ValueError):
    pass


def _marks(raw: bytes, state: int, depth: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Places of top-level brackets and commas, the places that hold text beside the array, and state and depth after."""
    a = np.frombuffer(raw, dtype=np.uint8)
    quote, escaping = _quotes(a, state == BACKSLASH)
    inside = (np.cumsum(quote) + (state != OUTSIDE)) % 2 == 1
    structural = ~(inside | quote)
    step = np.where(structural, _STEP[a], 0)
    after = depth + np.cumsum(step, dtype=np.int64)
    before = after - step
    opens, closes = (before == 0) & (step == 1), (after == 0) & (step == -1)
    comma = structural & (a == _COMMA) & (after == 1)
    # Outside the array there is white space only, and it begins and ends with square brackets.
    beside = (after == 0) & (before == 0) & ~_WHITE[a] | (after < 0) | (opens & (a != _OPEN)) | (closes & (a != _CLOSE))
    last = BACKSLASH if inside[-1] and escaping else INSIDE if inside[-1] else OUTSIDE
    return np.flatnonzero(opens | closes | comma), np.flatnonzero(beside), last, int(after[-1])


def elements(read, start: int, end: int, size: int, state: int, depth: int) -> Iterator[tuple[int, bytes, bool]]:
    """(offset, text, whether the array opens before it) of the elements that a bracket or comma in [start, end) precedes.
    ``read(a, b)`` gives bytes of the file. An empty array gives one empty text."""
    raw = read(start, end)
    places, beside, state, depth = _marks(raw, state, depth)
    if len(beside):
        raise Malformed("text beside the array")
    at = places.tolist()
    for p, q in zip(at, [*at[1:], None], strict=False):
        if raw[p] == _CLOSE:
            continue
        opens = raw[p] == _OPEN
        if q is not None:
            yield start + p + 1, raw[p + 1:q], opens
            continue
        held, pos = [raw[p + 1:]], end
        while pos < size:  # the last one goes on behind the range
            more = read(pos, min(size, pos + max(1 << 16, end - start)))
            places, _, state, depth = _marks(more, state, depth)
            if len(places):
                yield start + p + 1, b"".join([*held, more[:places[0]]]), opens
                return
            held.append(more)
            pos += len(more)
        raise Malformed("the array is not closed")


# ---- files

def _opened(path: str):
    """The file's random-access handle."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem().open_input_file(unquote("/" + path[len("file:"):].lstrip("/")))
    if "://" in path:
        system, at = pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
        return system.open_input_file(at)
    return pafs.LocalFileSystem().open_input_file(path)


def _reader(handle):
    def read(a: int, b: int) -> bytes:
        return handle.read_at(b - a, a)
    return read


_EFFECT = pa.schema([("path", pa.string()), ("start", pa.int64()), ("to", pa.list_(pa.int32())), ("change", pa.list_(pa.int64()))])
_FOUND = pa.schema([("path", pa.string()), ("modified", pa.timestamp("us", "UTC")), ("length", pa.int64()), ("offset", pa.int64()),
                    ("value", pa.binary()), ("opens", pa.int32()), ("error", pa.string())])


def _ranges(files: DataFrame, range_bytes: int) -> DataFrame:
    last = F.greatest(F.col("_length") - 1, F.lit(0)).cast("long")
    cut = files.select(F.col("_source_file").alias("path"), F.col("_modified").alias("modified"), F.col("_length").alias("length"),
                       F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(range_bytes).cast("long"))).alias("start"))
    return cut.withColumn("end", F.least(F.col("start") + range_bytes, F.col("length")))


def _effects(batches):
    for b in batches:
        for r in b.to_pylist():
            with _opened(r["path"]) as f:
                effect = range_effect(f.read_at(r["end"] - r["start"], r["start"]))
            yield pa.RecordBatch.from_pylist([{"path": r["path"], "start": r["start"], "to": [e[0] for e in effect], "change": [e[1] for e in effect]}],
                                             schema=_EFFECT)


def _composed(pdf: pd.DataFrame) -> pd.DataFrame:
    """State and depth before each range of one file: a small row per range."""
    pdf = pdf.sort_values("start")
    state, depth, states, depths = OUTSIDE, 0, [], []
    for to, change in zip(pdf["to"], pdf["change"], strict=True):
        states.append(state)
        depths.append(depth)
        state, depth = int(to[state]), depth + int(change[state])
    whole = state == OUTSIDE and depth == 0
    return pd.DataFrame({"path": pdf["path"].to_numpy(), "start": pdf["start"].to_numpy(), "state": states, "depth": depths, "whole": whole})


def _arrays(chunk_bytes: int):
    """Rows with an array of successive elements each, of about ``chunk_bytes``."""
    def row(r: dict, offset: int, texts: list, opens: int, error: str | None = None) -> pa.RecordBatch:
        value = b"[" + b",".join(texts) + b"]" if error is None else None
        return pa.RecordBatch.from_pylist([{**{k: r[k] for k in ("path", "modified", "length")}, "offset": offset, "value": value,
                                            "opens": opens, "error": error}], schema=_FOUND)

    def found(batches):
        for b in batches:
            for r in b.to_pylist():
                texts, size, first, opens = [], 0, r["start"], 0
                try:
                    if not r["whole"]:
                        raise Malformed("the array is not closed" if r["length"] else "empty file")
                    with _opened(r["path"]) as f:
                        for offset, text, opening in elements(_reader(f), r["start"], r["end"], r["length"], r["state"], r["depth"]):
                            if size > chunk_bytes:
                                yield row(r, first, texts, opens)
                                texts, size, opens = [], 0, 0
                            first = offset if not texts else first
                            texts.append(text)
                            size, opens = size + len(text), opens + opening
                except Malformed as e:
                    yield row(r, r["start"], [], 0, str(e))
                    continue
                if texts or not r["start"]:  # each file has a row, also if it is blank
                    yield row(r, first, texts, opens)
    return found


def read_array_feed(spark: SparkSession, pattern: str | list[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The files' JSON arrays in pieces: ``_source_file``, ``value`` (a JSON array of successive elements as written, undecodable
    bytes replaced), ``_modified``, ``_length``, ``_offset`` (byte of its first element), ``opens`` and ``error`` (NULL, or
    why the file is malformed; such a row has no value). A file is one array if its rows have no error and ``opens`` adds up to 1."""
    ranges = _ranges(list_feed(spark, pattern), range_bytes).repartition("path", "start")
    noted = scratch_path(spark, "array-ranges")
    ranges.mapInArrow(_effects, "path string, start long, to array<int>, change array<long>").write.parquet(noted)
    states = spark.read.parquet(noted).groupBy("path").applyInPandas(_composed, "path string, start long, state int, depth long, whole boolean")
    known = ranges.join(states, ["path", "start"]).repartition("path", "start")
    # Empty files have a range without bytes, and are not whole.
    known = known.withColumn("whole", F.col("whole") & (F.col("length") > 0))
    found = known.mapInArrow(_arrays(CHUNK_BYTES), "path string, modified timestamp, length long, offset long, value binary, opens int, error string")
    return found.select(F.col("path").alias("_source_file"), F.make_valid_utf8(F.col("value").cast("string")).alias("value"),
                        F.col("modified").alias("_modified"), F.col("length").alias("_length"), F.col("offset").alias("_offset"), "opens", "error")


def load_arrays(spark: SparkSession, pattern: str, bronze_path: str, rejects_path: str | None = None, loaded_at: Column | None = None,
                only_new: bool = True, load_id: str | None = None, range_bytes: int = RANGE_BYTES) -> str:
    """A5/A6 for array files of any size: bronze gets a row per piece of a file, with the file's envelope. A file is accepted or
    rejected whole: one malformed piece anywhere rejects it (its text, which may be of any size, is not copied to the rejects)."""
    load_id = load_id or uuid.uuid4().hex
    todo = new_files(spark, pattern, bronze_path) if only_new else pattern
    if not todo and path_exists(spark, bronze_path):
        return load_id
    ts = loaded_at if loaded_at is not None else F.current_timestamp()
    pieces = read_array_feed(spark, todo, range_bytes)
    staged = scratch_path(spark, "array-pieces")
    parsed = pieces.withColumn("data", canonical_json("value")).withColumn("error", F.coalesce("error", reject_reason("value", "data")))
    parsed.select(ts.cast("timestamp").alias("_loaded_at"), "_source_file", *VERSION, "_offset", "opens", "error", "data").write.parquet(staged)
    pieces = spark.read.parquet(staged)
    reason = F.when(F.count("error") > 0, F.min("error")).when(F.sum("opens") != 1, F.lit("malformed JSON"))
    verdicts = pieces.groupBy("_source_file").agg(F.min("_loaded_at").alias("_loaded_at"), reason.alias("reason"))
    broken = verdicts.filter("reason is not null")
    good = pieces.join(broken.select("_source_file"), "_source_file", "left_anti").select(*ENVELOPE, *VERSION)
    write_load(good, bronze_path, load_id)
    if rejects_path:
        write_load(broken.select("_loaded_at", "_source_file", "reason", F.lit(None).cast("string").alias("raw")), rejects_path, load_id)
    return load_id


__all__ = ["read_array_feed", "load_arrays", "range_effect", "elements", "Malformed"]

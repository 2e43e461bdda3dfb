"""Removal of passages of ``length`` bytes (400 unless given) that occur more than once, by a family of suffix arrays.

The suffixes that are indexed start at the minimisers of each text: in every window of ``length``
bytes, the start of its ``PREFIX``-byte piece with the smallest hash. Two equal windows
have the same minimiser at the same place, so a match of ``length`` bytes can't be missed. A suffix
array keeps these suffixes in the order of the hash of their first ``PREFIX`` bytes (equal prefixes
stand together; no other property of the order is used). A new batch gets its own array, is
merge-scanned against every level of the index for prefixes in common, and enters the index as a
level of rank 0; two levels of one rank merge into one of the next, so that a row is rewritten
once per doubling. Suffixes with a prefix in common are then compared in full: the windows of
``length`` bytes that a minimiser stands for are hashed, equal ones found by sorting,
within one task per prefix; a prefix with more than ``GROUP`` suffixes is dealt to several
tasks, and what stays single in one of them is compared over all of them by window hash.

Edge cases: a null text is empty; texts under ``length`` bytes lose nothing; identical texts lose
all they have (if long enough), rows alike included; a null doc_id is kept as it is; an empty table
gives an empty result; extra columns are ignored, and ``remove_repeats`` keeps them.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_bytes, materialize, mix, prepare, read_table, unused

LENGTH = 400
PREFIX = 96
BATCHES = 4
GROUP = 2000
CHUNK = 1 << 20
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

_RNG = np.random.default_rng(400)
_BYTE = _RNG.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if len(_POWERS.get("up", ())) < n:
        for name, b in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            p = np.full(n, b, dtype=np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def piece_hashes(sums: np.ndarray, length: int) -> np.ndarray:
    """Hash of each piece of ``length`` bytes, from running sums."""
    n = len(sums) - length
    return mix((sums[length:] - sums[:n]) * _powers(len(sums))[1][:n])


def running_sums(raw: np.ndarray) -> np.ndarray:
    out = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[raw] * _powers(len(raw) + 1)[0][:len(raw)], out=out[1:])
    return out


def _sliding(values: np.ndarray, width: int, of) -> np.ndarray:
    """of (np.minimum or np.maximum) over each run of ``width`` values."""
    n = len(values)
    edge = np.iinfo(np.uint64).max if of is np.minimum else 0
    padded = np.full(-(-n // width) * width, edge, dtype=np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = of.accumulate(blocks, axis=1).ravel()
    behind = of.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return of(behind[:n - width + 1], ahead[width - 1:n])


def _slices(texts: list, length: int):
    """(text number, first byte, bytes) with each window start in exactly one slice of at most about CHUNK bytes."""
    for i, t in enumerate(texts):
        if t is None or len(t) < length:
            continue
        last = len(t) - length + 1
        for a in range(0, last, CHUNK):
            yield i, a, t[a:min(a + CHUNK, last) + length - 1]


def minimisers(texts: list, length: int = LENGTH):
    """Yields, per chunk of slices: slice owners and offsets, bounds, bytes, prefix hashes, window minima, minimiser positions."""
    width = length - PREFIX + 1  # prefix positions in a window
    slices = list(_slices(texts, length))
    for lo, hi in by_bytes([s[2] for s in slices], CHUNK):
        part = slices[lo:hi]
        raw = np.frombuffer(b"".join(s[2] for s in part), dtype=np.uint8)
        ends = np.cumsum([len(s[2]) for s in part])
        starts = np.concatenate([[0], ends[:-1]])
        sums = running_sums(raw)
        h = piece_hashes(sums, PREFIX) | np.uint64(1)  # never 0
        low = _sliding(h, width, np.minimum)
        for e in ends[:-1]:  # windows over a slice's end are none
            low[max(0, e - length + 1):e] = 0
        padded = np.zeros(len(low) + 2 * (width - 1), dtype=np.uint64)
        padded[width - 1:width - 1 + len(low)] = low
        at = np.flatnonzero(_sliding(padded, width, np.maximum) == h[:len(low) + width - 1])
        owner = np.searchsorted(ends, at, side="right")
        yield part, starts, raw, h, low, at, owner


_INDEX = pa.schema([("batch", pa.int32()), ("key", pa.int64()), ("uid", pa.int64()), ("n", pa.int32())])


def _counted(rows: np.ndarray, uids: np.ndarray) -> pa.RecordBatch:
    """rows (text number, place, key) of whole texts -> key, uid and the places of the key in that text."""
    # A place next to the end of a slice may come from both slices.
    _, once = np.unique(rows[0] << 40 | rows[1], return_index=True)
    pairs, n = np.unique(rows[::2, once], axis=1, return_counts=True) if len(once) else (np.zeros((2, 0), np.int64), [])
    uid = uids[pairs[0]]
    return pa.RecordBatch.from_arrays(
        [pa.array(uid % BATCHES, pa.int32()), pa.array(pairs[1]), pa.array(uid), pa.array(n, pa.int32())], schema=_INDEX)


def _index_rows(batches, length: int = LENGTH):
    for b in batches:
        texts, uids = b.column("text").cast(pa.binary()).to_pylist(), b.column("uid").to_numpy()
        held = np.zeros((3, 0), np.int64)  # of the text whose slices may go on in the next chunk
        for part, starts, _, h, _, at, owner in minimisers(texts, length):
            number, first = (np.array([s[k] for s in part], dtype=np.int64) for k in (0, 1))
            rows = np.concatenate([held, np.stack([number[owner], at - starts[owner] + first[owner], h[at].view(np.int64)])], axis=1)
            whole = rows[0] < number[-1]
            yield _counted(rows[:, whole], uids)
            held = rows[:, ~whole]
        yield _counted(held, uids)


class SuffixIndex:
    """Levels of sorted suffix rows (key, uid, n: places of the key in that text) in the shared scratch folder."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.levels: list[tuple[int, DataFrame]] = []
        self.hits: list[DataFrame] = []

    def _array(self, rows: DataFrame) -> DataFrame:
        rows = rows.groupBy("key", "uid").agg(F.max("n").alias("n"))
        return materialize(self.spark, rows.sortWithinPartitions("key"), "suffix-level")

    def add(self, rows: DataFrame) -> None:
        """A new batch: its suffix array, its repeats within itself and with each level, then the merges."""
        array, rank = self._array(rows), 0
        own = array.groupBy("key").agg((F.count(F.lit(1)) + F.max("n")).alias("places")).filter("places > 2").select("key")
        found = [own, *(array.join(level, "key", "left_semi").select("key") for _, level in self.levels)]
        hits = found[0]
        for f in found[1:]:
            hits = hits.unionByName(f)
        self.hits.append(materialize(self.spark, hits.distinct(), "suffix-hits"))
        while any(r == rank for r, _ in self.levels):
            other = next(d for r, d in self.levels if r == rank)
            self.levels = [x for x in self.levels if x[0] != rank]
            array, rank = self._array(array.unionByName(other)), rank + 1
        self.levels.append((rank, array))

    def repeated(self) -> DataFrame:
        """key, uid, places (suffixes with that key over all texts) of all suffixes whose prefix is found twice."""
        hits = self.hits[0]
        for f in self.hits[1:]:
            hits = hits.unionByName(f)
        hits = materialize(self.spark, hits.distinct(), "suffix-hits")
        rows = self.levels[0][1]
        for _, level in self.levels[1:]:
            rows = rows.unionByName(level)
        rows = materialize(self.spark, rows.join(hits, "key"), "suffix-repeated")
        places = materialize(self.spark, rows.groupBy("key").agg(F.sum("n").alias("places")), "suffix-places")
        return rows.select("key", "uid").join(places, "key")


_CONTEXT = pa.schema([("key", pa.int64()), ("salt", pa.int32()), ("sha", pa.binary()), ("first", pa.int64()), ("context", pa.binary())])


def _contexts(batches, length: int):
    """For each suffix in a text's list of keys: the bytes of the windows that it stands for."""
    for b in batches:
        texts, shas, keys = b.column("text").cast(pa.binary()).to_pylist(), b.column("sha").to_pylist(), b.column("keys").to_pylist()
        wanted = [{k["key"]: k["salt"] for k in ks} for ks in keys]
        for part, starts, raw, h, low, at, owner in minimisers(texts, length):
            value = h[at].view(np.int64)
            out: list = [[], [], [], [], []]
            for k, (i, first, _) in enumerate(part):
                mine = np.flatnonzero(owner == k) if len(part) > 1 else np.arange(len(at))
                names = wanted[i]
                mine = mine[np.isin(value[mine], np.fromiter(names, np.int64, len(names)))]
                last: dict = {}
                for m in mine:
                    p, v = int(at[m]), int(value[m])
                    lo = max(int(starts[k]), p - (length - PREFIX))
                    same = np.flatnonzero(low[lo:p + 1] == h[p])
                    if v in last:  # a window with the minimum twice belongs to the first
                        same = same[same + lo > last[v]]
                    last[v] = p
                    if not len(same):
                        continue
                    s, z = lo + int(same[0]), lo + int(same[-1])
                    for col, x in zip(out, (v, names[v], shas[i], first + s - int(starts[k]), raw[s:z + length].tobytes()), strict=True):
                        col.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _CONTEXT, strict=True)], schema=_CONTEXT)


_RUNS = pa.schema([("sha", pa.binary()), ("lo", pa.int64()), ("hi", pa.int64()), ("window", pa.int64()), ("n", pa.int32())])


def _equal_windows(rows: list, hot: bool, length: int) -> list:
    """rows (sha, first, context) of one prefix -> (sha, lo, hi, None, None) for runs of repeated
    window starts; for a part of a hot prefix also (sha, start, start, hash, 1) for each
    window that is single here and (None, None, None, hash, 2) for each that is not."""
    rows = list({(sha, first): (sha, first, c) for sha, first, c in rows}.values())
    out = []
    if len(rows) < 2 and not hot and len(rows[0][2]) < length + 1:
        return out
    hashes = [piece_hashes(running_sums(np.frombuffer(c, dtype=np.uint8)), length) for _, _, c in rows]
    flat = np.concatenate(hashes)
    values, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    at = 0
    for (sha, first, _), own in zip(rows, hashes, strict=True):
        mark = again[at:at + len(own)]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], mark, [False]]).astype(np.int8)))
        out.extend((sha, first + int(a), first + int(z) - 1, None, None) for a, z in zip(edges[::2], edges[1::2], strict=True))
        if hot:
            signed = own.view(np.int64)
            out.extend((sha, first + int(j), first + int(j), int(signed[j]), 1) for j in np.flatnonzero(~mark))
        at += len(own)
    if hot:
        out.extend((None, None, None, int(v), 2) for v in values[counts > 1].view(np.int64))
    return out


def _compare(batches, length: int):
    """Rows come sorted by key and salt; a group may span batches."""
    group, rows, out = None, [], []

    def flush():
        cols = list(zip(*out, strict=True)) if out else [[]] * 5
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _RUNS, strict=True)], schema=_RUNS)
        out.clear()
        return batch

    for b in batches:
        for key, salt, sha, first, context in zip(*(b.column(c).to_pylist() for c in _CONTEXT.names), strict=True):
            if group != (key, salt):
                if rows:
                    out.extend(_equal_windows(rows, group[1] >= 0, length))
                group, rows = (key, salt), []
                if len(out) > 50_000:
                    yield flush()
            rows.append((sha, first, context))
    if rows:
        out.extend(_equal_windows(rows, group[1] >= 0, length))
    yield flush()


def _cut(text: bytes, spans: list, length: int) -> tuple[bytes, int, int]:
    """What is left without the windows that start in ``spans``; removed bytes and runs."""
    gone = np.zeros(len(text) + 1, dtype=np.int32)
    for s in spans:
        gone[s["lo"]] += 1
        gone[s["hi"] + length] -= 1
    mask = np.cumsum(gone[:-1]) > 0
    runs = int(np.count_nonzero(np.diff(np.concatenate([[False], mask]).astype(np.int8)) == 1))
    return np.frombuffer(text, dtype=np.uint8)[~mask].tobytes(), int(mask.sum()), runs


_CUT = pa.schema([("sha", pa.binary()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def _cut_rows(batches, length: int):
    for b in batches:
        shas, texts, spans = b.column("sha").to_pylist(), b.column("text").cast(pa.binary()).to_pylist(), b.column("spans").to_pylist()
        got = [_cut(t, s, length) for t, s in zip(texts, spans, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(shas, pa.binary()), pa.array([g[1] for g in got], pa.int64()), pa.array([g[2] for g in got], pa.int64()),
             pa.array([hashlib.sha256(g[0]).hexdigest() for g in got])], schema=_CUT)


def _sha(col="text"):
    return F.unhex(F.sha2(F.coalesce(F.col(col).cast("binary"), F.lit(b"")), 256))


def find_repeats(docs: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame, DataFrame]:
    """light: doc_id, sha, n_bytes per row; classes: sha, rep, copies per distinct text; and
    spans: sha, text, spans (runs of window starts) of the texts with a repeated window
    that share a prefix with another suffix."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select("doc_id", "text")
    light = materialize(spark, docs.select(
        "doc_id", _sha().alias("sha"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.xxhash64("text").alias("uid")), "suffix-light")
    classes = materialize(spark, light.groupBy("sha").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.min("uid").alias("uid")), "suffix-classes")
    rows = docs.filter(F.octet_length("text") >= length).select(F.xxhash64("text").alias("uid"), "text")
    rows = materialize(spark, rows.mapInArrow(partial(_index_rows, length=length), "batch int, key long, uid long, n int"), "suffix-rows")
    index = SuffixIndex(spark)
    for b in range(BATCHES):
        index.add(rows.filter(F.col("batch") == b).select("key", "uid", "n"))
    # A hot prefix is dealt to as many tasks as it has groups; salt -1: all in one.
    salt = F.when(F.col("places") <= GROUP, F.lit(-1)).otherwise(
        F.pmod(F.xxhash64("uid"), F.ceil(F.col("places") / GROUP)).cast("int")).alias("salt")
    keys = index.repeated().select("uid", F.struct("key", salt).alias("k")).groupBy("uid").agg(F.collect_list("k").alias("keys"))
    keys = keys.join(classes.select("uid", "sha", "rep"), "uid")
    held = docs.join(keys, docs["doc_id"].eqNullSafe(keys["rep"])).filter(_sha() == F.col("sha")).select("sha", "keys", "text")
    held = materialize(spark, held, "suffix-texts")
    contexts = held.mapInArrow(partial(_contexts, length=length), "key long, salt int, sha binary, first long, context binary")
    runs = contexts.repartition("key", "salt").sortWithinPartitions("key", "salt").mapInArrow(
        partial(_compare, length=length), "sha binary, lo long, hi long, window long, n int")
    runs = materialize(spark, runs, "suffix-runs")
    hot = runs.filter("window is not null")
    again = hot.groupBy("window").agg(F.sum("n").alias("places")).filter("places > 1").select("window")
    again = materialize(spark, again, "suffix-hot")
    spans = runs.filter("window is null").select("sha", "lo", "hi").unionByName(
        hot.filter("n = 1").join(again, "window").select("sha", "lo", "hi"))
    spans = spans.groupBy("sha").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    texts = held.select("sha", "text").dropDuplicates(["sha"])
    return light, classes, texts.join(spans, "sha")


def repeat_digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    spark = docs.sparkSession
    light, classes, spans = find_repeats(docs, length)
    cut = materialize(spark, spans.mapInArrow(partial(_cut_rows, length=length), "sha binary, n_removed long, n_spans long, kept_sha256 string"), "suffix-cut")
    known = materialize(spark, classes.select("sha", "copies").join(cut, "sha", "left"), "suffix-known")
    out = light.select("doc_id", "n_bytes", "sha").join(known, "sha")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    return out.select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(EMPTY_SHA)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("sha")))).alias("kept_sha256"))


def _whole_characters(text: bytes, kept_spans: list, length: int) -> str:
    """The text without the repeated bytes; a character that would go in part stays."""
    raw = np.frombuffer(text, dtype=np.uint8)
    gone = np.zeros(len(raw) + 1, dtype=np.int32)
    for s in kept_spans:
        gone[s["lo"]] += 1
        gone[s["hi"] + length] -= 1
    mask = np.cumsum(gone[:-1]) > 0
    char = np.cumsum((raw & 0xC0) != 0x80) - 1
    whole = np.bincount(char, weights=~mask) == 0
    return raw[~whole[char]].tobytes().decode("utf-8", "replace")


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents with their repeated passages cut out of ``text`` (n_chars follows, if there)."""
    spark = docs.sparkSession
    _, classes, spans = find_repeats(docs, length)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("lo"), F.lit(-1).cast("long").alias("hi")))
    cut_own, cut_sha, cut_spans = (unused(docs, c) for c in ("cut_own", "cut_sha", "cut_spans"))
    known = materialize(spark, spans.select("sha", "spans").join(classes.select("sha", "copies"), "sha", "right").select(
        F.col("sha").alias(cut_sha), F.when(F.col("copies") > 1, whole).otherwise(F.col("spans")).alias(cut_spans)).filter(
        F.col(cut_spans).isNotNull()), "suffix-spans")
    joined = docs.withColumn(cut_own, _sha()).join(known, F.col(cut_own) == F.col(cut_sha), "left").drop(cut_own, cut_sha)
    names = docs.columns

    def cut(batches):
        for b in batches:
            texts, spans_of = b.column("text").cast(pa.binary()).to_pylist(), b.column(cut_spans).to_pylist()
            new = []
            for t, s in zip(texts, spans_of, strict=True):
                if t is None or not s or len(t) < length:
                    new.append(None if t is None else t.decode("utf-8", "replace"))
                else:
                    new.append("" if s[0]["hi"] < 0 else _whole_characters(t, s, length))
            cols = {n: b.column(n) for n in names} | {"text": pa.array(new, pa.string())}
            if "n_chars" in cols:
                cols["n_chars"] = pa.array([None if t is None else len(t) for t in new], cols["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=names)

    return joined.mapInArrow(cut, docs.schema)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digests(read_table(spark, sf_dir, "documents"))

"""Periodic runs of words: stretches that repeat a block of words at least three times.

A run is a maximal stretch of words with smallest period q and at least max(24, 3 * q) words.
Seed and extend on diagonals: words q apart are equal over max(16, 2 * q) or more places of the run. The index
of level j holds the k-grams of k = 16 * 2^j words, which every run with a period in (k / 2, k] (level 0: up to 16)
is sure to contain; two such k-grams that overlap by a part of a period would give the run a smaller one, so a run's seed is a
pair of successive occurrences, and no other pairs need be listed. The pairs go by lag and place; a table holds for each
lag how far the text is covered by a run already extended, and a seed within it is not extended again. The
k-grams are numbered exactly, by pairs of numbers of the half as long ones; hashes only find the
texts that repeat any 16 words, as most do not.

Work is per document: n words cost a sort for each level that still has repeats, at most log2(n) of them. Nothing is
shuffled, and a lost executor's texts are read again.

Edge cases: a null or word-less text has no run and an empty collapsed text; a text under 24 words has no
run; repeated rows each give their row; a null doc_id is kept; an empty table gives an empty result; extra columns are
ignored. Texts are handled whole, whatever their length.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LocalVocab, by_bytes, mix, prepare, read_table

SEED = 16
LEAST = 24
REPEATS = 3


def _numbers(ids: np.ndarray) -> np.ndarray:
    """Exact numbers of all SEED-grams."""
    out, width = ids, 1
    while width < SEED:
        out, width = _doubled(out, width), 2 * width
    return out


def _doubled(numbers: np.ndarray, width: int) -> np.ndarray:
    """Numbers of the grams of twice the width."""
    left, right = numbers[:-width], numbers[width:]
    return np.unique(left * (int(numbers.max()) + 1) + right, return_inverse=True)[1]


def _successive(numbers: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """Places and lags of successive occurrences with a lag in (least, most], by lag and place; whether any gram repeats."""
    order = np.argsort(numbers, kind="stable")
    again = numbers[order[1:]] == numbers[order[:-1]]
    at, lag = order[:-1][again], (order[1:] - order[:-1])[again]
    fit = (lag > least) & (lag <= most)
    at, lag = at[fit], lag[fit]
    by = np.lexsort((at, lag))
    return at[by], lag[by], bool(again.any())


def _agrees(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common prefix, by pieces that double."""
    n, done, step = min(len(a), len(b)), 0, 64
    while done < n:
        same = a[done:done + step] == b[done:done + step]
        if not same.all():
            return done + int(np.argmin(same))
        done, step = done + len(same), 2 * step
    return n


def runs_of(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of word numbers, by start and period."""
    n, k, found = len(ids), SEED, []
    if n < LEAST:
        return found
    numbers, least = _numbers(ids), 0
    while REPEATS * (least + 1) <= n and len(numbers) > 1:
        places, lags, repeats = _successive(numbers, least, k)
        if not repeats:
            break
        # A stretch of seeds side by side on one diagonal is extended once, from its first.
        head = np.ones(len(places), dtype=bool)
        head[1:] = (lags[1:] != lags[:-1]) | (places[1:] != places[:-1] + 1)
        covered: dict = {}
        for i, lag in zip(places[head].tolist(), lags[head].tolist(), strict=True):
            if i < covered.get(lag, 0):
                continue
            start = i - _agrees(ids[:i][::-1], ids[lag:i + lag][::-1])
            end = i + _agrees(ids[i:n - lag], ids[i + lag:])
            covered[lag] = end
            length = end - start + lag
            if length >= max(LEAST, REPEATS * lag):
                found.append((start, length, lag))
        if len(numbers) <= k:
            break
        numbers, least, k = _doubled(numbers, k), k, 2 * k
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed_words(words: list, runs: list) -> list:
    """The words without those that a run contains after its first period."""
    gone = np.zeros(len(words) + 1, dtype=np.int32)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    keep = np.cumsum(gone[:-1]) == 0
    return [w for w, k in zip(words, keep.tolist(), strict=True) if k]


def _suspects(tokens: list, hashes: np.ndarray) -> set:
    """Texts in which some SEED words come twice (others with probability 2^-64 or so)."""
    sizes = np.array([len(t) for t in tokens])
    flat = np.concatenate(tokens) if len(tokens) else np.zeros(0, np.int64)
    if len(flat) < SEED:
        return set()
    owner = np.repeat(np.arange(len(tokens)), sizes)
    h, width = hashes[flat], 1
    while width < SEED:
        h = mix(h[:-width] * np.uint64(0xA0761D6478BD642F) + h[width:])
        width *= 2
    inside = owner[:len(h)] == owner[SEED - 1:]
    h, owner = (h ^ mix(owner[:len(h)].astype(np.uint64)))[inside], owner[:len(h)][inside]
    order = np.argsort(h)
    return set(owner[order[1:][h[order[1:]] == h[order[:-1]]]].tolist())


_SCHEMA = pa.schema([
    ("doc_id", pa.int64()),
    ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
    ("collapsed", pa.binary())])


def _mapper(rewrite):
    def found(batches):
        for b in batches:
            ids, texts = b.column("doc_id").to_pylist(), b.column("text").cast(pa.binary()).to_pylist()
            for lo, hi in by_bytes(texts, 2 << 20):
                vocab, words = LocalVocab(), [(t or b"").split() for t in texts[lo:hi]]
                if rewrite is not None:
                    words = [rewrite(d, w) for d, w in zip(ids[lo:hi], words, strict=True)]
                tokens = [vocab.ids(w) for w in words]
                suspects = _suspects(tokens, vocab.hashes())
                runs = [runs_of(t) if i in suspects else [] for i, t in enumerate(tokens)]
                left = [b" ".join(collapsed_words(w, r) if r else w) for w, r in zip(words, runs, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[lo:hi], pa.int64()),
                     pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in rs] for rs in runs], _SCHEMA.field("runs").type),
                     pa.array(left, pa.binary())], schema=_SCHEMA)
    return found


def periodic_runs(docs: DataFrame, rewrite=None) -> DataFrame:
    """doc_id, runs (array of start, length, period; by start, then period) and collapsed (the words outside the repeats, joined by
    one space); one row per row of ``docs``. ``rewrite(doc_id, words)`` may change the words of a text first."""
    prepare(docs.sparkSession)
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _mapper(rewrite), "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed binary")
    return out.withColumn("collapsed", F.col("collapsed").cast("string"))


def planted(doc_id: int | None, words: list) -> list:
    """The query's rule: by crc32 of the id, one text in ten has its end replaced by repeats of a block; null ids: none."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    block = words[a:a + p]
    return words[:a] + (block * -(-(n - a) // p))[:n - a]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(read_table(spark, sf_dir, "documents"), planted)
    best = F.expr("aggregate(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>), (b, r) -> case"
                  " when b is null or r.length * b.period > b.length * r.period then r else b end)")
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    out = found.select("doc_id", "runs", "collapsed", best.alias("best"))
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.expr("1000 * best.length div best.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))

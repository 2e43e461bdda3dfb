"""SimHash near-dedup: 64-bit fingerprints of 3-word shingles, linked at 3 or fewer differing bits.

Generalised pigeonhole search over the distinct fingerprints. The 64 bits are cut into parts;
bits that correlate over all fingerprints share a part, so that what repeats in the corpus makes few parts
unselective rather than all. A fingerprint x gives part i a threshold t_i of -1 (not probed) or more, with
sum(t_i + 1) = 4: a y within 3 bits of x is then within t_i bits of x in some part. The thresholds are x's own: dynamic
programming over the parts takes those with the least estimated cost, candidates and probes, so a part whose value
is frequent is passed over. The estimates come from a histogram of each part (its 16 best balanced bits, all
fingerprints counted; a table of fixed size); bits beyond them count as independent. x probes the index, rows
(part, value, fingerprint), at every value within t_i bits, and the join verifies the whole distance. As the guarantee holds
for each x alone, only larger fingerprints are taken as its partners.

Copies share a fingerprint and are merged before anything is joined; a link is a pair of distinct
fingerprints. Probe and index rows are joined by part and value, where the adaptive plan splits a hot value between tasks.

Edge cases: a null or word-less text has the fingerprint zero and is linked like any other; one or two
words make one shingle; ties and repeated rows share fingerprint and component; a null doc_id is never the smallest (component_id is
null if a component has no other); an empty table gives an empty result; extra columns are ignored. Texts are handled whole.
"""

from __future__ import annotations

from itertools import repeat
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, prepare, read_table
from .components import components

SHINGLE = 3
XXH_SEED = 42
DISTANCE = 3
PARTS = (4, 3, 2)  # numbers of parts to choose from
HIST = 16  # bits of a part that its histogram tells apart
PROBE = 3.0  # cost of a probe row, in candidates


# ---- fingerprints

def fingerprint(text: bytes | None) -> int:
    words = text.lower().split() if text else []
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)), strict=False))
    n = max(1, len(words) - SHINGLE + 1)
    h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(XXH_SEED)), dtype=np.uint64, count=n)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, 1 << 16):
        ones += np.unpackbits(h[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _prints(batches):
    for b in batches:
        prints = np.array([fingerprint(t) for t in b.column("text").cast(pa.binary()).to_pylist()], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(prints.view(np.int64))], names=["doc_id", "print"])


# ---- partitions and thresholds

def _bits(prints: np.ndarray) -> np.ndarray:
    return np.unpackbits(prints.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _joint_counts(batches):
    """One row per task: counts of bits that are set together."""
    total = np.zeros((64, 64))
    for b in batches:
        x = _bits(b.column("print").to_numpy().view(np.uint64)).astype(np.float32)
        total += x.T @ x
    yield pa.RecordBatch.from_arrays([pa.array([total.astype(np.int64).ravel()], pa.list_(pa.int64()))], names=["both"])


def correlated_parts(both: np.ndarray, n: int, m: int) -> list[list[int]]:
    """m lists of bits of nearly equal length: each begins with the most correlated pair left and takes the bits that
    correlate most with it; the best balanced bits come first in a list."""
    share = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    corr = np.abs((both / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread))
    np.fill_diagonal(corr, 0)
    left, parts = list(range(64)), []
    for k in range(m):
        width = 64 // m + (k < 64 % m)
        sub = corr[np.ix_(left, left)]
        first = np.unravel_index(np.argmax(sub), sub.shape) if len(left) > 1 else (0, 0)
        part = list(dict.fromkeys(left[i] for i in first))
        while len(part) < width:
            rest = [b for b in left if b not in part]
            part.append(max(rest, key=lambda b: (corr[b, part].mean(), -b)))
        left = [b for b in left if b not in part]
        parts.append(sorted(part[:width], key=lambda b: (abs(share[b] - 0.5), b)))
    return parts


def number_of_parts(n: int) -> int:
    """The number of parts with the least cost if fingerprints were spread evenly."""
    def cost(m: int) -> float:
        units = [(DISTANCE + 1) // m + (i < (DISTANCE + 1) % m) for i in range(m)]
        return sum(sum(comb(64 // m, k) for k in range(u)) * (PROBE + n / 2 ** (64 // m)) for u in units)
    return min(PARTS, key=cost)


def _value(prints: np.ndarray, part: list[int]) -> np.ndarray:
    out = np.zeros(len(prints), dtype=np.uint64)
    for k, bit in enumerate(part):
        out |= (prints >> np.uint64(bit) & np.uint64(1)) << np.uint64(k)
    return out


def _ball_counts(histogram: np.ndarray, width: int) -> np.ndarray:
    """[t, v]: estimated fingerprints within t bits of a value with coarse value v, for t up to DISTANCE."""
    exact = np.zeros((DISTANCE + 1, len(histogram)))
    exact[0] = histogram
    at = np.arange(len(histogram))
    for b in range(len(histogram).bit_length() - 1):
        flipped = exact[:, at ^ (1 << b)]
        exact[1:] += flipped[:-1]
    rest = width - (len(histogram).bit_length() - 1)
    out = np.zeros_like(exact)
    for t in range(DISTANCE + 1):
        for k in range(t + 1):
            out[t] += exact[k] * sum(comb(rest, j) for j in range(t - k + 1)) / 2 ** rest
    return out


def allocate(costs: np.ndarray) -> np.ndarray:
    """costs[x, part, units] -> units of each part per x, DISTANCE + 1 in all, with the least total cost: dynamic programming."""
    n, m, top = costs.shape[0], costs.shape[1], DISTANCE + 1
    best = np.full((n, top + 1), np.inf)
    best[:, 0] = 0
    choice = np.zeros((m, n, top + 1), dtype=np.int64)
    for i in range(m):
        new = np.full((n, top + 1), np.inf)
        for total in range(top + 1):
            for u in range(total + 1):
                c = best[:, total - u] + costs[:, i, u]
                less = c < new[:, total]
                new[less, total], choice[i, less, total] = c[less], u
        best = new
    units, left = np.zeros((n, m), dtype=np.int64), np.full(n, top)
    for i in range(m - 1, -1, -1):
        units[:, i] = choice[i, np.arange(n), left]
        left = left - units[:, i]
    return units


def _flips(width: int, most: int) -> list[np.ndarray]:
    """Masks of exactly 0, 1, .. most bits."""
    one = np.uint64(1) << np.arange(width, dtype=np.uint64)
    out = [np.zeros(1, dtype=np.uint64)]
    for _ in range(most):
        out.append(np.unique(np.concatenate([out[-1] ^ b for b in one])))
        out[-1] = out[-1][np.bitwise_count(out[-1]) == len(out) - 1]
    return out


def _prober(parts: list[list[int]], held):
    """Probe rows (part, value, print) by each fingerprint's own thresholds."""
    def probes(batches):
        tables = held.value
        flips = [_flips(len(p), min(2, DISTANCE)) for p in parts]
        for b in batches:
            prints = b.column("print").to_numpy().view(np.uint64)
            values = [_value(prints, p) for p in parts]
            costs = np.zeros((len(prints), len(parts), DISTANCE + 2))
            for i, (p, v, table) in enumerate(zip(parts, values, tables, strict=True)):
                coarse = (v & np.uint64(table.shape[1] - 1)).astype(np.int64)
                for u in range(1, DISTANCE + 2):
                    costs[:, i, u] = table[u - 1][coarse] + PROBE * sum(comb(len(p), k) for k in range(u))
            units = allocate(costs)
            for i, v in enumerate(values):
                for t in range(DISTANCE + 1):
                    who = np.flatnonzero(units[:, i] > t)
                    if not len(who):
                        continue
                    while len(flips[i]) <= t:
                        flips[i] = _flips(len(parts[i]), t)
                    masks = flips[i][t]
                    for lo in range(0, len(who), max(1, 200_000 // len(masks))):
                        some = who[lo:lo + max(1, 200_000 // len(masks))]
                        value = (v[some, None] ^ masks[None, :]).ravel()
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(value), i, np.int32)), pa.array(value.view(np.int64)),
                             pa.array(np.repeat(prints[some], len(masks)).view(np.int64))], names=["part", "value", "print"])
    return probes


def _projected(parts: list[list[int]], most: int | None = None):
    """Rows (part, value, print); with ``most``, the value of that many bits only."""
    def project(batches):
        for b in batches:
            prints = b.column("print").to_numpy().view(np.uint64)
            for i, p in enumerate(parts):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(prints), i, np.int32)), pa.array(_value(prints, p[:most]).view(np.int64)), b.column("print")],
                    names=["part", "value", "print"])
    return project


ROWS = "part int, value long, print long"


def links(prints: DataFrame) -> DataFrame:
    """a, b: the pairs of distinct values of ``print`` that differ in at most DISTANCE bits."""
    spark = prints.sparkSession
    prints = materialize(spark, prints.select("print").distinct(), "simhash-distinct")
    n = prints.count()
    both = prints.mapInArrow(_joint_counts, "both array<long>").select(F.posexplode("both").alias("i", "c")).groupBy("i").agg(
        F.sum("c").alias("c")).collect()  # 64 x 64 counts
    joint = np.zeros(64 * 64)
    for r in both:
        joint[r["i"]] = r["c"]
    parts = correlated_parts(joint.reshape(64, 64), n, number_of_parts(n))
    counts = prints.mapInArrow(_projected(parts, HIST), ROWS).groupBy("part", "value").agg(F.count(F.lit(1)).alias("c")).toArrow()
    tables = []  # at most 2^16 counts for each part
    for i, p in enumerate(parts):
        own = counts.filter(pa.compute.equal(counts["part"], i))
        histogram = np.zeros(1 << min(HIST, len(p)))
        histogram[own["value"].to_numpy()] = own["c"].to_numpy()
        tables.append(_ball_counts(histogram, len(p)))
    held = spark.sparkContext.broadcast(tables)
    x = prints.mapInArrow(_prober(parts, held), ROWS).withColumnRenamed("print", "a")
    y = prints.mapInArrow(_projected(parts), ROWS).withColumnRenamed("print", "b")
    near = x.join(y, ["part", "value"]).filter(f"a < b and bit_count(a ^ b) <= {DISTANCE}").select("a", "b").distinct()
    return materialize(spark, near, "simhash-links")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, print (the fingerprint as a signed long) and component_id; one row per row of ``docs``."""
    spark = docs.sparkSession
    prepare(spark)
    signed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_prints, "doc_id long, print long")
    signed = materialize(spark, signed, "simhash-prints")
    classes = materialize(spark, signed.groupBy("print").agg(F.min("doc_id").alias("rep")), "simhash-classes")
    found = materialize(spark, components(links(classes)), "simhash-components")
    ids = classes.join(found, classes["print"] == found["node"], "left").select(
        F.col("print").alias("own"), "rep", F.coalesce("component", "print").alias("component"))
    least = ids.groupBy("component").agg(F.min("rep").alias("component_id"))
    ids = materialize(spark, ids.join(least, "component").select("own", "component_id"), "simhash-ids")
    return signed.join(ids, F.col("print") == F.col("own")).select("doc_id", "print", "component_id")


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")

"""Hard negatives, SimHash groups and periodic runs against brute force, on edge rows and on hot groups."""

import collections
import hashlib
import math
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from filmmart.llm import hard_negatives, periodic_runs, simhash_dedup
from filmmart.llm.common import LocalVocab


# 11 hard negatives


def inner(a, b):
    return sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(a, b))


def mined(rows):
    """rows: (id, label, vector), every pair looked at."""
    rows = [r for r in rows if r[1] is not None and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    key = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for i, (a, label, v) in enumerate(rows):
        if a is None or a % 100:
            continue
        scored = [(inner(v, w), b, other == label) for j, (b, other, w) in enumerate(rows) if j != i]
        for s, b, _ in sorted((x for x in scored if x[2]), key=key)[:5]:
            fits = sorted((x for x in scored if not x[2] and 80 * s <= 100 * x[0] <= 100 * s), key=key)[:5]
            out += [(a, b, k + 1, c, s, t) for k, (t, c, _) in enumerate(fits)]
    return collections.Counter(out)


def vectors(rng, n, dims=12):
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(3)]
    return [[c + rng.gauss(0, 0.4) for c in rng.choice(centres)] for _ in range(n)]


VECTORS = "id long, label int, vector array<double>, score double, block string, a string, number int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0.0, "b", "a", 1) for r in rows], VECTORS).repartition(3)


def mine(df):
    return collections.Counter(tuple(r) for r in hard_negatives.mine(df, F.col("id") % 100 == 0).collect())


def test_table_scores_are_inner_products():
    rng = np.random.default_rng(3)
    for most, dims in ((1, 8), (300, 64), (2**20, 24), (2**29, 16)):
        a, c = rng.integers(-most, most + 1, (130, dims)), rng.integers(-most, most + 1, (1500, dims))
        planes = hard_negatives.planes_of(c)
        assert planes.shape[1:] == (dims // 8, 1500)
        assert (hard_negatives.scores(a, planes) == a @ c.T).all()
    short = hard_negatives.planes_of(rng.integers(-5, 5, (10, 8)))
    assert hard_negatives.scores(a, short).shape == (130, 10)


def test_hard_negatives_on_edges(spark, monkeypatch):
    rng = random.Random(11)
    rows = [(i, rng.randint(0, 3), v) for i, v in enumerate(vectors(rng, 420))]
    rows += [(100, 1, rows[3][2]), (100, rows[100][1], rows[100][2]), (201, 2, [math.nan] * 12), (202, 2, [math.inf] + [0.0] * 11), (203, 2, None),
             (204, None, rows[4][2]), (205, 1, [None] + [0.5] * 11), (None, 1, rows[5][2]), (None, None, None), (900, 1, []), (1000, 2, [0.25] * 5),
             (1100, 2, [3.0] * 20), (1200, 1, [0.0] * 12), (-100, 1, rows[6][2]), (1300, 0, [40000.5] * 12)]
    rows += [(2000 + i, 3, rows[7][2]) for i in range(200)]  # one vector very often
    want = mined(rows)
    assert mine(frame(spark, rows)) == want and len(want) > 50
    monkeypatch.setattr(hard_negatives, "BLOCK", 50)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 3)
    assert mine(frame(spark, rows)) == want


def test_hard_negatives_of_nothing(spark):
    assert not mine(frame(spark, []))
    assert not mine(frame(spark, [(1, 1, [0.5]), (2, 2, [0.5])]))  # no anchor
    assert not mine(frame(spark, [(100, 1, [0.5]), (2, 2, [0.5])]))  # no positive


# 12 SimHash


def print_brute(text):
    w = (text or "").encode().lower().split()
    s = [w[i:i + 3] for i in range(len(w) - 2)] if len(w) >= 3 else [w] if w else []
    h = [xxhash.xxh64(b" ".join(x), seed=42).intdigest() for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def grouped(prints, ids):
    up = list(range(len(prints)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                up[root(i)] = root(j)
    groups = collections.defaultdict(list)
    for i, d in enumerate(ids):
        if d is not None:
            groups[root(i)].append(d)
    return [min(groups[root(i)], default=None) for i in range(len(prints))]


def test_simhash_on_edges(spark, edge, nothing):
    rows, docs = edge
    prints = [print_brute(r[1]) for r in rows]
    want = collections.Counter(zip([r[0] for r in rows], prints, grouped(prints, [r[0] for r in rows])))
    got = simhash_dedup.near_duplicates(docs).collect()
    assert collections.Counter((r.doc_id, r.print % 2**64, r.component_id) for r in got) == want
    assert simhash_dedup.near_duplicates(nothing).count() == 0
    # Spark's own hash of a string is the one that the fingerprint is made of.
    assert spark.sql("select xxhash64('ab cd ef')").first()[0] % 2**64 == xxhash.xxh64(b"ab cd ef", seed=42).intdigest()


def clustered(rng, n):
    """Values with correlated bits, many of them near one centre: every part has hot values."""
    centre = rng.getrandbits(64)
    out = set()
    while len(out) < n:
        x = centre if rng.random() < 0.5 else rng.getrandbits(64)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 8])):
            x ^= 1 << rng.randrange(64)
        if rng.random() < 0.3:
            x = (x & ~0xFF) | (0xFF if x & 1 else 0)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("parts", [2, 3, 4])
def test_links_are_exact(spark, monkeypatch, parts):
    monkeypatch.setattr(simhash_dedup, "PARTS", (parts,))
    values = clustered(random.Random(parts), 700)
    df = spark.createDataFrame([(v - 2**64 if v >= 2**63 else v,) for v in values], "print long")
    got = {frozenset((r.a % 2**64, r.b % 2**64)) for r in simhash_dedup.links(df).collect()}
    want = {frozenset((x, y)) for x in values for y in values if x < y and (x ^ y).bit_count() <= 3}
    assert got == want and len(want) > 500


def test_thresholds_are_the_cheapest():
    rng = np.random.default_rng(5)
    costs = np.concatenate([np.zeros((50, 3, 1)), np.cumsum(rng.integers(0, 9, (50, 3, 4)), axis=2)], axis=2)
    units = simhash_dedup.allocate(costs)
    assert (units.sum(axis=1) == 4).all()
    for x, u in zip(costs, units):
        every = [(a, b, 4 - a - b) for a in range(5) for b in range(5 - a)]
        assert sum(x[i, k] for i, k in enumerate(u)) == min(sum(x[i, k] for i, k in enumerate(e)) for e in every)


def test_correlated_bits_share_a_part():
    rng = np.random.default_rng(6)
    bits = rng.integers(0, 2, (4000, 64))
    bits[:, [3, 17, 33, 60]] = bits[:, [3]] ^ (rng.random((4000, 4)) < 0.05)
    parts = simhash_dedup.correlated_parts((bits.T @ bits).astype(float), 4000, 4)
    assert sorted(b for p in parts for b in p) == list(range(64)) and {len(p) for p in parts} == {16}
    assert any({3, 17, 33, 60} <= set(p) for p in parts)


# 13 periodic runs


def runs_brute(words):
    n, out = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(24, 3 * q):
                out[i, j + q] = min(q, out.get((i, j + q), q))
            i = j
    # A stretch counts with its smallest period only.
    return sorted((s, e - s, q) for (s, e), q in out.items())


def sequence(rng):
    words = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(80))]
    for _ in range(rng.randrange(4)):
        block = [rng.randrange(rng.choice([2, 4, 90])) for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 31, 32, 33, 40, 65]))]
        words += (block * rng.choice([2, 3, 4, 9]))[:rng.randrange(1, 300)]
        words += [rng.randrange(50) for _ in range(rng.choice([0, 1, 30]))]
    return words


def test_runs_equal_brute_force():
    rng = random.Random(13)
    found = 0
    for _ in range(1200):
        words = sequence(rng)
        got = periodic_runs.runs_of(np.array(words, dtype=np.int64))
        assert got == runs_brute(words)
        found += len(got)
    assert found > 500
    # Nested runs: the block repeats and holds repeats of its own.
    block = [1, 2] * 14 + list(range(10, 50)) + [1, 2] * 14
    words = block * 4
    got = periodic_runs.runs_of(np.array(words))
    assert got == runs_brute(words) and {r[2] for r in got} == {2, len(block)}


def test_runs_of_very_long_texts():
    rng = random.Random(14)
    block = [rng.randrange(1000) for _ in range(30_000)]
    words = np.array(block * 3 + [0] * 200_000 + [5])
    assert periodic_runs.runs_of(words) == [(0, 90_000, 30_000), (90_000, 200_000, 1)]
    assert periodic_runs.runs_of(np.arange(300_000) % 99_999 + 7) == [(0, 300_000, 99_999)]


def expected_runs(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = runs_brute(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_periodic_runs_query(spark, edge, nothing, tmp_path):
    rng = random.Random(15)
    rows = [(d, t, *r) for d, t, *r in edge[0]]
    rows += [(1000 + i, " ".join(f"w{x}" for x in sequence(rng)), "en", "s", 1, *rows[0][5:]) for i in range(150)]
    schema = edge[1].schema
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = collections.Counter(tuple(r) for r in periodic_runs.op13_periodic_runs(spark, str(tmp_path)).collect())
    assert got == collections.Counter(expected_runs(r[0], r[1]) for r in rows)
    assert periodic_runs.periodic_runs(nothing).count() == 0
    texts = {r.doc_id: r for r in periodic_runs.periodic_runs(edge[1]).collect()}
    assert texts[3].collapsed == "one" and [tuple(x) for x in texts[11].runs] == [(0, 900, 1)] and texts[11].collapsed == "ab"

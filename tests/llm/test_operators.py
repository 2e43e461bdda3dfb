"""Each operator against a brute-force version on rows with every edge case, and on an empty table."""

import collections
import hashlib
import math
import random
import re
import time
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from filmmart.llm import (html_gbt, hpy_lm, iblt, langid, line_quality, minmax_dedup, mixing, packing, suffix_dedup, token_files)
from filmmart.llm.common import LocalVocab
from filmmart.llm.components import components
from filmmart.session import scratch_path


def split(text):
    return (text or "").encode().lower().split()


# 1 packing


def best_fit(rows, capacity):
    """Every open bin is looked at for every piece."""
    out, bins, rest = [], [], []
    for i, (_, _, n, _) in enumerate(rows):
        for p in range(n // capacity):
            out.append((i, p))
            bins.append([0, set(), set()])
        if n % capacity or not n:
            rest.append((n % capacity, n // capacity, i))
    rest.sort(key=lambda x: (-x[0], rows[x[2]][3], rows[x[2]][0] is None, rows[x[2]][0] or 0, x[2]))
    for left, piece, i in rest:
        if not left:
            out.append((i, 0, None))
            continue
        fits = [b for b in range(len(bins)) if bins[b][0] >= left and rows[i][1] not in bins[b][1] and rows[i][3] not in bins[b][2]]
        b = min(fits, key=lambda b: (bins[b][0], b)) if fits else len(bins)
        if not fits:
            bins.append([capacity, set(), set()])
        bins[b][0] -= left
        bins[b][1].add(rows[i][1])
        bins[b][2].add(rows[i][3])
        out.append((i, piece, b))
    return out


def test_packing_finds_the_tightest_compatible_bin():
    rng = random.Random(1)
    for _ in range(20):
        rows = [(i, f"s{rng.randint(0, 6)}", rng.choice([0, rng.randint(1, 40), rng.randint(1, 250)]), rng.randint(0, 60)) for i in range(150)]
        got = {(p[0], p[1]): p[4] for p in packing.pack_group(rows, 100)}
        for want in best_fit(rows, 100):
            if len(want) == 3:
                assert got[want[:2]] == want[2]


def test_packing_of_hot_sources_and_clusters():
    """The search is exact, and its work stays in proportion, where most pieces share a source or a text."""
    rng = random.Random(3)
    for _ in range(30):
        n_sources, n_clusters = rng.choice([(1, 60), (2, 5), (20, 3), (3, 1)])
        rows = [(i, f"s{rng.randint(0, n_sources)}", rng.choice([0, 7, rng.randint(1, 40), rng.randint(1, 250)]), rng.randint(0, n_clusters)) for i in range(150)]
        got = {(p[0], p[1]): p[4] for p in packing.pack_group(rows, 100)}
        assert all(got[want[:2]] == want[2] for want in best_fit(rows, 100) if len(want) == 3)
    for rows in ([(i, "s", rng.randint(1, 60), i) for i in range(40_000)], [(i, f"s{i % 20}", 30, 0) for i in range(40_000)]):
        began = time.process_time()
        assert len({p[4] for p in packing.pack_group(rows, 2048)}) == 40_000
        assert time.process_time() - began < 30


def test_packing_keeps_every_repeated_row(spark, monkeypatch):
    monkeypatch.setattr(packing, "LOT", 3)
    rows = [(1, "a b c", "s")] * 10 + [(2, None, None)] * 5 + [(i, "x y " * i, "s") for i in range(3, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = collections.Counter(r.doc_id for r in packing.pack_documents(docs).collect())
    assert got == collections.Counter(r[0] for r in rows)


def test_packing_rows(edge, nothing):
    rows, docs = edge
    got = packing.pack_documents(docs, capacity=100).collect()
    per_doc = collections.Counter()
    bins = collections.defaultdict(list)
    for r in got:
        per_doc[r.doc_id] += r.n_words
        if r.bin_id is not None:
            bins[r.bin_id].append(r)
    want = collections.Counter()
    for d, t, *_ in rows:
        want[d] += len(split(t))
    assert per_doc == want
    for held in bins.values():
        assert sum(r.n_words for r in held) <= 100
        assert len({r.source for r in held}) == len(held) == len({r.cluster for r in held})
        at = sorted((r.bin_offset, r.n_words) for r in held)
        assert all(a + n <= b for (a, n), (b, _) in zip(at, at[1:]))
    assert packing.pack_documents(nothing).count() == 0


# 2 near-dedup


def shingles(text):
    w = split(text)
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def near_brute(rows):
    sets = [shingles(t) for _, t, *_ in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = len(sets[i] & sets[j])
            if same and 100 * same >= 85 * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    out = []
    for i, (d, *_) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        c = (min(ids) if ids else None) if sets[i] else d
        out.append((d, len(sets[i]), c, d is not None and d == c))
    return collections.Counter(out)


def test_near_duplicates_on_edges(edge, nothing):
    rows, docs = edge
    got = collections.Counter(tuple(r) for r in minmax_dedup.near_duplicates(docs).collect())
    assert got == near_brute(rows)
    assert minmax_dedup.near_duplicates(nothing).count() == 0
    kept = minmax_dedup.near_dedup(docs)
    assert kept.columns == docs.columns


def test_near_dedup_keeps_one_row_of_each_group(spark, edge, nothing):
    rng = random.Random(6)
    words = lambda rng, n: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n))
    base, other, third, alone = (words(rng, 120) for _ in range(4))
    near = lambda t: " ".join([*t.split()[:60], "changed", *t.split()[61:]])
    rows = [(1, base, "a"), (1, base, "b"), (1, base, "b"), (2, near(base), "a"),  # repeated in full, and a near copy
            (3, other, "a"), (3, near(other), "a"), (4, other.upper(), "a"),  # two near texts under one doc_id
            (None, alone, "a"), (None, third, "a"), (9, third, "a"), (None, near(third), "a"),  # without a doc_id: alone, and with copies
            (1, words(rng, 50), "a"), (2, words(rng, 50), "a"),  # the doc_id again, another text
            (5, "", "a"), (5, "", "a"), (5, None, "a"), (6, None, "a"), (None, "", "a"), (None, None, "a"), (None, None, "a")]
    got = minmax_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)).collect()
    stay = collections.Counter((r.doc_id, r.text) for r in got)
    want = {(1, base), (None, alone), (9, third), rows[11][:2], rows[12][:2], (5, ""), (5, None), (6, None), (None, ""), (None, None)}
    pair = {(3, other), (3, near(other))}
    assert max(stay.values()) == 1 and set(stay) - pair == want and len(set(stay) & pair) == 1
    rows, docs = edge
    sets = {(r[0], r[1]): shingles(r[1]) for r in rows}
    got = minmax_dedup.near_dedup(docs)
    assert got.columns == docs.columns
    stay = [(r.doc_id, r.text) for r in got.collect()]
    assert len(set(stay)) == len(stay) and {k for k, s in sets.items() if not s} <= set(stay)
    close = lambda a, b: 100 * len(a & b) >= 85 * len(a | b)
    assert all(any(close(s, sets[k]) for k in stay if sets[k]) for s in sets.values() if s)  # no chains in these rows
    assert not any(close(sets[a], sets[b]) for i, a in enumerate(stay) for b in stay[:i] if sets[a] and sets[b])
    assert minmax_dedup.near_dedup(nothing).count() == 0


def test_near_duplicates_chains_and_groups(spark):
    """Chains a-b-c whose ends are no pair, and a group in which few pairs reach the threshold."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    rows = []
    for g in range(6):
        base = [word() for _ in range(130)]
        for k in range(14):
            w = list(base)
            for _ in range(k % 7):
                w[rng.randrange(len(w))] = word()
            rows.append((len(rows), " ".join(w)))
        for k in range(6):
            base = list(base)
            base[20 * k] = word()
            rows.append((len(rows), " ".join(base)))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = collections.Counter(tuple(r) for r in minmax_dedup.near_duplicates(docs).collect())
    assert got == near_brute(rows)


def test_min_max_signature_estimates_similarity():
    rng = np.random.default_rng(0)
    common, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (1500, 250, 250))
    sets = [np.unique(np.concatenate([common, x])) for x in (a, b)]
    starts = np.array([0, len(sets[0])])
    flat, same = np.concatenate(sets), []
    for p in range(minmax_dedup.N_HASH):
        h = flat * minmax_dedup._A[p] + minmax_dedup._B[p]
        for of in (np.minimum, np.maximum):
            v = of.reduceat(h, starts)
            same.append(v[0] == v[1])
    assert abs(np.mean(same) - 0.75) < 0.15


def test_components(spark):
    rng = random.Random(2)
    edges = [(str(rng.randint(0, 300)), str(rng.randint(0, 300))) for _ in range(220)] + [("hub", str(i)) for i in range(40)] + [(None, "1")]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a and b:
            up[root(a)] = root(b)
    want = {x: min(y for y in up if root(y) == root(x)) for x in up if any(root(y) == root(x) and y != x for y in up)}
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == want


# 3 repeated passages


def repeats_brute(rows):
    raw = [(t or "").encode() for _, t, *_ in rows]
    n = suffix_dedup.LENGTH
    seen = collections.Counter(b[i:i + n] for b in raw for i in range(len(b) - n + 1))
    out = []
    for (d, *_), b in zip(rows, raw, strict=True):
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if seen[b[i:i + n]] > 1:
                gone[i:i + n] = b"\1" * n
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return collections.Counter(out)


def passage_rows():
    rng = random.Random(8)
    w = lambda n: " ".join("".join(rng.choice("abcdefgé") for _ in range(rng.randint(2, 8))) for _ in range(n))
    shared = [w(110), w(75), w(300)]
    rows = []
    for i in range(30):
        parts = [w(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 2)):
            s = rng.choice(shared)
            a = rng.randint(0, len(s) // 3)
            parts += [s[a:a + rng.randint(380, 900)], w(rng.randint(0, 40))]
        rows.append((i, " ".join(parts)))
    rows += [(50, "ab" * 700), (51, "ab" * 300 + "c"), (52, "z" * 400), (53, "z" * 401), (54, shared[0] + shared[0])]
    return rows


@pytest.mark.parametrize("group", [2000, 3])
def test_repeats(spark, edge, nothing, monkeypatch, group):
    """With a small GROUP, the prefixes count as hot and go the way of dealt-out prefixes."""
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    rows = passage_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert collections.Counter(tuple(r) for r in suffix_dedup.repeat_digests(docs).collect()) == repeats_brute(rows)
    if group > 3:
        rows, docs = edge
        assert collections.Counter(tuple(r) for r in suffix_dedup.repeat_digests(docs).collect()) == repeats_brute(rows)
        assert suffix_dedup.repeat_digests(nothing).count() == 0


def test_slices_of_long_texts_give_the_same_windows(monkeypatch):
    text = " ".join(f"w{i * 7919 % 1000}" for i in range(3000)).encode()

    def stretches():
        out = set()
        for part, starts, raw, h, low, at, owner in suffix_dedup.minimisers([text]):
            out |= {(part[o][1] + int(p) - int(starts[o]), int(h[p])) for p, o in zip(at, owner, strict=True)}
        return out

    whole = stretches()
    monkeypatch.setattr(suffix_dedup, "CHUNK", 1000)
    assert stretches() == whole


def test_repeats_in_different_slices_of_one_text(spark):
    """A passage once in the first and once in the last slice of a text, in no other text; and a text without any repeat."""
    rng = random.Random(12)
    filler = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    size, passage = suffix_dedup.CHUNK, "".join(rng.choices("ijkl", k=700))
    parts = [filler(size // 2), filler(2 * size), filler(300)]
    rows = [(1, f"{parts[0]}1{passage}2{parts[1]}3{passage}4{parts[2]}"), (2, filler(2 * size + 999)), (None, f"5{filler(900)}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = {r.doc_id: r for r in suffix_dedup.repeat_digests(docs).collect()}
    kept = f"{parts[0]}12{parts[1]}34{parts[2]}".encode()
    assert (got[1].n_removed, got[1].n_spans, got[1].kept_sha256) == (1400, 2, hashlib.sha256(kept).hexdigest())
    assert got[2].n_removed == got[None].n_removed == 0
    assert {r.doc_id: r.text for r in suffix_dedup.remove_repeats(docs).collect()} == dict(rows) | {1: kept.decode()}


def test_places_are_counted_once_over_the_slices_of_a_text(monkeypatch):
    """The same index rows whatever the size of the slices; copies of a text in one batch don't add up."""
    rng = random.Random(13)
    texts = ["".join(rng.choices("abcd", k=n)) for n in (5000, 200, 7000, 3000)]
    texts = [texts[0] + texts[0][:1500], None, texts[1], texts[2], texts[2], texts[3] + texts[0][100:900] + texts[3][500:1500]]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([7, 8, 9, 10, 10, 11])], names=["text", "uid"])
    rows = lambda: collections.Counter(tuple(r.values()) for b in suffix_dedup._index_rows([batch]) for r in b.to_pylist())
    whole = rows()
    assert {r[3] for r in whole if r[2] == 10} == {1} and {r[3] for r in whole if r[2] == 7} == {1, 2}
    monkeypatch.setattr(suffix_dedup, "CHUNK", 1000)
    assert rows() == whole


def test_remove_repeats_keeps_characters_whole(edge):
    _, docs = edge
    got = suffix_dedup.remove_repeats(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    assert len(rows) == docs.count()
    assert all("�" not in (r.text or "") for r in rows)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows)


# 4 language model


def test_language_model(spark, edge, nothing):
    rows, docs = edge
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    got = hpy_lm.score_documents(docs.select("doc_id", "text", held.alias("held_out"))).collect()
    count = collections.Counter()
    flag = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    for d, t, *_ in rows:
        if not flag(d):
            count.update([*split(t), b"\n"])
    n, v = sum(count.values()), len(count)
    want = collections.Counter()
    for d, t, *_ in rows:
        w = [*split(t), b"\n"]
        want[(d, flag(d), len(w), sum(count[x] > 0 for x in w), n, round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), 4))] += 1
    assert collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    trained = [r for r in got if not r.held_out]
    assert sum(r.score for r in trained) > sum(r.base_score for r in trained)
    assert hpy_lm.score_documents(nothing.select("doc_id", "text", F.lit(False).alias("held_out"))).count() == 0


def test_predictive_probabilities_sum_to_one():
    rng = np.random.default_rng(4)
    codes, c = np.unique(rng.zipf(1.5, 4000) % 50 << 16 | rng.choice([0x6162, 0x6362, 0x6163], 4000), return_counts=True)
    word, contexts = codes >> 16, (codes & 0xFFFF).astype(np.uint16)
    words, word = np.unique(word, return_inverse=True)
    blob = hpy_lm._pack(words.astype(np.uint64), word.astype(np.uint32), contexts, c.astype(np.int64))
    setting = {"n": int(c.sum()), "v": len(words), "d": (0.5, 0.6, 0.7)}
    customers = np.bincount(contexts, weights=c, minlength=1 << 16)

    def totals(state):
        level, u, t = state.totals_rows()
        return hpy_lm._totals([{"level": a, "u": b, "t": x} for a, b, x in zip(level, u, t, strict=True)], customers)

    state = hpy_lm.Seating(0, blob, setting)
    for _ in range(3):
        state.sweep(totals(state))
    assert (state.t2 <= state.c2).all() and (state.t2 >= 1).all() and (state.t1 <= state.c1).all()
    now = totals(state)
    p0, p1, p2 = state.probabilities(now)
    unknown = 1 / (setting["n"] + setting["v"] + 1)
    s, d = hpy_lm.STRENGTH, setting["d"]
    rest0 = (s + d[0] * now.tables[0]) / (s + now.customers[0]) * unknown
    assert abs(p0.sum() + rest0 - 1) < 1e-9
    for u in (0x6162, 0x6362, 0x6163):
        share1 = (s + d[1] * now.tables[1][u & 0xFF]) / (s + now.customers[1][u & 0xFF])
        q1 = share1 * p0
        mine = state.parent == u & 0xFF
        q1[state.word1[mine]] = p1[mine]
        share2 = (s + d[2] * now.tables[2][u]) / (s + now.customers[2][u])
        q2 = share2 * q1
        mine = state.context == u
        q2[state.word[mine]] = p2[mine]
        assert abs(q2.sum() + share2 * share1 * rest0 - 1) < 1e-9


@pytest.mark.parametrize("n_buckets", [1, 5])
def test_words_before_are_contexts(spark, monkeypatch, n_buckets):
    """north and south end alike; what follows each is learnt apart, in one bucket of words and in several."""
    train = [(i, f"the north wind of m{i} and the south rain of n{i}", False) for i in range(40)]
    ask = [(100, "the north wind", True), (101, "the north rain", True), (102, "the south rain", True), (103, "the south wind", True), (104, "the south zebra", True)]
    size = sum(len(t) for _, t, _ in train + ask)
    monkeypatch.setattr(hpy_lm, "BUCKET_BYTES", -(-size // n_buckets))
    got = {r.doc_id: r for r in hpy_lm.score_documents(spark.createDataFrame(train + ask, "doc_id long, text string, held_out boolean")).collect()}
    assert len(got) == len(train) + len(ask) and all(r.train_tokens == 40 * 12 for r in got.values())
    assert got[100].score > got[101].score + 1 and got[102].score > got[103].score + 1 and got[103].score > got[104].score
    assert got[100].base_score == pytest.approx(got[101].base_score)


def test_seating_follows_the_restaurant_rule():
    """Mean tables of a lone dish against the exact mean of the rule, on small and large numbers of customers."""
    rng = np.random.default_rng(1)
    for c, a, d in ((6, 0.8, 0.5), (400, 3.0, 0.6)):
        mean = {1: 1.0}
        for i in range(1, c):
            nxt = collections.defaultdict(float)
            for t, p in mean.items():
                new = a / (a + i - d * t)
                nxt[t + 1] += p * new
                nxt[t] += p * (1 - new)
            mean = nxt
        want = sum(t * p for t, p in mean.items())
        t, _ = hpy_lm.seat(np.full(4000, c), np.full(4000, a), d, rng)
        assert abs(t.mean() - want) < 0.05 * want


# 5 token files


def test_token_files_round_trip(spark, edge, nothing, monkeypatch):
    from tokenizers import Tokenizer
    monkeypatch.setattr(token_files, "FILE_BYTES", 20_000)
    rows, docs = edge
    path = token_files.tokenizer_path()
    manifest = token_files.write_files(docs, scratch_path(spark, "t-tokens"), path)
    got = token_files.read_digests(manifest).collect()
    tk = Tokenizer.from_file(path)
    tk.encode_special_tokens = True
    ids_of = lambda t: [*tk.encode(t or "", add_special_tokens=False).ids, token_files.END]
    crc = lambda ids: zlib.crc32(np.array(ids, dtype="<u4").tobytes())
    want = collections.Counter((d, len(ids_of(t)), crc(ids_of(t))) for d, t, *_ in rows)
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    files = manifest.orderBy("part").collect()
    assert len(files) > 1
    for f in files:
        whole = np.concatenate([ids for _, _, ids in token_files.read_documents(f.path)])
        for i in range(-(-f.n_tokens // token_files.SEQUENCE)):
            ids, mask = token_files.read_sequence(f.path, i)
            part = whole[i * token_files.SEQUENCE:(i + 1) * token_files.SEQUENCE]
            assert len(ids) == token_files.SEQUENCE and mask.sum() == len(part) and (ids[:len(part)] == part).all()
    empty = token_files.write_files(nothing, scratch_path(spark, "t-none"), path)
    assert empty.count() == 0 and token_files.read_digests(empty).count() == 0


def test_word_lookup_agrees_with_whole_texts():
    from tokenizers import Tokenizer
    path = token_files.tokenizer_path()
    tk = Tokenizer.from_file(path)
    tk.encode_special_tokens = True
    texts = ["Don't stop, I'll go... we've", "été, ÉTÉ! İstanbul", "a,b.c!? (x) 12,345.67;", "Å ẛ̣ fiﬁ :;", "it's. 's 's, \U0001f600, 你好,",
             "x y z\u0085w", "end.\n\nNew\tline", "café́, ΣΣ."]
    texts += ["", "a ~ b~c ~~ ^ @ | \u1fef", "\u0301 \u0338a", "<|endoftext|> [PAD] a<s>b"]
    rng = random.Random(5)
    texts.append(" ".join("".join(rng.choices("abcdé~.,'#sΣ1İ", k=rng.randint(1, 9))) for _ in range(60_000)))  # a very long one
    want = [tk.encode(t, add_special_tokens=False).ids for t in texts]
    for remember in (5, 500_000):
        coder = token_files.WordEncoder(path, remember)
        for end in (False, True, True):
            ids, sizes = coder.encode([t.encode() for t in texts], end)
            assert [p.tolist() for p in np.split(ids, np.cumsum(sizes)[:-1])] == [w + [token_files.END] * end for w in want]
    coder.mark = b""
    assert coder.encode([b"no mark, one by one"])[0].tolist() == tk.encode("no mark, one by one", add_special_tokens=False).ids
    assert [len(x) for x in coder.encode([])] == [0, 0]

def test_frequent_words_stay_known(monkeypatch):
    """Words that keep coming are encoded once, however many rare ones pass by; the ids are those of the tokenizer."""
    path = token_files.tokenizer_path()
    coder, learnt = token_files.WordEncoder(path, 300), collections.Counter()
    learn = coder._learn
    monkeypatch.setattr(coder, "_learn", lambda words, first: (learnt.update(words), learn(words, first)))
    for i in range(12):
        text = " ".join(f"the film was {random.Random(100 * i + j).getrandbits(40):x}" for j in range(100))
        ids, n = coder.encode([text.encode()], end=True)
        assert ids.tolist() == [*coder.tokenizer.encode(text, add_special_tokens=False).ids, token_files.END] and n.tolist() == [len(ids)]
    assert learnt[b"the"] == learnt[b"film"] == learnt[b"was"] == 1 and len(learnt) > 1000
    assert len(coder.index) < 700


# 6 fingerprints

PIECES = re.compile(rf"[^\n]{{1,{iblt.PARAGRAPH}}}[^\n.!?]*[.!?]*")


def likeness(a, b):
    x, y = set(PIECES.findall(a)), set(PIECES.findall(b))
    n, d = len(x) + len(y), len(x ^ y)
    return (n - d) / (n + d) if n else 1.0


def test_fingerprints(edge, nothing):
    rows, docs = edge
    got = iblt.fingerprints(docs).collect()
    ids = sorted({d for d, *_ in rows if d is not None}, reverse=True)
    text_of = {i: min(t or "" for d, t, *_ in rows if d == i) for i in ids}
    want = collections.Counter()
    for d, t, *_ in rows:
        t = t or ""
        after = text_of[ids[(ids.index(d) + 1) % len(ids)] if d is not None else ids[0]]
        h = len(t) // 2
        edited = t[:len(t) - h] + after[:h]
        want[(d, len(t), hashlib.sha256(edited.encode()).hexdigest(), round(likeness(t, edited), 9), round(likeness(t, after), 9))] += 1
    assert collections.Counter((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == want
    by_text = collections.defaultdict(set)
    prints = {r.doc_id: r.fingerprint for r in got}
    for d, t, *_ in rows:
        if d not in (None, 5, 7):
            by_text[t or ""].add(prints[d])
    assert all(len(x) == 1 for x in by_text.values())
    assert iblt.fingerprints(nothing).count() == 0


def test_sketch_differences_are_retried_larger(spark, monkeypatch):
    """Too few cells for the first attempt: the retries recover every difference."""
    monkeypatch.setattr(iblt, "CELLS", 0.2)
    rng = random.Random(4)
    rows = []
    for i in range(60):
        a = [rng.getrandbits(62) for _ in range(rng.randint(0, 60))]
        b = a[:rng.randint(0, len(a))] + [rng.getrandbits(62) for _ in range(rng.randint(0, 60))]
        rows.append((i, a, b, a))
    sets = spark.createDataFrame(rows, "row long, keys array<long>, x array<long>, y array<long>")
    got = {(r.row, r.id): r.d for r in iblt.differences(sets, ["x", "y"]).collect()}
    for i, a, b, _ in rows:
        assert got.get((i, 0), 0) == len(set(a) ^ set(b)) and got.get((i, 1), 0) == 0


# 7 quality


def test_line_quality_oracle_on_edges(spark, edge, nothing):
    rows, docs = edge
    rows = [r for r in rows if r[0] not in (None, 5, 7)]
    common = " ".join(f"Menu{j}" for j in range(60))
    rows += [(1000 + i, f"{common} 12{i % 10}\n" + " ".join(f"w{i}x{j}" for j in range(100 if i % 2 else 20)), "en", "host", *r[4:]) for i, r in enumerate(rows[:30])]
    docs = spark.createDataFrame(rows, docs.schema)
    got = collections.Counter(tuple(r) for r in line_quality.rate_documents(docs).collect())
    con = duckdb.connect()
    documents = docs.select("doc_id", "text", "source").toPandas()  # noqa: F841
    con.execute("CREATE TABLE documents AS SELECT doc_id, text, source FROM documents")
    assert got == collections.Counter(con.execute(line_quality.ORACLE).fetchall())
    assert any(not r[7] and not r[6] for r in got)  # a depleted document
    assert line_quality.rate_documents(nothing).count() == 0


# 8 mixing


def test_apportionment_is_sainte_lague(spark):
    rng = random.Random(6)
    rows, want = [], {}
    for g in range(5):
        cells = [(g, i, rng.uniform(0.1, 40), rng.randint(1, 60)) for i in range(30)]
        seats = rng.randint(5, 500)
        quotients = sorted(((c / (2 * k - 1), i) for _, i, c, most in cells for k in range(1, most + 1)), reverse=True)[:seats]
        held = collections.Counter(i for _, i in quotients)
        want.update({(g, i): held[i] for _, i, _, _ in cells})
        rows += [(*c, seats) for c in cells]
    cells = spark.createDataFrame(rows, "g long, i long, claim double, most long, seats long")
    got = {(r.g, r.i): r.quota for r in mixing.apportion(cells, "g", "seats", "claim", "most").collect()}
    assert got == want


def test_mixing(spark, edge, nothing):
    rows, docs = edge
    got = mixing.mix_documents(docs).collect()
    sizes = collections.Counter()
    for _, t, _, s, *_ in rows:
        sizes[s] += len(split(t))
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, target, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while open_:
        unit = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if unit * weight[s] > 2 * sizes[s]}
        if not over:
            target.update({s: unit * weight[s] for s in open_})
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over
    of = collections.Counter()
    want = collections.Counter((d, len(split(t)), sizes[s], round(target[s], 6)) for d, t, _, s, *_ in rows)
    assert collections.Counter((r.doc_id, r.size, r.source_size, round(r.target, 6)) for r in got) == want
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        of[round(r.target, 6)] += r.taken
    for s in names:
        assert abs(of[round(target[s], 6)] - target[s]) <= 2 * mixing.BLOCK_WORDS
    again = mixing.mix_documents(docs.repartition(5)).collect()
    assert collections.Counter(map(tuple, again)) == collections.Counter(map(tuple, got))
    texts = mixing.mixed_texts(docs)
    assert texts.columns == docs.columns
    taken, per_doc = sum(r.taken for r in got), collections.Counter()
    for r in texts.collect():
        per_doc[r.doc_id] += len(split(r.text))
        assert r.n_chars == len(r.text)
    assert sum(per_doc.values()) == taken
    assert mixing.mix_documents(nothing).count() == 0 and mixing.mixed_texts(nothing).count() == 0


# 9 language ID


def test_langid_on_edges(spark, edge, nothing):
    rows, docs = edge
    model = langid.fit(docs.select("text", "lang"))
    got = langid.predict(docs.select("doc_id", "text"), model).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.text is None or not any(map(str.isalpha, r.text)):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        else:
            assert r.lang_pred in ("en", "fr") and 0 <= r.score <= 1
    none = langid.fit(nothing.select("text", "lang"))
    assert {r.lang_pred for r in langid.predict(docs.select("text"), none).collect()} == {"und"}
    assert langid.predict(nothing.select("text"), model).count() == 0


def test_langid_held_out_accuracy(spark):
    got = langid.op9_langid(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    r = got.filter("held_out").join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.avg(F.col("rejected").cast("int"))).first()
    assert r[0] > 0.97 and r[1] < 0.02


# 10 HTML


def test_extraction_of_marked_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in html_gbt.op10_html_gbt(spark, "/root/testdata/sf0.01").collect()}
    import html
    n = 0
    for p in pages.collect():
        story = p.html.split("<article>")[1].split("</article>")[0] if "<article>" in p.html else ""
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", story)]
        assert got[p.page_id].text == "\n\n".join(b for b in blocks if b)
        assert got[p.page_id].n_chars == len(got[p.page_id].text)
        n += bool(story)
    assert n > 100


def test_extraction_of_other_layouts(spark):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").collect()]
    model = html_gbt.train(pages)
    bank = [x.text for p in pages for x in html_gbt.walk(html_gbt.parse(p)) if len(x.text) > 60]
    rng, right = np.random.default_rng(77), [0, 0, 0]
    for _ in range(100):
        nodes = html_gbt.walk(html_gbt.parse(html_gbt.rebuilt_page(rng, bank)))
        truth = html_gbt._labels(nodes, True)
        keep = html_gbt.decode(nodes, model.log_odds(html_gbt.features(nodes)))
        for x, y, k in zip(nodes, truth, keep, strict=True):
            if x.text:
                right[0 if y and k else 1 if k else 2] += len(x.text) if y or k else 0
            if x.parent is not None and k:
                assert keep[x.parent.at]  # never main text below a rejected node
    assert right[0] / (right[0] + right[1]) > 0.95 and right[0] / (right[0] + right[2]) > 0.95


def test_extraction_of_hand_written_pages():
    """Layouts that no training page is made from, with texts that no training page holds."""
    import pyarrow.parquet as pq
    model = html_gbt.train(pq.read_table("/root/testdata/sf0.001/pages.parquet", columns=["html"]).column("html").to_pylist())
    s = "A long winter kept the river under ice until the middle of March, and the ferries stayed in the harbour while their crews mended nets and argued about the price of diesel."
    p = "The committee met twice before it agreed on a plan that neither side liked, which most observers took as a sign that the plan might work after all."
    q = "In the end it was the schoolteacher who found the old map, folded into a hymn book, and her pupils who walked the boundary with chalk and string."
    held_out = [
     (f"<html><body><div id='masthead'><a href='/'>The Gazette</a></div><div class='nav'><a href='/a'>News</a> <a href='/b'>Sport</a></div><div id='content'><h1>Ice on the river</h1><p>{s}</p><p>{p}</p></div><div class='sidebar'><h3>Popular</h3><ul><li><a href='/1'>One</a><li><a href='/2'>Two</a></ul></div><div id='footer'>&copy; The Gazette 2020</div></body></html>", f"Ice on the river\n\n{s}\n\n{p}"),
     (f"<body><header><nav><ul><li><a href=x>Home</a><li><a href=y>About</a></ul></nav></header><main><section><h2>The map</h2><p>{q}</p><blockquote>{p}</blockquote><aside class='ad'>Buy now and save</aside><p>{s}</p></section></main><footer><p>All rights reserved.</p></footer></body>", f"The map\n\n{q}\n\n{p}\n\n{s}"),
     (f"<div class='wrapper'><div class='cookie-banner'><p>We use cookies to improve this site.</p><button>Accept</button></div><div class='post'><p>{s}</p><ul><li>{p}</li><li>{q}</li></ul></div><div class='comments'><h3>2 comments</h3><div class='comment'><b>Ann</b><p>{p}</p></div></div></div>", f"{s}\n\n{p}\n\n{q}"),
    ]
    for (_, want), got in zip(held_out, html_gbt.extract([page for page, _ in held_out], model), strict=True):
        assert got == want


def test_extraction_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "no tags at all"), (4, "u", "<p>open <b>bold"), (5, "u", "<div>" * 3000 + "deep"),
            (6, "u", "<article><h1>T &amp; x</h1><p>A  b\n c &eacute;&nbsp;d<br>e</p></article><footer>f</footer>"), (6, "u", "<script>var a='<p>no</p>'"), (7, "u", "&#0; &bogus; <"),
            (8, "u", "<style>p{}</style><!-- c --><title>t</title>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("n_chars", F.lit(1))
    train = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    model = html_gbt.fit(train)
    got = html_gbt.extract_pages(pages, model).collect()
    assert len(got) == len(rows)
    text = {(r.page_id, r.url): r.text for r in got}
    assert text[(1, "u")] == text[(2, None)] == text[(8, "u")] == ""
    assert "T & x\n\nA b c é d e" in {r.text for r in got}
    assert html_gbt.extract_pages(pages.filter("false"), model).count() == 0
    assert html_gbt.extract_pages(pages, html_gbt.fit(pages.filter("false"))).count() == len(rows)


def test_embedded_elements_lose_no_text():
    read = lambda page: " ".join(" ".join(x.text for x in html_gbt.walk(html_gbt.parse(page)) if x.text).split())
    assert read("<p>a <svg class='i'/> b</p><p>c</p>") == read("<p>a <svg /> b</p><p>c<svg><text>x</text></svg></p>") == "a b c"
    assert read("<p>a <math/> b</p><p>c</p>") == "a b c"
    assert read("<p>a</p><svg><svg><text>x</text></svg><text>y</text><svg/><title/></svg><p>b</p>") == "a b"
    assert read("<p>a</p><template><p>x</p><template>y</template><p>z</p></template><p>b</p>") == "a b"
    assert read("<p>a <math><mi>x</mi><mo>=</mo></math> b <object><object>c</object> d</object></p>") == "a x= b c d"
    assert read("<p>a <svg> b</p><iframe src=x><p>c</p><svg><text>y</text></svg>d") == "a b c d"  # never closed
    assert read("<p>a</p><svg><script>'</svg>'</script><text>x</text></svg>b<script>c") == "a b"
    assert read("<svg>" * 20000 + "a") == "a"


def test_local_vocab():
    v = LocalVocab()
    assert v.ids([b"a", b"b", b"a"]).tolist() == [0, 1, 0] and len(v.hashes()) == 2

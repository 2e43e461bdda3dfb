"""LM scoring with a hierarchical Pitman-Yor model.

A token's context is the word before it (at the start of a text, the end of a text). Each context is a restaurant; all share one
parent, the restaurant of the words whatever comes before, and this the root, whose base is the given add-one unigram. Seating (the number
of tables per restaurant and word) is sampled by Gibbs sweeps: the customers of a dish are unseated and
seated again one by one by the restaurant's rule, the new seating accepted by its Metropolis
ratio (at the contexts; parent and root are reseated as proposed). The predictive probabilities of the sweeps after ``BURN_IN`` are averaged.

Words are dealt to buckets by hash; all restaurants' seats of a word lie in one bucket, so a sweep runs in the buckets. A sweep uses the
totals after the sweep before: each context's tables are summed over the buckets by a shuffle, and go back by a join to the buckets
that ask for this context; only counts of the whole table go over the driver. Dishes with one customer keep their one table, and are only
counted. A bucket repeats its sweeps from the totals of each, which are fewer than its seats. Texts are numbered in chunks of about ``CHUNK``
bytes; a chunk sends the buckets its distinct (word, word before) pairs once, and is answered with their counts and tables.
Contexts are told apart by 48 bits of a hash, words by 64.

Edge cases: a null text is the end token alone; rows repeated in full are scored alike (and
counted as often as they are there, if they are training rows); a null doc_id is a training row;
without training rows every word has the base probability 1 / (0 + 0 + 1); an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LocalVocab, by_bytes, materialize, prepare, read_table

CHUNK = 9 << 20
BUCKET_BYTES = 12 << 20  # of text per bucket of words
SWEEPS = 4
BURN_IN = 1
STRENGTH = 1.0
SEED = 4
END = b"\n"  # no word holds it
ROOT, PARENT, CONTEXT = 0, 1, 2


_CODEC = pa.Codec("zstd", 1)


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays by byte planes, compressed."""
    planes = lambda a: np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
    raw = b"".join(len(a).to_bytes(8, "little") + a.dtype.str.encode().ljust(4) + planes(a) for a in arrays)
    return len(raw).to_bytes(8, "little") + _CODEC.compress(raw, asbytes=True)


def _unpack(blob: bytes) -> list:
    raw, at, out = _CODEC.decompress(memoryview(blob)[8:], int.from_bytes(blob[:8], "little"), asbytes=True), 0, []
    while at < len(raw):
        n, dtype = int.from_bytes(raw[at:at + 8], "little"), np.dtype(raw[at + 8:at + 12].decode().strip())
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * dtype.itemsize, at + 12).reshape(dtype.itemsize, n).T).view(dtype).ravel())
        at += 12 + n * dtype.itemsize
    return out


def _small(a: np.ndarray) -> np.ndarray:
    """Values from 0 on in the narrowest type that holds them."""
    return a.astype(np.min_scalar_type(int(a.max())) if len(a) else np.uint8)


def _steps(a: np.ndarray) -> np.ndarray:
    """Differences of an ascending array; its cumulated sum restores it."""
    return _small(np.diff(a, prepend=0))


def _restored(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps.astype(np.int64))


def _hash_steps(hashes: np.ndarray) -> np.ndarray:
    return np.diff(hashes, prepend=np.uint64(0))


def _hashes(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=np.uint64)


def _code(hashes: np.ndarray) -> np.ndarray:
    """A word's code as a context: 48 bits of its hash, and the number of its parent in the low byte."""
    return (hashes >> np.uint64(16) << np.uint64(8)).astype(np.int64)


def _bucket(codes: np.ndarray, n_buckets: int) -> np.ndarray:
    return (codes >> 8) % n_buckets


def _pairs(ids: np.ndarray, lens: np.ndarray, end: int) -> np.ndarray:
    """word << 32 | word before of each token, words by their place."""
    before = np.empty(len(ids), dtype=np.int64)
    before[1:] = ids[:-1]
    before[np.cumsum(lens) - lens] = end
    return ids.astype(np.int64) << 32 | before


def _batch(rows: list, schema: pa.Schema, kind=pa.RecordBatch):
    cols = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    return kind.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


_CHUNKS = pa.schema([("chunk", pa.string()), ("bucket", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("held_out", pa.list_(pa.bool_())), ("blob", pa.binary()),
                     ("words", pa.binary())])
_CHUNKS_DDL = "chunk string, bucket long, doc_id array<long>, held_out array<boolean>, blob binary, words binary"


def _number(n_buckets: int):
    """Per chunk: its texts as numbers of its words, and the hashes of these, by bucket and hash."""
    def run(batches):
        part, k = TaskContext.get().partitionId(), 0
        held_ids, held_flags, held_texts, size = [], [], [], 0

        def chunk():
            nonlocal k
            vocab, ids = LocalVocab(), []
            for t in held_texts:
                words = t.lower().split() if t else []
                words.append(END)
                ids.append(vocab.ids(words))
            lens, flat, end = np.array([len(x) for x in ids], dtype=np.int64), np.concatenate(ids), vocab.index[END]
            hashes = vocab.hashes()
            del vocab, ids
            order = np.lexsort((hashes, _bucket(_code(hashes), n_buckets)))
            rank = np.empty(len(order), dtype=np.int64)
            rank[order] = np.arange(len(order))
            by_use = np.argsort(-np.bincount(flat, minlength=len(order)), kind="stable")  # frequent words get the small numbers
            number = np.empty_like(by_use)
            number[by_use] = np.arange(len(by_use))
            blob = _pack(_small(lens), number[flat].astype(np.uint32), rank[by_use].astype(np.uint32), rank[[end]].astype(np.uint32))
            k += 1
            return _batch([(f"{part}-{k - 1}", -1, held_ids, held_flags, blob, _pack(_hash_steps(hashes[order])))], _CHUNKS)

        for b in batches:
            texts, doc_ids, flags = b.column("text").cast(pa.binary()).to_pylist(), b.column("doc_id").to_pylist(), b.column("held_out").to_pylist()
            for lo, hi in by_bytes(texts, 1 << 20):
                held_ids.extend(doc_ids[lo:hi])
                held_flags.extend(flags[lo:hi])
                held_texts.extend(texts[lo:hi])
                size += sum(len(t) if t else 0 for t in texts[lo:hi])
                if size >= CHUNK:
                    yield chunk()
                    held_ids, held_flags, held_texts, size = [], [], [], 0
        if held_texts:
            yield chunk()
    return run


def _text(blob: bytes) -> tuple:
    """Tokens of each text, all tokens' words by their place, and the place of the end of a text."""
    lens, ids, place, end = _unpack(blob)
    return lens.astype(np.int64), place.astype(np.int64)[ids], int(end[0])


_ASKED = pa.schema([("bucket", pa.int64()), ("chunk", pa.string()), ("blob", pa.binary())])
_ASKED_DDL = "bucket long, chunk string, blob binary"


def _ask(n_buckets: int):
    """Per chunk and bucket: the chunk's distinct pairs of a word of the bucket and the word before it, with their training counts."""
    def run(batches):
        for b in batches:
            for chunk, flags, blob, words in zip(*(b.column(c).to_pylist() for c in ("chunk", "held_out", "blob", "words")), strict=True):
                (lens, ids, end), hashes = _text(blob), _hashes(_unpack(words)[0])
                tokens = _pairs(ids, lens, end) << 1
                tokens |= np.repeat(~np.array(flags, dtype=bool), lens)
                tokens.sort()
                at = np.flatnonzero(np.diff(tokens >> 1, prepend=-1))
                codes, counts = tokens[at] >> 1, np.add.reduceat(tokens & 1, at)
                del tokens, ids
                per_word = np.bincount(codes >> 32, minlength=len(hashes))
                contexts = _code(hashes)
                buckets = _bucket(contexts, n_buckets)
                before = contexts[codes & 0xFFFFFFFF] >> 8
                word_cut = np.searchsorted(buckets, np.arange(n_buckets + 1))
                pair_cut = np.concatenate([[0], np.cumsum(per_word)])[word_cut].astype(np.int64)
                for k in np.flatnonzero(np.diff(word_cut)):
                    w, p = slice(word_cut[k], word_cut[k + 1]), slice(pair_cut[k], pair_cut[k + 1])
                    used, local = np.unique(before[p], return_inverse=True)
                    asked = _pack(_hash_steps(hashes[w]), _small(per_word[w]), _steps(used), _small(local), _small(counts[p]))
                    yield _batch([(int(k), chunk, asked)], _ASKED)
    return run


def _request(blob: bytes) -> tuple:
    """Word hashes, and word (by place), context and training count of each pair."""
    steps, per_word, used, local, counts = _unpack(blob)
    return _hashes(steps), np.repeat(np.arange(len(steps), dtype=np.int32), per_word), _restored(used)[local] << 8, counts


_MERGED = pa.schema([("bucket", pa.int64()), ("chunk", pa.string()), ("blob", pa.binary()), ("words", pa.binary()), ("contexts", pa.list_(pa.int64())), ("spread", pa.binary()),
                     ("n", pa.int64()), ("v", pa.int64()), ("ones", pa.list_(pa.int64()))])
_MERGED_DDL = "bucket long, chunk string, blob binary, words binary, contexts array<long>, spread binary, n long, v long, ones array<long>"


def _merge(n_buckets: int):
    """Training counts of a bucket's pairs over all chunks: a row with the bucket's model, and a row for each chunk with the counts that it
    asked for and the places of its words and pairs in the model. A word or pair that comes once has one table for good, so the
    model holds the words that come twice and more, their pairs that do, and of the other pairs their number per word."""
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        got = [_request(b) for b in table.column("blob").to_pylist()]
        hashes = np.concatenate([h[w] for h, w, _, _ in got])
        contexts, counts = np.concatenate([g[2] for g in got]), np.concatenate([g[3] for g in got])
        order = np.lexsort((contexts, _bucket(contexts, n_buckets), hashes))
        hashes, contexts = hashes[order], contexts[order]
        new = np.ones(len(hashes), dtype=bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (contexts[1:] != contexts[:-1])
        at = np.flatnonzero(new)
        pair = np.empty(len(order), dtype=np.int64)
        pair[order] = np.cumsum(new) - 1  # of each asked pair
        c = np.add.reduceat(counts[order], at, dtype=np.int64)
        del counts, order
        words, word = np.unique(hashes[at], return_inverse=True)
        contexts = contexts[at]
        count = np.bincount(word, weights=c, minlength=len(words)).astype(np.int64)
        many, often = count > 1, c > 1  # a pair that comes twice is of a word that does
        lone = np.bincount(word[c == 1], minlength=len(words))
        place_w, place_p = np.cumsum(many) - 1, np.cumsum(often) - 1
        used, local = np.unique(contexts[often], return_inverse=True)
        n_contexts = np.bincount(word[c > 0], minlength=len(words))
        ones = [int((c == 1).sum()), int((c == 2).sum()), int((n_contexts == 1).sum()), int((n_contexts == 2).sum()), int((count == 1).sum())]
        spread, n_spread = np.unique(contexts[c > 0], return_counts=True)
        by = np.lexsort((spread, _bucket(spread, n_buckets)))
        model = _pack(_steps(place_w[word[often]]), _small(local), _small(c[often]), _small(lone[many]), _small(count[many]))
        rows = [(bucket, None, model, _pack(_hash_steps(words[many])), used.tolist(), _pack(spread[by] >> 8, _small(n_spread[by])), int(c.sum()), int((count > 0).sum()), ones)]
        lo = 0
        for chunk, (h, w, _, _) in zip(table.column("chunk").to_pylist(), got, strict=True):
            asked_w, asked_p = np.searchsorted(words, h), pair[lo:lo + len(w)]
            lo += len(w)
            blob = _pack(_small(count[asked_w]), _steps(place_w[asked_w[many[asked_w]]]), _small(c[asked_p]), _steps(place_p[asked_p[often[asked_p]]]))
            rows.append((bucket, chunk, blob, None, None, None, None, None, None))
        return _batch(rows, _MERGED, pa.Table)
    return run


def _spread(n_buckets: int):
    """The contexts that a bucket's words follow, with their numbers of words there, to the contexts' buckets."""
    def run(batches):
        for b in batches:
            for blob in b.column("spread").to_pylist():
                codes, n = _unpack(blob)
                cut = np.searchsorted(codes % n_buckets, np.arange(n_buckets + 1))
                for k in np.flatnonzero(np.diff(cut)):
                    part = codes[cut[k]:cut[k + 1]]
                    yield pa.RecordBatch.from_arrays([pa.array([int(k)], pa.int64()), pa.array([_pack(_steps(part), n[cut[k]:cut[k + 1]])], pa.binary())],
                                                     names=["bucket", "blob"])
    return run


def _restaurants(table: pa.Table) -> pa.Table:
    """Distinct words after each context of a bucket, less one; contexts with one only are left out."""
    got = [_unpack(b) for b in table.column("blob").to_pylist()]
    codes, where = np.unique(np.concatenate([_restored(g[0]) for g in got]), return_inverse=True)
    n = np.bincount(where, weights=np.concatenate([g[1] for g in got])).astype(np.int64)
    return pa.table({"u": pa.array(codes[n > 1] << 8, pa.int64()), "d": pa.array(n[n > 1] - 1, pa.int64())})


def seat(c: np.ndarray, a: np.ndarray, d: float, rng) -> tuple[np.ndarray, np.ndarray]:
    """Tables after seating c customers of each dish one by one (a: weight of a new table), and the
    log of the product of the rule's normalisers. From the 32nd customer on, customers come in groups
    of a sixteenth of those seated."""
    order = np.argsort(-c, kind="stable")
    c, a = c[order], a[order]
    t, logz, i = np.ones(len(c), dtype=np.int64), np.zeros(len(c)), 1
    active = len(c)
    while True:
        active = int(np.searchsorted(-c[:active], -i, side="left"))
        if not active:
            break
        step = max(1, i // 16)
        weight = a[:active] + i - d * t[:active]
        p = np.minimum(a[:active] / weight, 1.0)
        if step == 1:
            born = rng.random(active) < p
            logz[:active] += np.log(weight)
        else:
            n = np.minimum(step, c[:active] - i)
            born = rng.binomial(n, p)
            logz[:active] += n * np.log(weight)
        t[:active] += born
        i += step
    out_t, out_z = np.empty_like(t), np.empty_like(logz)
    out_t[order], out_z[order] = t, logz
    return out_t, out_z


class Held:
    """Values by key, ``rest`` for the others."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, rest: float = 0.0) -> None:
        order = np.argsort(keys, kind="stable")
        self.keys, self.values = np.append(np.asarray(keys, dtype=np.int64)[order], np.iinfo(np.int64).max), np.append(np.asarray(values, float)[order], rest)
        self.rest = rest

    def __getitem__(self, wanted):
        at = np.searchsorted(self.keys, wanted)
        return np.where(self.keys[at] == wanted, self.values[at], self.rest)


class Totals:
    """Customers and tables per restaurant: contexts (by code), parents (256), root."""

    def __init__(self, tables, customers) -> None:
        self.tables, self.customers = tables, customers


class Seating:
    """The seats of one bucket's words, level by level: CONTEXT, PARENT, ROOT. ``lone``: further contexts of each word, under parent 0,
    with one customer."""

    def __init__(self, bucket: int, blob: bytes, setting: dict, lone=None, count=None) -> None:
        self.words, word, contexts, c = _unpack(blob)
        self.word, self.context, self.c2 = word.astype(np.int64), contexts.astype(np.int64), c
        codes, alone = self.word << 8 | self.context & 0xFF, np.arange(len(self.words) if lone is not None else 0) << 8
        self.parent_codes, up = np.unique(np.concatenate([codes, alone]), return_inverse=True)
        self.up = up[:len(codes)]
        self.word1, self.parent = self.parent_codes >> 8, self.parent_codes & 0xFF
        self.lone = np.zeros(len(self.parent_codes), dtype=np.int64)
        if lone is not None:
            self.lone[up[len(codes):]] = lone
        self.count = np.bincount(self.word, weights=c, minlength=len(self.words)) if count is None else count
        self.setting, self.rng = setting, np.random.default_rng([SEED, bucket])
        self.base = (self.count + 1) / (setting["n"] + setting["v"] + 1)
        self.t2, self.z2 = np.ones_like(self.c2), None
        self._below()
        self.t1, self.z1 = np.ones_like(self.c1), None
        self.c0 = np.bincount(self.word1, weights=self.t1, minlength=len(self.words)).astype(np.int64)
        self.t0, self.z0 = np.ones_like(self.c0), None

    def _below(self) -> None:
        self.c1 = self.lone + np.bincount(self.up, weights=self.t2, minlength=len(self.word1)).astype(np.int64)

    def upper(self, totals: Totals) -> tuple:
        """Probability of each word at the root, of each (word, parent) pair."""
        d, s = self.setting["d"], STRENGTH
        c, t = totals.customers, totals.tables
        p0 = (self.c0 - d[ROOT] * self.t0 + (s + d[ROOT] * t[ROOT]) * self.base) / (s + c[ROOT])
        p1 = (self.c1 - d[PARENT] * self.t1 + (s + d[PARENT] * t[PARENT][self.parent]) * p0[self.word1]) / (s + c[PARENT][self.parent])
        return p0, p1

    def probabilities(self, totals: Totals) -> tuple:
        """Of each word at the root, of each (word, parent) pair, of each (word, context) pair."""
        d, s = self.setting["d"], STRENGTH
        c, t = totals.customers, totals.tables
        p0, p1 = self.upper(totals)
        p2 = (self.c2 - d[CONTEXT] * self.t2 + (s + d[CONTEXT] * t[CONTEXT][self.context]) * p1[self.up]) / (s + c[CONTEXT][self.context])
        return p0, p1, p2

    def _resample(self, c, t, z, a, d):
        new_t, new_z = seat(c, np.maximum(a, 1e-300), d, self.rng)
        if z is None:
            return new_t, new_z
        take = np.log(self.rng.random(len(c))) < new_z - z
        return np.where(take, new_t, t), np.where(take, new_z, z)

    def sweep(self, totals: Totals) -> None:
        d, s, t = self.setting["d"], STRENGTH, totals.tables
        p0, p1 = self.upper(totals)
        self.t2, self.z2 = self._resample(self.c2, self.t2, self.z2, (s + d[CONTEXT] * t[CONTEXT][self.context]) * p1[self.up], d[CONTEXT])
        self._below()
        self.z1 = None  # its customers have changed
        self.t1, self.z1 = self._resample(self.c1, self.t1, self.z1, (s + d[PARENT] * t[PARENT][self.parent]) * p0[self.word1], d[PARENT])
        self.c0 = np.bincount(self.word1, weights=self.t1, minlength=len(self.words)).astype(np.int64)
        self.t0, self.z0 = self._resample(self.c0, self.t0, None, (s + d[ROOT] * t[ROOT]) * self.base, d[ROOT])

    def totals_rows(self) -> tuple[list, list, list]:
        u2, at = np.unique(self.context, return_inverse=True)
        t2 = np.bincount(at, weights=self.t2, minlength=len(u2)).astype(np.int64)
        t1 = np.bincount(self.parent, weights=self.t1, minlength=256).astype(np.int64)
        u1 = np.flatnonzero(t1)
        return ([CONTEXT] * len(u2) + [PARENT] * len(u1) + [ROOT], [*u2.tolist(), *u1.tolist(), 0],
                [*t2.tolist(), *t1[u1].tolist(), int(self.t0.sum())])


def _totals(rows, customers2: np.ndarray) -> Totals:
    """Totals of seats that lie in one place."""
    t1, t0, u2, t2 = np.zeros(256), 0, [], []
    for r in rows:
        if r["level"] == CONTEXT:
            u2.append(r["u"])
            t2.append(r["t"])
        elif r["level"] == PARENT:
            t1[r["u"]] = r["t"]
        else:
            t0 = r["t"]
    c1 = np.bincount(np.array(u2, dtype=np.int64) & 0xFF, weights=t2, minlength=256)
    return Totals((t0, t1, Held(np.array(u2), np.array(t2))), (t1.sum(), c1, customers2))


def _seating(bucket: int, blob: bytes, contexts: list, setting: dict) -> Seating:
    steps, local, c, lone, count = _unpack(blob)
    codes = np.array(contexts, dtype=np.int64)[local] if len(local) else np.zeros(0, np.int64)
    return Seating(bucket, _pack(np.zeros(len(lone), np.uint8), _restored(steps).astype(np.uint32), codes, c.astype(np.int64)), setting, lone.astype(np.int64), count.astype(np.int64))


def _shared(scalars: list, tables) -> list[Totals]:
    """Totals before each sweep: the parent's and the root's, the same for all buckets, and the contexts' (one column for each sweep)."""
    keys = tables.column("u").to_numpy()
    columns = [tables.column(f"d{j}").to_numpy() for j in range(len(scalars))]
    first = np.argsort(keys, kind="stable")
    parent = lambda x: np.full(256, float(x))
    return [Totals((t0, parent(t1), Held(keys[first], 1 + d[first], 1)), (c0, parent(c1), None)) for (t0, t1, c0, c1), d in zip(scalars, columns, strict=True)]


_TABLES = pa.schema([("u", pa.list_(pa.int64())), ("d", pa.list_(pa.int64())), ("t0", pa.int64()), ("t1", pa.int64()), ("c1", pa.int64())])
_TABLES_DDL = "u array<long>, d array<long>, t0 long, t1 long, c1 long"


def _sweep(setting: dict, scalars: list):
    """A bucket's tables after len(scalars) sweeps: per context those beyond one a pair, of the parent and the root all."""
    def run(model: pa.Table, tables: pa.Table) -> pa.Table:
        rows = []
        for bucket, blob, contexts in zip(*(model.column(c).to_pylist() for c in ("bucket", "blob", "contexts")), strict=True):
            state = _seating(bucket, blob, contexts, setting)
            for totals in _shared(scalars, tables):
                state.sweep(totals)
            u, at = np.unique(state.context, return_inverse=True)
            more = np.bincount(at, weights=state.t2 - 1, minlength=len(u)).astype(np.int64)
            rows.append((u[more > 0].tolist(), more[more > 0].tolist(), int(state.t0.sum()), int(state.t1.sum()), int(state.c1.sum())))
        return _batch(rows, _TABLES, pa.Table)
    return run


_ANSWER = pa.schema([_CHUNKS.field(i) for i in range(5)])
_ANSWER_DDL = _CHUNKS_DDL.removesuffix(", words binary")


def _answer(setting: dict, scalars: list):
    """For each chunk's words and pairs in the bucket: counts; of words that come twice and more, the probability at the parent and the tables
    as a context after each kept sweep; of pairs that do, the tables over all kept sweeps."""
    def run(merged: pa.Table, tables: pa.Table) -> pa.Table:
        rows = list(zip(*(merged.column(c).to_pylist() for c in ("bucket", "chunk", "blob", "contexts", "words")), strict=True))
        bucket, _, blob, contexts, words = next(r for r in rows if r[1] is None)
        state, shared = _seating(bucket, blob, contexts, setting), _shared(scalars, tables)
        sums, parents, own = np.zeros(len(state.c2), dtype=np.int64), [], _code(_hashes(_unpack(words)[0]))
        for j in range(SWEEPS):
            state.sweep(shared[j])
            if j >= BURN_IN:
                sums += state.t2
                parents.append(state.upper(shared[j + 1])[1])
        at_parent = np.stack(parents).astype(np.float32)
        as_context = np.stack([t.tables[CONTEXT][own] for t in shared[BURN_IN + 1:]]).astype(np.int64)
        out = []
        for _, chunk, asked, *_ in rows:
            if chunk is not None:
                count, words, c, pairs = _unpack(asked)
                w = _restored(words)
                out.append((chunk, bucket, None, None, _pack(count, at_parent[:, w].ravel(), _small(as_context[:, w].ravel()), c, _small(sums[_restored(pairs)]))))
        return _batch(out, _ANSWER, pa.Table)
    return run


_SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
                     ("base_score", pa.float64()), ("score", pa.float64())])


def _score(setting: dict, scalars: list):
    n, v, d, s = setting["n"], setting["v"], setting["d"], STRENGTH

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("bucket", "doc_id", "held_out", "blob")), strict=True), key=lambda r: r[0])
        _, doc_ids, flags, blob = rows[0]
        lens, ids, end = _text(blob)
        answers = [_unpack(r[3]) for r in rows[1:]]
        count, c = (np.concatenate([a[i] for a in answers]).astype(np.int64) for i in (0, 3))
        kept = SWEEPS - BURN_IN
        starts = np.cumsum(lens) - lens
        codes, where = np.unique(_pairs(ids, lens, end), return_inverse=True)
        word, before, many = codes >> 32, codes & 0xFFFFFFFF, count > 1
        tables = np.zeros(len(c))
        tables[c == 1] = kept
        tables[c > 1] = np.concatenate([a[4] for a in answers])
        p = c - d[CONTEXT] * tables / kept
        at_parent, as_context = (np.concatenate([a[i].reshape(kept, -1) for a in answers], axis=1) for i in (1, 2))
        for k, (t0, t1, c0, c1) in enumerate(scalars[BURN_IN + 1:]):
            new = lambda seen, k0=(t0, c0), k1=(t1, c1): (
                seen * (1 - d[PARENT]) + (s + d[PARENT] * k1[0]) * (seen * (1 - d[ROOT]) + (s + d[ROOT] * k0[0]) * (seen + 1) / (n + v + 1)) / (s + k0[1])) / (s + k1[1])
            above = np.where(count == 1, new(1), new(0))
            above[many] = at_parent[k]
            seats = (count == 1).astype(float)
            seats[many] = as_context[k]
            p += (s + d[CONTEXT] * seats[before]) * above[word] / kept
        logp = np.log10(p / (s + count[before]))
        base = np.log10((count.astype(np.float64) + 1) / (n + v + 1))
        cols = (doc_ids, flags, lens, np.add.reduceat((count[ids] > 0).astype(np.int64), starts), np.full(len(lens), n),
                np.add.reduceat(base[ids], starts), np.add.reduceat(logp[where], starts))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _SCORED, strict=True)], schema=_SCORED)
    return run


def score_documents(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, held_out) -> doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    prepare(spark)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(1, -(-total // BUCKET_BYTES))
    chunks = materialize(spark, docs.select("doc_id", "text", "held_out").mapInArrow(_number(n_buckets), _CHUNKS_DDL), "lm-chunks")
    asked = chunks.select("chunk", "held_out", "blob", "words").mapInArrow(_ask(n_buckets), _ASKED_DDL)
    merged = materialize(spark, asked.groupBy("bucket").applyInArrow(_merge(n_buckets), _MERGED_DDL), "lm-merged")
    model = merged.filter("chunk is null").select("bucket", "blob", "contexts")
    sums = merged.agg(F.sum("n").alias("n"), F.sum("v").alias("v"), *[F.sum(F.col("ones")[i]).alias(f"o{i}") for i in range(5)]).first()
    n, v, alone = sums["n"] or 0, sums["v"] or 0, sums["o4"] or 0
    discount = lambda one, two: float(np.clip(one / (one + 2 * two), 0.1, 0.9)) if one else 0.5
    upper = discount(sums["o2"] or 0, sums["o3"] or 0)
    setting = {"n": n, "v": v, "d": (upper, upper, discount(sums["o0"] or 0, sums["o1"] or 0))}
    spread = merged.filter("chunk is null").select("spread").mapInArrow(_spread(n_buckets), "bucket long, blob binary")
    restaurants = materialize(spark, spread.groupBy("bucket").applyInArrow(_restaurants, "u long, d long"), "lm-restaurants")
    asking = model.select(F.explode("contexts").alias("u"), F.col("bucket").alias("asker"))
    changes: list[DataFrame] = []  # of each sweep

    def tables() -> DataFrame:
        """Tables beyond the first of each restaurant that has them, before the first sweep and after each."""
        rows = [restaurants.select("u", F.lit(0).alias("k"), "d")]
        rows += [t.select(F.explode(F.arrays_zip("u", "d")).alias("x")).select("x.u", F.lit(k).alias("k"), "x.d") for k, t in enumerate(changes, 1)]
        of = lambda j: F.sum(F.when(F.col("k").isin(0, j), F.col("d")).otherwise(0)).alias(f"d{j}")
        return reduce(DataFrame.unionByName, rows).groupBy("u").agg(*[of(j) for j in range(len(changes) + 1)])

    pairs = restaurants.agg(F.sum("d")).first()[0] or 0
    scalars = [(v, v, v, pairs + v)]  # one table for each dish
    for j in range(SWEEPS):
        for_bucket = asking.join(tables(), "u")
        swept = model.groupBy("bucket").cogroup(for_bucket.groupBy("asker")).applyInArrow(_sweep(setting, list(scalars)), _TABLES_DDL)
        changes.append(materialize(spark, swept, f"lm-tables-{j}"))
        t0, t1, c1 = changes[-1].agg(F.sum("t0"), F.sum("t1"), F.sum("c1")).first()
        t0, t1, c1 = ((x or 0) + alone for x in (t0, t1, c1))
        scalars.append((t0, t1, t1, c1))
    last = tables()
    own = last.withColumn("asker", F.shiftright("u", 8) % n_buckets)
    for_bucket = asking.join(last, "u").unionByName(own)
    answers = merged.select("bucket", "chunk", "blob", "contexts", "words").groupBy("bucket").cogroup(for_bucket.groupBy("asker")).applyInArrow(
        _answer(setting, scalars), _ANSWER_DDL)
    return chunks.drop("words").unionByName(answers).groupBy("chunk").applyInArrow(
        _score(setting, scalars), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op4_hpy_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    return score_documents(docs.select("doc_id", "text", held_out.alias("held_out")))

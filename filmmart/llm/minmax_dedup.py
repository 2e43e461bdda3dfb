"""MinHash near-dedup with min-max hashing.

Each hash function is evaluated once per shingle and gives two signature values, its minimum and
its maximum: ``N_HASH`` evaluations make 2 * N_HASH values, cut into bands of ``ROWS`` values of
different hash functions. Documents with the same word sequence are one class. In each band's
bucket of classes a pivot is compared with all members; then the members outside the pivot's
component are compared with all members of other components. Every candidate is confirmed on
the full shingle sets, so a link is never wrong; a pair at the threshold shares no band with
probability (1 - 0.85^5)^24 < 1e-6. Before that, pairs go whose sets cannot be close enough: sets
of n and m shingles have the similarity only if they differ in at most 0.15 / 1.85 * (n + m), and
two bitmaps of hashed shingles differ in at most as many bits as the sets differ in shingles. No pair within one component is compared beyond the
pivot's, whatever the size of a group of copies.

Edge cases: a null or word-less text has an empty set and links with nothing; fewer than five
words make one shingle; rows repeated in full are alike; rows with one doc_id but different
texts are classes of their own; a null doc_id is never the smallest id (component_id is null
if a component has no other) and ``near_duplicates`` marks no row without a doc_id as kept; an empty
table gives an empty result; extra columns are ignored. ``near_dedup`` keeps them, and goes by rows: exactly one
row of each component stays, also if rows are repeated in full, share a doc_id or have none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LocalVocab, by_bytes, materialize, mix, prepare, read_table, shingle_hashes, unused
from .components import components

SHINGLE = 5
THRESHOLD = 85  # per cent of the union
ROWS = 5
N_HASH = 60
BANDS = 2 * N_HASH // ROWS
CELL = 512  # members of a bucket in a block
TOGETHER = 2000  # pairs of one pivot in a task
BITS = 1024  # of the bitmap that bounds the difference of two sets
SKETCH = [f"s{i}" for i in range(BITS // 64)]

_RNG = np.random.default_rng(20_11)
_A = _RNG.integers(0, 2**63, N_HASH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 2**63, N_HASH, dtype=np.uint64)


def _shingles(texts: list) -> list:
    """Sorted distinct shingle hashes of each text, and its class (hash of the word sequence)."""
    vocab, tokens, keys = LocalVocab(), [], []
    for t in texts:
        words = t.lower().split() if t else []
        tokens.append(vocab.ids(words))
        keys.append(xxhash.xxh3_128_digest(b" ".join(words)))
    hashes = vocab.hashes()
    return [np.unique(shingle_hashes(hashes[ids], SHINGLE)) for ids in tokens], keys


def _bands(sets: list) -> np.ndarray:
    """BANDS keys for each (non-empty) set, from the minima and maxima of N_HASH functions."""
    starts = np.cumsum([0, *[len(s) for s in sets[:-1]]])
    flat = np.concatenate(sets)
    values = np.empty((2 * N_HASH, len(sets)), dtype=np.uint64)
    for p in range(N_HASH):
        h = flat * _A[p]
        h += _B[p]
        values[p] = np.minimum.reduceat(h, starts)
        values[N_HASH + p] = np.maximum.reduceat(h, starts)
    keys = np.empty((len(sets), BANDS), dtype=np.uint64)
    for j in range(BANDS):
        k = np.full(len(sets), j + 1, dtype=np.uint64)
        for r in range(ROWS):
            k = mix(k ^ values[j * ROWS + r])
        keys[:, j] = k
    return keys


_SIGNED = pa.schema([("doc_id", pa.int64()), ("row", pa.binary()), ("n_shingles", pa.int64()), ("node", pa.binary()), ("bands", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))])


def _bitmap(shingles: np.ndarray) -> np.ndarray:
    bits = np.zeros(BITS, dtype=bool)
    bits[(shingles % np.uint64(BITS)).astype(np.int64)] = True
    return np.packbits(bits).view(np.int64)


def _may_link(a: str, b: str, n_a: str, n_b: str) -> "F.Column":
    """False only for pairs whose similarity is below the threshold."""
    differ = sum((F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))) for s in SKETCH), F.lit(0))
    n, m = F.col(f"{a}.{n_a}"), F.col(f"{b}.{n_b}")
    return (100 * F.least(n, m) >= THRESHOLD * F.greatest(n, m)) & ((100 + THRESHOLD) * differ <= (100 - THRESHOLD) * (n + m))


def _sign(batches):
    for b in batches:
        texts = b.column("text").cast(pa.binary()).to_pylist()
        for lo, hi in by_bytes(texts, 2 << 20):
            sets, keys = _shingles(texts[lo:hi])
            full = [i for i, s in enumerate(sets) if len(s)]
            rows: list = [None] * len(sets)
            if full:
                for i, k in zip(full, _bands([sets[i] for i in full]).view(np.int64), strict=True):
                    rows[i] = k
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").slice(lo, hi - lo).cast(pa.int64()), b.column("row").slice(lo, hi - lo), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([k if len(s) else None for k, s in zip(keys, sets, strict=True)], pa.binary()),
                 pa.array(rows, pa.list_(pa.int64())),
                 pa.array([_bitmap(s) if len(s) else None for s in sets], pa.list_(pa.int64()))], schema=_SIGNED)


def _confirm(batches):
    """Rows (b, salt, a, text) sorted by b, salt and a, nulls first: a null a brings b's own text, the others the texts to hold
    against it. Keeps the pairs (a, b) whose full sets have the similarity asked for."""
    key, held = None, None
    for batch in batches:
        b, a, salts = (batch.column(c).to_pylist() for c in ("b", "a", "salt"))
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        keep_a, keep_b = [], []
        for lo, hi in by_bytes(texts, 2 << 20):
            sets, _ = _shingles(texts[lo:hi])
            for i, x in zip(range(lo, hi), sets, strict=True):
                if a[i] is None:
                    key, held = (b[i], salts[i]), x
                elif key == (b[i], salts[i]):
                    same = len(np.intersect1d(x, held, assume_unique=True))
                    if 100 * same >= THRESHOLD * (len(x) + len(held) - same):
                        keep_a.append(a[i])
                        keep_b.append(b[i])
        yield pa.RecordBatch.from_arrays([pa.array(keep_a, pa.binary()), pa.array(keep_b, pa.binary())], names=["a", "b"])


def _cell_pairs(batches):
    """Rows of cells (bucket, i, j), sorted by them: the members of blocks i and j of a bucket. Gives the pairs of members of different
    components that may have the similarity, by set sizes and bitmaps, each in the first bucket that both are in. A pivot, whose
    component is null here, has been compared already."""
    def pairs(key: tuple, rows: list) -> list:
        bucket, i, j = key
        rows = [r for r in rows if r["component"] is not None]
        if len(rows) < 2:
            return []
        number: dict = {}
        component = np.array([number.setdefault(r["component"], len(number)) for r in rows])
        if len(number) < 2:
            return []
        sketch = np.array([r["sketch"] for r in rows], dtype=np.int64).view(np.uint64)
        bands = np.array([r["bands"] for r in rows], dtype=np.int64)
        n = np.array([r["n"] for r in rows], dtype=np.int64)
        block = np.array([r["own"] for r in rows])
        left = np.flatnonzero(block == i)
        right = left if i == j else np.flatnonzero(block == j)
        x, y = n[left][:, None], n[right][None, :]
        may = (component[left][:, None] != component[right][None, :]) & (100 * np.minimum(x, y) >= THRESHOLD * np.maximum(x, y))
        if i == j:
            may &= np.arange(len(left))[:, None] < np.arange(len(right))[None, :]
        p, q = np.nonzero(may)
        p, q = left[p], right[q]
        out = []
        for lo in range(0, len(p), 1 << 16):
            a, b = p[lo:lo + (1 << 16)], q[lo:lo + (1 << 16)]
            differ = np.bitwise_count(sketch[a] ^ sketch[b]).sum(axis=1, dtype=np.int64)
            close = (100 + THRESHOLD) * differ <= (100 - THRESHOLD) * (n[a] + n[b])
            a, b = a[close], b[close]
            same = bands[a] == bands[b]
            first = bands[a, same.argmax(axis=1)] == bucket
            out.extend((rows[k]["node"], rows[m]["node"]) for k, m in zip(a[first].tolist(), b[first].tolist(), strict=True))
        return out

    key, held = None, []
    for batch in batches:
        found = []
        for r in batch.to_pylist():
            if key != (r["bucket"], r["i"], r["j"]):
                if held:
                    found += pairs(key, held)
                key, held = (r["bucket"], r["i"], r["j"]), []
            held.append(r)
        yield _pair_batch(found)
    if held:
        yield _pair_batch(pairs(key, held))


def _pair_batch(found: list) -> pa.RecordBatch:
    a, b = zip(*found, strict=True) if found else ([], [])
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) that hold on the full sets. b's text goes once to each task that holds some of its pairs."""
    spark = pairs.sparkSession
    counts = materialize(spark, pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / TOGETHER).alias("salts")), "minmax-salts")
    own = counts.join(texts, F.col("b") == F.col("node")).select(
        "b", F.explode(F.sequence(F.lit(0), F.col("salts").cast("int") - 1)).alias("salt"), F.lit(None).cast("binary").alias("a"), "text")
    dealt = pairs.join(counts, "b").select("b", F.pmod(F.xxhash64("a"), F.col("salts")).cast("int").alias("salt"), "a")
    rows = own.unionByName(dealt.join(texts, F.col("a") == F.col("node")).select("b", "salt", "a", "text"))
    rows = rows.repartition("b", "salt").sortWithinPartitions("b", "salt", F.col("a").asc_nulls_first())
    return rows.mapInArrow(_confirm, "a binary, b binary")


def _grouped(docs: DataFrame, row) -> DataFrame:
    """doc_id, row (the given column), n_shingles, node (class; null without words), component, component_id; one row per
    row of ``docs``."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select("doc_id", "text", row.cast("binary").alias("row"))
    signed = materialize(spark, docs.mapInArrow(_sign, "doc_id long, row binary, n_shingles long, node binary, bands array<long>, sketch array<long>"), "minmax-signed")
    # One row per class; copies are merged before the shuffle.
    classes = signed.filter("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.min("n_shingles").alias("n"), F.first("bands").alias("bands"),
        F.first("sketch").alias("sketch"))
    classes = materialize(spark, classes, "minmax-classes")
    sketches = classes.select("node", "n", "bands", "sketch", *[F.col("sketch")[i].alias(c) for i, c in enumerate(SKETCH)])
    members = classes.select("node", F.explode("bands").alias("bucket"))
    buckets = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("pivot")).filter("size > 1")
    buckets = materialize(spark, buckets.select("bucket", "pivot"), "minmax-buckets")
    members = materialize(spark, members.join(buckets, "bucket"), "minmax-members")  # bucket, node, pivot
    in_buckets = materialize(spark, sketches.join(members.select("node").distinct(), "node"), "minmax-sketches")
    stars = members.filter("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    stars = materialize(spark, stars, "minmax-stars").alias("p").join(
        in_buckets.alias("x"), F.col("p.a") == F.col("x.node")).join(
        in_buckets.alias("y"), (F.col("p.b") == F.col("y.node")) & _may_link("x", "y", "n", "n")).select("p.a", "p.b")
    # Texts of the classes in any bucket. A class is found by one of its documents.
    wanted = members.select("node").distinct().join(classes.select("node", "rep"), "node")
    holders = signed.filter("node is not null").select("doc_id", "node").join(
        wanted.select("node", "rep"), "node").filter(F.col("doc_id").eqNullSafe(F.col("rep"))).select("doc_id", "node").distinct()
    holders = materialize(spark, holders, "minmax-holders")
    # Holders grow with the texts: they are shuffled at every size, never sent whole to each executor.
    texts = docs.join(holders.hint("merge"), docs["doc_id"].eqNullSafe(holders["doc_id"])).select("node", "text")
    # Rows with one doc_id may have other texts: only the class's own text confirms.
    texts = texts.mapInArrow(_own_text, "node binary, text string")
    texts = materialize(spark, texts.groupBy("node").agg(F.first("text").alias("text")), "minmax-texts")
    links = materialize(spark, _confirmed(stars, texts), "minmax-links")
    found = materialize(spark, components(links), "minmax-components")

    # What the pivots left open: members outside the pivot's component, against members of any other component.
    placed = members.join(found, "node", "left").select(
        "bucket", "node", "pivot", F.coalesce("component", "node").alias("component"))
    pivots = found.select(F.col("node").alias("pivot"), F.col("component").alias("pivot_component"))
    placed = placed.join(pivots, "pivot", "left").withColumn("main", F.coalesce("pivot_component", "pivot") == F.col("component"))
    placed = materialize(spark, placed.drop("pivot_component"), "minmax-placed")
    # Only buckets that hold several components have pairs to try: blocks of their members meet in cells of bounded size.
    unsettled = placed.groupBy("bucket").agg(F.count_if(~F.col("main")).alias("open"), F.ceil(F.count(F.lit(1)) / CELL).alias("blocks"))
    unsettled = materialize(spark, unsettled.filter("open > 0").select("bucket", F.col("blocks").cast("int").alias("blocks")), "minmax-unsettled")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    cells = placed.join(unsettled, "bucket").join(in_buckets, "node").select(
        "bucket", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"), "node",
        F.when(F.col("node") != F.col("pivot"), F.col("component")).alias("component"), "n", "sketch", "bands")
    cells = cells.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("other")
    cells = cells.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    open_pairs = cells.mapInArrow(_cell_pairs, "a binary, b binary")
    open_pairs = materialize(spark, open_pairs, "minmax-open")
    more = materialize(spark, _confirmed(open_pairs, texts), "minmax-more")
    if not more.isEmpty():
        found = materialize(spark, components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)),
                            "minmax-components")
    ids = classes.select("node", "rep").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = materialize(spark, ids.groupBy("component").agg(F.min("rep").alias("component_id")), "minmax-least")
    ids = materialize(spark, ids.join(least, "component").select(F.col("node").alias("n_node"), "component", "component_id"), "minmax-ids")
    out = signed.select("doc_id", "row", "n_shingles", "node").join(ids, F.col("node") == F.col("n_node"), "left")
    component_id = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "row", "n_shingles", "node", "component", component_id.alias("component_id"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept; one row per row of ``docs``."""
    return _grouped(docs, F.lit(None)).select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def _own_text(batches):
    for b in batches:
        nodes, texts = b.column("node").to_pylist(), b.column("text").cast(pa.binary()).to_pylist()
        own = [xxhash.xxh3_128_digest(b" ".join((t or b"").lower().split())) == n for n, t in zip(nodes, texts, strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("node"), b.column("text")], names=["node", "text"]).filter(pa.array(own, pa.bool_()))


def near_dedup(docs: DataFrame) -> DataFrame:
    """The documents that stay: of each component one row, by the smallest doc_id (null last), class and digest of the row;
    of the rows without words all but repeated ones."""
    spark = docs.sparkSession
    digest = F.unhex(F.sha2(F.concat(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce(F.concat(F.lit(" "), "text"), F.lit(""))).cast("binary"), 256))
    kept_row, kept_n = unused(docs, "kept_row"), unused(docs, "kept_n")
    rows = _grouped(docs, digest).withColumn("component", F.coalesce("component", "row"))
    rows = rows.groupBy("component", "doc_id", "node", "row").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "node", "row", "n")).alias("first")
    stay = rows.groupBy("component").agg(first).select(F.col("first.row").alias(kept_row), F.col("first.n").alias(kept_n))
    stay = materialize(spark, stay, "minmax-stay")
    numbered = docs.withColumn(kept_row, digest)
    once = numbered.join(stay.filter(F.col(kept_n) == 1), kept_row, "left_semi")
    # Of rows alike one stays; written first, so that a row repeated very often is merged where it is read.
    alike = materialize(spark, numbered.join(stay.filter(F.col(kept_n) > 1), kept_row, "left_semi"), "minmax-alike")
    return once.unionByName(alike.dropDuplicates([kept_row])).select(docs.columns)


def op2_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))

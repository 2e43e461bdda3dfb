"""Hard-negative mining with exact integer scores by the method of the four Russians.

Vectors are quantised to integers floor(scale * x). Candidates are packed into blocks of rows: each group of eight dimensions
gives one byte per bit plane (two's complement) and row. An anchor has, for each group, a table of its 256 subset sums; a byte indexes it, and the
looked-up sums, shifted by plane and added (the sign plane subtracted), are the exact inner product. Tables of many anchors stand side by side, so
one byte fetches the partial sums of all of them.

Every anchor meets every block: blocks of anchors are dealt to all numbers of candidate blocks, and joined by that number. A first
pass scores rows of an anchor's own label and keeps its first positives, a second one scores the others against
the ranges that these positives set. Each task keeps, per anchor and positive, no more than the rows asked for; their first ones over all
blocks are a top-k per group. Blocks hold a fixed number of rows, dealt evenly, so a frequent label or vector makes no task larger, and
anchors are shuffled, never broadcast.

Edge cases: rows with a null label, a null vector, a null or non-finite component (or one beyond 2^55, outside 64 bits after
scaling) take no part; vectors of different lengths are compared as if padded with zeros; scores are exact in
64 bits; equal scores go by smaller id, null ids last, which can be positives and negatives but no anchors; of
repeated rows each takes part, and an anchor leaves out only itself; an empty table, or one without anchors, gives an empty
result; an anchor without positives, or a positive without negatives, has no row; extra columns are ignored.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ARROW_ROWS, materialize, prepare, read_table

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
BLOCK = 4096  # candidate rows
ANCHORS = 1024  # anchors in a block
GROUP = 8  # dimensions that share a table
TILE = 128  # anchors scored at once: their tables stay in the cache
CELLS = 16  # pairs of blocks in an Arrow batch


# ---- blocks

_BLOCK = pa.schema([("block", pa.int64()), ("n", pa.int64()), ("dims", pa.int64()), ("ids", pa.binary()), ("unnamed", pa.binary()),
                    ("labels", pa.binary()), ("data", pa.binary()), ("kind", pa.string())])
_BLOCK_SQL = "block long, n long, dims long, ids binary, unnamed binary, labels binary, data binary, kind string"


def _quantised(vectors: pa.Array) -> np.ndarray:
    """n x dims integers, shorter vectors padded with zeros; dims a multiple of GROUP."""
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    dims = max(GROUP, -(-int(sizes.max(initial=0)) // GROUP) * GROUP)
    flat = np.floor(SCALE * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).astype(np.int64)
    out = np.zeros((len(sizes), dims), dtype=np.int64)
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def planes_of(q: np.ndarray) -> np.ndarray:
    """planes x groups x rows bytes of the two's complement; the last plane is the sign."""
    most = max(int(q.max(initial=0)), -int(q.min(initial=0)) - 1, 0)
    planes = most.bit_length() + 1
    return np.stack([np.packbits((q >> p & 1).astype(np.uint8), axis=1, bitorder="little").T for p in range(planes)])


def _packer(size: int, packed: bool):
    """Blocks of up to ``size`` rows in the order of their ids: as bit planes, or as plain integers."""
    def block(parts: list, number: int) -> pa.RecordBatch:
        t = pa.concat_batches(parts)
        unnamed = t.column("id").is_null().to_numpy(zero_copy_only=False)
        ids = t.column("id").fill_null(0).to_numpy()
        order = np.lexsort((ids, unnamed))
        q = _quantised(t.column("vector"))[order]
        data = planes_of(q) if packed else q
        return pa.RecordBatch.from_pydict({
            "block": [TaskContext.get().partitionId() << 32 | number], "n": [len(order)], "dims": [q.shape[1]],
            "ids": [ids[order].tobytes()], "unnamed": [unnamed[order].astype(np.uint8).tobytes()],
            "labels": [t.column("label").to_numpy()[order].tobytes()], "data": [data.tobytes()], "kind": ["planes" if packed else "rows"]}, schema=_BLOCK)

    def pack(batches):
        held, rows, number = [], 0, 0
        for b in batches:
            while b.num_rows:
                take = b.slice(0, size - rows)
                held.append(take)
                rows, b = rows + take.num_rows, b.slice(take.num_rows)
                if rows == size:
                    yield block(held, number)
                    held, rows, number = [], 0, number + 1
        if rows:
            yield block(held, number)
    return pack


def _blocks(rows: DataFrame, n: int, size: int, packed: bool, name: str) -> DataFrame:
    """Rows dealt evenly, whatever their keys, written as blocks."""
    return materialize(rows.sparkSession, rows.repartition(max(1, ceil(n / size))).mapInArrow(_packer(size, packed), _BLOCK_SQL), name)


# ---- scores

def scores(anchors: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """anchors (a x dims) against rows in bit planes: exact inner products, a x rows."""
    n_planes, groups, n = planes.shape
    groups = min(groups, anchors.shape[1] // GROUP)  # what is beyond either is zero
    most = int(np.abs(anchors).max(initial=0)) * GROUP * max(groups, 1) << n_planes
    kind = np.int32 if most < 2**31 else np.int64  # sums beyond wrap, and come back into range with the last plane
    out = np.empty((len(anchors), n), dtype=kind)
    for lo in range(0, len(anchors), TILE):
        part = anchors[lo:lo + TILE].astype(kind)
        tables = np.zeros((groups, 1 << GROUP, len(part)), dtype=kind)
        for g in range(groups):
            for k in range(GROUP):
                tables[g, 1 << k:2 << k] = tables[g, :1 << k] + part[:, g * GROUP + k]
        for at in range(0, n, 1024):
            bytes_of = planes[:, :groups, at:at + 1024]
            total = np.zeros((bytes_of.shape[2], len(part)), dtype=kind)
            fetched = np.empty_like(total)
            for p in range(n_planes - 1, -1, -1):
                total += total
                for g in range(groups):
                    np.take(tables[g], bytes_of[p, g], axis=0, out=fetched, mode="clip")
                    if p == n_planes - 1:
                        total -= fetched
                    else:
                        total += fetched
            out[lo:lo + len(part), at:at + 1024] = total.T
    return out


class _Block:
    def __init__(self, r: dict) -> None:
        self.block, self.n = r["block"], r["n"]
        self.ids, self.labels = (np.frombuffer(r[c], dtype=np.int64) for c in ("ids", "labels"))
        self.unnamed = np.frombuffer(r["unnamed"], dtype=np.uint8).astype(bool)
        data = np.frombuffer(r["data"], dtype=np.uint8 if r["kind"] == "planes" else np.int64)
        self.data = data.reshape(-1, r["dims"] // GROUP, r["n"]) if r["kind"] == "planes" else data.reshape(r["n"], r["dims"])

    def names(self, rows: np.ndarray) -> list:
        return [None if u else i for i, u in zip(self.ids[rows].tolist(), self.unnamed[rows].tolist(), strict=True)]


def _first(values: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` highest values; the earlier of equal ones first."""
    at = np.arange(len(values))
    if len(values) > most:
        at = np.flatnonzero(values >= np.partition(values, len(values) - most)[len(values) - most])
    return at[np.argsort(~values[at], kind="stable")][:most]  # ~ turns the order round without overflow


def _cells(batches):
    """Pairs of an anchor block and a candidate block."""
    for b in batches:
        for r in b.to_pylist():
            yield r, _Block(r["a"]), _Block(r["c"])


def _emit(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(schema), schema, strict=True)], schema=schema)


_SAME = pa.schema([("block", pa.int64()), ("place", pa.int64()), ("anchor_id", pa.int64()), ("own_score", pa.int64()), ("score", pa.int64()), ("id", pa.int64())])


def _same_label(most: int):
    """The first ``most`` rows of an anchor's label in each block, itself among them."""
    def keep(batches):
        for _, a, c in _cells(batches):
            out = []
            for label in np.intersect1d(a.labels, c.labels):
                mine, theirs = np.flatnonzero(a.labels == label), np.flatnonzero(c.labels == label)
                for k, row in zip(mine, scores(a.data[mine], c.data[:, :, theirs]), strict=True):
                    at = _first(row, most)
                    own = int((a.data[k] * a.data[k]).sum())
                    out.extend((a.block, int(k), int(a.ids[k]), own, s, i) for s, i in zip(row[at].tolist(), c.names(theirs[at]), strict=True))
            yield _emit(out, _SAME)
    return keep


_OTHER = pa.schema([("block", pa.int64()), ("place", pa.int64()), ("positive", pa.int32()), ("score", pa.int64()), ("id", pa.int64())])


def _other_labels(most: int):
    """For each anchor and positive the first ``most`` rows of other labels within the positive's range, of each block."""
    def keep(batches):
        for r, a, c in _cells(batches):
            out, asked = [], {}
            for p in r["asked"]:
                asked.setdefault(p["place"], []).append((p["positive"], p["least"], p["score"]))
            places = np.array(sorted(asked), dtype=np.int64)
            for k, row in zip(places.tolist(), scores(a.data[places], c.data) if len(places) else [], strict=True):
                low, high = min(x[1] for x in asked[k]), max(x[2] for x in asked[k])
                near = np.flatnonzero((row >= low) & (row <= high) & (c.labels != a.labels[k]))
                if not len(near):
                    continue
                near = near[np.argsort(~row[near], kind="stable")]
                found = row[near]
                for positive, least, score in asked[k]:
                    begin = np.searchsorted(~found, ~np.int64(score), side="left")
                    at = near[begin:begin + most]
                    at = at[row[at] >= least]
                    out.extend((a.block, k, positive, s, i) for s, i in zip(row[at].tolist(), c.names(at), strict=True))
            yield _emit(out, _OTHER)
    return keep


def mine(rows: DataFrame, is_anchor, n_positives: int = POSITIVES, n_negatives: int = NEGATIVES, least_share: tuple[int, int] = (4, 5)) -> DataFrame:
    """rows (id, label, vector) -> anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor``: a condition on ``id``. A negative scores at most as the positive and at least ``least_share`` of it.
    """
    spark = rows.sparkSession
    prepare(spark)
    rows = rows.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
                       F.col("vector").cast("array<double>").alias("vector")).filter(
        F.col("label").isNotNull() & F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(2.0 ** 55))))
    chosen = rows.filter(is_anchor)
    n, n_anchors = rows.count(), chosen.count()
    candidates = _blocks(rows, n, BLOCK, True, "negatives-candidates")
    anchors = _blocks(chosen, n_anchors, ANCHORS, False, "negatives-anchors")
    # Each block of anchors goes to every number, each block of candidates to one.
    numbers = max(1, ceil(n / BLOCK))
    tasks = min(4 * numbers, 10_000)
    dealt = candidates.select(F.pmod(F.xxhash64("block"), F.lit(numbers)).cast("int").alias("number"),
                              F.struct(*candidates.columns).alias("c")).repartition(tasks, "number")

    def cells(blocks: DataFrame) -> DataFrame:
        sent = blocks.withColumn("number", F.explode(F.sequence(F.lit(0), F.lit(numbers - 1)))).repartition(tasks, "number")
        return sent.join(dealt.hint("merge"), "number").drop("number")

    def scored(pairs: DataFrame, by, schema: str, name: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(CELLS))
        try:
            return materialize(spark, pairs.mapInArrow(by, schema), name)
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))

    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    struct = F.struct(*anchors.columns).alias("a")
    same = scored(cells(anchors.select(struct)), _same_label(n_positives + 1),
                  "block long, place long, anchor_id long, own_score long, score long, id long", "negatives-same")
    by_anchor = Window.partitionBy("block", "place")
    same = same.withColumn("at", F.row_number().over(by_anchor.orderBy(*order))).filter(F.col("at") <= n_positives + 1)
    # The anchor itself is one of the rows with its id and its own score, if it is among the first at all.
    itself = F.min(F.when((F.col("id") == F.col("anchor_id")) & (F.col("score") == F.col("own_score")), F.col("at"))).over(by_anchor)
    same = same.withColumn("itself", itself).filter("itself is null or at <> itself")
    same = same.withColumn("positive", F.expr("at - if(itself < at, 1, 0)").cast("int")).filter(F.col("positive") <= n_positives)
    positives = materialize(spark, same.select("block", "place", "anchor_id", "positive", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")),
                            "negatives-positives")
    # The least whole score of at least the share: score - floor(score * (1 - share)).
    up, down = least_share
    least = F.expr(f"positive_score - floor(cast(positive_score as decimal(38, 0)) * {down - up} / {down})").cast("long")
    asked = positives.filter("positive_score >= 0").groupBy("block").agg(
        F.collect_list(F.struct("place", "positive", least.alias("least"), F.col("positive_score").alias("score"))).alias("asked"))
    wanted = anchors.join(asked, "block").select(struct, "asked")
    other = scored(cells(wanted), _other_labels(n_negatives), "block long, place long, positive int, score long, id long", "negatives-other")
    rank = F.row_number().over(Window.partitionBy("block", "place", "positive").orderBy(*order))
    other = other.withColumn("rank", rank).filter(F.col("rank") <= n_negatives)
    return other.join(positives, ["block", "place", "positive"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = read_table(spark, sf_dir, "embeddings")
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine(t.select(F.col("vec_id").alias("id"), moved.alias("label"), F.col("embedding").alias("vector")), F.col("id") % 100 == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same,
         coalesce(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * c.q[i])), 0)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id
), p AS (
  SELECT anchor_id, id, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.id AS positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id)::INTEGER AS rank,
       s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score
QUALIFY rank <= 5
"""

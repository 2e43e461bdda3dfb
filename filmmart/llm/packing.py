"""Conflict-constrained best-fit packing of documents into bins of ``CAPACITY`` words.

A bin holds at most one piece of each source and of each duplicate cluster (a null source is a
source of its own). A document longer than a bin is cut: full pieces fill bins of their
own, the rest is packed. Pieces are placed largest first; open bins are ordered by what is left
in them and carry bitmaps of their sources and clusters; the successor search starts at the
smallest residual that holds the piece and goes on, bin by bin, until a bin without conflict is
found: the tightest compatible one (on equal residuals the oldest). Documents are dealt to shards of
about ``SHARD_WORDS`` words (and at most some ``SHARD_ROWS`` rows) by hash; each shard is packed in one task.

Edge cases: a null or word-less text has one row with a null bin; repeated rows are pieces of
their own in the same cluster; ties are placed by cluster and doc_id; an empty table gives an
empty result; extra columns are ignored; ``cluster`` names a column with cluster ids, else
documents with the same A-Z lower-cased word sequence are a cluster.
"""

from __future__ import annotations

from bisect import insort
from collections import Counter

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare, read_table

CAPACITY = 2048
SHARD_WORDS = 1_000_000
SHARD_ROWS = 50_000
LOT = 1000  # rows alike that may meet in a shard
SEED = 77

_SIZED = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("n", pa.int64()), ("cluster", pa.int64())])


def _size(batches):
    for b in batches:
        n, cluster = [], []
        for t in b.column("text").cast(pa.binary()).to_pylist():
            words = t.lower().split() if t else []
            h = xxhash.xxh3_64_intdigest(b" ".join(words))
            n.append(len(words))
            cluster.append(h - ((h >> 63) << 64))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id").cast(pa.int64()), b.column("source").cast(pa.string()), pa.array(n, pa.int64()), pa.array(cluster, pa.int64())],
            schema=_SIZED)


class Bins:
    """Open bins by residual: a bitmap of the residuals in use, and for each the bins by their sources, oldest first.

    A residual whose bins all hold a source (or a cluster) is noted for it and passed over by the search until a bin without it comes
    there, so that many pieces of one source don't look at all their bins each time.
    """

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.used = 0
        self.at: dict[int, dict[int, list]] = {}  # residual -> sources -> [(bin, clusters)]
        self.closed: dict[tuple, int] = {}  # ("s", source) or ("c", cluster) -> residuals whose bins all hold it
        self.closed_at: dict[int, set] = {}  # residual -> those keys

    def place(self, size: int, source: int, cluster: int, new_bin: int) -> tuple[int, int]:
        """(bin, offset) of the piece; ``new_bin`` if no open bin fits. Cluster 0 is no cluster."""
        own = 1 << cluster if cluster else 0
        residual = self._successor(size, source, cluster)
        while residual is not None:
            found = self._oldest(residual, source, cluster)
            if found:
                b, sources, clusters = found
                self._keep(residual - size, b, sources | 1 << source, clusters | own)
                return b, self.capacity - residual
            residual = self._successor(residual + 1, source, cluster)
        self._keep(self.capacity - size, new_bin, 1 << source, own)
        return new_bin, 0

    def _successor(self, size: int, source: int, cluster: int) -> int | None:
        open_to = self.used & ~self.closed.get(("s", source), 0) & ~self.closed.get(("c", cluster), 0)
        above = open_to >> size
        return size + (above & -above).bit_length() - 1 if above else None

    def _oldest(self, residual: int, source: int, cluster: int) -> tuple | None:
        """Takes the oldest bin without conflict out of this residual."""
        best, no_source, no_cluster = None, True, True  # no bin without the source, without the cluster
        for sources, held in self.at[residual].items():
            if sources >> source & 1:
                no_cluster = no_cluster and all(c >> cluster & 1 for _, c in held[:1])
                continue
            no_source = False
            for i, (b, clusters) in enumerate(held):
                if not clusters >> cluster & 1:
                    no_cluster = False
                    if best is None or b < best[0]:
                        best = (b, sources, i)
                    break
        if best is None:
            if no_source:
                self._close(residual, ("s", source))
            elif no_cluster and all(c >> cluster & 1 for held in self.at[residual].values() for _, c in held):
                self._close(residual, ("c", cluster))
            return None
        b, sources, i = best
        _, clusters = self.at[residual][sources].pop(i)
        if not self.at[residual][sources]:
            del self.at[residual][sources]
            if not self.at[residual]:
                del self.at[residual]
                self.used &= ~(1 << residual)
        return b, sources, clusters

    def _close(self, residual: int, key: tuple) -> None:
        self.closed[key] = self.closed.get(key, 0) | 1 << residual
        self.closed_at.setdefault(residual, set()).add(key)

    def _keep(self, residual: int, b: int, sources: int, clusters: int) -> None:
        if not residual:
            return
        insort(self.at.setdefault(residual, {}).setdefault(sources, []), (b, clusters))
        self.used |= 1 << residual
        keys = self.closed_at.get(residual)
        if keys:
            opened = {k for k in keys if not (sources if k[0] == "s" else clusters) >> k[1] & 1}
            for k in opened:
                self.closed[k] &= ~(1 << residual)
            keys -= opened


def pack_group(rows: list[tuple], capacity: int) -> list[tuple]:
    """rows: (doc_id, source, n, cluster) -> (row number, piece, word_start, n_words, bin, offset)."""
    out, rest, n_bins = [], [], 0
    for i, (_, _, n, _) in enumerate(rows):
        full, left = divmod(n, capacity)
        for p in range(full):
            out.append((i, p, p * capacity, capacity, n_bins, 0))
            n_bins += 1
        if left or not n:
            rest.append((left, full, i))
    key = lambda x: (-x[0], rows[x[2]][3], rows[x[2]][0] is None, rows[x[2]][0] or 0, x[2])
    sources, clusters, bins = {}, {}, Bins(capacity)
    repeated = Counter(rows[i][3] for left, _, i in rest if left)  # a cluster's only piece conflicts with none
    for left, piece, i in sorted(rest, key=key):
        if not left:
            out.append((i, 0, 0, 0, None, None))
            continue
        s = sources.setdefault(rows[i][1], len(sources))
        c = clusters.setdefault(rows[i][3], len(clusters) + 1) if repeated[rows[i][3]] > 1 else 0
        b, offset = bins.place(left, s, c, n_bins)
        n_bins += b == n_bins
        out.append((i, piece, piece * capacity, left, b, offset))
    return out


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, cluster: str | None = None) -> DataFrame:
    """doc_id, source, cluster, piece, word_start, n_words, bin_id, bin_offset: one row per piece."""
    spark = docs.sparkSession
    prepare(spark)
    if cluster:
        from .common import n_words
        sized = docs.select("doc_id", F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("n"),
                            F.xxhash64(F.col(cluster)).alias("cluster"))
    else:
        sized = docs.select("doc_id", "source", "text").mapInArrow(_size, "doc_id long, source string, n long, cluster long")
    sizes = docs.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    # A word and its space take about six bytes; short texts count by rows.
    n_shards = max(1, -(-(sizes["bytes"] or 0) // (SHARD_WORDS * 6)), -(-sizes["rows"] // SHARD_ROWS))
    # Rows alike are counted where they are read, and dealt to shards by the thousand.
    alike = ["doc_id", "source", "n", "cluster"]
    sized = sized.groupBy(*alike).agg(F.count(F.lit(1)).alias("rows"))
    sized = sized.withColumn("lot", F.explode(F.sequence(F.lit(0), F.floor((F.col("rows") - 1) / LOT).cast("int"))))
    sized = sized.withColumn("rows", F.least(F.lit(LOT), F.col("rows") - F.col("lot") * LOT).cast("int")).withColumn(
        "shard", F.pmod(F.xxhash64(*alike, "lot", F.lit(SEED)), F.lit(n_shards)))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.loc[pdf.index.repeat(pdf["rows"])]
        ids = [None if pd.isna(x) else int(x) for x in pdf["doc_id"]]
        names = [None if pd.isna(x) else x for x in pdf["source"]]
        rows = sorted(zip(ids, names, pdf["n"].tolist(), pdf["cluster"].tolist(), strict=True),
                      key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "", r[2], r[3]))
        base = int(pdf["shard"].iloc[0]) << 32
        packed = pack_group(rows, capacity)
        return pd.DataFrame({
            "doc_id": pd.array([rows[p[0]][0] for p in packed], dtype="Int64"), "source": [rows[p[0]][1] for p in packed],
            "cluster": [rows[p[0]][3] for p in packed], "piece": [p[1] for p in packed], "word_start": [p[2] for p in packed],
            "n_words": [p[3] for p in packed],
            "bin_id": pd.array([None if p[4] is None else base + p[4] for p in packed], dtype="Int64"),
            "bin_offset": pd.array([p[5] for p in packed], dtype="Int64")})

    return sized.groupBy("shard").applyInPandas(
        pack, "doc_id long, source string, cluster long, piece long, word_start long, n_words long, bin_id long, bin_offset long")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"))

"""Mixing sources to target weights by Sainte-Laguë apportionment.

Every source gets a target of words. Its documents are dealt to shards of about
``SHARD_WORDS`` words by a seeded hash, and each shard's documents, laid end to end in a seeded
order, are cut into blocks of equal size (about ``BLOCK_WORDS``). Blocks are seats: the highest
quotients ``claim / (2 i - 1)`` win them, first between the sources, then between the shards
of a source. Which blocks a shard gives is a seeded choice; a quota above its blocks takes whole
passes first. No quota exceeds ``most`` passes, so no document exceeds ``most`` times its size.

Edge cases: a null or word-less text has size 0 and takes nothing; null sources are one
source, ordered last; repeated rows are documents of their own; an empty table gives an empty
result; extra columns are ignored by ``mix_documents`` and kept by ``mixed_texts`` (helper
columns carry the prefix ``_mix_``).
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, materialize, n_words, prepare, read_table

BLOCK_WORDS = 128
SHARD_WORDS = 500_000
SEED = 20240
WEIGHTS = (3.0, 1.0, 2.0)  # by rank of the source, repeating
SHARE = 1.5  # words to take, as a share of all words
MOST = 2  # a source's (and a document's) upper limit, times its size


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """sid, source, source_size, target: one row per source, in code point order, null last.

    Water filling: target = min(most * size, level * weight). The level rises by aggregate
    rounds over the sources until the set of stopped sources no longer grows.
    """
    src = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # UTF-8 bytes sort as code points; ranks add up from per-head counts, so that no task sorts all sources.
    src = src.withColumn("head", F.coalesce(F.hex(F.encode(F.substring("source", 1, 2), "UTF-8")), F.lit("~")))
    heads = src.groupBy("head").agg(F.count(F.lit(1)).alias("n"))
    heads = heads.select("head", (F.sum("n").over(Window.orderBy("head")) - F.col("n")).alias("before"))
    in_head = Window.partitionBy("head").orderBy(F.encode("source", "UTF-8").asc_nulls_last())
    src = src.withColumn("r", F.row_number().over(in_head)).join(heads, "head")
    src = src.select((F.col("before") + F.col("r") - 1).alias("sid"), "source", "source_size")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    src = materialize(sized.sparkSession, src.withColumn("weight", weight), "mix-sources")
    cap = F.col("source_size") * F.lit(float(most))
    level, stopped = 0.0, -1
    while True:
        over = (F.col("weight") * F.lit(level) > cap) & F.lit(stopped >= 0)
        r = src.agg(F.sum("source_size").alias("total"), F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("w"),
                    F.sum(F.when(over, cap).otherwise(0.0)).alias("held"), F.sum(F.when(over, 1).otherwise(0)).alias("n")).first()
        if not r["total"] or not r["w"] or r["n"] == stopped:
            break
        stopped, level = r["n"], (share * r["total"] - r["held"]) / r["w"]
    return src.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))


def apportion(cells: DataFrame, group: str, seats: str, claim: str, most: str, rounds: int = 5, ways: int = 128) -> DataFrame:
    """Adds ``quota``: in each group, ``seats`` seats go to the cells with the highest quotients
    claim / (2 i - 1), i = 1, 2, ..., none beyond ``most``.

    A cell holds floor(claim / (2 x) + 1/2) seats above the bar x. The bar of each group is
    narrowed by ``rounds`` aggregates with ``ways`` candidate bars each; seats tied within what is
    left of the interval are dealt in a seeded order.
    """
    def held(x):
        return F.least(F.col(most).cast("double"), F.floor(F.col(claim) / (2 * x) + 0.5))

    bars = cells.groupBy(group).agg(F.lit(1e-9).alias("_lo"), (F.max(claim) + 1.0).alias("_hi"),
                                    F.least(F.max(seats), F.sum(most)).alias("_seats"))
    for _ in range(rounds):
        # Candidate bars lie in geometric steps: quotients near the bar differ by factors.
        ratio = F.col("_hi") / F.col("_lo")
        bar = lambda i: F.col("_lo") * F.pow(ratio, i / ways)
        tried = cells.join(bars, group).withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(ways - 1))))
        tried = tried.groupBy(group, "_lo", "_hi", "_seats", "_i").agg(F.sum(held(bar(F.col("_i")))).alias("_s"))
        first = F.coalesce(F.min(F.when(F.col("_s") <= F.col("_seats"), F.col("_i"))), F.lit(ways))
        bars = tried.groupBy(group, "_lo", "_hi", "_seats").agg(first.alias("_i")).select(
            group, bar(F.col("_i") - 1).alias("_lo"), bar(F.col("_i")).alias("_hi"), "_seats")
    out = cells.join(bars, group)
    out = out.withColumn("_tied", held(F.col("_lo")) - held(F.col("_hi"))).withColumn("quota", held(F.col("_hi")))
    all_in, order = Window.partitionBy(group), Window.partitionBy(group).orderBy(F.xxhash64(*cells.columns))
    left = F.col("_seats") - F.sum("quota").over(all_in)
    before = F.sum("_tied").over(order) - F.col("_tied")
    extra = F.greatest(F.lit(0.0), F.least(F.col("_tied"), left - before))
    return out.withColumn("quota", (F.col("quota") + extra).cast("long")).select(*cells.columns, "quota")


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    return docs.withColumn("_mix_size", n_words(F.col("text"))).withColumn("_mix_h", F.xxhash64(F.col("doc_id"), F.col("text"), F.lit(seed)))


def _dealer(sized: DataFrame, weights, share, most):
    """From the written sizes (source, _mix_size, _mix_h) of all documents: a function that gives rows with these columns their
    source_size, target, cell (sid, shard) and the cell's quota of blocks."""
    spark = sized.sparkSession
    light = sized.select("source", F.col("_mix_size").alias("size"))
    light = light.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")).select(
        "source", (F.col("size") * F.col("n")).alias("size"))
    src = source_targets(light, weights, share, most)
    n_shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / SHARD_WORDS)).cast("long")
    names = src.select(F.col("source").alias("_mix_source"), F.col("sid").alias("_mix_sid"), n_shards.alias("_mix_n"),
                       F.col("source_size").alias("_mix_source_size"), F.col("target").alias("_mix_target"))
    names = materialize(spark, names, "mix-sources")

    def in_cells(rows: DataFrame) -> DataFrame:
        return rows.join(names, F.col("source").eqNullSafe(F.col("_mix_source"))).withColumn(
            "_mix_shard", F.pmod(F.xxhash64("_mix_h", F.lit(1)), F.col("_mix_n")))

    dealt = in_cells(sized)
    nb = F.ceil(F.sum("_mix_size") / BLOCK_WORDS).cast("long")
    cells = dealt.groupBy("_mix_sid", "_mix_shard").agg(
        nb.alias("nb"), F.max("_mix_source_size").alias("source_size"), F.max("_mix_target").alias("target"))
    cells = materialize(spark, cells.filter("nb > 0"), "mix-cells")
    by_source = cells.groupBy("_mix_sid").agg(F.sum("nb").alias("nb"), F.max("source_size").alias("source_size"), F.max("target").alias("target"))
    by_source = by_source.select("_mix_sid", (F.col("target") * F.col("nb") / F.col("source_size")).alias("claim"),
                                 (F.col("nb") * most).alias("most"), F.lit(0).alias("all"))
    total = by_source.groupBy("all").agg(F.round(F.sum("claim")).alias("seats"))
    by_source = materialize(spark, apportion(by_source.join(total, "all"), "all", "seats", "claim", "most"), "mix-source-quotas")
    cells = cells.join(by_source.select("_mix_sid", F.col("quota").alias("seats")), "_mix_sid").select(
        "_mix_sid", "_mix_shard", "seats", (F.col("target") * F.col("nb") / F.col("source_size")).alias("claim"),
        (F.col("nb") * most).alias("most"))
    quotas = materialize(spark, apportion(cells, "_mix_sid", "seats", "claim", "most"), "mix-quotas").select(
        "_mix_sid", "_mix_shard", F.col("quota").alias("_mix_quota"))
    return lambda rows: in_cells(rows).join(quotas, ["_mix_sid", "_mix_shard"], "left")


def _spans(size: np.ndarray, h: np.ndarray, quota: int, seed: int) -> list:
    """Word spans [lo, hi) and their repeats taken from each document of one cell."""
    spans: list = [[] for _ in size]
    words = int(size.sum())
    if not words or not quota:
        return spans
    nb = -(-words // BLOCK_WORDS)
    order = np.lexsort((size, h))
    ends = np.cumsum(size[order])
    passes, rest = divmod(int(quota), nb)
    times = np.full(nb, passes, dtype=np.int64)
    times[np.random.default_rng(seed).permutation(nb)[:rest]] += 1
    cut = np.arange(nb + 1, dtype=np.int64) * words // nb
    for k, i in enumerate(order):
        lo, hi = int(ends[k] - size[i]), int(ends[k])
        if lo == hi:
            continue
        b = int(np.searchsorted(cut, lo, side="right")) - 1
        while b < nb and cut[b] < hi:
            a, z = max(lo, int(cut[b])) - lo, min(hi, int(cut[b + 1])) - lo
            if times[b]:
                if spans[i] and spans[i][-1][1] == a and spans[i][-1][2] == times[b]:
                    spans[i][-1][1] = z
                else:
                    spans[i].append([a, z, int(times[b])])
            b += 1
    return spans


def _cell_seed(seed: int, pdf: pd.DataFrame) -> int:
    return (seed * 1_000_003 + int(pdf["_mix_sid"].iloc[0]) * 10_007 + int(pdf["_mix_shard"].iloc[0])) % 2**63


def mix_documents(docs: DataFrame, seed: int = SEED, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """doc_id, size, source_size, target, taken: the words the mix takes of each document."""
    prepare(docs.sparkSession)
    sized = _sized(docs.select("doc_id", "text", "source"), seed).select("doc_id", "source", "_mix_size", "_mix_h")
    sized = materialize(docs.sparkSession, sized, "mix-sizes")  # the words of a text are counted once
    dealt = _dealer(sized, weights, share, most)(sized).select(
        "doc_id", "_mix_sid", "_mix_shard", "_mix_size", "_mix_h", "_mix_source_size", "_mix_target", "_mix_quota")

    def taken(pdf: pd.DataFrame) -> pd.DataFrame:
        quota = pdf["_mix_quota"].fillna(0).iloc[0]
        spans = _spans(pdf["_mix_size"].to_numpy(), pdf["_mix_h"].to_numpy(), int(quota), _cell_seed(seed, pdf))
        return pd.DataFrame({"doc_id": pdf["doc_id"], "size": pdf["_mix_size"], "source_size": pdf["_mix_source_size"],
                             "target": pdf["_mix_target"], "taken": [sum((z - a) * t for a, z, t in s) for s in spans]})

    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(
        "size long, source_size long, target double, taken long").fields])
    return dealt.groupBy("_mix_sid", "_mix_shard").applyInPandas(taken, schema)


_WORD = re.compile(WORD)


def mixed_texts(docs: DataFrame, seed: int = SEED, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """The mix itself, with the columns of ``docs``: one row per pass over a document, its text
    the words taken (spans apart are joined by a line break; a document taken whole keeps its text as it is)."""
    prepare(docs.sparkSession)
    names = docs.columns
    sized = _sized(docs, seed)
    light = materialize(docs.sparkSession, sized.select("source", "_mix_size", "_mix_h"), "mix-sizes")
    dealt = _dealer(light, weights, share, most)(sized).drop("_mix_source", "_mix_n", "_mix_source_size", "_mix_target")

    def take(pdf: pd.DataFrame) -> pd.DataFrame:
        quota = pdf["_mix_quota"].fillna(0).iloc[0]
        sizes = pdf["_mix_size"].to_numpy()
        rows, texts = [], []
        for i, spans in enumerate(_spans(sizes, pdf["_mix_h"].to_numpy(), int(quota), _cell_seed(seed, pdf))):
            text, at = pdf["text"].iloc[i], None
            for turn in range(max((t for _, _, t in spans), default=0)):
                part = [(a, z) for a, z, t in spans if t > turn]
                whole = sum(z - a for a, z in part) == sizes[i]
                if not whole and at is None:
                    at = [m.span() for m in _WORD.finditer(text)]
                joined = []
                for a, z in part:
                    if joined and joined[-1][1] == a:
                        joined[-1][1] = z
                    else:
                        joined.append([a, z])
                rows.append(i)
                texts.append(text if whole else "\n".join(text[at[a][0]:at[z - 1][1]] for a, z in joined))
        out = pdf.iloc[rows][names].copy()
        out["text"] = texts
        if "n_chars" in names:
            out["n_chars"] = out["text"].str.len().astype("int64")
        return out

    return dealt.groupBy("_mix_sid", "_mix_shard").applyInPandas(take, docs.schema)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(read_table(spark, sf_dir, "documents"))

"""Language ID by nearest centroid.

A text is a TF-IDF vector over hashed 2- and 3-byte n-grams of the lower-cased text (log term
frequency, unit length). Each language has ``CENTROIDS`` centroids, clustered by spherical
k-means; a text gets the language of the closest centroid by cosine. A text farther from all
centroids than ``SLACK`` times the similarity that nearly all training texts of that language
reach is rejected. The document frequencies come from all training rows; the centroids are
fitted on at most ``SAMPLE`` rows per language (smallest seeded hashes).

Edge cases: a null text or one without a letter is ``und`` with score 0 and rejected; with nothing to learn from every
text is ``und`` with score 0 and none is rejected; rows with a null lang are predicted, not learned
from; repeated rows get the same answer; a null doc_id is not held out; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, prepare, read_table

DIMS = 8192
CENTROIDS = 4
SAMPLE = 400
SHARES = 16  # of a language, ranked apart
BROADCAST_LANGS = 10_000
SLACK = 0.3
QUANTILE = 0.005
ROUNDS = 10
UND = "und"

_TO_SPACE = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
_ASCII_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str | None) -> bool:
    return bool(text) and (_ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def counts(text: str) -> np.ndarray:
    """Counts of hashed n-grams over the whole text; runs without ASCII letters or bytes above 127 count as one space."""
    words = text.lower().encode("utf-8", "surrogatepass").translate(_TO_SPACE).split()
    raw = np.frombuffer(b" " + b" ".join(words) + b" ", dtype=np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return np.zeros(DIMS, dtype=np.int64)
    two = raw[:-1] | raw[1:] << np.uint32(8)
    three = two[:-1] | raw[2:] << np.uint32(16)
    shift = np.uint32(32 - (DIMS.bit_length() - 1))
    codes = np.concatenate([(two + np.uint32(0x5BD1E995)) * np.uint32(0x9E3779B1) >> shift, three * np.uint32(0x85EBCA6B) >> shift])
    return np.bincount(codes, minlength=DIMS)


def vector(text: str, idf: np.ndarray) -> np.ndarray:
    c = counts(text)
    at = np.flatnonzero(c)
    out = np.zeros(DIMS, dtype=np.float32)
    out[at] = (1.0 + np.log(c[at])) * idf[at]
    norm = float(np.sqrt((out * out).sum()))
    return out / np.float32(norm) if norm else out


def cluster(vectors: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means: farthest-first start from the mean, ROUNDS rounds; at most k unit centroids."""
    def unit(x):
        norm = np.sqrt((x * x).sum(axis=-1, keepdims=True))
        return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)

    centres = [unit(vectors.mean(axis=0))]
    while len(centres) < min(k, len(vectors)):
        near = (vectors @ np.stack(centres).T).max(axis=1)
        centres.append(vectors[int(near.argmin())])
    centres = np.stack(centres)
    for _ in range(ROUNDS):
        own = (vectors @ centres.T).argmax(axis=1)
        centres = np.stack([unit(vectors[own == j].mean(axis=0)) if (own == j).any() else centres[j] for j in range(len(centres))])
    return centres


def _df_rows(batches):
    """Per task: in how many texts each n-gram occurs, and under -1 the number of texts."""
    seen, n = np.zeros(DIMS, dtype=np.int64), 0
    for b in batches:
        for t in b.column("text").to_pylist():
            if has_letter(t):
                seen += counts(t) > 0
                n += 1
    at = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array([*at, -1], pa.int64()), pa.array([*seen[at], n], pa.int64())], names=["f", "n"])


class Model:
    """langs: one label per centroid row; bars: similarity below which a text of it is rejected."""

    def __init__(self, idf, langs, centroids, bars) -> None:
        self.idf, self.langs, self.centroids, self.bars = idf, langs, centroids, bars

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not self.langs:
            return UND, 0.0, False
        if not has_letter(text):
            return UND, 0.0, True
        sims = self.centroids @ vector(text, self.idf)
        best = int(sims.argmax())
        score = float(min(1.0, max(0.0, sims[best])))
        return self.langs[best], score, score < self.bars[best]


def fit(train: DataFrame, sample: int = SAMPLE) -> Model:
    """Learns from (text, lang) rows; the driver gets the n-gram table (DIMS rows) and the centroids only."""
    prepare(train.sparkSession)
    train = train.filter("lang is not null and text is not null").select("text", "lang")
    rows = train.select("text").mapInArrow(_df_rows, "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).collect()
    seen, n = np.zeros(DIMS), 0
    for r in rows:
        if r["f"] < 0:
            n = r["n"]
        else:
            seen[r["f"]] = r["n"]
    if not n:
        return Model(np.zeros(DIMS, np.float32), [], np.zeros((0, DIMS), np.float32), [])
    idf = (np.log((1.0 + n) / (1.0 + seen)) + 1.0).astype(np.float32)
    # Ranked by hashes alone, first within shares of a language, so that no task ranks all rows of one.
    hashes = train.select("lang", F.xxhash64("text", F.lit(9)).alias("h")).withColumn("share", F.pmod("h", F.lit(SHARES)))
    first = hashes.withColumn("r", F.row_number().over(Window.partitionBy("lang", "share").orderBy("h"))).filter(F.col("r") <= sample)
    first = first.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).filter(F.col("r") <= sample)
    cut = materialize(train.sparkSession, first.groupBy("lang").agg(F.max("h").alias("cut")), "langid-cut")
    if cut.count() <= BROADCAST_LANGS:  # a label and a number each
        cut = F.broadcast(cut)
    picked = train.withColumn("h", F.xxhash64("text", F.lit(9))).join(cut, "lang").filter("h <= cut").select("lang", "h", "text")

    def vectors(batches):
        for b in batches:
            texts = b.column("text").to_pylist()
            packed = [vector(t, idf).tobytes() if has_letter(t) else None for t in texts]
            yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("h"), pa.array(packed, pa.binary())], names=["lang", "h", "vector"])

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [np.frombuffer(v, np.float32) for v in pdf.sort_values("h")["vector"]]
        vectors = np.stack(rows)
        centres = cluster(vectors, CENTROIDS)
        bar = float(np.quantile((vectors @ centres.T).max(axis=1), QUANTILE)) * SLACK
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]] * len(centres), "centroid": [c.astype(np.float32).tobytes() for c in centres],
                             "bar": [bar] * len(centres)})

    # Equal texts are one row: at most ``sample`` vectors of a language meet.
    packed = picked.mapInArrow(vectors, "lang string, h long, vector binary").filter("vector is not null").dropDuplicates(["lang", "h"])
    learned = packed.groupBy("lang").applyInPandas(learn, "lang string, centroid binary, bar double").collect()
    learned = sorted(learned, key=lambda r: (r["lang"], bytes(r["centroid"])))
    centroids = np.stack([np.frombuffer(r["centroid"], np.float32) for r in learned]) if learned else np.zeros((0, DIMS), np.float32)
    return Model(idf, [r["lang"] for r in learned], centroids, [r["bar"] for r in learned])


NEW = ("lang_pred", "score", "rejected")


def free_prefix(docs: DataFrame) -> str:
    """A prefix under which none of the new columns' names is taken."""
    taken, prefix = {c.lower() for c in docs.columns}, ""
    while any(f"{prefix}{c}" in taken for c in NEW):
        prefix = f"langid_{prefix}"
    return prefix


def predict(docs: DataFrame, model: Model, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with lang_pred, score, rejected (after ``prefix``, where names clash). Only the text is looked at."""
    names, new = docs.columns, [f"{prefix}{c}" for c in NEW]
    schema = T.StructType([*docs.schema.fields, *T.StructType.fromDDL("{} string, {} double, {} boolean".format(*new)).fields])

    def run(batches):
        for b in batches:
            got = [model.predict(t) for t in b.column(text).to_pylist()]
            cols = [pa.array([g[k] for g in got], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=[*names, *new])

    return docs.mapInArrow(run, schema)


def held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs.filter(~held_out()).select("text", "lang"))
    light = docs.select("doc_id", "text", held_out().alias("held_out"))
    return predict(light, model).select("doc_id", "held_out", "lang_pred", "score", "rejected")

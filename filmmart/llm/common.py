"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
from collections import defaultdict
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import apply_defaults, scratch_path

#: A word: a run of anything but space and the control characters tab to carriage return.
#: ``bytes.split()`` cuts UTF-8 text at exactly these six characters.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows per Arrow batch handed to Python: a few MB of text at usual document lengths.
ARROW_ROWS = 512


def prepare(spark: SparkSession) -> None:
    """Session settings of the operators: library defaults, small Arrow batches, and the folder that
    holds this package on the Python workers' path (where it is not installed)."""
    apply_defaults(spark)
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts lineage and keeps one copy that
    survives a lost executor."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def n_words(col) -> "F.Column":
    """Words in a text column; 0 for null."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def binary_list(column: pa.Array) -> list:
    """Values of a string column as UTF-8 bytes (None for null)."""
    return column.cast(pa.binary()).to_pylist()


def by_bytes(values: list, limit: int) -> Iterator[tuple[int, int]]:
    """Index ranges whose values hold about ``limit`` bytes; a longer value stands alone."""
    start = size = 0
    for i, v in enumerate(values):
        n = len(v) if v else 0
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(values):
        yield start, len(values)


class LocalVocab:
    """Numbers words as they come; ``hashes`` gives their 64-bit hashes in that order."""

    def __init__(self) -> None:
        self.index: dict = defaultdict()
        self.index.default_factory = self.index.__len__

    def ids(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.index.__getitem__, words), dtype=np.int64, count=len(words))

    def hashes(self) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, self.index), dtype=np.uint64, count=len(self.index))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift, multiply)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def shingle_hashes(word_hashes: np.ndarray, k: int = 5) -> np.ndarray:
    """Hashes of all k-word windows; of the whole sequence when it has fewer words; none without words."""
    n = len(word_hashes)
    if n == 0:
        return word_hashes
    width = min(k, n)
    out = np.full(n - width + 1, width, dtype=np.uint64)
    for i in range(width):
        out = out * np.uint64(0xA0761D6478BD642F) + word_hashes[i:n - width + 1 + i]
        out ^= out >> np.uint64(29)
    return mix(out)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)

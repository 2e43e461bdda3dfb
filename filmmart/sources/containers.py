"""A11 for millions of keys: a keyed feed in a fixed number of folders.

A folder per key lists badly from some hundred thousand keys on. Here records lie in ``buckets`` folders by a hash of their key,
sorted by key within each file, and an index table says for every key which files hold it and at which rows. Replacing
keys rewrites the buckets they fall in and nothing else; a key's records are read from the files that the index
names, and their row groups by the sort order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists, scratch_path

BUCKETS = 256
BUCKET = "_bucket"


def _bucket(keys: Sequence, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def container_write(df: DataFrame, path: str, keys: Sequence[str] = ("action", "movie"), buckets: int = BUCKETS) -> None:
    """The records of every key in ``df`` take the place of what the feed had for it; other keys stay, and an empty ``df``
    changes nothing. ``buckets`` is fixed with the first write. Key columns must not be NULL."""
    spark, root = df.sparkSession, path.rstrip("/")
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    staged = scratch_path(spark, "container")
    df.withColumn(BUCKET, _bucket(keys, buckets)).write.parquet(f"{staged}/new")
    new = spark.read.parquet(f"{staged}/new")
    touched = sorted(r[0] for r in new.select(BUCKET).distinct().collect())  # at most ``buckets`` numbers
    if not touched:
        return
    rows = new
    if path_exists(spark, f"{root}/data"):
        old = spark.read.schema(new.schema).parquet(f"{root}/data").filter(F.col(BUCKET).isin(touched))
        rows = new.unionByName(old.join(new.select(*keys).distinct(), list(keys), "left_anti").select(*new.columns))
    # A hot key is split over several files of its folder. Written aside first: the old files are read meanwhile.
    rows.write.parquet(f"{staged}/rows")
    _replace(spark.read.schema(new.schema).parquet(f"{staged}/rows").hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, *keys), f"{root}/data")
    _replace(_index(spark, root, keys, touched), f"{root}/index")


def _replace(df: DataFrame, path: str) -> None:
    df.write.partitionBy(BUCKET).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def _index(spark: SparkSession, root: str, keys: Sequence[str], touched: list[int]) -> DataFrame:
    """keys, file, first_row, n_rows, _bucket: where the rows of each key lie."""
    data = spark.read.parquet(f"{root}/data").filter(F.col(BUCKET).isin(touched))
    at = data.select(*keys, BUCKET, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return at.groupBy(*keys, BUCKET, "file").agg(F.min("row").alias("first_row"), F.count(F.lit(1)).alias("n_rows")).select(
        *keys, "file", "first_row", "n_rows", BUCKET)


def container_read(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """All records."""
    reader = spark.read.schema(f"{schema}, {BUCKET} int") if schema else spark.read
    return reader.parquet(f"{path.rstrip('/')}/data").drop(BUCKET)


def container_get(spark: SparkSession, path: str, key: dict, buckets: int = BUCKETS) -> DataFrame:
    """The records of one key, from the files that the index names for it."""
    root = path.rstrip("/")
    here = F.lit(True)
    for k, v in key.items():
        here = here & (F.col(k) == F.lit(v))
    in_bucket = F.col(BUCKET) == _bucket([F.lit(v) for v in key.values()], buckets)
    files = [r["file"] for r in spark.read.parquet(f"{root}/index").filter(in_bucket & here).select("file").distinct().collect()]
    data = spark.read.option("basePath", f"{root}/data").parquet(*files) if files else spark.read.parquet(f"{root}/data").filter("false")
    return data.filter(here).drop(BUCKET)


__all__ = ["container_write", "container_read", "container_get", "BUCKETS"]

"""C1 by position: pages of a sorted catalogue without sorting and skipping what comes before.

The catalogue is written once per sort order: range-partitioned and sorted, each row with its position, and beside it one row per file with the
first and last position in it. A page is a range of positions: the few files that hold it are named by that small table, and the
position's statistics prune their row groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .keys import dense_key
from .planning import SORTS

POSITION = "_position"


def write_sorted(catalogue: DataFrame, sort_by: str, tiebreak: str, path: str, partitions: int | None = None) -> None:
    """The order of ``planning.browse``; equal rows keep any one order, fixed here."""
    spark, root = catalogue.sparkSession, path.rstrip("/")
    order = [F.col(SORTS.get(sort_by, sort_by)).desc_nulls_last(), F.col(tiebreak).asc_nulls_last()]
    keyed = dense_key(catalogue, order, POSITION, partitions)
    keyed.repartitionByRange(F.col(POSITION)).sortWithinPartitions(POSITION).write.mode("overwrite").parquet(f"{root}/rows")
    rows = spark.read.parquet(f"{root}/rows").select(POSITION, F.col("_metadata.file_path").alias("file"))
    rows.groupBy("file").agg(F.min(POSITION).alias("first"), F.max(POSITION).alias("last")).write.mode("overwrite").parquet(f"{root}/files")


def read_page(spark: SparkSession, path: str, offset: int, max_items: int) -> DataFrame:
    """Rows ``offset`` + 1 .. ``offset`` + ``max_items`` of the order, sorted."""
    root, first, last = path.rstrip("/"), offset + 1, offset + max_items
    held = spark.read.parquet(f"{root}/files").filter((F.col("last") >= first) & (F.col("first") <= last))
    files = [r["file"] for r in held.select("file").collect()]  # of one page
    rows = spark.read.parquet(*files) if files else spark.read.parquet(f"{root}/rows").filter("false")
    return rows.filter(F.col(POSITION).between(first, last)).orderBy(POSITION).drop(POSITION)


__all__ = ["write_sorted", "read_page", "POSITION"]

"""Dense surrogate keys 1..n by a sort order (F1) without a single-task global sort.

``row_number() over (order by ...)`` with no partition plans ``Exchange SinglePartition``:
one task sorts the whole table. Here the rows are range-partitioned on the order
(bounds from a sample, so a hot leading value is split by the later sort columns),
sorted inside each partition and numbered locally, the layout is written to the shared
scratch folder (the two uses below must see the same partitions), and each partition's
offset -- a running sum of its predecessors' counts -- is added back. The offsets table
has one row per partition, a size fixed by the partition count, so it is summed on the driver and
broadcast; the frame returned has the layout's files as its only source.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

_LOCAL_BITS = 33  # monotonically_increasing_id = partition index << 33 | row index


def dense_key(df: DataFrame, order: Sequence[Column], name: str, partitions: int | None = None,
              strategy: str = "range", salt: bool = True) -> DataFrame:
    """Add ``name`` = 1..n (BIGINT) following ``order``; ``order`` should be total.

    ``partitions``: range partition count; by default ``spark.sql.shuffle.partitions``,
    coalesced by AQE to the data's size. ``strategy='global'`` is the plain window form,
    for inputs of a known small size.
    """
    order = list(order)
    if strategy == "global":
        return df.select(F.row_number().over(Window.orderBy(*order)).cast("long").alias(name), *df.columns)
    if strategy != "range":
        raise ValueError(f"unknown strategy {strategy!r}")
    spark = df.sparkSession
    cols = list(df.columns)
    work = df
    if salt:
        # Rows equal in every order column would all land in one range partition; a last sort key
        # spreads them (their relative order is immaterial). It is a hash of a row number that
        # is written first, so a task that runs again places its rows as before.
        numbered = scratch_path(spark, "dense-key-rows")
        work.withColumn("_row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(numbered)
        work = spark.read.parquet(numbered).select(*cols, F.hash("_row").alias("_salt"))  # 4 bytes a row in the shuffle
        order = order + [F.col("_salt")]
    # Without an explicit count AQE sizes the range exchange to the data (it only merges
    # adjacent range partitions, so order holds); the files written below freeze the result.
    exchanged = work.repartitionByRange(int(partitions), *order) if partitions else work.repartitionByRange(*order)
    ranged = (exchanged
                  .sortWithinPartitions(*order)
                  .withColumn("_mid", F.monotonically_increasing_id()))
    if salt:
        ranged = ranged.drop("_salt")
    # Frozen as columnar files: the count reads the id column only, and the rows are read once.
    path = scratch_path(spark, "dense-key")
    ranged.write.option("compression", "zstd").parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path)
    pid = F.shiftrightunsigned(F.col("_mid"), _LOCAL_BITS)
    counts = sorted(tuple(r) for r in ranged.groupBy(pid.alias("_pid")).count().collect())  # one row per partition
    before = accumulate((n for _, n in counts), initial=0)
    offsets = spark.createDataFrame([(p, off) for (p, _), off in zip(counts, before, strict=False)], "_pid long, _off long")
    local = F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (ranged.join(F.broadcast(offsets), pid == F.col("_pid"))
                  .select((F.col("_off") + local + F.lit(1)).cast("long").alias(name), *cols))


__all__ = ["dense_key"]

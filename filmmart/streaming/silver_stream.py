"""E8-E16 kept up to date: silver follows bronze by micro-batches instead of being rebuilt.

Bronze is a file stream of its loads. A streaming aggregation holds the latest row of every natural key in the state store, in the
JVM: the minimum of a struct that sorts as the batch build orders rows, with the row behind it. A micro-batch puts out the
keys it changed, and they are written as that batch's change file set (overwritten if the batch is replayed). A key's current
row is the one of its last change, so readers take the last change per key; ``compact`` folds the changes into one base. The result
does not depend on the order in which loads arrive, and a load seen twice changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.silver import SilverSpec, typed_records
from ..schemas import BRONZE_SCHEMA
from ..session import child_dirs, make_dir, path_exists, remove_dir

BATCH = "_batch"
SETTINGS = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def _descending(text: Column) -> Column:
    """A binary that sorts upwards as the text sorts downwards: its bytes complemented, and an end above all of them."""
    flipped = F.translate(F.hex(text.cast("binary")), "0123456789ABCDEF", "FEDCBA9876543210")
    return F.unhex(F.concat(flipped, F.lit("FFFF")))


def order_struct(df: DataFrame) -> Column:
    """Sorts upwards as ``operators.dedup.total_order`` orders rows: newest load and file first, then all columns, NULLs last."""
    parts = [F.col("_loaded_at").isNull(), -F.unix_micros("_loaded_at"), F.col("_source_file").isNull(), _descending(F.col("_source_file"))]
    for f in df.schema.fields:
        if f.name not in ("_loaded_at", "_source_file"):
            parts += [F.col(f.name).isNull(), F.col(f.name)]
    return F.struct(*[p.alias(f"o{i}") for i, p in enumerate(parts)])


def latest_rows(typed: DataFrame, keys: list[str]) -> DataFrame:
    """The first row of each key by ``order_struct``; works on a stream and on a table."""
    best = F.min(F.struct(order_struct(typed).alias("order"), F.struct(*typed.columns).alias("row"))).alias("best")
    return typed.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(best).select("best.row.*")


def update_silver(spark: SparkSession, bronze_path: str, silver_path: str, spec: SilverSpec, checkpoint: str, max_files: int = 10_000) -> None:
    """Takes the bronze loads not seen yet (at most ``max_files`` files in a micro-batch) into the silver table's changes."""
    if not path_exists(spark, bronze_path):
        return
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    bronze = spark.readStream.schema(BRONZE_SCHEMA).option("maxFilesPerTrigger", max_files).option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.parquet").parquet(bronze_path)
    changed = latest_rows(typed_records(bronze, spec), list(spec.keys))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{silver_path.rstrip('/')}/changes/{BATCH}={batch_id:012d}")

    q = (changed.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def _schema(spec: SilverSpec) -> T.StructType:
    kinds = {"text": "string", "json": "string", "int": "int", "bool": "boolean"}
    return T.StructType.fromDDL(", ".join([*(f"{out} {kinds[kind]}" for out, _, kind in spec.fields), "_loaded_at timestamp", "_source_file string"]))


def _folders(spark: SparkSession, silver_path: str) -> list[tuple[str, int, str]]:
    """(folder, last batch in it, kind) of the current base and of the changes after it."""
    root = silver_path.rstrip("/")
    bases = sorted(child_dirs(spark, f"{root}/base", f"{BATCH}="))
    ready = [b for b in bases if path_exists(spark, f"{root}/base/{b}/_SUCCESS")]
    last = int(ready[-1].split("=")[1]) if ready else -1
    out = [(f"{root}/base/{ready[-1]}", last, "base")] if ready else []
    for c in sorted(child_dirs(spark, f"{root}/changes", f"{BATCH}=")):
        n = int(c.split("=")[1])
        if n > last:
            out.append((f"{root}/changes/{c}", n, "change"))
    return out


def read_silver(spark: SparkSession, silver_path: str, spec: SilverSpec) -> DataFrame:
    """The current rows: of each key the last change, with the columns of the batch build."""
    schema, held = _schema(spec), None
    for folder, n, _ in _folders(spark, silver_path):
        part = spark.read.schema(schema).parquet(folder).withColumn(BATCH, F.lit(n).cast("long"))
        held = part if held is None else held.unionByName(part)
    if held is None:
        held = spark.createDataFrame([], schema).withColumn(BATCH, F.lit(0).cast("long"))
    w = Window.partitionBy(*spec.keys).orderBy(F.col(BATCH).desc())
    current = held.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
    return current.select(*[f[0] for f in spec.fields], "_loaded_at", *(["_source_file"] if spec.source_file else []))


def compact(spark: SparkSession, silver_path: str, spec: SilverSpec) -> None:
    """Folds base and changes into one base. A base counts once it is written whole; changes are removed after that."""
    root, folders = silver_path.rstrip("/"), _folders(spark, silver_path)
    if sum(kind == "change" for _, _, kind in folders) == 0:
        return
    last = max(n for _, n, _ in folders)
    full = SilverSpec(spec.name, spec.fields, spec.required, spec.keys)
    read_silver(spark, silver_path, full).write.mode("overwrite").parquet(f"{root}/base/{BATCH}={last:012d}")
    make_dir(spark, f"{root}/base")
    for folder, _, _ in folders:
        remove_dir(spark, folder)


__all__ = ["update_silver", "read_silver", "compact", "latest_rows", "order_struct"]

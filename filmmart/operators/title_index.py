"""C2 by index: substring search over titles through postings of their character grams.

Every title gives its distinct grams of one, two and three characters; a posting is (gram, row id), in folders by a hash of the gram, sorted
by gram in each file. A query is looked up by the grams it is made of (its trigrams, or itself if it is shorter): only their
postings are read, rows that have all of them are the candidates, and the candidates' titles are checked. The result is that of the substring scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .planning import title_search

GRAM = 3
FOLDERS = 64


def _bucket(gram, folders: int):
    return F.pmod(F.xxhash64(gram), F.lit(folders)).cast("int")


def build_title_index(catalogue: DataFrame, path: str, title: str = "title", folders: int = FOLDERS) -> None:
    """Writes the numbered catalogue and its postings below ``path``. Rows without a title are found by no query."""
    spark, root = catalogue.sparkSession, path.rstrip("/")
    numbered = scratch_path(spark, "title-rows")
    catalogue.withColumn("_id", F.monotonically_increasing_id()).write.parquet(numbered)  # the ids are fixed here
    rows = spark.read.parquet(numbered)
    rows.repartitionByRange("_id").sortWithinPartitions("_id").write.mode("overwrite").parquet(f"{root}/rows")
    text = F.lower(F.col(title))

    def grams(n: int):
        every = F.transform(F.sequence(F.lit(1), F.length("_t") - (n - 1)), lambda i: F.substring(F.col("_t"), i, F.lit(n)))
        return F.when(F.length("_t") >= n, every).otherwise(F.array().cast("array<string>"))

    postings = rows.filter(F.col(title).isNotNull()).select("_id", text.alias("_t")).select(
        "_id", F.explode(F.array_distinct(F.concat(*[grams(n) for n in range(1, GRAM + 1)]))).alias("gram"))
    # A frequent gram's postings are split over several files of its folder.
    (postings.withColumn("folder", _bucket(F.col("gram"), folders)).hint("rebalance", "folder").sortWithinPartitions("folder", "gram", "_id")
     .write.partitionBy("folder").mode("overwrite").parquet(f"{root}/postings"))


def query_grams(query: str) -> list[str]:
    q = query.lower()
    return sorted({q[i:i + GRAM] for i in range(len(q) - GRAM + 1)}) if len(q) > GRAM else [q] if q else []


def postings_of(spark: SparkSession, path: str, grams: Sequence[str], folders: int = FOLDERS) -> DataFrame:
    """The postings of these grams, from their folders alone."""
    wanted = F.lit(False)
    for g in grams:
        wanted = wanted | ((F.col("folder") == _bucket(F.lit(g), folders)) & (F.col("gram") == g))
    return spark.read.parquet(f"{path.rstrip('/')}/postings").filter(wanted).select("_id", "gram")


def search_titles(spark: SparkSession, path: str, query: str, tiebreak: str, max_items: int | None = None, title: str = "title",
                  folders: int = FOLDERS) -> DataFrame:
    """As ``planning.title_search`` over the indexed catalogue."""
    rows, grams = spark.read.parquet(f"{path.rstrip('/')}/rows"), query_grams(query)
    if grams:
        found = postings_of(spark, path, grams, folders).groupBy("_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(grams))
        rows = rows.join(found.select("_id"), "_id", "left_semi")
    return title_search(rows, query, tiebreak, max_items, title).drop("_id")


__all__ = ["build_title_index", "search_titles", "postings_of", "query_grams"]

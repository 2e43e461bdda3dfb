"""The corpus pipeline: language ID, near-dedup, removal of repeated passages, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's result as
Parquet and reads it again as the next one's documents. All but the last return the columns of
``documents``; extra columns come along, an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmmart.llm import langid, minmax_dedup, mixing, packing, suffix_dedup
from filmmart.llm.common import materialize, read_table

PASSAGE = 250


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts far from every known language go, and texts without a letter, null ones among them; all others stay, whatever their
    language. Without any labelled text there is no language to be far from, and every document stays; repeated rows fare alike."""
    model = langid.fit(docs.filter(~langid.held_out()).select("text", "lang"))
    prefix = langid.free_prefix(docs)
    return langid.predict(docs, model, prefix=prefix).filter(~F.col(f"{prefix}rejected")).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: one with the smallest doc_id (a null one only where there is no other). Rows
    repeated in full count as copies; documents without words (null texts too) are copies of nothing but their own repeats."""
    return minmax_dedup.near_dedup(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of PASSAGE bytes (50 words or so) that occur again anywhere are cut out of the texts; every document stays, null and empty
    texts as they are."""
    return suffix_dedup.remove_repeats(docs, PASSAGE)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources' target shares (a null source is one of them): a document has a row for each pass that takes words of it; one
    without words has none."""
    return mixing.mixed_texts(docs)


def bin_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of 2,048 words without two pieces of one source or of one text."""
    return packing.pack_documents(docs)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("repeated_passages", repeated_passages),
          ("source_mix", source_mix), ("bin_packing", bin_packing)]

#: The stages are a fitted model, sketches and seeded choices: SQL does not express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

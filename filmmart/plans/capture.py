"""Captured responses and pages -> keyed feeds, in one job.

Input: one row per captured response or page, ``platform, action, entity_id, page_no, body``. Each (platform, action) has its
flattener; its records are cleaned of control characters, checked against the types that silver reads, and written as the feed of
their bronze table, one key per (action, movie). What gives no record goes to the rejects with a reason: bodies without the expected
shape, pages without their embedded data, items with a null where none is allowed, records that do not fit the types.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import scrub_strings
from ..sources import responses as R
from ..session import remove_dir, scratch_path
from ..sources.feeds import keyed_feed_write
from ..sources.small_files import parts
from .silver import BRONZE_OF, SPECS

MC, RT = "mc", "rt"
CAPTURED_DDL = "platform string, action string, entity_id string, page_no long, body string"
# Row groups of captures on the way, so that few files of few bytes can still be read by all cores.
ROW_GROUPS = {"parquet.block.size": 16 << 20, "parquet.block.row.count.limit": 10_000}
OPEN_COST = "64kb"
REJECT_COLS = ["platform", "action", "entity_id", "page_no", "reason", "record"]
_SPEC_OF = {bronze: SPECS[silver] for silver, bronze in BRONZE_OF.items()}


@dataclass(frozen=True)
class Action:
    platform: str
    name: str
    table: str  # of bronze
    movie: str  # column of the movie's key
    flatten: Callable[[DataFrame], DataFrame]
    shape: str = ""  # JSON path that a body must have
    no_nulls: tuple = ()  # item keys that may be absent, not null


def _page(fn: Callable) -> Callable[[DataFrame], DataFrame]:
    return lambda df: fn(df, "entity_id", "body")


# What is captured on each platform, and the bronze table it is for.
ACTIONS = (
    Action(MC, "general", "mc_general", "movie_slug", R.flatten_movie, "$.data.item"),
    Action(MC, "critic_reviews", "mc_critic_reviews", "movie_slug", R.flatten_critic_reviews, "$.data.items", ("quote",)),
    Action(MC, "user_reviews", "mc_user_reviews", "movie_slug", R.flatten_user_reviews, "$.data.items", ("id", "spoiler")),
    Action(RT, "score", "rt_score", "movie_id", _page(R.page_scorecard)),
    Action(RT, "details", "rt_details", "movie_id", _page(R.page_details)),
    Action(RT, "reviews", "rt_reviews", "movie_id", R.flatten_audience_reviews, "$.reviews"),
    Action(RT, "critic_reviews", "rt_critic_reviews", "movie_id", R.flatten_rt_critic_reviews, "$.reviews"),
)


def rules(table: str) -> dict:
    """Type rules of a bronze table's records, from what silver reads of them."""
    spec = _SPEC_OF[table]
    return {key: (kind, out == spec.required) for out, key, kind in spec.fields if kind != "json"}


def _rejected(df: DataFrame, action: Action, reason, record=None, page: bool = True) -> DataFrame:
    return df.select(F.lit(action.platform).alias("platform"), F.lit(action.name).alias("action"), F.col("entity_id"),
                     (F.col("page_no") if page else F.lit(None)).cast("long").alias("page_no"), reason.alias("reason"),
                     (record if record is not None else F.lit(None)).cast("string").alias("record"))


def flatten_action(captured: DataFrame, action: Action, max_pages: int | None = None,
                   staged: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[DataFrame, DataFrame]:
    """(records with ``action`` and ``movie`` first, rejects) of one kind of capture. ``staged``: what keeps a frame that both are
    made of."""
    own = captured.filter((F.col("platform") == action.platform) & (F.col("action") == action.name)).select("entity_id", "page_no", "body")
    own = R.page_cap(own, "entity_id", "page_no", max_pages)
    if action.shape:
        has = F.get_json_object("body", action.shape).isNotNull()
        bad = _rejected(own.filter(~F.coalesce(has, F.lit(False))), action, F.lit(f"no {action.shape}"))
        flat = action.flatten(own.filter(has))
    else:
        kind = "scorecard" if action.name == "score" else "details"
        pages = R.page_rejects(own, "entity_id", "body").filter(F.col("kind") == kind).withColumnRenamed("movie_id", "entity_id")
        bad = _rejected(pages, action, F.col("reason"), page=False)
        flat = action.flatten(own)
    if action.no_nulls:
        nulls = staged(R.review_rejects(own, keys=action.no_nulls))
        bad = bad.unionByName(_rejected(nulls.withColumnRenamed("movie_slug", "entity_id"), action, F.col("reason"), F.col("record")))
        at = nulls.select(F.col("movie_slug").alias("_m"), F.col("page_no").alias("_p"), F.col("item_pos").alias("_i"))
        flat = flat.join(at, (F.col("movie_slug").eqNullSafe(F.col("_m"))) & (F.col("page_no").eqNullSafe(F.col("_p"))) & (F.col("item_pos") == F.col("_i")),
                         "left_anti")
    clean = scrub_strings(flat)
    fields = [c for c in clean.columns if c not in ("page_no", "item_pos", "movie_code")]
    checked = clean.withColumn("_record", F.to_json(F.struct(*fields)))
    checked = checked.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(fields)], "_record",
                             *[(F.col(c) if c in clean.columns else F.lit(None)).cast("long").alias(c) for c in ("page_no", "item_pos")])
    tagged = R.tag_records(checked, rules(action.table), "_record")
    tagged = staged(tagged.withColumn("_record", F.when(F.col("reason").isNotNull(), F.col("_record"))))
    ok, unfit = R.split_tagged(tagged, checked.columns)
    bad = bad.unionByName(_rejected(unfit.withColumn("entity_id", F.col(f"_c{fields.index(action.movie)}")), action, F.col("reason"), F.col("_record")))
    records = ok.select(F.lit(action.name).alias("action"), F.col(f"_c{fields.index(action.movie)}").alias("movie"), "page_no", "item_pos",
                        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(fields)])
    return records, bad


def _kind() -> Column:
    """Place in ``ACTIONS`` of a capture's kind; -1: an unknown kind."""
    at = F.lit(-1)
    for i, a in enumerate(ACTIONS):
        at = F.when((F.col("platform") == a.platform) & (F.col("action") == a.name), F.lit(i)).otherwise(at)
    return at


def flatten_captured(captured: DataFrame, max_pages: int | None = None,
                     staged: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[dict[str, DataFrame], DataFrame]:
    """(records by bronze table, rejects) of all captures; captures of an unknown kind are rejected too. A column ``_kind`` of
    ``captured``, if there, is what it is laid out by; kinds that it does not have are left out then."""
    tables, bad = {}, None
    laid_out = "_kind" in captured.columns
    of = lambda i: captured.filter(F.col("_kind") == i) if laid_out else captured
    there = {r[0] for r in captured.select("_kind").distinct().collect()} if laid_out else range(len(ACTIONS))  # at most 8 numbers
    for i, a in enumerate(ACTIONS):
        if i not in there:
            continue
        tables[a.table], rejected = flatten_action(of(i), a, max_pages, staged)
        bad = rejected if bad is None else bad.unionByName(rejected)
    other = of(-1).filter(_kind() == -1).select(
        "platform", "action", "entity_id", F.col("page_no").cast("long").alias("page_no"), F.lit("unknown kind of capture").alias("reason"),
        F.lit(None).cast("string").alias("record"))
    return tables, other if bad is None else bad.unionByName(other)


def write_feeds(captured: DataFrame, out: str, rejects_path: str | None = None, max_pages: int | None = None) -> dict[str, str]:
    """Writes each table's feed to ``<out>/<table>`` (a movie's records replaced whole, other movies untouched); returns the globs
    that ``load_batch(json_lines=True)`` takes. On a mounted file system the feeds are packed (``sources.packs``)."""
    spark, kept = captured.sparkSession, []

    def scratch(df: DataFrame, *by: str) -> DataFrame:
        kept.append(scratch_path(spark, "captured"))
        df.write.partitionBy(*by).options(compression="zstd", **ROW_GROUPS).parquet(kept[-1])
        return spark.read.schema(df.schema).parquet(kept[-1])

    # Each kind is read by its own flattener, and each frame of records gives a feed and rejects: made once, not for every reader.
    kinds = captured.select("platform", "action", "entity_id", "page_no", "body", _kind().alias("_kind"))
    laid_out = scratch(kinds, "_kind")
    # The work is in the rows, whatever their bytes: they are split for all cores where they lie, not shuffled.
    own = {"spark.sql.files.openCostInBytes": OPEN_COST, "spark.sql.files.minPartitionNum": str(parts(spark))}
    before = {k: spark.conf.get(k, None) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        tables, bad = flatten_captured(laid_out, max_pages, scratch)
        for name, records in tables.items():
            keyed_feed_write(records.drop("page_no", "item_pos"), f"{out.rstrip('/')}/{name}", packed=True)
        if rejects_path:
            bad.write.mode("append").parquet(rejects_path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        for path in kept:
            remove_dir(spark, path)
    return {a.table: f"{out.rstrip('/')}/{a.table}/action=*/movie=*/*.json" for a in ACTIONS}


__all__ = ["ACTIONS", "Action", "CAPTURED_DDL", "flatten_action", "flatten_captured", "write_feeds", "rules"]

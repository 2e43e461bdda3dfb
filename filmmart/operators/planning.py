"""Catalogue selection and work planning (C1-C8), as DataFrame plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import path_exists
from .dedup import top_n_per_group
from .keys import dense_key

# Batching rule of the reference (size = max(50, ceil(n / 1000))).
MIN_BATCH = 50
MAX_BATCHES = 1000
SORTS = {"critic": "critic_score", "user": "user_score", "release": "release_date"}


def browse(df: DataFrame, sort_by: str, tiebreak: str, year_min: int | None = None, year_max: int | None = None,
           genres: Sequence[str] | None = None, type_: str | None = None, in_theaters: bool | None = None,
           release_type: str | None = None, networks: Sequence | None = None, offset: int = 0,
           max_items: int | None = None, year: str = "premiere_year", genre_col: str = "genres",
           type_col: str = "type", theaters_col: str = "in_theaters", release_type_col: str = "release_type",
           networks_col: str = "networks") -> DataFrame:
    """Filters, descending sort with a tiebreak, offset + limit (a top-k plan)."""
    out = df
    if year_min is not None:
        out = out.filter(F.col(year) >= year_min)
    if year_max is not None:
        out = out.filter(F.col(year) <= year_max)
    if genres:
        out = out.filter(F.arrays_overlap(F.col(genre_col), F.array(*[F.lit(g) for g in genres])))
    if type_ is not None:
        out = out.filter(F.col(type_col) == type_)
    if in_theaters:  # asked for or not; "not in theatres" is no filter
        out = out.filter(F.col(theaters_col))
    if release_type is not None:
        out = out.filter(F.col(release_type_col) == release_type)
    if networks:
        out = out.filter(F.arrays_overlap(F.col(networks_col), F.array(*[F.lit(n) for n in networks])))
    col = SORTS.get(sort_by, sort_by)
    out = out.orderBy(F.col(col).desc_nulls_last(), F.col(tiebreak).asc_nulls_last())
    if offset:
        out = out.offset(offset)
    if max_items is not None and max_items > 0:
        out = out.limit(max_items)
    return out


def title_search(df: DataFrame, query: str, tiebreak: str, max_items: int | None = None,
                 title: str = "title") -> DataFrame:
    """Case-insensitive substring match, in tiebreak order, capped."""
    out = df.filter(F.lower(F.col(title)).contains(query.lower())).orderBy(F.col(tiebreak).asc_nulls_last())
    return out.limit(max_items) if max_items and max_items > 0 else out


def top_n_per_year(df: DataFrame, year: str, score: str, tiebreak: str, n: int,
                   year_min: int | None = None, year_max: int | None = None) -> DataFrame:
    """Years min..max inclusive, the best ``n`` per year (WindowGroupLimit plan)."""
    out = df
    if year_min is not None:
        out = out.filter(F.col(year) >= year_min)
    if year_max is not None:
        out = out.filter(F.col(year) <= year_max)
    return top_n_per_group(out, [year], [F.col(score).desc_nulls_last(), F.col(tiebreak).asc_nulls_last()], n,
                           rank_col="rank_in_year")


def ordered_distinct(passes: Sequence[DataFrame], key: str, position: str = "pos", out: str = "position") -> DataFrame:
    """C4: concatenate passes, keep each key's first occurrence, keep that order.

    Each pass carries its own ``position``; the first occurrence is the minimum of
    (pass number, position) per key -- a partial aggregate, so a repeated key costs one
    row per map task -- and the kept rows are numbered 1..n in that order.
    """
    u = None
    for i, p in enumerate(passes):
        part = p.select(F.col(key), F.struct(F.lit(i).alias("p"), F.col(position).alias("i")).alias("_o"))
        u = part if u is None else u.unionByName(part)
    first = u.groupBy(key).agg(F.min("_o").alias("_o"))
    ranked = dense_key(first, [F.col("_o").asc()], out)
    return ranked.select(out, key)


def _discovery_array(value: str) -> Column:
    return F.from_json(F.col(value), "array<struct<slug: string>>", {"allowUnquotedControlChars": "true"})


def discovery_rejects(feed: DataFrame, value: str = "value", file: str = "_source_file") -> DataFrame:
    """Discovery files that ``discovered_slugs`` can't read as an array: the crawl must not go on
    without them."""
    return feed.filter(_discovery_array(value).isNull()).select(
        file, F.lit("not a JSON array of discovery records").alias("reason"))


def discovered_slugs(feed: DataFrame, limit: int | None = None, value: str = "value",
                     file: str = "_source_file") -> DataFrame:
    """Discovered movie slugs from discovery feed files: C4 + C5 as the catalogue job does.

    Files are JSON arrays of discovery records, parsed leniently (raw control characters
    inside strings are accepted, as the job's decoder does); slugs are taken in file then
    position order, each kept at its first occurrence, then capped if the caller gives a ``limit``
    (None or <= 0: all). Files that don't parse are in ``discovery_rejects``.
    Output: ``position`` (1..n) and ``slug``.
    """
    recs = feed.select(F.col(file).alias("_f"), F.posexplode(_discovery_array(value)).alias("_p", "_r"))
    recs = recs.filter(F.col("_r.slug").isNotNull()).select(F.col("_r.slug").alias("slug"), "_f", "_p")
    first = recs.groupBy("slug").agg(F.min(F.struct("_f", "_p")).alias("_o"))
    ranked = dense_key(first, [F.col("_o").asc()], "position")
    out = ranked.select("position", "slug")
    return out if limit is None or limit <= 0 else out.filter(F.col("position") <= limit)


def optional_cap(df: DataFrame, limit: int | None, order: Sequence[Column]) -> DataFrame:
    """``limit <= 0`` (or None) means everything; else the first ``limit`` by ``order``."""
    if limit is None or limit <= 0:
        return df
    return df.orderBy(*order).limit(limit)


def resume_filter(todo: DataFrame, ledger: DataFrame, keys: Sequence[str], force: bool = False) -> DataFrame:
    """Drop work already marked done, unless ``force``."""
    if force:
        return todo
    return todo.join(ledger.select(*keys).distinct(), list(keys), "left_anti")


def mark_done(results: DataFrame, keys: Sequence[str], require_items: bool = True,
              finished: str | None = None) -> DataFrame:
    """Ledger rows for finished work. RT rule: only with > 0 items; MC: regardless."""
    src = results.filter(F.col(finished)) if finished else results
    counted = src.groupBy(*keys).agg(F.count_if(F.col("item").isNotNull()).alias("items"))
    return counted.filter(F.col("items") > 0) if require_items else counted


def append_ledger(done: DataFrame, path: str, keys: Sequence[str] = ("slug", "action")) -> None:
    """Finished work appended to the ledger table that ``resume_filter`` reads; marks that
    are there already are not repeated."""
    spark = done.sparkSession
    new = done.select(*keys).distinct()
    if path_exists(spark, path):
        new = new.join(spark.read.parquet(path).select(*keys), list(keys), "left_anti")
    new.write.mode("append").parquet(path)


def work_batches(slugs: DataFrame, ledger: DataFrame, action: str, template: str, force: bool = False,
                 slug: str = "slug", order: str = "position", noop: str | None = "echo nothing to do") -> DataFrame:
    """The crawl plan for one action: ordered distinct slugs, minus (slug, action) pairs the
    ``ledger`` marks done (unless ``force``), one command per slug from ``template``
    (``{slug}`` and ``{action}`` are filled in), batched by C8's rule. ``ledger`` columns:
    ``slug``, ``action``."""
    done = ledger.filter(F.col("action") == action).select(F.col("slug").alias(slug))
    todo = resume_filter(slugs.select(slug, order), done, [slug], force)
    parts = template.split("{slug}")
    pieces = []
    for i, piece in enumerate(parts):
        if i:
            pieces.append(F.col(slug))
        pieces.append(F.lit(piece.replace("{action}", action)))
    return batch_commands(todo, [F.col(order)], F.concat(*pieces), noop=noop)


def batch_size(n: Column) -> Column:
    return F.greatest(F.lit(MIN_BATCH), F.ceil(n / F.lit(MAX_BATCHES)))


def command_plan(work: DataFrame, order: Sequence[Column], command: Column) -> DataFrame:
    """C8 in long form: batch, position (1..n), command; one row per command, whatever a batch's size."""
    keyed = dense_key(work.select(*work.columns, command.alias("_cmd")), list(order), "_k")
    n = keyed.agg(F.count(F.lit(1)).alias("_n"))
    # n as a scalar subquery: computed once and inlined, no join needed.
    batch = F.floor((F.col("_k") - 1) / batch_size(n.scalar())).cast("long")
    return keyed.select(batch.alias("batch"), F.col("_k").alias("position"), F.col("_cmd").alias("command"))


def batch_commands(work: DataFrame, order: Sequence[Column], command: Column, sep: str = "; ",
                   noop: str | None = None) -> DataFrame:
    """Number the work 1..n (dense key), size = max(50, ceil(n/1000)), consecutive rows
    per batch, commands joined by ``sep`` in order. ``noop``: one batch when there is no work.

    The joined text of a batch grows with n / 1000, as a scheduler wants it; jobs that run the
    commands take ``command_plan``.
    """
    sized = command_plan(work, order, command)
    n = sized.agg(F.count(F.lit(1)).alias("_n"))
    batches = (sized.groupBy("batch")
               .agg(F.sort_array(F.collect_list(F.struct("position", F.col("command").alias("_cmd")))).alias("_cs"))
               .select("batch", F.array_join(F.transform("_cs", lambda x: x["_cmd"]), sep).alias("commands"),
                       F.size("_cs").cast("long").alias("n_commands")))
    if noop is None:
        return batches
    empty = n.filter(F.col("_n") == 0).select(F.lit(0).cast("long").alias("batch"), F.lit(noop).alias("commands"),
                                              F.lit(0).cast("long").alias("n_commands"))
    return batches.unionByName(empty)


__all__ = ["browse", "title_search", "top_n_per_year", "ordered_distinct", "discovered_slugs", "optional_cap", "resume_filter",
           "mark_done", "append_ledger", "discovery_rejects", "command_plan", "batch_commands", "work_batches", "batch_size"]

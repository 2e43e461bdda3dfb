"""Command line: the reference's load and build tasks as Spark jobs.

  python -m filmmart load     --feed 'data/mc/general/*.json' --bronze wh/bronze/mc_general [--rejects PATH]
  python -m filmmart stream   --feed-dir data/rt/score --bronze wh/bronze/rt_score --rejects PATH --checkpoint PATH
  python -m filmmart snapshot --feed data/rt/crosswalk.json --bronze wh/bronze/rt_crosswalk
  python -m filmmart arrays   --feed 'data/big/*.json' --bronze wh/bronze/mc_general [--rejects PATH]
  python -m filmmart flatten  --captured wh/captured --out data [--rejects PATH] [--max-pages N]
  python -m filmmart keep     --table silver_mc_user_reviews --bronze wh/bronze/mc_user_reviews --silver PATH --checkpoint PATH
  python -m filmmart build    --bronze-root wh/bronze --out wh/mart [--sql 'select ...']
  python -m filmmart crosswalk --bronze-root wh/bronze --mapping wh/imdb_to_rt --out data/rt/crosswalk
  python -m filmmart plan     --bronze-root wh/bronze --ledger wh/ledger --action details --out wh/plan/details
  python -m filmmart mark     --results wh/results --ledger wh/ledger [--require-items]
  python -m filmmart replay   --feed 'data/mc/general/*.json' --bronze wh/bronze/mc_general --rejects PATH

The session comes from ``spark-submit`` / the environment; checkpoints go to the
cluster's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import sys
import uuid

from pyspark.sql import functions as F

from .functions.jsonops import unnest_records
from .operators.crosswalk import build_crosswalk, identity_map
from .operators.planning import append_ledger, mark_done, ordered_distinct, work_batches
from .operators.quality import sources_freshness
from .plans.capture import write_feeds
from .plans.mart import build_from_root, register_views
from .plans.silver import SPECS
from .session import get_spark, path_exists
from .sources.feeds import load_batch, read_bronze, read_bronze_root, replace_snapshot
from .sources.json_array import load_arrays
from .streaming.feed_stream import load_stream, replay_rejects
from .streaming.silver_stream import compact, update_silver


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="filmmart")
    sub = p.add_subparsers(dest="cmd", required=True)
    ld = sub.add_parser("load", help="append new feed files to a bronze table (each file once)")
    ld.add_argument("--feed", required=True)
    ld.add_argument("--bronze", required=True)
    ld.add_argument("--rejects")
    ld.add_argument("--all", action="store_true", help="append every file again (duplicates accepted)")
    ld.add_argument("--json-lines", action="store_true", help="files hold one JSON document per line")
    st = sub.add_parser("stream", help="load new feed files with a checkpointed file stream, then stop")
    st.add_argument("--feed-dir", required=True)
    st.add_argument("--glob", default="*.json")
    st.add_argument("--bronze", required=True)
    st.add_argument("--rejects", required=True)
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--json-lines", action="store_true")
    sn = sub.add_parser("snapshot", help="replace a snapshot table if the new file is valid")
    sn.add_argument("--feed", required=True)
    sn.add_argument("--bronze", required=True)
    sn.add_argument("--json-lines", action="store_true")
    ar = sub.add_parser("arrays", help="append new array files of any size, each read by many tasks")
    ar.add_argument("--feed", required=True)
    ar.add_argument("--bronze", required=True)
    ar.add_argument("--rejects")
    fl = sub.add_parser("flatten", help="captured responses and pages -> keyed feeds of all tables")
    fl.add_argument("--captured", required=True, help="parquet table (platform, action, entity_id, page_no, body)")
    fl.add_argument("--out", required=True, help="folder for the feeds, one folder per table")
    fl.add_argument("--rejects")
    fl.add_argument("--max-pages", type=int)
    kp = sub.add_parser("keep", help="take new bronze loads into a silver table by micro-batches, then stop")
    kp.add_argument("--table", required=True, choices=sorted(SPECS))
    kp.add_argument("--bronze", required=True)
    kp.add_argument("--silver", required=True)
    kp.add_argument("--checkpoint", required=True)
    kp.add_argument("--compact", action="store_true")
    cw = sub.add_parser("crosswalk", help="first-wins imdb map from bronze mc_general + id mapping -> crosswalk feed")
    cw.add_argument("--bronze-root", required=True)
    cw.add_argument("--mapping", required=True, help="parquet table (imdb_id, rt_raw)")
    cw.add_argument("--out", required=True, help="folder for the crosswalk feed (JSON lines)")
    pl = sub.add_parser("plan", help="command batches for one action: crosswalk slugs minus the done ledger")
    pl.add_argument("--bronze-root", required=True)
    pl.add_argument("--ledger", required=True, help="parquet table (slug, action); may be absent")
    pl.add_argument("--action", required=True)
    pl.add_argument("--template", default="crawl movie={slug} action={action}")
    pl.add_argument("--force", action="store_true")
    pl.add_argument("--out", required=True)
    rp = sub.add_parser("replay", help="load files that were rejected and are valid now")
    rp.add_argument("--feed", required=True)
    rp.add_argument("--bronze", required=True)
    rp.add_argument("--rejects", required=True)
    mk = sub.add_parser("mark", help="append finished work to the ledger that plan reads")
    mk.add_argument("--results", required=True, help="parquet table (slug, action, item, finished)")
    mk.add_argument("--ledger", required=True)
    mk.add_argument("--require-items", action="store_true", help="done only with at least one item")
    bd = sub.add_parser("build", help="bronze -> silver -> gold -> data tests")
    bd.add_argument("--bronze-root", required=True)
    bd.add_argument("--out", required=True)
    bd.add_argument("--sql", help="query to run over the built tables afterwards")
    bd.add_argument("--movie-rows", type=int, nargs=2, default=(1, 1_000_000), metavar=("MIN", "MAX"),
                    help="accepted row count of dim_movie")
    bd.add_argument("--now", help="timestamp for the bronze freshness check (warn 24 h, error 48 h)")
    a = p.parse_args(argv)

    spark = get_spark()
    if a.cmd == "load":
        print(load_batch(spark, a.feed, a.bronze, a.rejects, only_new=not a.all, json_lines=a.json_lines))
    elif a.cmd == "stream":
        load_stream(spark, a.feed_dir, a.bronze, a.rejects, a.checkpoint, glob=a.glob, json_lines=a.json_lines)
    elif a.cmd == "snapshot":
        print(replace_snapshot(spark, a.feed, a.bronze, json_lines=a.json_lines))
    elif a.cmd == "arrays":
        print(load_arrays(spark, a.feed, a.bronze, a.rejects))
    elif a.cmd == "flatten":
        for table, glob in write_feeds(spark.read.parquet(a.captured), a.out, a.rejects, a.max_pages).items():
            print(f"{table}\t{glob}")
    elif a.cmd == "keep":
        update_silver(spark, a.bronze, a.silver, SPECS[a.table], a.checkpoint)
        if a.compact:
            compact(spark, a.silver, SPECS[a.table])
    elif a.cmd == "crosswalk":
        ids = identity_map(read_bronze(spark, f"{a.bronze_root.rstrip('/')}/mc_general"))
        build_crosswalk(ids, spark.read.parquet(a.mapping)).write.mode("overwrite").json(a.out)
    elif a.cmd == "plan":
        xw = read_bronze(spark, f"{a.bronze_root.rstrip('/')}/rt_crosswalk")
        recs = unnest_records(xw, with_position=True)
        slugs = ordered_distinct([recs.select(F.get_json_object("record", "$.rt_slug").alias("slug"),
                                              F.struct("_loaded_at", "_source_file", "_pos").alias("pos"))
                                  .filter(F.coalesce(F.col("slug"), F.lit("")) != "")], "slug")
        ledger = (spark.read.parquet(a.ledger) if path_exists(spark, a.ledger)
                  else spark.createDataFrame([], "slug string, action string"))
        work_batches(slugs, ledger, a.action, a.template, a.force).write.mode("overwrite").json(a.out)
    elif a.cmd == "replay":
        replay_rejects(spark, a.feed, a.rejects, a.bronze, f"replay-{uuid.uuid4().hex}")
    elif a.cmd == "mark":
        append_ledger(mark_done(spark.read.parquet(a.results), ["slug", "action"], a.require_items, "finished"), a.ledger)
    else:
        out = build_from_root(spark, a.bronze_root, a.out, movie_rows=tuple(a.movie_rows))
        failing = out["tests"].filter(F.col("status") != "pass")
        failing.show(truncate=False)
        if a.now:
            sources_freshness(read_bronze_root(spark, a.bronze_root), a.now).show(truncate=False)
        if a.sql:
            register_views(out)
            spark.sql(a.sql).show(truncate=False)
        return 1 if failing.limit(1).count() else 0
    return 0


if __name__ == "__main__":
    sys.exit(main())

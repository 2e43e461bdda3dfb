"""Write PLANS.md: the physical plans (tree of ``explain("formatted")``) of the operators
whose shape matters at scale. Run from the repo root: ``python tools/explain_plans.py [sf_dir]``."""

from __future__ import annotations

import contextlib
import io
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from filmmart.checks.registry import all_queries  # noqa: E402
from filmmart.plans import gold as G  # noqa: E402
from filmmart.plans import silver as S  # noqa: E402
from filmmart.plans.standins import bronze_from_driver  # noqa: E402
from filmmart.session import get_spark, scratch_path  # noqa: E402

NOTES = {
    "silver_mc_critic_reviews": "latest row per (movie, author, date): WindowGroupLimit before and after the shuffle",
    "dim_movie_rows": "NULL ids split once; per-id dedup and full outer join only on non-NULL ids",
    "fact_critic_review_rows": "one lookup join per platform branch; dimensions broadcast by AQE from measured size, "
                               "the date spine by hint",
    "dense_key (fact_critic_review)": "after the checkpoint: local ids + one broadcast row of offsets per partition",
    "dq_relationships": "child reduced to distinct keys (partial aggregate) before the anti join",
    "identity_map": "first-wins map as a min_by aggregate (partial on the map side)",
    "batch_commands": "work count as a scalar subquery, batches grouped by number",
    "hot_key_latest": "a third of the rows on one key: the partial limit keeps 2 rows per key per task",
}


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    return text.split("\n\n\n")[0].strip()


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", "filmmart-plans", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    root = scratch_path(spark, "plans")
    silver = {}
    for name, df in S.build_all_silver(bronze_from_driver(spark, sf)).items():
        df.write.parquet(f"{root}/{name}")
        silver[name] = spark.read.parquet(f"{root}/{name}")
    G.dim_movie(silver["silver_mc_general"], silver["silver_rt_details"]).write.parquet(f"{root}/dm")
    G.dim_critic(silver["silver_mc_critic_reviews"], silver["silver_rt_critic_reviews"]).write.parquet(f"{root}/dc")
    dm, dc = spark.read.parquet(f"{root}/dm"), spark.read.parquet(f"{root}/dc")
    b = bronze_from_driver(spark, sf)
    q = all_queries()
    frames = {
        "silver_mc_critic_reviews": S.build_silver(b["mc_critic_reviews"], S.SPECS["silver_mc_critic_reviews"]),
        "dim_movie_rows": G.dim_movie_rows(silver["silver_mc_general"], silver["silver_rt_details"]),
        "fact_critic_review_rows": G.fact_critic_review_rows(silver["silver_mc_critic_reviews"],
                                                             silver["silver_rt_critic_reviews"], dm, dc,
                                                             G.dim_date(spark)),
        "dense_key (fact_critic_review)": G.fact_critic_review(silver["silver_mc_critic_reviews"],
                                                               silver["silver_rt_critic_reviews"], dm, dc,
                                                               G.dim_date(spark)),
        "dq_relationships": q["dq_relationships"](spark, sf),
        "identity_map": q["identity_map"](spark, sf),
        "batch_commands": q["batch_commands"](spark, sf),
        "hot_key_latest": q["hot_key_latest"](spark, sf),
    }
    out = ["# Physical plans", "",
           f"Generated by `tools/explain_plans.py` on `{sf}`, local[8], 8 shuffle partitions, AQE on.",
           "These are the plans before execution; at run time AQE may still turn a sort-merge join",
           "into a broadcast join (measured size) or split a skewed partition.", ""]
    for name, df in frames.items():
        out += [f"## {name}", "", NOTES[name], "", "```", tree(df), "```", ""]
    Path("PLANS.md").write_text("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()

"""What a job moves and how it commits, where that decides how far it scales."""

import datetime

from pyspark.sql import functions as F

from filmmart.plans.standins import mc_critic_reviews


def test_bronze_shuffles_columns_not_text(spark):
    """The envelopes of reviews are put together after the shuffle: no JSON text is made before it."""
    day = datetime.date(1996, 3, 13)
    rows = [(1, 1, 155, 7, 17.0, day), (1, 2, 67, 17, 36.0, day), (13, 1, 5, None, None, None)]
    lines = spark.createDataFrame(rows, "l_orderkey long, l_linenumber long, l_partkey long, l_suppkey long, l_quantity double, l_shipdate date")
    bronze = mc_critic_reviews(lines)
    got = {r["_source_file"]: r["data"] for r in bronze.collect()}
    assert got["mc_critic_reviews/1704067201_0.json"].startswith('[{"movie_slug":"p-155","quote":"o1 l1","score":34,"date":"1996-03-13"')
    assert got["mc_critic_reviews/1704067201_0.json"].count('"quote"') == 2
    assert '"date":"soon"' in got["mc_critic_reviews/1704067213_0.json"] and "author_slug" not in got["mc_critic_reviews/1704067213_0.json"]
    plan = bronze.select(F.length("data")).toDF("n")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(_epoch" in plan
    assert "to_json" not in plan.split("Exchange hashpartitioning(_epoch")[1].lower().replace("structstojson", "to_json")


def test_candidate_texts_meet_by_shuffle_at_every_size(spark, monkeypatch):
    """The classes whose texts are wanted grow with the input: their join is planned alike at any size, without a broadcast."""
    from filmmart.llm import minmax_dedup
    plans, written = {}, minmax_dedup.materialize

    def noted(spark, df, name):
        out = written(spark, df, name)
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return out

    monkeypatch.setattr(minmax_dedup, "materialize", noted)
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:59], "x"])), (3, "something else altogether"), (None, None)]
    got = minmax_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {1: 1, 2: 1, 3: 3, None: None}
    assert "SortMergeJoin" in plans["minmax-texts"] and "BroadcastHashJoin" not in plans["minmax-texts"]

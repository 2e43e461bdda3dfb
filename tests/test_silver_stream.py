"""Silver kept by micro-batches equals the rebuild, in any order of loads, replayed, and compacted."""

import os
import random

from pyspark.sql import functions as F

from filmmart.plans import silver as S
from filmmart.session import local_path, scratch_path
from filmmart.sources import feeds as A
from filmmart.streaming import silver_stream as K


def _loads(rng, n):
    """Envelopes with few keys, equal load times, NULLs in keys and columns, equal rows."""
    out = []
    for i in range(n):
        recs = []
        for _ in range(rng.randrange(4)):
            rec = {"review_id": rng.choice(["a", "b", "c", "d", None]), "movie_slug": rng.choice(["m", "n", None, "m"]), "score": rng.choice([None, "5", "x", 7]),
                   "quote": rng.choice(["é", "z", "", None]), "spoiler": rng.choice([True, None])}
            recs.append("{" + ",".join(f'"{k}":{str(v).lower() if isinstance(v, bool) else v if isinstance(v, int) else "null" if v is None else chr(34) + v + chr(34)}'
                                       for k, v in rec.items()) + "}")
        out.append((rng.choice(["2024-01-01 00:00:00", "2024-01-02 00:00:00", None]), rng.choice(["f", "f1", "f10", "g", None]), "[" + ",".join(recs) + "]"))
    return out


def test_latest_rows_order_as_the_batch_build(spark):
    spec = S.SPECS["silver_mc_user_reviews"]
    for seed in range(3):
        rows = _loads(random.Random(seed), 150)
        b = spark.createDataFrame(rows, "t string, _source_file string, data string").select(F.to_timestamp("t").alias("_loaded_at"), "_source_file", "data")
        want = sorted(map(tuple, S.build_silver(b, spec).collect()), key=str)
        typed = S.typed_records(b, spec)
        cols = [f[0] for f in spec.fields] + ["_loaded_at", "_source_file"]
        assert sorted(map(tuple, K.latest_rows(typed, list(spec.keys)).select(*cols).collect()), key=str) == want and want


def test_any_order_replay_and_compaction(spark):
    spec = S.SPECS["silver_mc_user_reviews"]
    rows = _loads(random.Random(9), 60)
    frame = lambda part: spark.createDataFrame(part, "t string, _source_file string, data string").select(
        F.to_timestamp("t").alias("_loaded_at"), "_source_file", "data")
    want = sorted(map(tuple, S.build_silver(frame(rows), spec).collect()), key=str)
    for turn in (1, -1):
        root = scratch_path(spark, "t-kept")
        for i, at in enumerate(range(0, 60, 20)[::turn]):
            A.write_load(frame(rows[at:at + 20]), f"{root}/bronze", f"l{i}")
            K.update_silver(spark, f"{root}/bronze", f"{root}/silver", spec, f"{root}/ck")
            if i == 1:
                K.compact(spark, f"{root}/silver", spec)
            if i == 2:  # the last batch was written, its commit was not
                for name in ("2", ".2.crc"):
                    if os.path.exists(local_path(f"{root}/ck/commits/{name}")):
                        os.remove(local_path(f"{root}/ck/commits/{name}"))
                K.update_silver(spark, f"{root}/bronze", f"{root}/silver", spec, f"{root}/ck")
        A.write_load(frame(rows[:20]), f"{root}/bronze", "again")  # a load that comes twice
        K.update_silver(spark, f"{root}/bronze", f"{root}/silver", spec, f"{root}/ck")
        assert sorted(map(tuple, K.read_silver(spark, f"{root}/silver", spec).collect()), key=str) == want
        K.compact(spark, f"{root}/silver", spec)
        assert sorted(map(tuple, K.read_silver(spark, f"{root}/silver", spec).collect()), key=str) == want
    assert K.read_silver(spark, f"{root}/none", spec).count() == 0

"""Array files read by byte ranges: every cut gives the elements of the whole text."""

import json
import os
import random

import pytest

from filmmart.functions import jsonops as J
from filmmart.session import local_path, scratch_path
from filmmart.sources import feeds as A
from filmmart.sources import json_array as R

TRICKY = [{"a": 'quo"te', "b": "back\\slash", "c": "end\\"}, "[1,2]", ",", '"', "\\", '\\"', "}{][", {"k,}": [1, {"x": "],["}]}, [], {}, [[]], None, True, -1.5e3,
          {"u": "é  ü", "tab": "\t\n"}, ["", "\\\\", 'a\\"b'], {"nested": {"deep": [[["\\\\\""]]]}}]


def pieces(text: bytes, step: int) -> list:
    """All elements by ranges of ``step`` bytes, states composed as the job does."""
    state, depth, out = 0, 0, []
    for a in range(0, len(text), step):
        z = min(a + step, len(text))
        out += [e for _, e, _ in R.elements(lambda x, y: text[x:y], a, z, len(text), state, depth)]
        to, change = R.range_effect(text[a:z])[state]
        state, depth = to, depth + change
    assert (state, depth) == (0, 0)
    return out


@pytest.mark.parametrize("indent", [None, 2])
def test_every_cut_gives_the_same_elements(indent):
    rng = random.Random(1)
    rows = TRICKY + [{"s": "".join(rng.choices('ab"\\{}[],: \n', k=rng.randrange(30))), "n": rng.random()} for _ in range(60)]
    text = (" \n" + json.dumps(rows, indent=indent, ensure_ascii=False) + "\n ").encode()
    for step in [1, 2, 3, 5, 7, 16, 61, 500, len(text)]:
        assert [json.loads(e) for e in pieces(text, step)] == rows


def _files(folder: str, files: dict) -> str:
    d = local_path(folder)
    os.makedirs(d)
    for name, text in files.items():
        with open(f"{d}/{name}.json", "wb") as f:
            f.write(text if isinstance(text, bytes) else text.encode())
    return f"{folder}/*.json"


def test_ranges_equal_the_whole_text(spark):
    rng = random.Random(2)
    good = {f"g {i}é": json.dumps([rng.choice(TRICKY) if rng.random() < 0.5 else {"i": j, "t": "x,]" * rng.randrange(9)} for j in range(rng.randrange(1, 40))],
                                  indent=rng.choice([None, 1])) for i in range(12)}
    good |= {"empty": "[]", "blank array": " [ \n ] ", "bad bytes": b'[{"a": "caf\xe9"}]', "twice": '[{"a":1,"a":2}]'}
    bad = {"cut": '[{"a": 1}', "open string": '["a', "trailing": "[1] x", "two": "[1][2]", "two apart": "[1]" + " " * 300 + "[2]", "object": '{"a": 1}', "scalar": "12",
           "null": "null", "blank": " " * 200, "comma": "[1,]", "gap": "[1,,2]", "crossed": '[{"a": [1}]]', "brace": '[1}', "late": "[" + "1," * 400 + "x]", "stray": "[1]]"}
    root = scratch_path(spark, "t-ranges")
    glob = _files(f"{root}/feed", good | bad)
    for step in (64, 4096):
        bronze, rej = f"{root}/bronze{step}", f"{root}/rejects{step}"
        R.load_arrays(spark, glob, bronze, rej, range_bytes=step)
        got = J.unnest_records(A.read_bronze(spark, bronze), keep=("_source_file",))
        want = J.unnest_records(A.good(A.to_bronze(A.read_feed(spark, glob))), keep=("_source_file",))
        rejected = {r["_source_file"].rsplit("/", 1)[-1] for r in A.read_rejects(spark, rej).collect()}
        assert rejected == {r["f"] for r in spark.createDataFrame([(f"{n}.json".replace(" ", "%20"),) for n in bad], "f string").collect()}
        names = [r["_source_file"] for r in want.select("_source_file").distinct().collect()]
        assert len(names) == 12 + 2  # the two empty arrays have no rows
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.filter("_source_file not rlike 'object|scalar|null'").collect()), key=str)
        R.load_arrays(spark, glob, bronze, rej, range_bytes=step)
        assert J.unnest_records(A.read_bronze(spark, bronze), keep=()).count() == got.count()  # loaded once


def test_one_large_file_is_read_by_many_tasks(spark):
    root = scratch_path(spark, "t-one-large")
    os.makedirs(local_path(root))
    part = ',{"movie_slug": "m", "title": "' + "y]," * 300_000 + '"}'
    with open(f"{local_path(root)}/f.json", "w") as f:
        f.write('[{"movie_slug": "m0"}' + part * 120 + "]")
    feed = R.read_array_feed(spark, f"{root}/*.json")
    from pyspark.sql import functions as F
    r = feed.agg(F.sum("opens"), F.count("error"), F.countDistinct("_offset")).first()
    assert (r[0], r[1]) == (1, 0) and r[2] >= 7
    assert J.unnest_records(feed.withColumn("_loaded_at", F.current_timestamp()), data="value").count() == 121

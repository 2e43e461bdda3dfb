"""The pipeline, stage by stage, against what each stage promises on its own input."""

import collections
import random

from pyspark.sql import functions as F

from corpus_pipeline import PASSAGE, STAGES
from filmmart.llm import langid, minmax_dedup, mixing, suffix_dedup
from filmmart.llm.common import materialize
from filmmart.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
    assert [n for n, _ in STAGES] == ["language_id", "near_dedup", "repeated_passages", "source_mix", "bin_packing"]


def test_stages(spark, edge):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(3)
    columns, kept = docs.columns, {}
    for name, stage in STAGES:
        before = docs
        docs = materialize(spark, stage(spark, docs, SF), f"t-{name}")
        kept[name] = (before, docs)
        if name != "bin_packing":
            assert docs.columns == columns
    before, after = kept["language_id"]
    model = langid.fit(before.filter(~langid.held_out()).select("text", "lang"))
    gone = {r.doc_id for r in langid.predict(before, model).collect() if r.rejected}
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()} - gone
    before, after = kept["near_dedup"]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in minmax_dedup.near_duplicates(before).collect() if r.kept}
    before, after = kept["repeated_passages"]
    bytes_left = {r.doc_id: r.n_bytes - r.n_removed for r in suffix_dedup.repeat_digests(before, PASSAGE).collect()}
    for r in after.collect():
        assert 0 <= len(r.text.encode()) - bytes_left[r.doc_id] <= 8  # whole characters stay
    before, after = kept["source_mix"]
    taken = {r.doc_id: r.taken for r in mixing.mix_documents(before).collect()}
    got = collections.Counter()
    for r in after.collect():
        got[r.doc_id] += len(r.text.encode().split())
    assert {d: n for d, n in taken.items() if n} == dict(got)
    before, after = kept["bin_packing"]
    words = sum(len(r.text.encode().split()) for r in before.collect())
    assert sum(r.n_words for r in after.collect()) == words


def word_runs(texts: dict, n: int) -> dict:
    """Per document the n-word windows that another document has too."""
    where = collections.defaultdict(set)
    for d, t in texts.items():
        w = (t or "").split()
        for i in range(len(w) - n + 1):
            where[tuple(w[i:i + n])].add(d)
    out = collections.defaultdict(set)
    for window, ds in where.items():
        if len(ds) > 1:
            for d in ds:
                out[d].add(window)
    return out


def test_passages_shared_between_documents_go(spark):
    """Every passage of over 50 words that two documents of sf0.01 share is cut; documents without one, and
    without a byte run of that length found twice, stay as they are."""
    stages = dict(STAGES)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").dropDuplicates(["text"]).dropDuplicates(["doc_id"])
    before = {r.doc_id: r.text for r in docs.collect()}
    after = {r.doc_id: r.text for r in stages["repeated_passages"](spark, docs, "").collect()}
    shared = word_runs(before, 51)
    assert after.keys() == before.keys() and len(shared) > 40
    left = sum(any(" ".join(w) in " ".join(after[d].split()) for w in ws) for d, ws in shared.items())
    assert left == 0
    seen, twice = set(), set()
    for d, t in before.items():
        raw = (t or "").encode()
        for i in range(len(raw) - PASSAGE + 1):
            window = raw[i:i + PASSAGE]
            (twice if window in seen else seen).add(window)
    for d, t in before.items():
        raw = (t or "").encode()
        if not any(raw[i:i + PASSAGE] in twice for i in range(len(raw) - PASSAGE + 1)):
            assert after[d] == t


def test_language_id_keeps_what_it_cannot_judge(spark, edge, nothing):
    stages = dict(STAGES)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert stages["language_id"](spark, unlabelled, SF).count() == docs.count()
    clash = docs.withColumn("langid_Score", F.lit(1)).withColumn("rejected", F.lit("x")).withColumn("langid_rejected", F.lit("y"))
    kept = stages["language_id"](spark, clash, SF)
    assert kept.columns == clash.columns and 0.9 * docs.count() < kept.count() <= docs.count()
    for _, stage in STAGES:
        assert stage(spark, nothing, SF).count() == 0


def test_near_dedup_keeps_one_of_each_group(spark):
    """Against brute force on planted copies, with names of the operator's own columns taken."""
    rng = random.Random(4)
    rows, group = [], {}
    for g in range(12):
        base = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(200)]
        for _ in range(rng.choice([1, 2, 6])):
            w = list(base)
            if rng.random() < 0.5:
                w[rng.randrange(200)] = "edited"
            group[len(rows)] = g
            rows.append((len(rows), " ".join(w), "en", "s", 1, "x", 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept_row string, kept_n int")
    got = dict(STAGES)["near_dedup"](spark, docs, SF)
    ids = [r.doc_id for r in got.collect()]
    assert got.columns == docs.columns and sorted(ids) == sorted(min(d for d in group if group[d] == g) for g in range(12))


def test_stages_keep_extra_columns(spark, edge):
    _, docs = edge
    for name, stage in STAGES[:-1]:
        docs = materialize(spark, stage(spark, docs, SF), f"t-{name}")
        assert docs.columns == edge[1].columns
    assert STAGES[-1][1](spark, docs, SF).count() > 0

"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, in DataFrame functions only.

A text's paragraphs are its lines, a long line cut after the first sentence end beyond
``PARAGRAPH`` characters; the set of their 64-bit digests is hashed into cells of (count, xor of
digests, xor of checks), each digest into one cell of each of three sub-tables. Cells of two
versions subtract; peeling pure cells recovers the digests in which the versions differ. A
comparison of two versions subtracts sketches with ``CELLS`` cells per digest, kept as rows, peels them in
``ROUNDS`` aggregate rounds, and tries what doesn't peel again with twice the cells. The fingerprint
is the same sketch at a small fixed size. Likeness is (n + m - d) / (n + m + d) for sets of n and m digests that differ in d.

Edge cases: a null text is empty, and two empty texts are equal (likeness 1); repeated paragraphs
count once; rows with one doc_id share the next document, and the next document of
several rows is the smallest text; null doc_ids aren't in the order, their next document is the
first; a single document is its own next; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, prepare, read_table

PARAGRAPH = 120
SKETCH = 5  # cells per sub-table of the fingerprint
CELLS = 2.25  # cells per digest of the two versions in the first comparison; each retry has twice as many
ROUNDS = 7
TASK_DIGESTS = 150_000  # of all versions, per task


def paragraph_digests(text: Column) -> Column:
    pieces = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"[^\n]{{1,{PARAGRAPH}}}[^\n.!?]*[.!?]*"), F.lit(0))
    return F.array_distinct(F.transform(pieces, lambda p: F.xxhash64(p)))


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit(77))


def _entries(keys: Column, sign: int, size: int) -> Column:
    """(sign, digest, check, cell per sub-table) of each digest, for sub-tables of ``size`` cells."""
    return F.transform(keys, lambda k: F.struct(
        F.lit(sign).alias("s"), k.alias("k"), _check(k).alias("h"),
        *[(F.pmod(F.shiftrightunsigned(k, 21 * j), F.lit(size)).cast("int") + j * size).alias(f"p{j}") for j in range(3)]))


def _let(value: Column, body) -> Column:
    """``body`` with ``value`` evaluated once: lambdas evaluate what they refer to at each element."""
    return F.transform(F.array(value), body)[0]


def _folded(entries: Column, hit, start: Column, sign: int) -> Column:
    """``start`` with the entries that hit added (sign 1) or taken off (-1)."""
    return F.aggregate(entries, start, lambda a, e: F.when(hit(e), F.struct(
        (a["c"] + sign * e["s"]).alias("c"), a["k"].bitwiseXOR(e["k"]).alias("k"), a["h"].bitwiseXOR(e["h"]).alias("h"))).otherwise(a))


_ZERO = (("c", "int"), ("k", "long"), ("h", "long"))


def _cells(entries: Column, size: int) -> Column:
    """The 3 * size cells: (count, xor of digests, xor of checks)."""
    zero = F.struct(*[F.lit(0).cast(kind).alias(name) for name, kind in _ZERO])

    def of(es, j):
        return F.transform(F.sequence(F.lit(j * size), F.lit((j + 1) * size - 1)), lambda i: _folded(es, lambda e: e[f"p{j}"] == i, zero, 1))

    return _let(entries, lambda es: F.concat(*[of(es, j) for j in range(3)]))


def _position(key: Column, j: int, size: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(j)), size) + j * size


def _subtracted(pairs: DataFrame) -> DataFrame:
    """Cells of sketch(a) - sketch(b) of each pair, three sub-tables of ``size`` cells."""
    side = lambda keys, sign: F.transform(keys, lambda k: F.struct(F.lit(sign).alias("c"), k.alias("k")))
    rows = pairs.select("row", "id", "size", F.explode(F.concat(side("a", 1), side("b", -1))).alias("e")).select(
        "row", "id", "size", F.col("e.c").alias("c"), F.col("e.k").alias("k"))
    rows = rows.withColumn("cell", F.explode(F.array(*[_position(F.col("k"), j, F.col("size")) for j in range(3)])))
    return rows.groupBy("row", "id", "size", "cell").agg(F.sum("c").alias("c"), F.bit_xor("k").alias("k"),
                                                         F.bit_xor(_check(F.col("k"))).alias("h"), F.lit(0).cast("long").alias("got"))


def _peeled(cells: DataFrame) -> DataFrame:
    """One round: the digest of each pure cell is counted and taken out of its three cells."""
    pure = (F.abs("c") == 1) & (F.col("h") == _check(F.col("k")))
    row = lambda cell, c, got, by: F.struct(
        cell.alias("cell"), c.alias("c"), F.col("k").alias("k"), F.col("h").alias("h"), got.alias("got"), by.alias("by"))
    itself = row(F.col("cell"), F.col("c"), F.col("got"), F.lit(None).cast("long"))
    taken = [row(_position(F.col("k"), j, F.col("size")), -F.col("c"), F.lit(int(j == 0)).cast("long"), F.col("k")) for j in range(3)]
    rows = cells.select("row", "id", "size", F.explode(F.when(pure, F.array(itself, *taken)).otherwise(F.array(itself))).alias("r")).select(
        "row", "id", "size", "r.*")
    # A digest may stand alone in two or three cells; it is taken out once.
    once = rows.groupBy("row", "id", "size", "cell", "by").agg(*[F.max(x).alias(x) for x in ("c", "k", "h", "got")])
    return once.groupBy("row", "id", "size", "cell").agg(
        F.sum("c").alias("c"), F.bit_xor("k").alias("k"), F.bit_xor("h").alias("h"), F.sum("got").alias("got"))


def differences(sets: DataFrame, others: list[str]) -> DataFrame:
    """sets (row, keys, <others>: arrays of distinct digests) -> row, id (place in ``others``), d: the digests
    in one of keys and that other array only.

    The cells of a row stay in the task that the row is dealt to: building, subtracting and
    peeling need no further shuffle. Pairs that don't peel are tried again with twice the cells.
    """
    spark = sets.sparkSession
    digests = sets.agg(F.sum(F.size("keys") + sum((F.size(c) for c in others), F.lit(0)))).first()[0] or 0
    n_tasks = max(1, -(-digests // TASK_DIGESTS))
    pending, attempt, done = sets, 0, None
    while True:
        against = F.explode(F.array(*[F.struct(F.lit(i).alias("id"), F.col(c).alias("b")) for i, c in enumerate(others)])).alias("o")
        pairs = pending.repartition(n_tasks, "row").select("row", F.col("keys").alias("a"), against, *(["ids"] if attempt else []))
        if attempt:
            pairs = pairs.filter(F.array_contains("ids", F.col("o.id")))
        pairs = pairs.select("row", F.col("o.id").alias("id"), "a", F.col("o.b").alias("b")).filter("size(a) + size(b) > 0")
        size = F.ceil((F.size("a") + F.size("b")) * (CELLS * 2 ** attempt / 3)) + 4 + attempt
        cells = _subtracted(pairs.withColumn("size", size.cast("long")))
        for _ in range(ROUNDS):
            cells = _peeled(cells)
        empty = (F.col("c") == 0) & (F.col("k") == 0) & (F.col("h") == 0)
        tried = cells.groupBy("row", "id").agg(F.sum("got").alias("d"), F.bool_and(empty).alias("ok"))
        tried = materialize(spark, tried, "iblt-tried")
        right = tried.filter("ok").select("row", "id", "d")
        done = right if done is None else done.unionByName(right)
        failed = tried.filter("not ok").groupBy("row").agg(F.collect_list("id").alias("ids"))
        if failed.isEmpty():
            return done
        pending, attempt = materialize(spark, pending.drop("ids").join(failed, "row"), "iblt-pending"), attempt + 1
        n_tasks = max(1, n_tasks // 4)


def fingerprint(keys: Column) -> Column:
    """The fixed sketch as text: the number of digests, then count:digests:checks of each cell."""
    cells = _cells(_entries(keys, 1, SKETCH), SKETCH)
    as_text = F.transform(cells, lambda x: F.concat_ws(":", F.hex(x["c"].cast("long")), F.hex(x["k"]), F.hex(x["h"])))
    return F.concat_ws("|", F.size(keys).cast("string"), F.array_join(as_text, "|"))


def next_ids(docs: DataFrame) -> DataFrame:
    """doc_id, next_id, n_chars: each doc_id's next one in descending order (the first after the last), and its longest text's length."""
    spark = docs.sparkSession
    ids = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.max(F.coalesce(F.length("text"), F.lit(0))).alias("n_chars"))
    ids = materialize(spark, ids.repartitionByRange("doc_id").withColumn("part", F.spark_partition_id()), "iblt-ids")
    tops = ids.groupBy("part").agg(F.max("doc_id").alias("top"))
    order = Window.orderBy("part")  # one row per partition of the id table
    tops = tops.select("part", F.lag("top").over(order).alias("below"),
                       F.max("top").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("last"))
    ids = ids.join(tops, "part")
    below = F.lag("doc_id").over(Window.partitionBy("part").orderBy("doc_id"))
    return ids.select("doc_id", F.coalesce(below, "below", "last").alias("next_id"), "n_chars")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    chain = materialize(spark, next_ids(docs), "iblt-chain")
    first = chain.agg(F.max("doc_id")).first()[0]
    nulls = docs.filter("doc_id is null").agg(F.count(F.lit(1)), F.max(F.length("text"))).first()
    if nulls[0] and first is not None:
        chain = chain.unionByName(spark.range(1).select(
            F.lit(None).cast("long").alias("doc_id"), F.lit(first).alias("next_id"), F.lit(nulls[1]).alias("n_chars")))
    repeated = docs.filter("doc_id is not null").count() > chain.filter("doc_id is not null").count()
    # Both joins read the same rows, so that the texts are shuffled once.
    known = docs.filter("doc_id is not null")
    source = known.groupBy("doc_id").agg(F.min("text").alias("text")) if repeated else known
    chain = chain.select(F.col("doc_id").alias("c_id"), "next_id", F.col("n_chars").alias("longest"))
    after = chain.join(source, F.col("next_id") == F.col("doc_id")).select(
        "c_id", F.substring("text", F.lit(1), F.floor(F.col("longest") / 2).cast("int")).alias("head"), paragraph_digests(F.col("text")).alias("next_keys"))
    both = known.join(after, F.col("doc_id") == F.col("c_id"), "left")
    if nulls[0]:
        both = both.unionByName(docs.filter("doc_id is null").join(after, F.col("doc_id").eqNullSafe(F.col("c_id")), "left"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.coalesce(F.substring("head", F.lit(1), half), F.lit("")))
    both = both.select("doc_id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"),
                       F.coalesce("next_keys", F.array().cast("array<bigint>")).alias("next_keys"))
    keyed = both.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                        paragraph_digests(F.col("text")).alias("keys"), paragraph_digests(F.col("edited")).alias("edited_keys"), "next_keys")
    # Row numbers as written stay what they are: repeated rows are rows of their own.
    keyed = materialize(spark, keyed.withColumn("row", F.monotonically_increasing_id()), "iblt-digests")
    d = differences(keyed.select("row", "keys", "edited_keys", "next_keys"), ["edited_keys", "next_keys"])
    d = d.groupBy(F.col("row").alias("d_row")).agg(
        F.max(F.when(F.col("id") == 0, F.col("d"))).alias("d_edited"), F.max(F.when(F.col("id") == 1, F.col("d"))).alias("d_next"))

    def likeness(other, difference):
        n = F.size("keys") + F.size(other)
        return F.when(n == 0, F.lit(1.0)).otherwise((n - F.col(difference)) / (n + F.col(difference)))

    return keyed.join(d, F.col("row") == F.col("d_row"), "left").select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("keys")).alias("fingerprint"),
        fingerprint(F.col("edited_keys")).alias("edited_fingerprint"),
        likeness("edited_keys", "d_edited").alias("near_edited"), likeness("next_keys", "d_next").alias("near_next"))


def op6_iblt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read_table(spark, sf_dir, "documents"))

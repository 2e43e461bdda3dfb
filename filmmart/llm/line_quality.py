"""Quality rules: cross-document line frequency.

Lines are normalised (A-Z lower-cased, white space runs to one space, digits to 0) and hashed;
the distinct documents that hold a line are counted per host (the ``source`` column). A line
above the limit (``min_docs`` documents and ``max_share`` of the host's documents) is boilerplate
and is removed; a document left with fewer than ``min_words`` words, or with less than
``min_kept`` of its words, is depleted and rejected. Documents of one host with the same text
count once: exact copies are the deduplication's business and don't make a line boilerplate.

Edge cases: a null text has no words and no lines (base rule fails); null hosts are one host;
a line without a word is ignored; repeated rows are rated alike; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import re
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LocalVocab, by_bytes, materialize, prepare, read_table

MIN_DOCS = 10
MAX_SHARE = 0.05
MIN_WORDS = 50
MIN_KEPT = 0.5

_SYMBOLS = b"#*$%&|<>"
_NOT_SYMBOL = bytes(set(range(256)) - set(_SYMBOLS))
_CONTINUATION = bytes(range(0x80, 0xC0))
_DIGITS = re.compile(rb"[0-9]")


def _repeat_words(ids: np.ndarray) -> int:
    """Words that lie in a 3-word window found twice or more in the text."""
    n = len(ids) - 2
    if n < 2:
        return 0
    v = int(ids.max()) + 1
    pair = ids[:-1] * v + ids[1:]
    if v > 2_000_000:  # keeps the triple's code within 64 bits
        pair = np.unique(pair, return_inverse=True)[1]
    codes = pair[:-1] * v + ids[2:]
    _, inverse, counts = np.unique(codes, return_inverse=True, return_counts=True)
    start = counts[inverse] > 1
    covered = np.zeros(n + 2, dtype=bool)
    for i in range(3):
        covered[i:i + n] |= start
    return int(covered.sum())


def _features(text: bytes | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and {line hash: words of that line}."""
    text = text or b""
    words = text.split()
    joined = b"".join(words)
    chars = len(joined.translate(None, _CONTINUATION))
    symbols = len(text.translate(None, _NOT_SYMBOL))
    seen: set = set()
    dup, lines = 0, {}
    for line in text.split(b"\n"):
        parts = line.split()
        if not parts:
            continue
        if line in seen:
            dup += 1
        seen.add(line)
        norm = _DIGITS.sub(b"0", b" ".join(parts).lower())
        h = xxhash.xxh3_64_intdigest(norm)
        h -= (h >> 63) << 64
        lines[h] = lines.get(h, 0) + len(parts)
    return len(words), chars, symbols, dup, _repeat_words(LocalVocab().ids(words)), lines


_OUT = pa.schema([("doc_id", pa.int64()), ("host", pa.string()), ("text_hash", pa.int64()), ("n_words", pa.int64()),
                  ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
                  ("n_repeat_words", pa.int64()),
                  ("lines", pa.list_(pa.struct([("h", pa.int64()), ("n", pa.int64())])))])


def _scan(batches):
    for b in batches:
        texts = b.column("text").cast(pa.binary()).to_pylist()
        ids, hosts = b.column("doc_id"), b.column("host")
        for lo, hi in by_bytes(texts, 8 << 20):
            rows = [_features(t) for t in texts[lo:hi]]
            hashes = [xxhash.xxh3_64_intdigest(t or b"") for t in texts[lo:hi]]
            cols = [pa.array([r[k] for r in rows], pa.int64()) for k in range(5)]
            lines = pa.array([[{"h": h, "n": n} for h, n in r[5].items()] for r in rows], _OUT.field("lines").type)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, hi - lo).cast(pa.int64()), hosts.slice(lo, hi - lo).cast(pa.string()),
                 pa.array([h - ((h >> 63) << 64) for h in hashes], pa.int64()), *cols, lines], schema=_OUT)


def rate_documents(docs: DataFrame, host: str = "source", min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE,
                   min_words: int = MIN_WORDS, min_kept: float = MIN_KEPT) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, kept_words."""
    spark = docs.sparkSession
    prepare(spark)
    ddl = ("doc_id long, host string, text_hash long, n_words long, word_chars long, n_symbols long, "
           "n_dup_lines long, n_repeat_words long, lines array<struct<h: long, n: long>>")
    scanned = docs.select("doc_id", F.col(host).cast("string").alias("host"), "text").mapInArrow(_scan, ddl)
    # A row's own key: rows alike in doc_id, host and text are rated alike.
    scanned = materialize(spark, scanned, "line-features")
    texts = scanned.groupBy("host", "text_hash").agg(F.first("lines").alias("lines"))
    texts = texts.withColumn("host", F.coalesce(F.concat(F.lit("h"), "host"), F.lit("n")))
    sizes = texts.groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    counts = (texts.select("host", F.explode("lines.h").alias("h"))
              .groupBy("host", "h").agg(F.count(F.lit(1)).alias("docs")).filter(F.col("docs") > min_docs))
    common = counts.join(sizes, "host").filter(F.col("docs") > F.col("host_docs") * max_share).select("host", "h")
    common = materialize(spark, common, "common-lines")
    removed = (texts.select("host", "text_hash", F.explode("lines").alias("l"))
               .select("host", "text_hash", F.col("l.h").alias("h"), F.col("l.n").alias("n"))
               .join(common, ["host", "h"]).groupBy("host", "text_hash").agg(F.sum("n").alias("removed")))
    removed = materialize(spark, removed, "removed-words").withColumnsRenamed({"host": "r_host", "text_hash": "r_hash"})
    rated = scanned.drop("lines").join(
        removed, (F.coalesce(F.concat(F.lit("h"), "host"), F.lit("n")) == F.col("r_host")) & (F.col("text_hash") == F.col("r_hash")), "left")
    kept_words = F.col("n_words") - F.coalesce("removed", F.lit(0))
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    depleted = (kept_words < min_words) | (kept_words < F.col("n_words") * F.lit(float(min_kept)))
    return rated.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        base_failed.alias("base_failed"), (~base_failed & ~depleted).alias("kept"), kept_words.alias("kept_words"))


def op7_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rate_documents(read_table(spark, sf_dir, "documents"))


#: The same rules over whole tables, words and lines by regular expressions.
ORACLE = rf"""
WITH base AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
lines AS (
  SELECT doc_id, source, text, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
         regexp_replace(translate(array_to_string(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), ' '),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]', '0', 'g') AS norm
  FROM (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM base) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dups AS (
  SELECT doc_id, sum(k - 1) AS n_dup_lines FROM (SELECT doc_id, line, count(*) AS k FROM lines GROUP BY ALL) GROUP BY doc_id),
hosts AS (SELECT source, count(DISTINCT text) AS texts FROM base GROUP BY source),
common AS (
  SELECT l.source, norm FROM lines l JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source
  GROUP BY l.source, norm, h.texts HAVING count(DISTINCT text) > {MIN_DOCS} AND count(DISTINCT text) > h.texts * {MAX_SHARE}),
gone AS (
  SELECT doc_id, sum(n) AS removed FROM lines l JOIN common c ON l.source IS NOT DISTINCT FROM c.source AND l.norm = c.norm GROUP BY doc_id),
places AS (SELECT doc_id, words, unnest(generate_series(1, len(words) - 2)) AS i FROM base WHERE len(words) > 3),
windows AS (SELECT doc_id, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c FROM places),
again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS k FROM windows) WHERE k > 1),
covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM again) GROUP BY doc_id),
facts AS (
  SELECT b.doc_id, len(words)::BIGINT AS n_words, coalesce(length(array_to_string(words, '')), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         (len(words) - coalesce(removed, 0))::BIGINT AS kept_words
  FROM base b LEFT JOIN dups USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND kept_words >= {MIN_WORDS} AND kept_words >= n_words * {MIN_KEPT} AS kept,
       kept_words
FROM facts
"""

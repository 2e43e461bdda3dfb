"""Token IDs in Arrow files of fixed-size lists.

Documents go in ascending doc_id order to files of about ``FILE_BYTES`` of text. A file holds the
ids of its documents end to end, cut into sequences of ``SEQUENCE`` ids: record batches of
``ROWS`` sequences with columns ``ids`` (fixed-size list of unsigned integers, 16 bits if the vocabulary
allows) and ``mask`` (fixed-size list of booleans, false for the padding of the last sequence), not
compressed, so that sequence i of a mapped file is a slice of batch i // ROWS without a copy. Beside it
lies an Arrow file with doc_id, start and n_tokens of each document. Files are written under a name
of the attempt and moved when complete, so that a task run again replaces them whole.

Words between ASCII white space are encoded once per worker and looked up after that, rare ones as long as there is
room: the tokenizer never joins pieces over white space.

Edge cases: a null or empty text has the end id only; documents with a null doc_id come first;
rows with one doc_id are ordered by a hash of their text; an empty table writes no file; extra
columns are ignored; special tokens' strings in a text are ordinary text.
"""

from __future__ import annotations

import os
import unicodedata
import uuid
import zlib
from collections import defaultdict
from itertools import islice

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import by_bytes, prepare, read_table

SEQUENCE = 2048
ROWS = 128
FILE_BYTES = 16 << 20
END = 1
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _letters(word: bytes) -> bool:
    """Whether all of it is letters, also in the form that the tokenizer gives it."""
    return unicodedata.normalize("NFC", word.decode("utf-8", "replace")).lower().isalpha()


class _Rows:
    """A growing array."""

    def __init__(self, dtype) -> None:
        self.held, self.n = np.empty(1 << 12, dtype=dtype), 0

    def grow(self, n: int) -> None:
        if n > len(self.held):
            self.held = np.concatenate([self.held[:self.n], np.empty(max(n, 2 * self.n) - self.n, dtype=self.held.dtype)])
        self.n = n

    def extend(self, values: np.ndarray) -> None:
        at = self.n
        self.grow(at + len(values))
        self.held[at:self.n] = values


class WordEncoder:
    """Ids of texts. Each word is numbered when it first comes and encoded once; a text is its words' ids end to end, gathered from
    one array. A word of letters and punctuation behind them is put together from these two, which the tokenizer's splitting never
    joins. New words go to the tokenizer as lines of many words with a mark between them, a word that it turns into
    one id of its own; words with the mark's character, and lines whose marks don't add up, are encoded one by one. Beyond
    ``remember`` words those that came but once lately are forgotten, and at least half of all."""

    MARKS = "~^\\@=+"
    LINE = 512  # words
    PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())

    def __init__(self, path: str, remember: int = 500_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks of a machine have its cores already
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.remember = remember
        alone = [(m, self._ids(m)) for m in self.MARKS]
        self.mark, self.mark_id = next(((m.encode(), ids[0]) for m, ids in alone if len(ids) == 1), (b"", None))
        self._forget()

    def _forget(self) -> None:
        self.index: dict = defaultdict()
        self.index.default_factory = self.index.__len__
        self.pool, self.starts, self.sizes, self.seen = _Rows(self.dtype), _Rows(np.int64), _Rows(np.int64), _Rows(np.int64)
        self.index[None]  # the end of a document
        for rows in (self.starts, self.sizes):
            rows.grow(1)
        self._note([0], np.zeros(1, np.int64), np.ones(1, np.int64), np.array([END], dtype=self.dtype))

    def _forget_rare(self) -> None:
        n, half = len(self.index), max(1, self.remember // 2)
        seen = self.seen.held[:n]
        least = max(2, int(np.partition(seen, n - half)[n - half]) + 1) if n > half else 2
        kept = np.flatnonzero(seen[1:] >= least) + 1
        words = list(self.index)
        ids, ends = self._gathered(kept)
        sizes = self.sizes.held[kept]
        self._forget()
        for k in kept.tolist():
            self.index[words[k]]
        for rows in (self.starts, self.sizes):
            rows.grow(len(self.index))
        self._note(np.arange(1, len(self.index)), ends - sizes, sizes, ids)
        self._count(np.zeros(0, np.int64))
        self.seen.held[1:len(self.index)] = seen[kept] // 2

    def _count(self, words: np.ndarray) -> None:
        known, n = self.seen.n, len(self.index)
        self.seen.grow(n)
        self.seen.held[known:n] = 0
        self.seen.held[:n] += np.bincount(words, minlength=n)

    def _ids(self, text: str) -> list:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _note(self, numbers, starts: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        """The words with these numbers are slices of ``ids``."""
        self.starts.held[numbers], self.sizes.held[numbers] = starts + self.pool.n, sizes
        self.pool.extend(ids)

    def _gathered(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words' ids end to end, and where each ends."""
        sizes = self.sizes.held[words]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts.held[words] - ends + sizes, sizes)
        at += np.arange(len(at))
        return self.pool.held[at], ends

    def _learn(self, words: list, first: int) -> None:
        """New words, numbered from ``first`` on."""
        number, joined, plain = self.index.__getitem__, [], []
        for i, w in enumerate(words, first):
            head = w.rstrip(self.PUNCTUATION)
            if head and len(head) < len(w) and (head.isalpha() or _letters(head)):
                joined.append((i, number(head), number(w[len(head):])))
            else:
                plain.append((i, w))
        parts = list(islice(reversed(self.index), len(self.index) - first - len(words)))
        plain.extend(enumerate(reversed(parts), first + len(words)))
        for rows in (self.starts, self.sizes):
            rows.grow(len(self.index))
        alone = [x for x in plain if not self.mark or self.mark in x[1]]
        plain = [x for x in plain if self.mark and self.mark not in x[1]]
        lines = [plain[k:k + self.LINE] for k in range(0, len(plain), self.LINE)]
        joint = b" " + self.mark + b" "
        got = self.tokenizer.encode_batch_fast([(joint.join([w for _, w in x]) + joint).decode("utf-8", "replace") for x in lines],
                                               add_special_tokens=False)
        for line, e in zip(lines, got, strict=True):
            ids = np.array(e.ids, dtype=self.dtype)
            at = np.flatnonzero(ids == self.mark_id)
            if len(at) != len(line):
                alone.extend(line)
                continue
            starts = np.concatenate([[0], at[:-1] + 1])
            self._note([i for i, _ in line], starts, at - starts, ids)
        for i, w in alone:
            ids = np.array(self._ids(w.decode("utf-8", "replace")), dtype=self.dtype)
            self._note([i], np.zeros(1, np.int64), np.array([len(ids)]), ids)
        if joined:
            numbers, heads, tails = np.array(joined, dtype=np.int64).T
            ids, ends = self._gathered(np.stack([heads, tails], axis=1).ravel())
            ends = ends[1::2]
            starts = np.concatenate([[0], ends[:-1]])
            self._note(numbers, starts, ends - starts, ids)

    def encode(self, texts: list, end: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """texts: UTF-8 bytes. The ids of all of them end to end (``end``: each with the end id), and how many each has. A-Z are
        lower-cased first, as the tokenizer would."""
        if len(self.index) > self.remember:
            self._forget_rare()
        known, number, parts = len(self.index), self.index.__getitem__, []
        for t in texts:
            words = t.lower().split() if t else []
            parts.append(np.fromiter(map(number, words), dtype=np.int64, count=len(words)))
            if end:
                parts.append(np.zeros(1, dtype=np.int64))
        if len(self.index) > known:
            new = list(islice(reversed(self.index), len(self.index) - known))
            new.reverse()
            self._learn(new, known)
        words = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        self._count(words)
        ids, ends = self._gathered(words)
        n = np.array([len(p) for p in parts], dtype=np.int64)
        upto = np.concatenate([[0], ends])[np.cumsum(n.reshape(-1, 2).sum(axis=1) if end else n)] if len(texts) else np.zeros(0, np.int64)
        return ids, np.diff(upto, prepend=0)


_ENCODERS: dict = {}  # of this worker: words learnt in one task serve the next


def _encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _file_schema(dtype: np.dtype) -> pa.Schema:
    kind = pa.uint16() if dtype.itemsize == 2 else pa.uint32()
    return pa.schema([("ids", pa.list_(kind, SEQUENCE)), ("mask", pa.list_(pa.bool_(), SEQUENCE))])


_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
_MANIFEST = "part int, path string, n_docs long, n_tokens long"


def _open(path: str):
    """File system and path within it, for a URI or a plain path."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def write_files(docs: DataFrame, folder: str, tokenizer: str) -> DataFrame:
    """Writes the files; returns the manifest (part, path, n_docs, n_tokens), parts in doc_id order."""
    spark = docs.sparkSession
    prepare(spark)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ranged = docs.select("doc_id", "text").repartitionByRange(max(1, -(-size // FILE_BYTES)), *order).sortWithinPartitions(*order)

    def write(batches):
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex[:8]
        encoder, sink = _encoder(tokenizer), None
        schema = _file_schema(encoder.dtype)
        held, held_n, total, n_docs = [], 0, 0, 0
        per_batch = SEQUENCE * ROWS

        def record(ids: np.ndarray) -> pa.RecordBatch:
            rows = -(-len(ids) // SEQUENCE)
            padded, mask = np.zeros(rows * SEQUENCE, dtype=encoder.dtype), np.zeros(rows * SEQUENCE, dtype=bool)
            padded[:len(ids)], mask[:len(ids)] = ids, True
            return pa.RecordBatch.from_arrays(
                [pa.FixedSizeListArray.from_arrays(pa.array(padded), SEQUENCE), pa.FixedSizeListArray.from_arrays(pa.array(mask), SEQUENCE)],
                schema=schema)

        for b in batches:
            texts, doc_ids = b.column("text").cast(pa.binary()).to_pylist(), b.column("doc_id").cast(pa.int64())
            for lo, hi in by_bytes(texts, 2 << 20):
                if sink is None:
                    system, at = _open(f"{folder}/part-{part:06d}")
                    system.create_dir(at.rpartition("/")[0], recursive=True)
                    sink = system.open_output_stream(f"{at}.{attempt}.ids")
                    ids_out = pa.ipc.new_file(sink, schema)
                    side = system.open_output_stream(f"{at}.{attempt}.docs")
                    docs_out = pa.ipc.new_file(side, _DOCS)
                ids, n = encoder.encode(texts[lo:hi], end=True)
                starts = total + np.cumsum(n) - n
                docs_out.write_batch(pa.RecordBatch.from_arrays([doc_ids.slice(lo, hi - lo), pa.array(starts), pa.array(n)], schema=_DOCS))
                total, n_docs = total + len(ids), n_docs + hi - lo
                held.append(ids)
                held_n += len(ids)
                if held_n >= per_batch:
                    flat = np.concatenate(held)
                    full = len(flat) // per_batch * per_batch
                    for a in range(0, full, per_batch):
                        ids_out.write_batch(record(flat[a:a + per_batch]))
                    held, held_n = [flat[full:]], len(flat) - full
        if sink is not None:
            if held_n:
                ids_out.write_batch(record(np.concatenate(held)))
            for out, stream, kind in ((ids_out, sink, "ids"), (docs_out, side, "docs")):
                out.close()
                stream.close()
                system.move(f"{at}.{attempt}.{kind}", f"{at}.{kind}.arrow")
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([f"{folder}/part-{part:06d}"]), pa.array([n_docs], pa.int64()), pa.array([total], pa.int64())],
                names=["part", "path", "n_docs", "n_tokens"])

    path = f"{folder}/manifest"
    ranged.mapInArrow(write, _MANIFEST).write.parquet(path)
    return spark.read.schema(_MANIFEST).parquet(path)


def read_sequence(path: str, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and mask of sequence i of a file; ids are a view of the file's buffer (mapped, if local)."""
    system, at = _open(f"{path}.ids.arrow")
    source = pa.memory_map(at) if isinstance(system, pafs.LocalFileSystem) else system.open_input_file(at)
    batch = pa.ipc.open_file(source).get_batch(i // ROWS)
    lo = (i % ROWS) * SEQUENCE
    ids = batch.column("ids").flatten().slice(lo, SEQUENCE).to_numpy(zero_copy_only=True)
    return ids, batch.column("mask").flatten().slice(lo, SEQUENCE).to_numpy(zero_copy_only=False)


def read_documents(path: str):
    """Yields (doc_id, start in the file, ids) of each document, one batch of sequences in memory."""
    system, at = _open(path)
    with system.open_input_file(f"{at}.ids.arrow") as f, system.open_input_file(f"{at}.docs.arrow") as g:
        ids_file, docs_file = pa.ipc.open_file(f), pa.ipc.open_file(g)
        k, held = 0, np.zeros(0, dtype=np.uint16)
        for j in range(docs_file.num_record_batches):
            rows = docs_file.get_batch(j)
            for doc_id, start, n in zip(*(rows.column(c).to_pylist() for c in _DOCS.names), strict=True):
                parts, have = [held], len(held)
                while have < n:
                    batch = ids_file.get_batch(k)
                    ids = batch.column("ids").flatten().to_numpy()
                    ids = ids[batch.column("mask").flatten().to_numpy(zero_copy_only=False)]
                    parts.append(ids)
                    have, k = have + len(ids), k + 1
                held = np.concatenate(parts) if len(parts) > 1 else held
                yield doc_id, start, held[:n]
                held = held[n:]


def read_digests(manifest: DataFrame) -> DataFrame:
    """doc_id, start (over all files), n_tokens, ids_crc32, read from the files; one task per file at most."""
    before = F.sum("n_tokens").over(Window.orderBy("part")) - F.col("n_tokens")  # one row per file
    files = manifest.select("path", before.alias("base"))
    n_files = manifest.count()

    def read(batches):
        for b in batches:
            for path, base in zip(b.column("path").to_pylist(), b.column("base").to_pylist(), strict=True):
                rows = [(d, base + s, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for d, s, ids in read_documents(path)]
                cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.repartition(max(1, n_files), "path").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op5_token_files(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    manifest = write_files(read_table(spark, sf_dir, "documents"), scratch_path(spark, "token-files"), tokenizer or tokenizer_path())
    return read_digests(manifest)

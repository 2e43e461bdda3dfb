"""Feeds of very many small files, listed, read and written by tasks.

Spark's file sources expand a pattern and keep every file's status on the driver, and its writers move every file there; on a
mounted (``file:``) folder each file also costs child processes. Here the driver gets neither names nor contents: a pattern is
expanded level by level by tasks, files are read whole by tasks, and each folder's file is written by the task that holds its rows.
Files in packs (``packs``) are listed and read like files of their own.
Other file systems keep Spark's own sources and writers (``by_tasks`` tells).
"""

from __future__ import annotations

import datetime
import itertools
import json
import re
import uuid
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists, remove_dir, scratch_path, share_code
from . import packs as P

LISTED_DDL = "_source_file string, _modified timestamp, _length long"
BATCH_BYTES = 4 << 20  # of contents in one batch
LISTED_ROWS = 10_000  # of a pack's list in one batch
PACK_TASKS = 4  # that read one pack
MERGED = "32kb"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
LINE_FILE = "part-"
_SPECIAL = re.compile(r'[\x01-\x1f"#%\'*/:=?\\\x7f{\[\]^]')
_NOT_IN_URI = re.compile(r'[\x00-\x20"#%<>?\[\]\\^`{|}\x7f-\xa0]|\s')


def qualified(spark: SparkSession, path: str) -> str:
    """The path (or pattern) with its file system's scheme."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(hpath).toString()


def by_tasks(spark: SparkSession, path) -> bool:
    """Whether this module serves the path: one path or pattern on a mounted file system, without a choice between paths of several levels."""
    share_code(spark)
    return isinstance(path, str) and qualified(spark, path).startswith("file:") and not re.search(r"\{[^}]*/", path)


def _local(path: str) -> str:
    """'file:/a/b' as '/a/b', for Hadoop paths (which are not escaped)."""
    return "/" + re.sub("^file:", "", path).strip("/")


def file_uri(path: str) -> str:
    """A local path as file metadata give it."""
    return "file:" + _NOT_IN_URI.sub(lambda m: quote(m[0]), path)


def from_uri(uri: str) -> str:
    return "/" + unquote(re.sub("^file:", "", uri)).strip("/")


def _matcher(glob: str):
    """Hadoop's file patterns within one path segment."""
    out, at, depth = "", 0, 0
    while at < len(glob):
        c = glob[at]
        if c == "\\" and at + 1 < len(glob):
            at += 1
            out += re.escape(glob[at])
        elif c == "*":
            out += ".*"
        elif c == "?":
            out += "."
        elif c == "[":
            end = glob.index("]", at + 2)
            inner = glob[at + 1:end]
            out += "[" + ("^" + inner[1:] if inner[0] in "^!" else inner).replace("\\", r"\\") + "]"
            at = end
        elif c == "{":
            out, depth = out + "(?:", depth + 1
        elif c == "}" and depth:
            out, depth = out + ")", depth - 1
        elif c == "," and depth:
            out += "|"
        else:
            out += re.escape(c)
        at += 1
    return re.compile(out, re.DOTALL).fullmatch


def _hidden(name: str) -> bool:
    return name[:1] == "." or (name[:1] == "_" and "=" not in name) or name.endswith("._COPYING_")


def _entries(folder: str, glob: str) -> tuple[list, list[str]]:
    """(entries of a folder whose name matches, its packs); without wildcards the name is asked for alone."""
    from pyarrow import fs
    system = fs.LocalFileSystem()
    if not re.search(r"[*?\[{\\]", glob):
        found = system.get_file_info(f"{folder.rstrip('/')}/{glob}")
        return [found] if found.type != fs.FileType.NotFound and glob != P.PACKS else [], P.packs(folder)
    matches = _matcher(glob)
    every = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    packed = any(e.base_name == P.PACKS and not e.is_file for e in every)
    return [e for e in every if matches(e.base_name) and e.base_name != P.PACKS], P.packs(folder) if packed else []


# What a pattern is expanded to on the way: folders, and packs with the number of the pattern's parts that lead to their feed.
_FOUND_DDL = "path string, below int"


def _found(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32())], names=["path", "below"])


def _above(parts: list[str]):
    """Besides the folder that an expansion begins at: packs of the folders above it, which may hold files below it."""
    def run(batches):
        for b in batches:
            packs = [(p, i) for i in range(len(parts)) for p in P.packs("/" + "/".join(parts[:i]))]
            yield _found([*((path, None) for path in b.column("path").to_pylist()), *packs])
    return run


def _expand(glob: str, depth: int):
    def run(batches):
        for b in batches:
            for path, below in zip(b.column("path").to_pylist(), b.column("below").to_pylist(), strict=True):
                if below is not None:
                    yield _found([(path, below)])
                    continue
                found, packs = _entries(path, glob)
                yield _found([*((e.path, None) for e in found if not e.is_file), *((p, depth) for p in packs)])
    return run


_LISTED = pa.schema([("_source_file", pa.string()), ("_modified", pa.timestamp("us", "UTC")), ("_length", pa.int64())])


def _version(info) -> tuple:
    """Modification time (whole milliseconds, as file metadata have it) and length."""
    return _time(info.mtime_ns // 1_000_000), info.size


def _time(ms: int) -> datetime.datetime:
    return datetime.datetime.fromtimestamp(0, datetime.timezone.utc) + datetime.timedelta(milliseconds=ms)


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    cols = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def _packed(pack: str, globs: list[str]):
    """Files of a pack whose path below the feed's root matches, by its first parts if there are fewer patterns."""
    (root, name), matchers, rows = P.of_pack(pack), [_matcher(g) for g in globs], []
    for folder, modified, length in P.listed(pack):
        parts = [*folder.split("/"), name]
        if len(matchers) <= len(parts) and all(m(p) for m, p in zip(matchers, parts, strict=False)):
            rows.append((file_uri(f"{root}/{folder}/{name}"), _time(modified), length))
            if len(rows) == LISTED_ROWS:
                yield _batch(rows, _LISTED)
                rows = []
    yield _batch(rows, _LISTED)


def _files(parts: list[str]):
    from pyarrow import fs

    def run(batches):
        for b in batches:
            for path, below in zip(b.column("path").to_pylist(), b.column("below").to_pylist(), strict=True):
                if below is not None:
                    yield from _packed(path, parts[below:])
                    continue
                found, packs = _entries(path, parts[-1])
                for p in packs:
                    yield from _packed(p, parts[-1:])
                for d in [e for e in found if not e.is_file]:  # a folder stands for its files, and for those of key folders below it
                    for e in fs.LocalFileSystem().get_file_info(fs.FileSelector(d.path, recursive=True)):
                        inner = e.path[len(d.path):].strip("/").split("/")[:-1]
                        if P.is_pack(e) and all("=" in p and not _hidden(p) for p in inner[:-1]):
                            yield from _packed(e.path, [])
                        elif all("=" in p and not _hidden(p) for p in inner):
                            found.append(e)
                yield _batch([(file_uri(e.path), *_version(e)) for e in found if e.is_file and e.size and not _hidden(e.base_name)], _LISTED)
    return run


def parts(spark: SparkSession) -> int:
    """As many parts as the session shuffles to, one a core at least."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def dealt(df: DataFrame) -> DataFrame:
    """Rows in ``parts`` parts: a path stands for a folder or a file of unknown size."""
    return df.repartition(parts(df.sparkSession))


def list_files(spark: SparkSession, pattern: str) -> DataFrame:
    """_source_file, _modified, _length of the files matching the pattern; files without a byte are left out, as Spark's sources do."""
    parts = _local(qualified(spark, pattern)).strip("/").split("/")
    wild = [i for i, p in enumerate(parts[:-1]) if re.search(r"[*?\[{\\]", p)]
    first = wild[0] if wild else len(parts) - 1
    paths = spark.createDataFrame([("/" + "/".join(parts[:first]),)], "path string").mapInArrow(_above(parts[:first]), _FOUND_DDL)
    for i, p in enumerate(parts[first:-1], first):
        paths = dealt(paths.mapInArrow(_expand(p, i), _FOUND_DDL))
    return paths.mapInArrow(_files(parts), LISTED_DDL)


_READ = pa.schema([*_LISTED, ("content", pa.binary())])
_PACKED = ["folder", "modified", "length", "content"]


def _read(batches):
    from pyarrow import fs
    system, roots = fs.LocalFileSystem(), {}

    def contents(uris):
        packed = {}
        for uri in uris:
            path = from_uri(uri)
            root = P.root_of(path, roots)
            if root is not None:
                folder, _, name = path[len(root) + 1:].rpartition("/")
                packed.setdefault(f"{root}/{P.PACKS}/{name}{P.ENDING}", {}).setdefault(folder, []).append(uri)
                continue
            info = system.get_file_info(path)
            if not info.is_file or not info.size:  # gone or emptied since it was listed
                continue
            with system.open_input_stream(path) as f:  # unpacked by the ending of its name
                yield uri, *_version(info), f.read()
        for pack, folders in packed.items():
            for t in P.groups(pack, _PACKED, folders.keys()):
                for folder, modified, length, content in zip(*(t[c].to_pylist() for c in _PACKED), strict=True):
                    for uri in folders[folder]:
                        yield uri, _time(modified), length, content

    for b in batches:
        rows, held = [], 0
        for row in contents(b.column("_source_file").to_pylist()):
            rows.append(row)
            held += len(row[-1])
            if held >= BATCH_BYTES:
                yield _batch(rows, _READ)
                rows, held = [], 0
        if rows:
            yield _batch(rows, _READ)


def read_files(files: DataFrame) -> DataFrame:
    """_source_file, _modified, _length and content of each listed file, in the version that is read; one gone meanwhile has no row."""
    # A pack is read by a few tasks, each in the order of its folders; other files are dealt by their whole path.
    name, own = F.substring_index("_source_file", "/", -1), F.xxhash64("_source_file")
    pack = F.when(name.rlike("^" + P.NAME), name)
    dealt_out = files.select("_source_file").repartition(parts(files.sparkSession), pack, F.when(pack.isNull(), own).otherwise(F.pmod(own, F.lit(PACK_TASKS))))
    return dealt_out.sortWithinPartitions(pack, "_source_file").mapInArrow(_read, f"{LISTED_DDL}, content binary")


def decoded(files: DataFrame) -> DataFrame:
    """Whole documents as text; the encoding is told from their first bytes, as JSON allows."""
    def run(batches):
        for b in batches:
            texts = [x.decode(json.detect_encoding(x), "replace") for x in b.column("content").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["value"])
    return files.select("content").mapInArrow(run, "value string")


def paths_as_uris(files: DataFrame) -> DataFrame:
    """_source_file of each row's ``path``."""
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([file_uri(_local(p)) for p in b.column("path").to_pylist()], pa.string())], names=["_source_file"])
    return files.select("path").mapInArrow(run, "_source_file string")


def kept_list(files: DataFrame) -> DataFrame:
    """The list written once, so that what is counted is what is read."""
    path = scratch_path(files.sparkSession, "file-list")
    files.write.parquet(path)
    return files.sparkSession.read.schema(files.schema).parquet(path)


def folder_name(key: str, value: str | None) -> str:
    return f"{key}={_SPECIAL.sub(lambda m: f'%{ord(m[0]):02X}', value) if value else NO_VALUE}"


def write_folders(df: DataFrame, path: str, keys: list[str], line: Column, ending: str, replace: bool = True, packed: bool = False) -> None:
    """Lines to ``<path>/<key>=<value>/.../part-*<ending>``, one file per key and task. Files are written under hidden names and shown
    when all are complete; ``replace``: in place of what the touched folders held, else beside it. ``packed``: the files of a task lie in
    packs, and the folders are names only."""
    spark, root, own = df.sparkSession, _local(qualified(df.sparkSession, path)), uuid.uuid4().hex
    text = lambda k: F.nullif(F.nullif(F.col(k).cast("string"), F.lit("")), F.lit(NO_VALUE))  # noqa: E731  all have the folder of no value
    rows = df.select(*[text(k).alias(f"k{i}") for i, k in enumerate(keys)], F.coalesce(line, F.lit("")).alias("line"))
    names = [f"k{i}" for i in range(len(keys))]

    def write(batches):
        from pyarrow import fs
        system, part, side = fs.LocalFileSystem(), TaskContext.get().partitionId(), f".side-{uuid.uuid4().hex}"
        at, sink = None, None

        def close():
            if sink is not None:
                sink.close()
                system.move(f"{at}/{side}", f"{at}/.{LINE_FILE}{part:05d}-{own}{ending}")

        for b in batches:
            done, lines = [], b.column("line").cast(pa.binary()).to_pylist()
            for *values, text in zip(*[b.column(k).to_pylist() for k in names], lines, strict=True):
                folder = "/".join([root, *map(folder_name, keys, values)])
                if folder != at:
                    close()
                    system.create_dir(folder, recursive=True)
                    sink, at = system.open_output_stream(f"{folder}/{side}", compression=None), folder
                    done.append(folder)
                sink.write(text + b"\n")
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], names=["folder"])
        close()

    def pack(batches):
        part = TaskContext.get().partitionId()
        out = P.PackWriter(lambda n: f"{root}/{P.PACKS}/.{P.pack_name(part, n, own, ending)}{P.ENDING}")
        for b in batches:
            lines = b.column("line").cast(pa.binary()).to_pylist()
            for *values, text in zip(*[b.column(k).to_pylist() for k in names], lines, strict=True):
                out.add("/".join(map(folder_name, keys, values)), text + b"\n")
        yield pa.RecordBatch.from_arrays([pa.array(out.close(), pa.string())], names=["pack"])

    def show(batches):
        from pyarrow import fs
        system = fs.LocalFileSystem()
        for b in batches:
            for folder in b.column("folder").to_pylist():
                found = [e for e in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if e.is_file]
                for e in found:
                    if replace and own not in e.base_name:
                        system.delete_file(e.path)
                for e in found:
                    if own in e.base_name and e.base_name[0] == ".":
                        system.move(e.path, f"{folder}/{e.base_name[1:]}")
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["shown"])

    # The work is a file a key, whatever its bytes: merged partitions shall not be fewer than the cores.
    setting = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    before = spark.conf.get(setting)
    spark.conf.set(setting, MERGED)
    try:
        made = kept_list(rows.sortWithinPartitions(*names).mapInArrow(*((pack, "pack string") if packed else (write, "folder string"))))
    finally:
        spark.conf.set(setting, before)
    folders = _folders(made, root) if packed else made
    moves = _without(spark, root, folders) if replace else []
    if not packed or replace and _has_folders(root):
        dealt(folders.distinct()).mapInArrow(show, "shown long").agg(F.sum("shown")).collect()
    if packed:
        moves += [(f"{at}/{name[1:]}", f"{at}/{name}") for at, _, name in (r[0].rpartition("/") for r in made.collect())]
    _move(moves)
    if packed and replace:  # what a job that failed left
        _move([(hidden, None) for hidden in P.unfinished(root)])


def _folders(packs: DataFrame, root: str) -> DataFrame:
    """The folders that have files in packs."""
    def run(batches):
        for b in batches:
            for pack in b.column("pack").to_pylist():
                for t in P.groups(pack, ["folder"]):
                    yield pa.RecordBatch.from_arrays([pa.array([f"{root}/{x}" for x in t["folder"].to_pylist()], pa.string())], names=["folder"])
    return dealt(packs).mapInArrow(run, "folder string")


def _without(spark: SparkSession, root: str, folders: DataFrame) -> list[tuple[str, str | None]]:
    """Takes folders out of a feed's packs. Packs that held some are written again beside the old ones; returns which is to take whose place."""
    old = P.packs(root)
    if not old:
        return []

    def held(batches):
        for b in batches:
            for pack in b.column("pack").to_pylist():
                for t in P.groups(pack, ["folder"]):
                    own = t["folder"].to_pylist()
                    yield pa.RecordBatch.from_arrays([pa.array([pack] * len(own), pa.string()), pa.array([f"{root}/{x}" for x in own], pa.string())], names=["pack", "folder"])

    def rewrite(batches):
        pairs = ((p, f[len(root) + 1:]) for b in batches for p, f in zip(b.column("pack").to_pylist(), b.column("folder").to_pylist(), strict=True))
        for pack, group in itertools.groupby(pairs, lambda r: r[0]):
            at, _, name = pack.rpartition("/")
            new = P.without(pack, [f for _, f in group], f"{at}/.less-{uuid.uuid4().hex}-{name}")
            yield pa.RecordBatch.from_arrays([pa.array([pack], pa.string()), pa.array([new], pa.string())], names=["pack", "new"])

    hit = dealt(spark.createDataFrame([(p,) for p in old], "pack string")).mapInArrow(held, "pack string, folder string").join(folders.distinct(), "folder", "left_semi")
    done = kept_list(hit.select("pack", "folder").repartition("pack").sortWithinPartitions("pack").mapInArrow(rewrite, "pack string, new string"))
    return [tuple(r) for r in done.collect()]


def _has_folders(root: str) -> bool:
    from pyarrow import fs
    return any(not e.is_file and "=" in e.base_name for e in fs.LocalFileSystem().get_file_info(fs.FileSelector(root, allow_not_found=True)))


def _move(moves: list[tuple[str, str | None]]) -> None:
    """Packs under their final names, a few renames after all are complete; None: nothing is left of a pack."""
    from pyarrow import fs
    system = fs.LocalFileSystem()
    for final, new in moves:
        if new is None:
            system.delete_file(final)
        else:
            system.move(new, final)


def fresh_folder(spark: SparkSession, path: str) -> None:
    if path_exists(spark, path):
        remove_dir(spark, path)


def folder_keys(spark: SparkSession, path: str) -> list[str]:
    """Keys of the folders below a path, told from the first of each level or of a pack."""
    from pyarrow import fs
    system, at, keys = fs.LocalFileSystem(), _local(qualified(spark, path)), []
    for pack in P.packs(at):
        for folder, *_ in P.listed(pack):
            return [unquote(p.partition("=")[0]) for p in folder.split("/")]
    while True:
        inner = [e for e in system.get_file_info(fs.FileSelector(at)) if not e.is_file and "=" in e.base_name and not _hidden(e.base_name)]
        if not inner:
            return keys
        first = min(inner, key=lambda e: e.path)
        at = first.path
        keys.append(unquote(first.base_name.partition("=")[0]))


def in_packs(spark: SparkSession, path: str) -> bool:
    return bool(P.packs(_local(qualified(spark, path))))


def read_folders(spark: SparkSession, path: str) -> DataFrame:
    """keys (map of the folders' keys) and line of every line that is not blank in the files of the key folders."""
    root = _local(qualified(spark, path))
    escaped = re.sub(r"([{}\[\]*?\\])", r"\\\1", root)
    files = list_files(spark, "/".join(["file:" + escaped, *["*=*"] * len(folder_keys(spark, path)), "*"]))

    def lines(batches):
        for b in batches:
            keys, out = [], []
            for uri, content in zip(b.column("_source_file").to_pylist(), b.column("content").to_pylist(), strict=True):
                pairs = [p.partition("=") for p in from_uri(uri)[len(root):].strip("/").split("/")[:-1]]
                own = [(unquote(k), None if v == NO_VALUE else unquote(v)) for k, _, v in pairs]
                found = [x for x in content.splitlines() if x.strip()]
                out.extend(x.decode("utf-8", "replace") for x in found)
                keys.extend([own] * len(found))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.map_(pa.string(), pa.string())), pa.array(out, pa.string())], names=["keys", "line"])

    return read_files(files).mapInArrow(lines, "keys map<string, string>, line string")


__all__ = ["by_tasks", "list_files", "read_files", "decoded", "kept_list", "paths_as_uris", "write_folders", "read_folders", "folder_keys", "in_packs", "fresh_folder", "file_uri", "from_uri", "qualified", "dealt", "parts"]

"""A streaming source of file versions: (path, modification time, length).

Spark's file source remembers paths, so a file written again at its path is never seen again. Here an
offset stands for an entry of a log of versions, kept beside the stream's checkpoint: each entry lists the versions that
were new when it was written. A rewritten file is a new version and so a row of a later offset; a version is handed
out once, whether its content turns out valid or broken, and an entry replays the same rows after a failure.

Only names and versions pass the source; ``feed_stream`` reads the contents with Spark. The source lists the folder in the
driver's Python worker, as Spark's file source lists it on the driver.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

VERSION_DDL = "path string, modified timestamp, length long"


class VersionLog:
    """Entries 1..n of a folder, each written once: under a name of its own first, then moved."""

    def __init__(self, folder: str) -> None:
        self.system, self.folder = opened(folder)
        self.system.create_dir(self.folder, recursive=True)

    def read(self, n: int) -> list | None:
        import json
        name = f"{self.folder}/{n:012d}.json"
        if self.system.get_file_info(name).type.name != "File":
            return None
        with self.system.open_input_stream(name) as f:
            return [tuple(v) for v in json.loads(f.read())]

    def write(self, n: int, versions: list) -> None:
        import json
        import uuid
        side = f"{self.folder}/.{n:012d}-{uuid.uuid4().hex}"
        with self.system.open_output_stream(side) as f:
            f.write(json.dumps(versions).encode())
        self.system.move(side, f"{self.folder}/{n:012d}.json")


def opened(path: str):
    """File system and path within it."""
    from pyarrow import fs
    if path.startswith("file:"):
        from urllib.parse import unquote
        return fs.LocalFileSystem(), "/" + unquote(path[len("file:"):]).strip("/")
    if "://" in path:
        system, at = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
        return system, at.rstrip("/")
    return fs.LocalFileSystem(), path.rstrip("/")


def list_versions(folder: str, glob: str) -> list[tuple[str, int, int]]:
    """(path below ``folder`` as it is given, modification time in ms, length) of the files below ``folder`` whose name matches; names that begin
    with a dot or an underscore are skipped, as Spark does."""
    from fnmatch import fnmatchcase

    from pyarrow import fs

    from ..sources.packs import is_pack, listed, of_pack
    system, at = opened(folder)
    if system.get_file_info(at).type != fs.FileType.Directory:
        return []
    out = []
    for f in system.get_file_info(fs.FileSelector(at, recursive=True)):
        parts = f.path[len(at):].strip("/").split("/")
        if is_pack(f) and not any(p[0] in "._" and "=" not in p for p in parts[:-2]) and fnmatchcase(of_pack(f.path)[1], glob):
            own = [folder.rstrip("/"), *parts[:-2]]
            out += [("/".join([*own, inner, of_pack(f.path)[1]]), modified, size) for inner, modified, size in listed(f.path, system)]
        if f.type == fs.FileType.File and fnmatchcase(parts[-1], glob) and not any(p[0] in "._" and "=" not in p for p in parts):
            out.append((f"{folder.rstrip('/')}/{'/'.join(parts)}", (f.mtime_ns or 0) // 1_000_000, f.size))
    return sorted(out, key=lambda v: (v[1], v[0]))


class VersionReader(SimpleDataSourceStreamReader):
    """Offset {"entry": n}: all versions of the log's entries 1..n are handed out."""

    def __init__(self, options: dict) -> None:
        self.folder, self.glob = options["path"], options.get("glob", "*.json")
        self.log = VersionLog(options["log"])
        self.seen, self.entries = set(), 0

    def initialOffset(self) -> dict:
        return {"entry": 0}

    def _entry(self, n: int) -> list | None:
        """Entry n of the log; noted as seen."""
        got = self.log.read(n)
        if got is not None and n == self.entries + 1:
            self.seen.update(got)
            self.entries = n
        return got

    def _rows(self, versions: list) -> list:
        import datetime
        utc = datetime.timezone.utc
        return [(p, datetime.datetime.fromtimestamp(m / 1000, utc), n) for p, m, n in versions]

    def read(self, start: dict):
        n = start["entry"]
        while self.entries < n and self._entry(self.entries + 1) is not None:
            pass
        ready = self._entry(n + 1)  # written before a failure, or not taken yet
        if ready is None:
            ready = [v for v in list_versions(self.folder, self.glob) if v not in self.seen]
            if not ready:
                return iter([]), start
            self.log.write(n + 1, ready)
            self._entry(n + 1)
        return iter(self._rows(ready)), {"entry": n + 1}

    def readBetweenOffsets(self, start: dict, end: dict):
        for n in range(start["entry"] + 1, end["entry"] + 1):
            yield from self._rows(self.log.read(n) or [])

    def commit(self, end: dict) -> None:
        """The log itself says what was handed out."""


class FileVersions(DataSource):
    """``spark.readStream.format("file_versions").option("log", folder).option("glob", "*.json").load(feed_dir)``"""

    @classmethod
    def name(cls) -> str:
        return "file_versions"

    def schema(self) -> str:
        return VERSION_DDL

    def simpleStreamReader(self, schema) -> VersionReader:
        return VersionReader(self.options)


def version_stream(spark: SparkSession, feed_dir: str, log: str, glob: str = "*.json"):
    spark.dataSource.register(FileVersions)
    return spark.readStream.format("file_versions").option("log", log).option("glob", glob).load(feed_dir)


__all__ = ["FileVersions", "VersionReader", "VersionLog", "list_versions", "opened", "version_stream", "VERSION_DDL"]

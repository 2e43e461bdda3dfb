"""Packed feeds: the files of many keys in one, each under the path that a file of its own would have.

A folder and a file per key take two blocks and two inodes of a disk, however few bytes they hold. Here the files that one task writes lie
in one Parquet file, ``<root>/_packs/<name>.pack``, a row each: folder below the root, modification time (ms), length, content.
``small_files`` lists and reads them as ``<root>/<folder>/<name>``. A pack is written whole and never added to; keys that are
written again are taken out of the packs that held them. One job at a time may write a packed feed.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs

PACKS = "_packs"
ENDING = ".pack"
GROUP_BYTES = 4 << 20  # of contents in a row group
PACK_BYTES = 64 << 20  # of contents in a pack; a key's lines beyond go to the next
_SCHEMA = pa.schema([("folder", pa.string()), ("modified", pa.int64()), ("length", pa.int64()), ("content", pa.binary())])
NAME = r"part-\d{5,}-\d{4,}-[0-9a-f]{32}\."  # how the names of files in packs begin


def pack_name(part: int, n: int, own: str, ending: str) -> str:
    """Name of a pack's files: the task, its pack and the write."""
    return f"part-{part:05d}-{n:04d}-{own}{ending}"


def packs(root: str, system=None) -> list[str]:
    """The packs of a feed."""
    found = (system or fs.LocalFileSystem()).get_file_info(fs.FileSelector(f"{root.rstrip('/')}/{PACKS}", allow_not_found=True))
    return sorted(e.path for e in found if is_pack(e))


def unfinished(root: str) -> list[str]:
    """Files under hidden names beside the packs of a feed."""
    found = fs.LocalFileSystem().get_file_info(fs.FileSelector(f"{root.rstrip('/')}/{PACKS}", allow_not_found=True))
    return [e.path for e in found if e.is_file and e.base_name[0] == "."]


def is_pack(info) -> bool:
    return info.is_file and info.base_name[0] != "." and info.base_name.endswith(ENDING) and info.path.split("/")[-2:-1] == [PACKS]


def of_pack(pack: str) -> tuple[str, str]:
    """(root of the feed, name of the files) of a pack."""
    folder, _, name = pack.rpartition("/")
    return folder[:-len(PACKS)].rstrip("/"), name[:-len(ENDING)]


def root_of(path: str, known: dict) -> str | None:
    """Root of the feed in whose pack a file lies, None for a file of its own. ``known``: what was found for earlier names."""
    at, _, name = path.rpartition("/")
    if not re.match(NAME, name):
        return None
    if name not in known:
        known[name] = None
        while "=" in at.rpartition("/")[2]:
            at = at.rpartition("/")[0]
            if fs.LocalFileSystem().get_file_info(f"{at}/{PACKS}/{name}{ENDING}").is_file:
                known[name] = at
                break
    return known[name] if known[name] is not None and path.startswith(f"{known[name]}/") else None


def groups(pack: str, columns: list[str], wanted=None, system=None) -> Iterator[pa.Table]:
    """Row groups of a pack; ``wanted``: of these folders only. A pack gone since it was listed has none."""
    try:
        source = (system or fs.LocalFileSystem()).open_input_file(pack)
    except FileNotFoundError:
        return
    with source, pq.ParquetFile(source) as f:
        low, high = (min(wanted), max(wanted)) if wanted else (None, None)
        for g in range(f.num_row_groups):
            span = f.metadata.row_group(g).column(0).statistics
            if wanted and span is not None and span.has_min_max and (span.max < low or span.min > high):
                continue
            t = f.read_row_group(g, columns=columns)
            yield t.filter(pc.is_in(t["folder"], pa.array(list(wanted), pa.string()))) if wanted else t


def listed(pack: str, system=None) -> Iterator[tuple[str, int, int]]:
    """(folder, modification time in ms, length) of a pack's files."""
    for t in groups(pack, ["folder", "modified", "length"], system=system):
        yield from zip(*(c.to_pylist() for c in t.columns), strict=True)


class PackFile:
    """A pack while it is written, under a hidden name of its own until it is complete."""

    def __init__(self, final: str) -> None:
        self.final, folder = final, final.rpartition("/")[0]
        fs.LocalFileSystem().create_dir(folder, recursive=True)
        self.side = f"{folder}/.side-{uuid.uuid4().hex}"
        self.out = pq.ParquetWriter(self.side, _SCHEMA, compression="zstd", use_dictionary=False)

    def write(self, table: pa.Table) -> None:
        self.out.write_table(table)

    def close(self) -> str:
        self.out.close()
        fs.LocalFileSystem().move(self.side, self.final)
        return self.final


class PackWriter:
    """Lines of one task, in the order of their folders, to packs with the hidden names ``hidden(n)``."""

    def __init__(self, hidden: Callable[[int], str]) -> None:
        self.hidden, self.done, self.file = hidden, [], None
        self.folder, self.lines, self.size = None, [], 0
        self.rows, self.held, self.total = [], 0, 0

    def add(self, folder: str, line: bytes) -> None:
        if folder != self.folder or self.total + self.size >= PACK_BYTES:
            self._end_file()
            self.folder = folder
        self.lines.append(line)
        self.size += len(line)

    def _end_file(self) -> None:
        if self.lines:
            self.rows.append((self.folder, self.size, b"".join(self.lines)))
            self.held, self.total, self.lines, self.size = self.held + self.size, self.total + self.size, [], 0
            if self.held >= GROUP_BYTES:
                self._end_group()
            if self.total >= PACK_BYTES:
                self._end_pack()

    def _end_group(self) -> None:
        if self.rows:
            if self.file is None:
                self.file, self.modified = PackFile(self.hidden(len(self.done))), time.time_ns() // 1_000_000
            rows = [(folder, self.modified, size, content) for folder, size, content in self.rows]
            self.file.write(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA))
            self.rows, self.held = [], 0

    def _end_pack(self) -> None:
        self._end_group()
        if self.file is not None:
            self.done.append(self.file.close())
            self.file, self.total = None, 0

    def close(self) -> list[str]:
        """The packs, complete."""
        self._end_file()
        self._end_pack()
        return self.done


def without(pack: str, dropped: list[str], final: str) -> str | None:
    """The pack without the files of some folders, written to ``final``; None if nothing is left."""
    out, gone = None, pa.array(dropped, pa.string())
    for t in groups(pack, _SCHEMA.names):
        t = t.filter(pc.invert(pc.is_in(t["folder"], gone)))
        if t.num_rows:
            out = out or PackFile(final)
            out.write(t.cast(_SCHEMA))
    return out and out.close()


__all__ = ["ENDING", "NAME", "PACKS", "PackWriter", "groups", "is_pack", "listed", "of_pack", "pack_name", "packs", "root_of", "unfinished", "without"]

"""Files that tasks open for themselves, on local disks or on any file system of pyarrow (which reaches Hadoop's by libhdfs).

Python workers have no JVM at hand; through these a task reads the byte ranges that it needs and no more.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs

LINE_END = re.compile(rb"\r\n|\r|\n")
#: Bytes that are read at once.
BLOCK = 1 << 20
#: How an address begins that names its file system.
SCHEME = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*:/")


@functools.lru_cache(maxsize=32)
def _system(base: str) -> pafs.FileSystem:
    return pafs.FileSystem.from_uri(base)[0]


def located(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if not SCHEME.match(path):
        return _system("file:///"), path if path.startswith("/") else os.path.abspath(path)
    scheme, rest = path.split(":", 1)
    if scheme == "file":
        return _system("file:///"), "/" + rest.lstrip("/")
    if rest.startswith("//"):
        host, _, inner = rest[2:].partition("/")
        # object stores have the bucket in the path, other systems only in the address
        return _system(f"{scheme}://{host}"), f"{host}/{inner}" if scheme in ("s3", "s3a", "gs", "gcs", "abfs", "abfss") else f"/{inner}"
    return pafs.FileSystem.from_uri(path)


def opened(path: str) -> pa.NativeFile:
    """For reading, at any place in it; FileNotFoundError if there is none."""
    system, where = located(path)
    return system.open_input_file(where)


def is_file(path: str) -> bool:
    system, where = located(path)
    if isinstance(system, pafs.LocalFileSystem):
        return os.path.isfile(where)  # several times as fast, and most paths are looked at once
    return system.get_file_info(where).is_file


def listed(path: str, suffix: str = "") -> list[tuple[str, int]]:
    """Path and bytes of the file, or of all files in the folder and below it whose names end so, in the order of their names.

    Names that begin with _ or . are no data, as for Spark.
    """
    system, where = located(path)
    info = system.get_file_info(where)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.is_file else system.get_file_info(pafs.FileSelector(where, recursive=True))
    prefix = path.rstrip("/")
    out = []
    for x in found:
        inside = x.path[len(where.rstrip("/")) :] if not info.is_file else ""
        if x.is_file and x.path.lower().endswith(suffix) and not any(p.startswith(("_", ".")) for p in inside.split("/") if p):
            out.append((prefix + inside, x.size))
    return sorted(out)


def split_ranges(files: list[tuple[str, int]], most: int) -> list[tuple[int, str, int, int]]:
    """(number of the file, path, from, to) of byte ranges of at most so many bytes; an empty file has none."""
    out = []
    for k, (path, size) in enumerate(files):
        parts = -(-size // most)
        out += [(k, path, size * i // parts, size * (i + 1) // parts) for i in range(parts)]
    return out


def lines(path: str, start: int, end: int, block: int = BLOCK) -> Iterator[tuple[int, bytes]]:
    r"""(offset, line without its end) of the lines that begin in [start, end).

    Lines end at \n, \r or \r\n, as Spark's text source has it.  A range's reader looks at the bytes before it to tell whether a line
    begins there, and reads on past its end until its last line does.
    """
    with opened(path) as f:
        at = start
        if start:
            f.seek(start - 1)
            before = f.read(2)
            if not (before[:1] == b"\n" or before[:1] == b"\r" and before[1:] != b"\n"):
                at = None  # in the midst of a line, or of \r\n
        f.seek(start)
        held, offset, seen = b"", start, 0
        while True:
            more = f.read(block)
            held += more
            # a \r at the end of what is read may go on as \r\n
            known = held[:-1] if more and held.endswith(b"\r") else held
            pos = 0
            for m in LINE_END.finditer(known, seen):
                if at is not None:
                    yield at, known[pos : m.start()]
                pos = m.end()
                at = offset + pos
                if at >= end:
                    return
            held, offset, seen = held[pos:], offset + pos, max(0, len(known) - pos)
            if not more:
                if held and at is not None:
                    yield at, held
                return

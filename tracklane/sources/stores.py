"""Files that tasks open themselves, in any store that Arrow's file systems know: local and shared folders, HDFS, S3, GCS."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of `uri` and the path in it. Spark writes local files as file:/x, Arrow reads file:///x."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))


def files_below(uri: str, suffix: str = "") -> list[str]:
    """`uri` itself where it is no folder, else the files in it by name."""
    store, path = opened(uri)
    if store.get_file_info(path).type != fs.FileType.Directory:
        return [uri]
    found = store.get_file_info(fs.FileSelector(path, recursive=True))
    return sorted(f"{uri.rstrip('/')}/{f.path[len(path) :].lstrip('/')}" for f in found if f.type == fs.FileType.File and f.path.endswith(suffix))


def exists(uri: str) -> bool:
    store, path = opened(uri)
    return store.get_file_info(path).type != fs.FileType.NotFound


def moved(source: str, target: str) -> str:
    """Move a file: "moved", or "already" where only the target is there, or "missing". Two tries end as one does."""
    store, path = opened(source)
    to = opened(target)[1]
    if store.get_file_info(path).type == fs.FileType.NotFound:
        return "already" if exists(target) else "missing"
    store.create_dir(to.rpartition("/")[0], recursive=True)
    store.move(path, to)
    return "moved"


def write_whole(uri: str, chunks: Iterator[bytes]) -> int:
    """Write a file as a stream, under another name until it is whole; the bytes written."""
    store, path = opened(uri)
    folder, _, name = path.rpartition("/")
    store.create_dir(folder, recursive=True)
    part = f"{folder}/.{name}-{uuid.uuid4().hex}"
    n = 0
    with store.open_output_stream(part) as out:
        for c in chunks:
            out.write(c)
            n += len(c)
    store.move(part, path)
    return n


def read_range(uri: str, at: int, length: int, step: int = 1 << 20) -> Iterator[bytes]:
    """`length` bytes of a file from byte `at`, in pieces."""
    store, path = opened(uri)
    with store.open_input_file(path) as f:
        f.seek(at)
        while length > 0:
            got = f.read(min(step, length))
            if not got:
                return
            length -= len(got)
            yield got

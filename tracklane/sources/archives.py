"""Zip archives read by entry: planning reads the archives' directories only, and each task its own entries by their place.

An archive of any size is dealt to as many tasks as its wanted entries fill; no archive is one row or one task's. Filters
on `path` and `archive` are taken over when planning (spark.sql.python.filterPushdown.enabled), so entries that they leave
out are not read. What cannot be read is a row with its error: a broken archive one, a broken entry one.
"""

from __future__ import annotations

import struct
import zipfile
import zlib
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition, StringContains, StringEndsWith, StringStartsWith

from tracklane.sources import stores

FORMAT, SCHEMA = "tracklane_archives", "archive string, path string, content binary, error string"
#: Compressed bytes of one input partition; a larger entry is a partition of its own.
PARTITION_BYTES = 16 << 20
#: The fixed part of an entry's own header: signature, 22 bytes that the directory holds too, lengths of name and extra field.
_HEADER = struct.Struct("<4s22xHH")
_ENCRYPTED = 1


@dataclass
class Entry:
    archive: str
    path: str | None
    at: int = 0
    packed: int = 0
    size: int = 0
    method: int = 0
    crc: int = 0
    flags: int = 0
    error: str | None = None


@dataclass
class Entries(InputPartition):
    entries: list[Entry]


def entries(archive: str) -> list[Entry]:
    """The directory of an archive, from its end."""
    try:
        store, path = stores.opened(archive)
        with store.open_input_file(path) as f, zipfile.ZipFile(f) as z:
            return [Entry(archive, i.filename, i.header_offset, i.compress_size, i.file_size, i.compress_type, i.CRC, i.flag_bits) for i in z.infolist()]
    except Exception as e:  # noqa: BLE001  one bad archive must not end the others
        return [Entry(archive, None, error=str(e) or type(e).__name__)]


def content(entry: Entry) -> bytes:
    """An entry's bytes, by its place in the archive."""
    if entry.flags & _ENCRYPTED or entry.method not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        raise ValueError(f"encrypted, or packed by method {entry.method}")
    mark, name, extra = _HEADER.unpack(b"".join(stores.read_range(entry.archive, entry.at, _HEADER.size)))
    if mark != b"PK\x03\x04":
        raise ValueError("no entry where the directory says")
    chunks = stores.read_range(entry.archive, entry.at + _HEADER.size + name + extra, entry.packed)
    if entry.method == zipfile.ZIP_DEFLATED:
        unpack = zlib.decompressobj(-zlib.MAX_WBITS)
        out = b"".join([*map(unpack.decompress, chunks), unpack.flush()])
    else:
        out = b"".join(chunks)
    if len(out) != entry.size or zlib.crc32(out) != entry.crc:
        raise ValueError("length or checksum differs")
    return out


_TESTS: dict[type[Filter], Callable[[str, str], bool]] = {EqualTo: str.__eq__, StringStartsWith: str.startswith, StringEndsWith: str.endswith, StringContains: str.__contains__}


class ArchiveReader(DataSourceReader):
    def __init__(self, options: Mapping[str, str]):
        self.archives = [f for p in options["path"].split("\n") for f in stores.files_below(p, ".zip")]
        self.suffix, self.bytes = options.get("suffix", "").lower(), int(options.get("partitionBytes", PARTITION_BYTES))
        self.tests: dict[str, list[tuple[Callable[[str, str], bool], str]]] = {"path": [], "archive": []}

    def pushFilters(self, filters: list[Filter]):  # noqa: N802
        for f in filters:
            if type(f) in _TESTS and f.attribute in (("path",), ("archive",)) and isinstance(f.value, str):
                self.tests[f.attribute[0]].append((_TESTS[type(f)], f.value))
            else:
                yield f

    def _wanted(self, e: Entry) -> bool:
        if e.path is None:  # a broken archive is told unless a path was asked for
            return not self.tests["path"]
        return e.path.lower().endswith(self.suffix) and all(t(e.path, v) for t, v in self.tests["path"])

    def partitions(self) -> list[InputPartition]:
        out: list[Entries] = []
        room = 0
        for archive in (a for a in self.archives if all(t(a, v) for t, v in self.tests["archive"])):
            for e in filter(self._wanted, entries(archive)):
                if not out or room < e.packed:
                    out.append(Entries([]))
                    room = self.bytes
                out[-1].entries.append(e)
                room -= e.packed
        return out or [Entries([])]

    def read(self, partition: Entries) -> Iterator[tuple]:
        for e in partition.entries:
            data = None
            if e.error is None:
                try:
                    data = content(e)
                except Exception as x:  # noqa: BLE001  one bad entry must not end the others
                    e.error = str(x) or type(x).__name__
            yield e.archive, e.path, data, e.error


class Archives(DataSource):
    """Options: path, archives or folders of them, a line each; suffix of the wanted entries; partitionBytes."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ArchiveReader(self.options)


def read(spark: SparkSession, paths: str | Sequence[str], suffix: str = ".xlsx", partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """(archive, path, content, error): a row for each wanted entry of archives, or of the archives in folders."""
    spark.dataSource.register(Archives)
    named = paths if isinstance(paths, str) else "\n".join(paths)
    return spark.read.format(FORMAT).option("path", named).option("suffix", suffix).option("partitionBytes", partition_bytes).load()

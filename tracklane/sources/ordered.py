"""Ordered text files written by many tasks.

Lines are dealt by ranges of (file, order), so each task holds a stretch of a file's lines or several small files. It
writes them as one part, with a list of the byte ranges of each file in it; the driver only notes which lists count, and
where the job fails removes the parts. Then a task a file joins its ranges as a stream of bytes, under another name until
the file is whole. No file is ever one row, and none passes through the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from tracklane.sources import stores
from tracklane.sources.scratch import written

FORMAT, SCHEMA = "tracklane_parts", "file string, line string"
_RANGES = "file string, part int, at bigint, length bigint, data string"
_LIST = "ranges.json"


class Part(WriterCommitMessage):
    def __init__(self, ranges: str):
        self.ranges = ranges


class PartWriter(DataSourceWriter):
    def __init__(self, folder: str, between: str):
        self.folder, self.between = folder.rstrip("/"), between.encode()

    def write(self, rows: Iterator) -> Part:
        part = TaskContext.get().partitionId()
        base = f"{self.folder}/{part}-{uuid.uuid4().hex}"  # another try of a task writes other files
        ranges: list[dict] = []

        def lines() -> Iterator[bytes]:
            at, now = 0, None
            for row in rows:
                if row.file != now:
                    now = row.file
                    ranges.append({"file": now, "part": part, "at": at, "length": 0, "data": f"{base}.part"})
                    text = row.line.encode()
                else:
                    text = self.between + row.line.encode()
                at += len(text)
                ranges[-1]["length"] += len(text)
                yield text

        stores.write_whole(f"{base}.part", lines())
        stores.write_whole(f"{base}.json", (f"{json.dumps(r)}\n".encode() for r in ranges))
        return Part(f"{base}.json")

    def commit(self, messages: list[Part | None]) -> None:
        stores.write_whole(f"{self.folder}/{_LIST}", (f"{m.ranges}\n".encode() for m in messages if m))

    def abort(self, messages: list[Part | None]) -> None:
        store, path = stores.opened(self.folder)
        if stores.exists(self.folder):
            store.delete_dir(path)


class Parts(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema, overwrite) -> DataSourceWriter:
        return PartWriter(self.options["path"], self.options["between"])


def write(lines: DataFrame, path: str, file: Column, line: Column, order: Sequence[Column | str], head: Callable[[Column], Column], foot: Callable[[Column], Column], between: str = "\n") -> DataFrame:
    """(file, bytes) of the files written below `path`: of each `file` its head, its lines in order with `between` between them, its foot.

    head and foot are made of the file's name. Written files replace those of their names. Files without lines are none.
    """
    spark = lines.sparkSession
    spark.dataSource.register(Parts)
    parts = f"{path.rstrip('/')}/.parts-{uuid.uuid4().hex}"
    keyed = lines.withColumns({"_file": file, "_line": line})
    dealt = keyed.repartitionByRange("_file", *order).sortWithinPartitions("_file", *order).select(F.col("_file").alias("file"), F.col("_line").alias("line"))
    dealt.write.format(FORMAT).option("path", parts).option("between", between).mode("append").save()

    lists = b"".join(stores.read_range(f"{parts}/{_LIST}", 0, 1 << 62)).decode().split()  # one name a task
    ranges = spark.read.schema(_RANGES).json(lists) if lists else spark.createDataFrame([], _RANGES)
    # A file has as many ranges as tasks held a stretch of it.
    files = ranges.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("part", "at", "length", "data"))).alias("ranges"))
    files = files.select("file", head(F.col("file")).alias("head"), foot(F.col("file")).alias("foot"), "ranges")

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = []
            for name, first, last, own in batch.itertuples(index=False):

                def chunks(first=first, last=last, own=own) -> Iterator[bytes]:
                    yield first.encode()
                    for k, r in enumerate(own):
                        if k:
                            yield between.encode()
                        yield from stores.read_range(r["data"], r["at"], r["length"])
                    yield last.encode()

                sizes.append(stores.write_whole(f"{path.rstrip('/')}/{name}", chunks()))
            yield pd.DataFrame({"file": batch["file"], "bytes": sizes})

    # Written, so that each file is joined once whatever is done with the answer.
    done = written(files.mapInPandas(join, "file string, bytes bigint"), "ordered")
    store, at = stores.opened(parts)
    store.delete_dir(at)
    return done

"""Sinks: clean files, yearly tables, JSON snapshots and payloads."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from tracklane.sources import stores
from tracklane.sources.scratch import written


def clean_texts(lines: DataFrame, path: str = "path") -> DataFrame:
    """(path, value): one text a source file, its lines joined by newlines; a file must fit one row."""
    rows = F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"])
    return lines.groupBy(path).agg(F.array_join(rows, "\n").alias("value"))


def write_clean_files(lines: DataFrame, path: str) -> None:
    """clean_texts as a table; for files of any size see write_clean_folders."""
    clean_texts(lines).write.mode("overwrite").parquet(path)


def write_clean_folders(lines: DataFrame, path: str, name: str = "name") -> None:
    """A folder of text for each source file, its lines in order; a file passes through one task as a stream."""
    rows = lines.repartition(name).sortWithinPartitions(name, "line_no")
    rows.select(name, F.col("line").alias("value")).write.mode("overwrite").partitionBy(name).text(path)


def overwrite_years(df: DataFrame, path: str) -> None:
    """Replace only the years that `df` holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path)


def drop_years(spark: SparkSession, path: str, years: Sequence[int | str]) -> None:
    """Delete what a yearly table holds of `years`, such as summaries that new files made out of date."""
    for year in years:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/year={year}")  # noqa: SLF001
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)  # noqa: SLF001


def overwrite_tabs(df: DataFrame, path: str) -> None:
    """Clear and rewrite only the tabs (source_id, tab) that `df` holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_id", "tab").parquet(path)


def write_summary(spark: SparkSession, rows: DataFrame, year: int, path: str, merged: Callable[[DataFrame], DataFrame]) -> None:
    """The year's combined rows under `path`/combined, and what `merged` makes of the written copy under `path`/summary."""
    overwrite_years(rows.withColumn("year", F.lit(year)), f"{path}/combined")
    copy = spark.read.parquet(f"{path}/combined").filter(F.col("year") == year).drop("year")
    overwrite_years(merged(copy).withColumn("year", F.lit(year)), f"{path}/summary")


def write_json(df: DataFrame, path: str, ascii_only: bool = False) -> None:
    """Rows as JSON lines, null fields shown."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").option("writeNonAsciiCharacterAsCodePoint", str(ascii_only).lower()).json(path)


def moves(plan: DataFrame) -> DataFrame:
    """(source, target, done) of a plan (source, target): files moved by the tasks, as stores.moved does; moved twice, they move once."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield part.assign(done=[stores.moved(a, b) for a, b in zip(part["source"], part["target"], strict=True)])

    return written(plan.select("source", "target").mapInPandas(run, "source string, target string, done string"), "moves")


class Sent(WriterCommitMessage):
    def __init__(self, n: int):
        self.n = n


class PostWriter(DataSourceWriter):
    """Sends each row's `payload` with `send`, trying again, after a pause, on connection errors but on no others."""

    def __init__(self, send, tries: int, pause: float):
        self.send, self.tries, self.pause = send, tries, pause

    def write(self, rows):
        n = 0
        for row in rows:
            for left in reversed(range(self.tries)):
                try:
                    self.send(row["payload"])
                    break
                except ConnectionError:
                    if not left:
                        raise
                    time.sleep(self.pause)
            n += 1
        return Sent(n)


def post_sink(format_name: str, send, tries: int = 3, pause: float = 5.0) -> type[DataSource]:
    """A data source class for spark.dataSource.register that posts (key, payload) rows."""

    class Post(DataSource):
        @classmethod
        def name(cls) -> str:
            return format_name

        def schema(self) -> str:
            return "key string, payload string"

        def writer(self, schema, overwrite) -> DataSourceWriter:
            return PostWriter(send, tries, pause)

    return Post

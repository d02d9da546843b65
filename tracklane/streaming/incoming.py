"""New files as a stream: each file is read once, cleaned, and written; the checkpoint remembers what is done."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklane.sources import sinks
from tracklane.sources.files import clean_lines, file_name


def incoming_lines(spark: SparkSession, folder: str, files_per_batch: int = 1000, archive: str | None = None) -> DataFrame:
    """A stream of cleaned lines (path, name, line_no, line) of the text files that arrive in `folder`.

    With `archive`, another folder, Spark itself moves files there once their batch is done; it does so as it can, the last
    batch's in the next run. archived_batch moves them for certain.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    raw = reader.text(folder, wholetext=True)
    rows = raw.select(F.col("_metadata.file_path").alias("path"), F.posexplode(F.split("value", "\n")).alias("line_no", "line"))
    return clean_lines(rows).withColumn("name", file_name(F.col("path")))


#: Into how many tasks Spark deals the listing of a batch's files at most; as it comes, one task a file.
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    """Hand all that has arrived to `each`, batch by batch, and end.

    A batch's files are looked up by as many tasks as run at once, so that each file does not send the driver a task's result.
    """
    spark = stream.sparkSession
    before = spark.conf.get(LISTING)
    spark.conf.set(LISTING, str(max(1, min(int(before), spark.sparkContext.defaultParallelism))))
    try:  # until the end: batches are looked up in the session that made the stream
        stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(LISTING, before)


def archived_batch(each: Callable[[DataFrame, int], None], archive: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: `each`, and then the files of the batch's lines (path, name) moved to `archive`, by the tasks.

    A batch that is tried again moves what still lies there. Put the file's own folder into `archive` where names repeat.
    """

    def run(batch: DataFrame, number: int) -> None:
        # A batch is read once for both: files that are moved cannot be read again.
        held = batch.persist()
        try:
            each(held, number)
            plan = held.select("path", "name").distinct().select(F.col("path").alias("source"), F.concat(F.lit(archive.rstrip("/") + "/"), "name").alias("target"))
            sinks.moves(plan)
        finally:
            held.unpersist()

    return run

"""Play history: entries of the latest file as plays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklane.functions import parse

#: Fixed value: the zone in which players write their history.
ZONE = "America/Chicago"


def latest_file(entries: DataFrame, file: str = "file") -> DataFrame:
    """Entries of the file of the greatest name, found first by a scalar subquery; nothing else of the others is read."""
    return entries.filter(F.col(file) == entries.select(F.max(file)).scalar())


def plays(entries: DataFrame, zone: str = ZONE, dt: str = "dt") -> DataFrame:
    """Entries whose time parses and whose title and artist are not empty, with played_at in ISO form."""
    good = (F.coalesce("title", F.lit("")) != "") & (F.coalesce("artist", F.lit("")) != "")
    return parse.with_instant(entries.filter(good), F.col(dt), zone)


def payload(played: DataFrame, file: str = "file") -> DataFrame:
    """(file, n_plays, payload): a file's plays as the service takes them, in the order of `line_no`."""
    one = F.struct("line_no", F.struct("played_at", "title", "artist").alias("play"))
    body = F.struct(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["play"]).alias("plays"))
    return played.groupBy(file).agg(F.count("*").alias("n_plays"), F.to_json(body).alias("payload"))


def summary(sent: DataFrame) -> DataFrame:
    """One row of counters from (file, status, n_plays): status is sent, api_error or error."""
    s, n = F.col("status"), F.col("n_plays")
    return sent.agg(
        F.coalesce(F.sum(F.when(s == "sent", n)), F.lit(0)).alias("plays_sent"), F.coalesce(F.sum(F.when(s == "api_error", n)), F.lit(0)).alias("plays_failed"),
        F.count_if(s == "sent").alias("files_ok"), F.count_if(s != "sent").alias("files_failed"),
    )


def finding(counters: DataFrame, *keys: str) -> DataFrame:
    """Rows of (base_url_set, had_files, plays_failed, files_failed), one a run, as (keys, severity, text)."""
    bad = (F.col("plays_failed") > 0) | (F.col("files_failed") > 0)
    n = lambda c: F.col(c).cast("string")
    failed = F.concat(F.lit("Completed with issues: plays_failed="), n("plays_failed"), F.lit(", files_failed="), n("files_failed"), F.lit("."))
    why = F.when(~F.col("base_url_set"), " Skipped (no service is set).").when(~F.col("had_files"), " No .m3u files found.").otherwise("")
    good = F.concat(F.lit("Run completed successfully."), why)
    return counters.select(*keys, F.when(bad, "WARN").otherwise("SUCCESS").alias("severity"), F.when(bad, failed).otherwise(good).alias("text"))

"""Typed tracks and the payload of a set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tracklane.functions import parse
from tracklane.functions.text import strip

#: The fields of a typed track, in order.
FIELDS = ("play_order", "label", "title", "remix", "artist", "comment", "genre", "length_secs", "bpm", "release_year", "play_time")


def has_title_and_artist(title: Column, artist: Column) -> Column:
    return (strip(title) != "") & (strip(artist) != "")


def text_of(rows: DataFrame, c: str) -> Column:
    """A cell as text; a number that is zero counts as blank, like null and an empty text."""
    kind = rows.schema[c].dataType
    return F.when(F.col(c) != 0, F.col(c).cast("string")) if isinstance(kind, NumericType) else F.col(c).cast("string")


def typed(rows: DataFrame, old_workbooks: bool = False) -> DataFrame:
    """Tracks that have a title and an artist; the other fields are null where blank or not parsed.

    play_order is kept from before the filter, so gaps remain. old_workbooks: the wider parsers.
    """
    length, year, at = parse.length_seconds, parse.to_int, parse.play_time
    if old_workbooks:
        length, year, at = parse.length_seconds_long, parse.to_int_via_double, parse.play_time_ampm
    raw = ("label", "title", "remix", "artist", "comment", "genre", "length", "bpm", "year", "play_time")
    others = [c for c in rows.columns if c not in raw and c != "play_order"]
    # Each cell is stripped once, in a projection below the parsers.
    bare = rows.select(*others, F.col("play_order").cast("int").alias("play_order"), *[strip(text_of(rows, c)).alias(c) for c in raw])
    t = lambda c: F.nullif(c, F.lit("")).alias(c)
    return bare.filter((F.col("title") != "") & (F.col("artist") != "")).select(
        *others, "play_order", t("label"), "title", t("remix"), "artist", t("comment"), t("genre"),
        length(F.col("length")).alias("length_secs"), parse.to_double(F.col("bpm")).alias("bpm"),
        year(F.col("year")).alias("release_year"), at(F.col("play_time")).alias("play_time"),
    )


def payloads(tracks: DataFrame, sets: DataFrame, key: str = "source_id") -> DataFrame:
    """(key, n_tracks, payload as JSON) for each set that has a track.

    sets: (key, date, venue, label, ord); of a repeated key the last row counts. A set's tracks are one nested array,
    which is the payload's form: a set is one evening's list.
    """
    last = sets.groupBy(key).agg(F.max_by(F.struct("date", "venue", "label"), "ord").alias("meta"))
    nested = tracks.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*FIELDS))).alias("tracks"), F.count("*").alias("n_tracks"))
    full = nested.join(last, key, "left")
    body = F.struct(
        F.nullif(F.col("meta.date"), F.lit("")).alias("set_date"), F.nullif(F.col("meta.venue"), F.lit("")).alias("venue"),
        F.coalesce(F.col("meta.label"), F.col(key).cast("string")).alias("source_file"), F.col("tracks"),
    )
    return full.select(key, "n_tracks", F.to_json(body, {"ignoreNullFields": "false"}).alias("payload"))


def with_order(rows: DataFrame, key: str = "source_id", *order: str) -> DataFrame:
    """`rows` of typed tracks whose missing play_order is their place among the kept rows of their set."""
    place = F.row_number().over(W.partitionBy(key).orderBy(*order or ["row_ord"]))
    return rows.withColumn("play_order", F.coalesce("play_order", place))


def ingest_summary(sent: DataFrame) -> DataFrame:
    """One row of counters from (label, n_tracks, error): error is null where the set was taken.

    Tracks count before they are sent, so those of failed sets are in; sets without tracks are not sent at all.
    """
    tried, bad = F.col("n_tracks") > 0, F.col("error").isNotNull()
    return sent.agg(
        F.count_if(tried & ~bad).alias("sets_sent"), F.count_if(tried & bad).alias("sets_failed"), F.coalesce(F.sum(F.when(tried, F.col("n_tracks"))), F.lit(0)).alias("total_tracks"),
    )


def ingest_failures(sent: DataFrame) -> DataFrame:
    """(label, error) of the sets that failed, as rows: their number has no bound."""
    return sent.filter((F.col("n_tracks") > 0) & F.col("error").isNotNull()).select("label", "error")

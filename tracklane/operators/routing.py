"""Routing of identified files, running caps, and run counters."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracklane.functions.text import base_name
from tracklane.operators.order import running_before

MIN_CONFIDENCE, MAX_UPLOADS, MAX_CANDIDATES = 0.90, 200, 5
#: The counters that make a run's finding a warning, in the order in which they are named.
ISSUES = ("sets_failed", "ingest_failed", "spotify_failed", "bad_filename_in_file", "track_read_failed")
#: Counters that a finding's extra text leaves out.
ABSORBED = (
    "sets_imported", "sets_failed", "sets_skipped", "total_tracks", "failed_set_labels", "api_ingest_success", "sets_attempted", "collection_update",
    "unrecognized_filename_skips", "duplicate_csv_count", "folders_processed", "tabs_written", "total_sets", "json_snapshot_written", "folder_names",
)


def routed(files: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Files with action (in_place or move), reason and tagged, from has_candidate, confidence and has_metadata.

    Tags are written wherever there is metadata, whatever the candidate.
    """
    none, sure = ~F.coalesce("has_candidate", F.lit(False)), F.coalesce("confidence", F.lit(0.0))
    low = sure < min_confidence
    reason = F.when(none, "no_candidates").when(low, F.format_string("low_confidence:%.3f", sure)).otherwise("identified")
    tagged = F.coalesce("has_metadata", F.lit(False))
    return files.select("*", F.when(none | low, "in_place").otherwise("move").alias("action"), reason.alias("reason"), tagged.alias("tagged"))


def writes(routed_files: DataFrame) -> DataFrame:
    """(file_id, step, target) of each routed file: update in place, or upload to the destination and then delete."""
    moved = F.array(F.struct(F.lit(0).alias("k"), F.lit("upload").alias("step"), F.lit("destination").alias("target")), F.struct(F.lit(1).alias("k"), F.lit("delete").alias("step"), F.lit("source").alias("target")))
    kept = F.array(F.struct(F.lit(0).alias("k"), F.lit("update").alias("step"), F.lit("source").alias("target")))
    return routed_files.select("file_id", F.inline(F.when(F.col("action") == "move", moved).otherwise(kept)).alias("k", "step", "target"))


def steps(routed_files: DataFrame) -> DataFrame:
    """(file_id, k, step) of each routed file in order: download, identify, tag and rename with metadata, update or upload and delete.

    A file without an id has none.
    """
    tags = F.when(F.col("tagged"), F.array(F.lit("tag"), F.lit("rename"))).otherwise(F.array().cast("array<string>"))
    end = F.when(F.col("action") == "move", F.array(F.lit("upload"), F.lit("delete"))).otherwise(F.array(F.lit("update")))
    all_ = F.concat(F.array(F.lit("download"), F.lit("identify")), tags, end)
    return routed_files.filter("file_id IS NOT NULL").select("file_id", F.posexplode(all_).alias("k", "step"))


def attempted(planned: DataFrame, failing: DataFrame) -> DataFrame:
    """(file_id, k, step, ok): what happens of the planned steps where those of `failing` (file_id, step) fail; such a step is a file's last."""
    stop = planned.join(failing, ["file_id", "step"]).groupBy("file_id").agg(F.min("k").alias("_stop"))
    held = planned.join(stop, "file_id", "left").filter("_stop IS NULL OR k <= _stop")
    return held.select("file_id", "k", "step", (F.col("_stop").isNull() | (F.col("k") < F.col("_stop"))).alias("ok"))


#: The counters of a file, and which steps count for each. A file counts as identified once its upload begins.
DELTAS = {"downloaded": ("download", True), "identified": ("upload", None), "tagged": ("tag", True), "uploaded": (("upload", "update"), True), "deleted": ("delete", True), "failed": (None, False)}


def deltas(events: DataFrame) -> DataFrame:
    """(file_id, downloaded, identified, tagged, uploaded, deleted, failed) from events (file_id, step, ok)."""

    def counts(step: str | tuple[str, ...] | None, ok: bool | None) -> Column:
        named = F.lit(True) if step is None else F.col("step").isin(*((step,) if isinstance(step, str) else step))
        return F.count_if(named & (F.lit(True) if ok is None else F.col("ok") == ok))

    return events.groupBy("file_id").agg(*[counts(*x).alias(k) for k, x in DELTAS.items()])


def retag_run(files: DataFrame, file_deltas: DataFrame, order: Sequence[str], limit: int = MAX_UPLOADS) -> DataFrame:
    """Files (file_id, order) with what happened to each (in place of columns of those names), and scanned: false once `limit` files before it were uploaded."""
    out = files.drop(*DELTAS).join(file_deltas, "file_id", "left").na.fill(0, list(DELTAS))
    return capped(out, F.col("uploaded"), order, limit)


def retag_counters(handled: DataFrame) -> DataFrame:
    """One row of sums over the scanned files; files behind the cap count as skipped, whatever would have happened to them."""
    seen = F.col("scanned")
    sums = [F.coalesce(F.sum(F.when(seen, F.col(k))), F.lit(0)).alias(k) for k in DELTAS]
    return handled.agg(F.count_if(seen).alias("scanned"), *sums, F.count_if(~seen).alias("skipped"))


def retag_finding(counters: DataFrame) -> DataFrame:
    """Retag counters as (severity, text, sets_imported, sets_failed, sets_skipped, total_tracks) and the counters."""
    bad, said = F.col("failed") > 0, lambda k: F.col(k).cast("string")
    #: Fixed value: the finding's text.
    text = F.concat(F.lit("Completed with issues: failed="), said("failed"), F.lit(" of scanned="), said("scanned"), F.lit(". Check AcoustID/MusicBrainz logs for identification failures."))
    named = {"sets_imported": "uploaded", "sets_failed": "failed", "sets_skipped": "skipped", "total_tracks": "scanned"}
    return counters.select(F.when(bad, "WARN").otherwise("SUCCESS").alias("severity"), F.when(bad, text).alias("text"), *[F.col(v).alias(k) for k, v in named.items()], "scanned", *DELTAS)


def capped(rows: DataFrame, uploaded: Column, order: Sequence[str], limit: int = MAX_UPLOADS) -> DataFrame:
    """Rows with `before`, the uploads before each one in `order`, and scanned: false once there were `limit` of them (0 or less: no limit)."""
    out = running_before(rows, uploaded.cast("bigint"), [], order, "before")
    return out.withColumn("scanned", F.lit(True) if limit <= 0 else F.col("before") < limit)


def _said(name: str, value: Column) -> Column:
    """`name=value`, or null where the value is null or empty."""
    return F.concat(F.lit(f"{name}="), F.nullif(value.cast("string"), F.lit("")))


def candidate_text(candidate: Column) -> Column:
    """A candidate in a line of log: confidence, the first of its two ids, title, artist."""
    sure = F.coalesce(F.format_string("%.3f", candidate["confidence"]), F.lit("N/A"))
    sure = F.when(candidate["confidence"].isNull(), "N/A").otherwise(sure)
    of = F.coalesce(F.nullif(candidate["mbid"], F.lit("")), candidate["recording_id"])
    return F.concat_ws(", ", F.concat(F.lit("confidence="), sure), _said("id", of), _said("title", candidate["title"]), _said("artist", candidate["artist"]))


def metadata_text(metadata: Column) -> Column:
    """Metadata in a line of log: title, artist, year, without empty ones; a year of 0 is empty."""
    year = F.when(metadata["year"].cast("string") != "0", metadata["year"].cast("string"))
    return F.concat_ws(", ", _said("title", metadata["title"]), _said("artist", metadata["artist"]), _said("year", year))


def sorted_tags(tags: Column) -> Column:
    """A map of tags as `key=value` texts by key."""
    return F.transform(F.array_sort(F.map_entries(tags)), lambda e: F.concat_ws("=", e["key"], F.coalesce(e["value"], F.lit(""))))


def best_candidates(candidates: Column, n: int = MAX_CANDIDATES) -> Column:
    """The n most confident of an array of structs whose first field is the confidence."""
    return F.slice(F.sort_array(candidates, asc=False), 1, n)


def union_distinct(tables: Sequence[DataFrame], key: str = "id", order: str = "listing_ord") -> DataFrame:
    """All rows of the tables, of equal keys the first (by table, then order); null keys go."""
    parts = [t.select(F.lit(i).alias("_table"), "*") for i, t in enumerate(tables)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    row = F.struct(*[c for c in out.columns if c != "_table"])
    return out.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(row, F.struct("_table", order)).alias("_r")).select("_r.*")


def listed_or_all(tables: Sequence[DataFrame], everything: DataFrame, key: str = "id", order: str = "listing_ord") -> DataFrame:
    """union_distinct of the tables, or where that is empty all of `everything` (whether it is, is found in the plan)."""
    some = union_distinct(tables, key, order)
    n = some.agg(F.count("*").alias("_n"))
    rest = everything.join(F.broadcast(n.filter("_n = 0")), F.col("_n") == 0).drop("_n")  # one row or none
    return some.unionByName(rest)


def _counters() -> list[Column]:
    """The aggregates of a run's counters; see run_counters."""
    route, status, c = F.col("route"), F.col("status"), F.count_if
    csv = route.isin("set", "bad_set_name")
    imported = csv & (status == "imported")
    return [
        c(csv).alias("sets_attempted"), c(imported).alias("sets_imported"), c(csv & _counts_as_failed()).alias("sets_failed"), c(route == "other").alias("sets_skipped"),
        c(route == "bad_filename").alias("unrecognized_filename_skips"), c(csv & (status == "duplicate")).alias("duplicate_csv_count"),
        F.coalesce(F.sum(F.when(imported, F.col("n_tracks"))), F.lit(0)).alias("total_tracks"), c(imported & F.col("ingest").isin("sent", "failed")).alias("ingest_attempted"),
        c(imported & (F.col("ingest") == "failed")).alias("ingest_failed"), c(imported & (F.col("playlist") == "failed")).alias("spotify_failed"),
        c(imported & (route == "bad_set_name")).alias("bad_filename_in_file"), c(imported & (F.col("ingest") == "no_tracks")).alias("ingest_skipped_no_tracks"),
        c(imported & (F.col("ingest") == "unset")).alias("ingest_skipped_env_missing"), c(imported & F.col("n_tracks").isNull()).alias("track_read_failed"),
    ]


def _counts_as_failed() -> Column:
    """A failed file whose rename failed too is told by its log only; one of an unexpected error always counts."""
    return (F.col("status") == "error") | (F.col("status") == "failed") & F.coalesce("renamed", F.lit(True))


def _ended(counters: DataFrame, push_failed: bool) -> DataFrame:
    """Counters with what the end of the run adds: the push of all playlists, and whether all ingests worked."""
    return counters.withColumn("spotify_failed", F.col("spotify_failed") + int(push_failed)).withColumn("api_ingest_success", F.col("ingest_failed") == 0)


def run_counters(files: DataFrame, push_failed: bool = False) -> DataFrame:
    """One row of a run's counters from (route, status, renamed, n_tracks, ingest, playlist).

    route as operators.files.routed gives it; status of a CSV file: imported, duplicate, failed or error (unexpected);
    renamed: whether a failed one got its failed name (null: yes); ingest and playlist: sent, failed, no_tracks, unset or
    null; n_tracks null where the tracks could not be read. push_failed: the push of all playlists at the run's end.
    """
    return _ended(files.agg(*_counters()), push_failed)


def counted_while(files: DataFrame, write: Callable[[DataFrame], None], push_failed: bool = False) -> DataFrame:
    """run_counters of `files`, taken while `write` writes them: one job, no second look at the files."""
    seen = Observation(f"run-{uuid.uuid4().hex}")
    write(files.observe(seen, *_counters()))
    n = seen.get
    return _ended(files.sparkSession.createDataFrame([tuple(n.values())], ", ".join(f"{k} bigint" for k in n)), push_failed)


def failed_labels(files: DataFrame, name: str = "name") -> DataFrame:
    """The base names of the sets that failed and were renamed, as rows: their number has no bound."""
    csv = F.col("route").isin("set", "bad_set_name")
    return files.filter(csv & (F.col("status") == "failed") & F.coalesce("renamed", F.lit(True))).select(base_name(F.col(name)).alias("label"))


def finding(counters: DataFrame, issues: Sequence[str] = ISSUES, absorbed: Sequence[str] = ABSORBED) -> DataFrame:
    """One row of counters as (severity, text, extra).

    A warning where one of `issues` is above 0, with those counters in order; else a success without a text. `extra`
    holds the counters that are not absorbed.
    """
    there = [c for c in issues if c in counters.columns]
    said = [F.when(F.col(c) > 0, F.concat(F.lit(f"{c}="), F.col(c).cast("string"))) for c in there]
    bad = reduce(lambda a, b: a | b, [F.col(c) > 0 for c in there], F.lit(False))
    text = F.concat(F.lit("Completed with issues: "), F.concat_ws("; ", *said))
    extra = F.concat_ws(" ", *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in counters.columns if c not in absorbed])
    return counters.select(F.when(bad, "WARN").otherwise("SUCCESS").alias("severity"), F.when(bad, text).alias("text"), extra.alias("extra"))


def sorted_report(report: DataFrame) -> DataFrame:
    """A yearly report's rows with their place, years ascending and the totals last; as many rows as years."""
    return report.withColumn("place", F.row_number().over(W.orderBy(F.asc_nulls_last("year")))).orderBy("place")


def yearly_report(sets: DataFrame, year: Column) -> DataFrame:
    """(year, expected, imported, skipped, failed, tracks) by year, and a row of totals whose year is null."""
    s = F.col("status")
    return sets.rollup(year.alias("year")).agg(
        F.count("*").alias("expected"), F.count_if(s == "imported").alias("imported"), F.count_if(s == "skipped").alias("skipped"), F.count_if(s == "failed").alias("failed"),
        F.coalesce(F.sum(F.when(s == "imported", F.col("n_tracks"))), F.lit(0)).alias("tracks"),
    )

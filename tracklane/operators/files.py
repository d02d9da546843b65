"""Files by name: routing, duplicates, renames, yearly readiness."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracklane.functions import text

#: Fixed value: the name of the collection's own workbook.
CATALOGUE = "DJ Set Collection"
SPREADSHEET = "application/vnd.google-apps.spreadsheet"


def routed(files: DataFrame, name: str = "name") -> DataFrame:
    """Files with year, is_csv, base_name, set_date, venue and route: bad_filename, other, bad_set_name or set."""
    n = F.col(name)
    year, base = text.year_of_name(n), text.base_name(n)
    pair, csv = text.date_venue(base), F.lower(n).endswith(".csv")
    route = F.when(year.isNull(), "bad_filename").when(~csv, "other").when(pair["set_date"].isNull(), "bad_set_name").otherwise("set")
    return files.select("*", year.alias("year"), csv.alias("is_csv"), base.alias("base_name"), pair["set_date"].alias("set_date"), pair["venue"].alias("venue"), route.alias("route"))


def with_duplicates(incoming: DataFrame, existing: DataFrame, name: str = "name", keys: tuple[str, ...] = ("year",)) -> DataFrame:
    """`incoming` with status "duplicate" where a file of that base name exists under the same keys, else "new"; and out_name."""
    there = existing.select(*keys, text.base_name(F.col(name)).alias("_base")).distinct().withColumn("_there", F.lit(True))
    out = incoming.withColumn("_base", text.base_name(F.col(name))).join(there, [*keys, "_base"], "left").drop("_base")
    status = F.when(F.col("_there"), "duplicate").otherwise("new")
    return out.withColumn("status", status).withColumn("out_name", F.when(F.col("_there"), F.concat(F.lit(text.DUPLICATE), name)).otherwise(F.col(name))).drop("_there")


def new_files(incoming: DataFrame, existing: DataFrame, name: str = "name", keys: tuple[str, ...] = ("year",)) -> DataFrame:
    """Files of `incoming` whose base name does not exist yet under the same keys."""
    base = lambda df: df.withColumn("_base", text.base_name(F.col(name)))
    return base(incoming).join(base(existing).select(*keys, "_base"), [*keys, "_base"], "left_anti").drop("_base")


def failed_names(files: DataFrame, name: str = "name") -> DataFrame:
    """Files with out_name: under the failed prefix where their status is "failed"."""
    return files.withColumn("out_name", F.when(F.col("status") == "failed", text.failed_name(F.col(name))).otherwise(F.col(name)))


def to_archive(files: DataFrame, parents: DataFrame) -> DataFrame:
    """The files (file_id, folder_id) that are still to move to their archive folder: those that do not lie there."""
    return files.join(parents.select("file_id", "folder_id").distinct(), ["file_id", "folder_id"], "left_anti")


def stale_summaries(summaries: DataFrame, years: DataFrame, name: str = "name") -> DataFrame:
    """The files named exactly "<year> Summary" of `years` (year), which new files make out of date."""
    return summaries.join(years.select(F.concat("year", F.lit(" Summary")).alias(name)).distinct(), name, "left_semi")


def sub_folders(listing: DataFrame) -> DataFrame:
    """(folder, n_files, place) of the folders of a listing, by name, last first; a row each, so few enough to sort."""
    folders = listing.groupBy("folder").agg(F.count("*").alias("n_files"))
    return folders.withColumn("place", F.row_number().over(W.orderBy(F.desc("folder"))))


def in_folder(files: DataFrame, parents: DataFrame) -> DataFrame:
    """Files that already lie in the folder they are to go to (file_id, folder_id)."""
    return files.join(parents.select("file_id", "folder_id"), ["file_id", "folder_id"], "left_semi")


def repaired_names(files: DataFrame, name: str = "name", order: str = "listing_ord", folder: str = "folder_id") -> DataFrame:
    """Files with new_name: one status prefix dropped where no file of the folder has that name; of several the first gets it."""
    target = text.without_status(F.col(name))
    wish = files.withColumn("_target", target).withColumn("_wants", F.col("_target") != F.col(name))
    taken = files.select(folder, F.col(name).alias("_target")).distinct().withColumn("_taken", F.lit(True))
    free = wish.filter("_wants").join(taken, [folder, "_target"], "left_anti")
    first = free.groupBy(folder, "_target").agg(F.min(order).alias(order)).withColumn("_won", F.lit(True))
    return wish.join(first, [folder, "_target", order], "left").withColumn("new_name", F.when(F.col("_wants") & F.col("_won"), F.col("_target")).otherwise(F.col(name))).drop("_target", "_wants", "_won")


def names_in_turn(files: DataFrame, name: str = "name", order: str = "listing_ord", folder: str = "folder_id") -> DataFrame:
    """Files with new_name, repaired one after the other: a status prefix goes where no file has that name by then.

    Unlike repaired_names a renamed file frees its old name for those behind it, and takes the new one. Only names that are
    alike without all their prefixes can meet: each such family of a folder is settled in order by itself. What a task
    holds of a family is the set of its names, which reach it first; its files pass as a stream. Of files equal in folder
    and name the first in order is repaired first; a null name is left.
    """
    family = F.regexp_replace(name, f"^(?i:{'|'.join(text.STATUS_PREFIXES)})+", "")
    target = text.without_status(F.col(name))
    row = F.struct(*files.columns)
    held = files.select(F.col(folder).alias("_folder"), family.alias("_family"), F.col(name).alias("_name"), F.nullif(target, F.col(name)).alias("_target"), F.col(order).alias("_order"), row.alias("_row"))
    names = held.filter("_name IS NOT NULL").groupBy("_folder", "_family", "_name").agg(F.lit(0).alias("_step"))
    nothing = lambda c: F.lit(None).cast(held.schema[c].dataType).alias(c)
    first = names.select("_folder", "_family", "_step", "_name", nothing("_target"), nothing("_order"), nothing("_row"))
    wishes = held.filter("_target IS NOT NULL").select("_folder", "_family", F.lit(1).alias("_step"), "_name", "_target", "_order", "_row")
    by = ["_folder", "_family"]
    dealt = first.union(wishes).repartition(*by).sortWithinPartitions(*by, "_step", "_order", "_name")

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, there = None, set()
        for batch in batches:
            new, rows = [], []
            for i, (*key, step, old, wish) in enumerate(zip(*[batch.column(c).to_pylist() for c in (*by, "_step", "_name", "_target")], strict=True)):
                if key != now:
                    now, there = key, set()
                if not step:
                    there.add(old)
                    continue
                rows.append(i)
                if wish in there:
                    new.append(old)
                else:
                    there.discard(old)
                    there.add(wish)
                    new.append(wish)
            yield pa.RecordBatch.from_arrays([batch.column("_row").take(pa.array(rows, pa.int64())), pa.array(new, pa.string())], names=["_row", "new_name"])

    shape = held.select("_row", F.col("_name").alias("new_name")).schema
    settled = dealt.mapInArrow(settle, shape).select("_row.*", "new_name")
    return settled.unionByName(held.filter("_target IS NULL").select("_row.*", F.col("_name").alias("new_name")))


def year_actions(files: DataFrame, summaries: DataFrame, name: str = "name", years: DataFrame | None = None) -> DataFrame:
    """(year, n_files, action): deduplicate, skip_similar, skip_unready or generate.

    files: (year, name); summaries: names in the summary folder, each of which may mention a year; years: the folders
    (year), where those without files count too. The summary folder itself is no year.
    """
    n = F.col(name)
    per_year = files.groupBy("year").agg(F.count("*").alias("n_files"), F.bool_or(n.startswith(text.FAILED) | n.contains("_Cleaned")).alias("unready"))
    if years is not None:
        folders = years.filter(F.lower("year") != "summary").select("year").distinct()
        per_year = folders.join(per_year, "year", "left").select("year", F.coalesce("n_files", F.lit(0)).alias("n_files"), F.coalesce("unready", F.lit(False)).alias("unready"))
    found = summaries.select(F.explode(F.array_distinct(F.regexp_extract_all(n, F.lit(r"(\d{4}) Summary"), F.lit(1)))).alias("year"), n.alias("s"))
    known = found.groupBy("year").agg(F.bool_or(F.col("s") == F.concat("year", F.lit(" Summary"))).alias("canonical"), F.lit(True).alias("similar"))
    action = F.when(F.coalesce("canonical", F.lit(False)), "deduplicate").when(F.coalesce("similar", F.lit(False)), "skip_similar").when(F.col("unready"), "skip_unready").otherwise("generate")
    return per_year.join(known, "year", "left").select("year", "n_files", action.alias("action"))


def archive_sets(entries: DataFrame, path: str = "path", year: str | None = None, keep: bool = False) -> DataFrame:
    """Workbooks of an archive listing that are sets: (path, set_date, venue, source_file); the catalogue is none.

    keep: with all other columns of `entries` too.
    """
    p = F.col(path)
    good = ~p.endswith("/") & ~p.contains("__MACOSX") & ~p.contains("/Summary/") & ~F.substring_index(p, "/", -1).contains(CATALOGUE)
    kept = entries.columns if keep else [path]
    out = entries.filter(good).select(*kept, text.archive_entry(p).alias("_e")).select(*kept, "_e.*").filter(F.col("set_date").isNotNull())
    return out.filter(F.col("set_date").startswith(year)) if year else out


def by_date(sets: DataFrame, order: str = "path") -> DataFrame:
    """Sets by date, those of one day as listed; a range-partitioned sort."""
    return sets.orderBy("set_date", order)


def ordinals(rows: DataFrame, group: list[str], order: list[str], keep: Column) -> DataFrame:
    """Rows where `keep`, with place (among all rows of the group) and kept_place (among the kept), from 1."""
    w = W.partitionBy(*group).orderBy(*order)
    placed = rows.withColumn("place", F.row_number().over(w)).filter(keep)
    return placed.withColumn("kept_place", F.row_number().over(w))

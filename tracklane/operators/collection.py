"""The collection: folders of files as sheet rows and as one nested snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklane.functions import text
from tracklane.operators.files import SPREADSHEET
from tracklane.operators.order import placed
from tracklane.sources import ordered

ARCHIVE, SUMMARY = "archive", "summary"


def items(files: DataFrame, url_prefix: str = "https://docs.google.com/spreadsheets/d/") -> DataFrame:
    """(folder, is_summary, date, title, label, url, spreadsheet_id, link, listing_ord) of the spreadsheets outside of the archive folder.

    Date and title come from the whole file name, which is the label.
    """
    got, name = text.date_title(F.col("name")), F.col("name")
    url = F.concat(F.lit(url_prefix), F.col("file_id").cast("string"))
    rows = files.filter((F.lower("folder") != ARCHIVE) & (F.col("mime_type") == SPREADSHEET))
    return rows.select(
        "folder", (F.lower("folder") == SUMMARY).alias("is_summary"), got["date"].alias("date"), got["title"].alias("title"), name.alias("label"), url.alias("url"),
        F.col("file_id").cast("string").alias("spreadsheet_id"), text.hyperlink(url, name).alias("link"), "listing_ord",
    )


def sheet_rows(rows: DataFrame) -> DataFrame:
    """(folder, tab_row, date_cell, title_cell, link): a tab a folder, by the date cell's text, latest first, ties as listed.

    Dates and titles are kept as text by an apostrophe; the summary tab shows links only, by name, last first.
    """
    s = F.col("is_summary")
    cells = rows.select(
        "folder", F.when(~s, text.text_cell(F.col("date"))).alias("date_cell"), F.when(~s, text.text_cell(F.col("title"))).alias("title_cell"), "link",
        F.when(s, F.col("label")).otherwise(text.text_cell(F.col("date"))).alias("by"), "listing_ord",
    )
    return placed(cells, ["folder"], [F.desc("by"), "listing_ord"], "tab_row").drop("by", "listing_ord")


def snapshot(rows: DataFrame) -> DataFrame:
    """(folder, place, item as JSON): by (date, label), latest first, ties as listed; of a summary folder by label, with fewer fields."""
    s = F.col("is_summary")
    item = F.when(s, F.to_json(F.struct("label", "url", "spreadsheet_id"))).otherwise(F.to_json(F.struct("date", "title", "label", "url", "spreadsheet_id")))
    flat = rows.select("folder", F.when(s, "").otherwise(F.col("date")).alias("by"), "label", item.alias("item"), "listing_ord")
    return placed(flat, ["folder"], [F.desc("by"), F.desc("label"), "listing_ord"], "place").select("folder", "place", "item")


def write_snapshot(snap: DataFrame, path: str, file: str = "collection.json") -> DataFrame:
    """(file, bytes): the whole collection as one JSON file below `path`, folders by name, last first, an item a line.

    {"folders":[{"name": ..., "items":[...]}, ...]}, written by as many tasks as its items fill; see sources.ordered.
    """
    ends = snap.agg(F.max("folder").alias("_first"))
    opens = F.concat(F.when(F.col("folder") == F.col("_first"), "").otherwise("]},\n"), F.lit('{"name":'), text.json_text(F.col("folder")), F.lit(',"items":[\n'))
    lines = snap.join(F.broadcast(ends), how="cross").withColumn("_text", F.concat(F.when(F.col("place") == 1, opens).otherwise(",\n"), "item"))  # one row
    return ordered.write(lines, path, F.lit(file), F.col("_text"), [F.desc("folder"), "place"], lambda f: F.lit('{"folders":[\n'), lambda f: F.lit("]}]}\n"), "")


def write_folders(snap: DataFrame, path: str) -> DataFrame:
    """(file, bytes): a JSON file of each folder's items below `path`, an item a line."""
    name = F.concat(F.url_encode("folder"), F.lit(".json"))
    folder = lambda f: F.url_decode(F.regexp_replace(f, r"\.json$", ""))
    return ordered.write(snap, path, name, F.col("item"), ["place"], lambda f: F.concat(F.lit('{"name":'), text.json_text(folder(f)), F.lit(',"items":[\n')), lambda f: F.lit("\n]}\n"), ",\n")


def nested(snap: DataFrame) -> DataFrame:
    """(folder, n_items, items): a folder's items as one JSON array, where that fits one row; write_folders has no such bound."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("place", "item"))), lambda x: x["item"])
    return snap.groupBy("folder").agg(F.count("*").alias("n_items"), F.concat(F.lit("["), F.array_join(parts, ","), F.lit("]")).alias("items"))


def totals(files: DataFrame) -> DataFrame:
    """One row: folders (with the archive), tabs (folders besides summary and archive that hold a spreadsheet) and their sets."""
    own = (F.col("mime_type") == SPREADSHEET) & ~F.lower("folder").isin(ARCHIVE, SUMMARY)
    return files.agg(
        F.countDistinct("folder").alias("folders_processed"), F.countDistinct(F.when(own, F.col("folder"))).alias("tabs_written"), F.count_if(own).alias("total_sets"),
    )

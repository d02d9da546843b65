"""Grids of cells: ragged rows, headers found at run time, union of differently shaped tabs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklane.functions.text import canonical_header, strip
from tracklane.operators.order import placed

#: The columns a summary keeps, in order, and the names they are shown by.
SUMMARY_COLUMNS = {"title": "Title", "remix": "Remix", "artist": "Artist", "comment": "Comment", "genre": "Genre", "year": "Year", "bpm": "BPM", "length": "Length"}
#: The columns of a track sheet, and other names for them in old workbooks.
TRACK_COLUMNS = ("label", "title", "remix", "artist", "comment", "genre", "length", "bpm", "year", "play_time")
ALIASES = {"playtime": "play_time", "play time": "play_time", "duration": "length", "release year": "year"}
MAX_COLUMNS = 26


def first_columns(cells: Column, n: int = MAX_COLUMNS) -> Column:
    return F.slice(cells, 1, n)


def padded(cells: Column, width: Column | int) -> Column:
    """Rows of one width: short ones get empty cells, long ones are cut."""
    width = F.lit(width) if isinstance(width, int) else width
    return F.slice(F.concat(F.transform(cells, lambda c: F.coalesce(c, F.lit(""))), F.array_repeat(F.lit(""), F.greatest(width - F.size(cells), F.lit(0)))), F.lit(1), width)


def with_headers(grid: DataFrame) -> DataFrame:
    """(source_id, tab, row_ord, header, cells) of data rows; tabs with a header only, or nothing, vanish.

    The header is row 0 of its tab, joined to the tab's rows (one row for each tab on the right).
    """
    cells = grid.select("source_id", "tab", "row_ord", first_columns(F.col("cells")).alias("cells"))
    headers = cells.filter("row_ord = 0").select("source_id", "tab", F.transform("cells", canonical_header).alias("header"))
    return cells.filter("row_ord > 0").join(headers, ["source_id", "tab"]).select("source_id", "tab", "row_ord", "header", "cells")


def named_cell(header: Column, cells: Column, name: str, last: bool = False) -> Column:
    """The cell under the first (or last) header of that name; empty where the header or the cell is missing."""
    place = F.array_position(F.reverse(header), name) if last else F.array_position(header, name)
    index = F.when(place > 0, (F.size(header) - place) if last else (place - 1)).cast("int")
    return F.coalesce(F.get(cells, index), F.lit(""))


def known_columns(grid: DataFrame, columns: Sequence[str] = TRACK_COLUMNS, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Track sheets: the known columns by name, and play_order, the row's place in its tab counted from 1."""
    rows = with_headers(grid)
    if aliases:
        names = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
        rows = rows.withColumn("header", F.transform("header", lambda h: F.coalesce(F.try_element_at(names, h), h)))
    return rows.select("source_id", "tab", F.col("row_ord").cast("int").alias("play_order"), *[named_cell(F.col("header"), F.col("cells"), c, last=bool(aliases)).alias(c) for c in columns])


def any_filled(cells: Column) -> Column:
    return F.exists(cells, lambda c: strip(c) != "")


def align(tables: Sequence[DataFrame], order: Mapping[str, str] = SUMMARY_COLUMNS, keep: Sequence[str] = (), count: str = "Count") -> DataFrame:
    """The union of tables of texts by canonical header, blanks for missing columns, a count of 1 on each row.

    Columns of `order` come first and by their shown names, then `keep` and what else there is, sorted.
    """

    def canonical(df: DataFrame) -> DataFrame:
        names: dict[str, str] = {}
        for c in df.columns:  # of headers that are alike, the last counts
            names[c.strip().lower()] = c
        return df.select(*[strip(F.col(f"`{c}`").cast("string")).alias(k) for k, c in names.items()])

    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(canonical, tables)).na.fill("")
    names = [k for k in order if k in union.columns] + sorted(k for k in union.columns if k not in order)
    return union.select(*[F.col(f"`{k}`").alias(order.get(k, k)) for k in names if not keep or k in order or k in keep], F.lit(1).alias(count))


def present_columns(grid: DataFrame, order: Mapping[str, str] = SUMMARY_COLUMNS) -> list[str]:
    """The summary columns, in order, that some tab with rows has. At most as many names as `order` reach the driver."""
    rows = with_headers(grid).filter(any_filled(F.col("cells")))
    tabs = rows.groupBy("source_id", "tab").agg(F.any_value("header").alias("header"))
    there = {r.h for r in tabs.select(F.explode("header").alias("h")).filter(F.col("h").isin(*order)).distinct().collect()}
    return [v for k, v in order.items() if k in there]


def summary_rows(grid: DataFrame, order: Mapping[str, str] = SUMMARY_COLUMNS) -> DataFrame:
    """All tabs' rows in the summary's columns; rows that are blank in every column, kept or not, are dropped."""
    rows = with_headers(grid).filter(any_filled(F.col("cells")))
    kept = [strip(named_cell(F.col("header"), F.col("cells"), k, last=True)).alias(v) for k, v in order.items()]
    has_any = F.arrays_overlap("header", F.array(*map(F.lit, order)))
    return rows.filter(has_any).select("source_id", "tab", "row_ord", *kept, F.lit(1).alias("Count"))


def sorted_summary(rows: DataFrame) -> DataFrame:
    """Summary rows with their place by title in the order of characters, equal ones as they were; without a title by all columns."""
    at = [c for c in ("source_id", "tab", "row_ord") if c in rows.columns]
    by = ["Title"] if "Title" in rows.columns else [c for c in rows.columns if c not in at]
    return placed(rows, [], [*[F.col(f"`{c}`").cast("string") for c in by], *at], "place").orderBy("place")


def first_tabs(grid: DataFrame, order: str = "tab") -> DataFrame:
    """The rows of each source's first tab, by `order`; a minimum a source, joined back."""
    first = grid.groupBy("source_id").agg(F.min(order).alias("_first")).withColumnRenamed("source_id", "_source")
    return grid.join(first, (F.col("source_id") == F.col("_source")) & (F.col(order) == F.col("_first"))).drop("_source", "_first")

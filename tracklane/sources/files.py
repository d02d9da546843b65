"""File sources: raw text files as lines, play histories, listings, workbooks."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator, Sequence
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklane.functions.text import clean_line
from tracklane.operators.order import placed
from tracklane.sources import archives

#: The audio types that are listed.
AUDIO_TYPES = ("audio/mpeg", "audio/mp4", "audio/x-m4a", "audio/wav", "audio/x-wav", "audio/flac", "audio/aac", "audio/ogg", "audio/x-aiff", "audio/aiff")


def file_name(path: Column) -> Column:
    return F.url_decode(F.replace(F.substring_index(path, "/", -1), F.lit("+"), F.lit("%2B")))


def lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(path, line_no, line) of whole text files, line_no from 0."""
    raw = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return raw.select("path", F.posexplode(F.split("value", "\n")).alias("line_no", "line"))


def clean_lines(rows: DataFrame) -> DataFrame:
    """Cleaned lines; those that a clean file does not have are gone, line_no keeps its gaps."""
    return rows.withColumn("line", clean_line(F.col("line"), F.col("line_no"))).filter(F.col("line").isNotNull())


def csv_grid(rows: DataFrame) -> DataFrame:
    """Cleaned lines of CSV files as a grid (source_id, tab, row_ord, cells): one tab a file, rows counted from 0.

    Cells may be quoted; quotes inside are doubled.
    """
    from pyspark.sql import Window as W

    found = F.regexp_extract_all(F.concat("line", F.lit(",")), F.lit(r'("(?:[^"]|"")*"|[^,]*),'), F.lit(1))
    bare = F.transform(found, lambda c: F.when(c.rlike(r'(?s)^".*"$'), F.replace(F.regexp_replace(c, '^"|"$', ""), F.lit('""'), F.lit('"'))).otherwise(c))
    order = F.row_number().over(W.partitionBy("path").orderBy("line_no")) - 1
    return rows.select(F.col("path").alias("source_id"), F.lit("csv").alias("tab"), order.alias("row_ord"), bare.alias("cells"))


#: Suffix -> type of the files that a listing tells apart.
TYPES = {
    "csv": "text/csv", "m3u": "audio/x-mpegurl", "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet", "mp3": "audio/mpeg", "m4a": "audio/mp4",
    "wav": "audio/wav", "flac": "audio/flac", "aac": "audio/aac", "ogg": "audio/ogg", "aiff": "audio/aiff", "aif": "audio/x-aiff",
}


def listing(spark: SparkSession, root: str) -> DataFrame:
    """(folder, file_id, name, mime_type, trashed, listing_ord) of the files below `root`; contents are not read."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
    types = F.create_map(*[F.lit(x) for kv in TYPES.items() for x in kv])
    mime = F.coalesce(F.try_element_at(types, F.lower(F.substring_index("path", ".", -1))), F.lit("application/octet-stream"))
    rows = raw.select(
        F.regexp_extract("path", "([^/]*)/[^/]*$", 1).alias("folder"), F.col("path").alias("file_id"), file_name(F.col("path")).alias("name"), mime.alias("mime_type"), F.lit(False).alias("trashed")
    )
    return placed(rows, ["folder"], ["name", "file_id"], "listing_ord")


def folder_files(listed: DataFrame, folder: str | None = None, mime_type: str | None = None) -> DataFrame:
    """The files of a listing that are not in the trash, of one folder and type where these are given."""
    out = listed.filter(~F.col("trashed"))
    out = out.filter(F.col("folder") == folder) if folder is not None else out
    return out.filter(F.col("mime_type") == mime_type) if mime_type is not None else out


def audio_files(listed: DataFrame) -> DataFrame:
    """Files of the audio types, each id once (of repeated ones the first by type, then place), or all where there are none."""
    there = folder_files(listed)
    place = F.array_position(F.array(*map(F.lit, AUDIO_TYPES)), F.col("mime_type"))
    typed = there.withColumn("_type", place).filter("_type > 0 AND coalesce(file_id, '') <> ''")
    row = F.struct(*listed.columns)
    found = typed.groupBy("file_id").agg(F.min_by(row, F.struct("_type", "listing_ord")).alias("_r")).select("_r.*")
    n = typed.agg(F.count("*").alias("_n")).filter("_n = 0")
    return found.unionByName(there.join(F.broadcast(n)).drop("_n"))  # one row or none


def history_entries(rows: DataFrame, file_date: Callable[[Column], Column] | None = None) -> DataFrame:
    """(path, line_no, dt, title, artist) of play-history lines.

    An own minimal grammar: an information line `#EXTVDJ:<time>12:30</time>...<artist>A</artist>...<title>T</title>`;
    other lines are paths or remarks. dt is the file name's date and the line's time.
    """
    tag = lambda k: F.nullif(F.regexp_extract("line", rf"<{k}>(.*?)</{k}>", 1), F.lit(""))
    date = file_date(F.col("path")) if file_date else F.regexp_extract(file_name(F.col("path")), r"^(.*?)\.m3u", 1)
    return rows.filter(F.col("line").startswith("#EXTVDJ:")).select("path", "line_no", F.concat_ws(" ", F.trim(date), tag("time")).alias("dt"), F.coalesce(tag("title"), F.lit("")).alias("title"), F.coalesce(tag("artist"), F.lit("")).alias("artist"))


_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}


_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _active(z: zipfile.ZipFile) -> str:
    """The part of the active sheet; without a workbook part the first sheet by name."""
    names = set(z.namelist())
    if {"xl/workbook.xml", "xl/_rels/workbook.xml.rels"} <= names:
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        view, sheets = book.find("m:bookViews/m:workbookView", _NS), book.findall("m:sheets/m:sheet", _NS)
        target = {r.get("Id"): r.get("Target", "") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        part = target[sheets[int(view.get("activeTab", 0)) if view is not None else 0].get(_REL)]
        return part.lstrip("/") if part.startswith("/") else f"xl/{part}"
    return sorted(n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n))[0]


def _time_styles(z: zipfile.ZipFile) -> dict[int, str]:
    """Cell style -> "duration" or "time" (any other date format), of the styles with such a number format."""
    if "xl/styles.xml" not in z.namelist():
        return {}
    root = ElementTree.fromstring(z.read("xl/styles.xml"))
    own = {int(f.get("numFmtId")): f.get("formatCode", "") for f in root.findall("m:numFmts/m:numFmt", _NS)}
    out = {}
    for i, x in enumerate(root.findall("m:cellXfs/m:xf", _NS)):
        k = int(x.get("numFmtId", 0))
        code = re.sub(r'"[^"]*"|\\.|_.', "", own.get(k, "")).lower().split(";")[0]
        if k == 46 or re.search(r"\[(h+|m+|s+)\]", code):
            out[i] = "duration"
        elif 14 <= k <= 22 or k in (45, 47) or re.search("[dmhys]", re.sub(r"\[[^\]]*\]|general", "", code)):
            out[i] = "time"
    return out


def _time_text(text: str, kind: str | None) -> str:
    """A native duration as "h:mm:ss", a native time of day as "Thh:mm:ss" (see parse.length_seconds_long); others unchanged."""
    days = float(text) if kind and re.fullmatch(r"[0-9.]+(?:[eE][+-]?[0-9]+)?", text) else -1.0
    if days < 0 or kind == "time" and days >= 1:
        return text
    s = round(days * 86400)
    return f"{s // 3600}:{s // 60 % 60:02d}:{s % 60:02d}" if kind == "duration" else f"T{s // 3600 % 24:02d}:{s // 60 % 60:02d}:{s % 60:02d}"


def sheet_cells(data: bytes) -> list[list[str]]:
    """The active sheet of a workbook as text cells; a small reader of the open format."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in s.iter(f"{{{_NS['m']}}}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", _NS)]
        first, styles = _active(z), _time_styles(z)
        out = []
        for row in ElementTree.fromstring(z.read(first)).iter(f"{{{_NS['m']}}}row"):
            cells: list[str] = []
            for c in row.findall("m:c", _NS):
                letters = re.match("[A-Z]+", c.get("r", "")) or re.match("", "")
                place = 0
                for x in letters.group():
                    place = place * 26 + ord(x) - 64
                cells += [""] * (place - 1 - len(cells))
                v, kind = c.find("m:v", _NS), c.get("t")
                text = "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t")) if kind == "inlineStr" else (v.text if v is not None else "") or ""
                style = styles.get(int(c.get("s", 0))) if kind in (None, "n") else None
                cells.append(shared[int(text)] if kind == "s" and text else _time_text(text, style))
            out.append(cells)
    return out


def workbook_rows(entries: DataFrame) -> DataFrame:
    """(archive, path, row_ord, cells, error) of the workbooks in `entries`; a broken one gives a row with its error."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for archive, path, content, error in part.itertuples(index=False):
                rows: list[list[str]] = []
                if error is None:
                    try:
                        rows = sheet_cells(content)
                    except Exception as e:  # noqa: BLE001  one bad file must not end the others
                        error = str(e) or type(e).__name__
                if error is not None:
                    yield pd.DataFrame({"archive": [archive], "path": [path], "row_ord": [-1], "cells": [[]], "error": [error]})
                else:
                    yield pd.DataFrame({"archive": archive, "path": path, "row_ord": range(len(rows)), "cells": rows, "error": None})

    return entries.select("archive", "path", "content", "error").mapInPandas(run, "archive string, path string, row_ord int, cells array<string>, error string")


def workbook_archives(spark: SparkSession, paths: str | Sequence[str], suffix: str = ".xlsx") -> DataFrame:
    """(archive, path, row_ord, cells, error) of the workbooks in zip archives, each entry read by the task that parses it."""
    return workbook_rows(archives.read(spark, paths, suffix))

"""Run a part of the library by its name."""

from __future__ import annotations

import argparse
import json
import os
import sys
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklane.functions import text
from tracklane.operators import files, grid, live, routing, summaries, tracks
from tracklane.sources import files as sources
from tracklane.sources import stores


def _env(name: str, default, kind=str):
    return field(default_factory=lambda: kind(os.environ.get(f"TRACKLANE_{name}", default)))


@dataclass(frozen=True)
class Settings:
    """Settings of a run, with defaults, from the environment where it names them."""

    zone: str = _env("ZONE", live.ZONE)
    min_confidence: float = _env("MIN_CONFIDENCE", routing.MIN_CONFIDENCE, float)
    max_candidates: int = _env("MAX_CANDIDATES", routing.MAX_CANDIDATES, int)
    max_uploads: int = _env("MAX_UPLOADS", routing.MAX_UPLOADS, int)
    service: str = _env("SERVICE", "", lambda x: x.strip().rstrip("/"))
    summary_folder: str = _env("SUMMARY_FOLDER", "Summary")
    snapshot_path: str = _env("SNAPSHOT_PATH", "collection.json")


def _summary(g: DataFrame, _: Settings) -> DataFrame:
    return summaries.table(g)


def _tracks(g: DataFrame, _: Settings) -> DataFrame:
    return tracks.typed(grid.known_columns(g))


def _old_tracks(g: DataFrame, _: Settings) -> DataFrame:
    return tracks.typed(grid.known_columns(g, aliases=grid.ALIASES), old_workbooks=True)


def _plays(entries: DataFrame, s: Settings) -> DataFrame:
    return live.plays(entries, s.zone)


#: What each mode makes of its input table.
MODES: dict[str, Callable[[DataFrame, Settings], DataFrame]] = {"summaries": _summary, "tracks": _tracks, "old-workbooks": _old_tracks, "live-history": _plays}


def run(mode: str, rows: DataFrame, settings: Settings | None = None) -> DataFrame:
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; there are {', '.join(sorted(MODES))}")
    return MODES[mode](rows, settings or Settings())


def archived_grid(spark: SparkSession, archive: str, year: str | None = None) -> DataFrame:
    """The sheets of an archive's sets as a grid (source_id, tab, row_ord, cells); source_id is the file's name without its ending.

    A workbook that cannot be read has no rows; of `year`, where it is given, only the sets of that year are read.
    """
    read = sources.workbook_archives(spark, archive).filter("error IS NULL")
    sets = files.archive_sets(read, year=year, keep=True)
    return sets.select(F.col("source_file").alias("source_id"), F.lit("sheet").alias("tab"), "row_ord", "cells")


def run_source(spark: SparkSession, mode: str, source: str, target: str | None, year: str | None = None) -> int:
    """Run a mode over one table, or one zip archive of workbooks, and write the result; how many rows it has."""
    if source.lower().endswith(".zip"):
        rows = archived_grid(spark, source, year)
    else:
        rows = spark.read.parquet(source)
        rows = rows.filter(text.year_of_name(rows["source_id"]) == year) if year else rows
    out = run(mode, rows)
    if target is None:
        return out.count()
    out.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target).count()


def main(argv: list[str] | None = None) -> int:
    """Run a mode over each source; 1 if one of them failed, while the others are still done."""
    p = argparse.ArgumentParser(prog="tracklane")
    p.add_argument("mode", choices=sorted(MODES))
    p.add_argument("sources", nargs="+", help="Parquet tables of the mode's input rows, or zip archives of workbooks")
    p.add_argument("target", help="folder to write; with several sources a sub-folder each, by number")
    p.add_argument("--year", help="only sets of this year")
    p.add_argument("--dry-run", action="store_true", help="count the rows, write nothing")
    p.add_argument("--outcomes", help="file for a JSON line of each source: source, ok, rows, error")
    args = p.parse_args(argv)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    outcomes = []
    for k, source in enumerate(args.sources):
        one = {"source": source, "ok": True, "rows": None, "error": None}
        try:
            one["rows"] = run_source(spark, args.mode, source, None if args.dry_run else args.target if len(args.sources) == 1 else f"{args.target}/{k}", args.year)
        except PySparkException as e:
            one |= {"ok": False, "error": str(e)}
        print(f"{source}: {one['rows']} rows" if one["ok"] else f"{source}: {one['error']}", file=sys.stdout if one["ok"] else sys.stderr)
        outcomes.append(one)
    if args.outcomes:
        stores.write_whole(args.outcomes, (f"{json.dumps(o)}\n".encode() for o in outcomes))
    return int(not all(o["ok"] for o in outcomes))


if __name__ == "__main__":
    sys.exit(main())

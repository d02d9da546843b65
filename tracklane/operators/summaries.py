"""A year's summary: all tabs of all its sheets as one table, then its duplicate rows merged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklane.operators import first_fit, grid

PLACE = ("source_id", "tab", "row_ord")


def combined(sheets: DataFrame) -> DataFrame:
    """The rows of a grid in the summary columns that some tab has, a count of 1, and `at`, their order.

    Rows are ordered by title, equal ones as they stand in the sheets; without a title column by all columns.
    """
    columns = grid.present_columns(sheets)
    by = ["Title"] if "Title" in columns else columns
    return grid.summary_rows(sheets).select(*columns, "Count", F.struct(*by, *PLACE).alias("at"))


def table(sheets: DataFrame) -> DataFrame:
    """The summary of a grid: merged rows with their counts; first_at.at is the place of each one's first row."""
    return first_fit.deduplicate(combined(sheets), order=["at"])

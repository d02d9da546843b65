"""How a module of queries registers them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tracklane.sources.scratch import scratch as scratch  # noqa: PLC0414

#: Unicode white space for DuckDB's regular expressions.
SPACE = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def strip_sql(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), '^{SPACE}+|{SPACE}+$', '', 'g')"


def fold_sql(x: str) -> str:
    return strip_sql(f"regexp_replace(strip_accents({strip_sql(x)}), '{SPACE}+', ' ', 'g')")


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


class Registry:
    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def add(self, sql: str):
        def register(f):
            self.queries[f.__name__] = f
            self.oracles[f.__name__] = sql
            return f

        return register

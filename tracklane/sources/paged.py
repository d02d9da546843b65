"""Paged services as tables and as streams.

A service is a function fetch(offset, limit, where) that gives a page: a mapping of `items` and `next`, or a list of rows.
Anything else ends the reading.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, InputPartition

from tracklane.operators.order import placed
from tracklane.sources import stores

Fetch = Callable[[int, int, dict], Sequence[tuple] | Mapping]
LIMIT = 50


class Page(InputPartition):
    def __init__(self, offset: int, limit: int):
        self.offset, self.limit = offset, limit


def _items(page) -> Sequence[tuple]:
    return (page.get("items") or []) if isinstance(page, Mapping) else page if isinstance(page, (list, tuple)) else []


class PagedReader(DataSourceReader):
    """One input partition for each page of `limit` rows where the option `total` tells how many rows there are.

    Without it one partition follows the pages as long as there is a next one. Equality filters on `type` are taken over.
    """

    def __init__(self, schema, options, fetch: Fetch):
        self.total, self.limit = int(options.get("total", -1)), int(options.get("limit", LIMIT))
        self.fetch, self.where = fetch, {}

    def pushFilters(self, filters: list[Filter]):  # noqa: N802
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("type",):
                self.where["type"] = f.value
            else:
                yield f

    def partitions(self):
        return [Page(o, self.limit) for o in range(0, self.total, self.limit)] if self.total >= 0 else [Page(0, self.limit)]

    def read(self, page: Page):
        offset = page.offset
        while True:
            got = self.fetch(offset, page.limit, self.where)
            yield from _items(got)
            if self.total >= 0 or not isinstance(got, Mapping) or not got.get("next"):
                return
            offset += page.limit


class PolledReader(DataSourceStreamReader):
    """A stream whose offset is the number of full pages behind it; a trigger reads what pages have come since, each as a task.

    A page counts once it is full, or once the option `closed` says that no more rows will come. So a row is read once,
    and a batch that is tried again reads the same pages.
    """

    def __init__(self, options, fetch: Fetch):
        self.limit, self.most, self.fetch = int(options.get("limit", LIMIT)), int(options.get("pagesPerTrigger", 1 << 30)), fetch
        self.closed = options.get("closed", "false") == "true"
        self.at = 0

    def initialOffset(self) -> dict:  # noqa: N802
        return {"page": 0}

    def _ready(self, page: int) -> bool:
        n = len(_items(self.fetch(page * self.limit, self.limit, {})))
        return n >= self.limit or self.closed and n > 0

    def latestOffset(self) -> dict:  # noqa: N802
        # Pages fill in order: step out until one is not ready, then halve.
        if not self._ready(self.at):
            return {"page": self.at}
        step = 1
        while step < self.most and self._ready(self.at + step):
            step *= 2
        low, high = self.at + step // 2 + 1, self.at + min(step, self.most)
        while low < high:
            middle = (low + high) // 2
            low, high = (middle + 1, high) if self._ready(middle) else (low, middle)
        return {"page": low}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.at = max(self.at, end["page"])
        return [Page(p * self.limit, self.limit) for p in range(start["page"], end["page"])]

    def read(self, partition: Page) -> Iterator[tuple]:
        yield from map(tuple, _items(self.fetch(partition.offset, partition.limit, {})))

    def commit(self, end: dict) -> None:
        self.at = max(self.at, end["page"])


def source(format_name: str, ddl: str, fetch: Fetch) -> type[DataSource]:
    """A data source class for spark.dataSource.register that reads a service page by page, for spark.read and readStream.

    It takes over filters, so the session needs spark.sql.python.filterPushdown.enabled=true.
    """

    class Paged(DataSource):
        @classmethod
        def name(cls) -> str:
            return format_name

        def schema(self) -> str:
            return ddl

        def reader(self, schema) -> DataSourceReader:
            return PagedReader(schema, self.options, fetch)

        def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
            return PolledReader(self.options, fetch)

    return Paged


def write_pages(rows: DataFrame, folder: str, order: Sequence[str], limit: int = LIMIT, before: int = 0) -> None:
    """A file-backed service: rows in order, `limit` a page, a JSON line each, behind the `before` pages that are there."""
    numbered = placed(rows, [], list(order), "_place").withColumn("_page", F.floor((F.col("_place") - 1) / limit) + before)
    dealt = numbered.repartition("_page").sortWithinPartitions("_page", "_place")
    body = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    dealt.select(body.alias("value"), F.col("_page").alias("page")).write.mode("append").partitionBy("page").text(folder)


def file_service(folder: str) -> Fetch:
    """fetch for pages that write_pages wrote. `where` keeps the rows of those values."""

    def rows_of(page: int) -> list[dict]:
        at = f"{folder.rstrip('/')}/page={page}"
        names = stores.files_below(at, ".txt") if stores.exists(at) else []
        return [json.loads(x) for f in names for x in b"".join(stores.read_range(f, 0, 1 << 62)).decode().split("\n") if x]

    def fetch(offset: int, limit: int, where: dict) -> Mapping:
        page = offset // limit
        items = [tuple(r.values()) for r in rows_of(page) if all(r.get(k) == v for k, v in where.items())]
        return {"items": items, "next": stores.exists(f"{folder.rstrip('/')}/page={page + 1}")}

    return fetch

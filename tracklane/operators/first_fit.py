"""First-fit merge: rows of one key join the first entry whose optional columns they do not contradict.

The merge depends on the order of rows, but equal rows always join the entry that the first of them joined: an entry's
blanks only ever get filled, so what contradicted a row still does, and the entry that took it still fits. So equal rows
are summed first, before and after the shuffle, and only a key's different combinations are merged in order. A key with
very many rows, such as blank titles, costs no more than its combinations.

A key's combinations pass through a task in order, as a stream of Arrow batches. Its open entries lie in hash tables by
their pattern of blanks and by the columns that entry and row both fill, so a row finds its first fitting entry by one
look-up a pattern; nothing but the entries is held. Entries that differ in a column which no row of the key leaves blank
never take the same row, so keys of over SPLIT combinations are split by all such columns and merged apart. What is left
in one piece is a key with many different values and a blank in every such column: first fit is sequential there by its
definition, and costs a few look-ups a row in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracklane.functions import parse, text
from tracklane.operators.grid import padded
from tracklane.operators.order import placed, running_before
from tracklane.sources.scratch import written

#: The columns that may differ within a merged row, and how each is compared once it is folded.
OPTIONAL: dict[str, Callable[[Column], Column]] = {"comment": lambda c: c, "genre": lambda c: c, "year": lambda c: c, "length": parse.length_key, "bpm": parse.bpm_key}
COUNT, TITLE = "count", "title"
#: Combinations of a key from which on it is split where it can be.
SPLIT = 10_000
#: Entries that one Arrow batch of results holds.
_BATCH = 5_000


class Entries:
    """The open entries of one key, in order of creation: (compared, shown, n, what its first row carried)."""

    def __init__(self, width: int):
        self.rows: list[tuple[list[str], list[str], list[int], tuple]] = []
        self.width, self.patterns = width, []
        #: pattern of filled columns -> columns compared -> their values -> numbers of entries, a heap.
        self.tables: dict[int, dict[int, dict[tuple, list[int]]]] = {}

    def _pattern(self, same: Sequence[str]) -> int:
        return sum(1 << c for c in range(self.width) if same[c])

    def _values(self, same: Sequence[str], mask: int) -> tuple:
        return tuple(same[c] for c in range(self.width) if mask >> c & 1)

    def _table(self, pattern: int, mask: int) -> dict[tuple, list[int]]:
        """The entries of a pattern by their values in some of its columns; made when a row first asks for it."""
        masks = self.tables[pattern]
        if mask not in masks:
            masks[mask] = {}
            for i, p in enumerate(self.patterns):
                if p == pattern:
                    masks[mask].setdefault(self._values(self.rows[i][0], mask), []).append(i)
        return masks[mask]

    def _first_fit(self, same: Sequence[str], filled: int) -> int | None:
        best = None
        for pattern in self.tables:
            heap = self._table(pattern, pattern & filled).get(self._values(same, pattern & filled), ())
            while heap and self.patterns[heap[0]] != pattern:  # it has been filled since
                heappop(heap)
            if heap and (best is None or heap[0] < best):
                best = heap[0]
        return best

    def _enter(self, i: int) -> None:
        """Entry i is now of another pattern, or new."""
        same = self.rows[i][0]
        pattern = self._pattern(same)
        if i == len(self.patterns):
            self.patterns.append(pattern)
        self.patterns[i] = pattern
        for mask, table in self.tables.setdefault(pattern, {}).items():
            heappush(table.setdefault(self._values(same, mask), []), i)

    def add(self, same: Sequence[str], shown: Sequence[str], n: int, carried: tuple) -> None:
        """A row joins the first entry that it does not contradict, or becomes one."""
        filled = self._pattern(same)
        i = self._first_fit(same, filled)
        if i is None:
            self.rows.append((list(same), list(shown), [n], carried))
            self._enter(len(self.rows) - 1)
            return
        own, own_shown, total, _ = self.rows[i]
        total[0] += n
        if filled & ~self.patterns[i]:
            for c in range(self.width):
                if same[c] and not own[c]:
                    own[c], own_shown[c] = same[c], shown[c]
            self._enter(i)


def _fold(width: int, keys: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sorted combinations (keys, part, first, at, same, shown, carried, n) to entries (keys, first, at, shown, carried, n)."""
    out_columns = [*keys, "first", "at", "shown", "carried", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, entries, done, types = None, Entries(width), [], None

        def close() -> None:
            done.extend((*carried[:-1], shown, carried[-1], n[0]) for _, shown, n, carried in entries.rows)

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done, strict=True), types, strict=True)], names=out_columns)

        for batch in batches:
            types = [batch.schema.field(c).type for c in out_columns]
            column = {c: batch.column(c).to_pylist() for c in batch.schema.names}
            for *key, part, first, at, same, shown, carried, n in zip(*[column[c] for c in (*keys, "part", "first", "at", "same", "shown", "carried", "n")], strict=True):
                if now != (key, part):
                    close()
                    now, entries, key_at = (key, part), Entries(width), at if first is None else first
                    if len(done) >= _BATCH:
                        yield batch_of()
                        done.clear()
                entries.add([x or "" for x in same], shown, n, (*key, key_at, at, carried))
        close()
        if done:
            yield batch_of()

    return run


def merge(rows: DataFrame, keys: Mapping[str, Column], optional: Mapping[str, tuple[Column, Column]], count: Column, order: Sequence[str], carry: Sequence[str] = (), split: int = SPLIT) -> DataFrame:
    """(keys, optional, carry, n, at, key_at): a row for each entry. at: the order of its first row; key_at: of its key's.

    optional: name -> (value shown, value compared); an empty value compared fits any. order: columns that together
    are unique, first rows first. carry: columns taken from an entry's first row. n: the sum of `count`. Ordered by
    key_at, at, keys come by first appearance, and a key's entries next to each other, as they were made.
    """
    names = list(optional)
    same = [f"same_{k}" for k in names]
    texts = lambda cs: F.array(*cs).cast("array<string>")
    flat = rows.select(
        *[c.alias(k) for k, c in keys.items()], *[optional[k][1].alias(f"same_{k}") for k in names], F.struct(*order).alias("at"),
        F.struct(texts([optional[k][0] for k in names]).alias("shown"), F.struct(F.lit(0).alias("_"), *carry).alias("carried")).alias("own"), count.cast("bigint").alias("n"),
    )
    alike = flat.groupBy(*keys, *same).agg(F.min("at").alias("at"), F.min_by("own", "at").alias("own"), F.sum("n").alias("n"))
    combos = written(alike.select(*keys, texts(same).alias("same"), "at", "own.shown", "own.carried", "n"), "combinations")
    never = [F.bool_and(F.get("same", i) != "").alias(f"_f{i}") for i in range(len(names))]
    large = combos.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("at").alias("first"), *never).filter(F.col("_n") > split)
    large = large.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "first", texts([F.col(f"_f{i}") for i in range(len(names))]).alias("_never"))
    same_key = F.lit(True)
    for i, k in enumerate(keys):
        same_key &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    part = F.zip_with("same", "_never", lambda x, always: F.when(always == "true", x).otherwise(""))
    dealt = combos.join(large, same_key, "left").select(*keys, part.alias("part"), "first", "at", "same", "shown", "carried", "n").repartition(*keys, "part").sortWithinPartitions(*keys, "part", "at")
    shape = dealt.select(*keys, F.coalesce("first", "at").alias("first"), "at", "shown", "carried", "n").schema
    out = dealt.mapInArrow(_fold(len(names), list(keys)), shape)
    return out.select(*keys, *[F.get("shown", i).alias(k) for i, k in enumerate(names)], *[F.col("carried")[c].alias(c) for c in carry], "n", "at", F.col("first").alias("key_at"))


def numbered(merged: DataFrame, keys: Sequence[str], at: str = "at") -> DataFrame:
    """Entries with `entry`, their number in their key from 0."""
    return merged.withColumn("entry", F.row_number().over(W.partitionBy(*keys).orderBy(at)) - 1)


def in_order(merged: DataFrame, at: str = "first_at") -> DataFrame:
    """Entries with their place, from 1, in the order of a de-duplicated sheet, for a sink; without key_at and `at`."""
    return placed(merged, [], ["key_at", at], "place").drop("key_at", at)


def ranked(merged: DataFrame, at: str = "at") -> DataFrame:
    """Entries with key_rank, the place of their key by its first appearance, from 1; see operators.order for groups of any size."""
    first = (F.col("key_at") == F.col(at)).cast("bigint")
    out = running_before(merged, first, [], ["key_at", at], "key_rank")
    return out.withColumn("key_rank", F.col("key_rank") + first)


def column_of(columns: Sequence[str], name: str) -> str | None:
    """The first of `columns` that is `name`, whatever its case, accents and width."""
    fold = lambda c: text.folded_text(c).lower()
    return next((c for c in columns if fold(c) == fold(name)), None)


def deduplicate(rows: DataFrame, order: Sequence[str], count_col: str = "Count") -> DataFrame:
    """A summary table with its duplicate rows merged, in the same columns and `count_col` (added as 1 if missing).

    Rows are alike where all columns but the optional ones and the count are: folded and lower-case, the title by its
    letters and digits only. Columns are found whatever their case, accents and width; output keeps each entry's first
    row's texts, and by key_at, first_at the order of a de-duplicated sheet.
    """
    columns = [c for c in rows.columns if c not in order]
    count, title = column_of(columns, COUNT), column_of(columns, TITLE)
    loose = {column_of(columns, k): f for k, f in OPTIONAL.items()}
    own, fixed = [c for c in columns if c in loose], [c for c in columns if c not in loose and c != count]
    cell = lambda c: F.col(f"`{c}`").cast("string")
    number = {c: i for i, c in enumerate(columns)}
    # Each step is a projection of its own, so that nothing is computed twice.
    clean = rows.select(*order, *[text.clean_cell(cell(c)).alias(f"v{number[c]}") for c in columns], (parse.to_count(cell(count)) if count else F.lit(1)).alias("_count"))
    compared = [c for c in columns if c != count]
    folded = clean.withColumn("_folded", text.folded_cells(F.array(*[F.col(f"v{number[c]}") for c in compared])))
    f = lambda c: F.get("_folded", compared.index(c))
    bare = folded.select(
        *order, "_count", *[f"v{number[c]}" for c in columns], *[F.lower(letters(f(c)) if c == title else f(c)).alias(f"key_{number[c]}") for c in fixed], *[loose[c](f(c)).alias(f"own_{number[c]}") for c in own]
    )
    keys = {f"key_{number[c]}": F.col(f"key_{number[c]}") for c in fixed}
    optional = {f"v{number[c]}": (F.col(f"v{number[c]}"), F.col(f"own_{number[c]}")) for c in own}
    merged = merge(bare, keys, optional, F.col("_count"), order, [f"v{number[c]}" for c in fixed])
    return merged.select(*[F.col(f"v{number[c]}").alias(c) for c in columns if c != count], F.col("n").alias(count or count_col), F.col("at").alias("first_at"), "key_at")


def letters(c: Column) -> Column:
    """A folded title's letters and digits."""
    return F.regexp_replace(c, r"[^\p{L}\p{N}]", "")


def deduplicate_grid(grid: DataFrame) -> DataFrame:
    """(source_id, tab, key_row, entry, row_ord, header, cells, count): the merged rows of each tab of a grid, whatever its columns.

    By key_row, the first row of an entry's key, and entry they are in the order of a de-duplicated sheet.

    grid: (source_id, tab, row_ord, header, cells) as operators.grid.with_headers gives it, headers in any case. Columns
    are found at run time, so a tab's key is one array of its other cells. Short rows are padded with blanks, long ones
    cut; a tab without a count counts each row once. Cells come back stripped, in the entry's first row's texts but for
    optional columns that a later row filled.
    """
    wide = grid.select("source_id", "tab", "row_ord", "header", F.transform(padded(F.col("cells"), F.size("header")), text.clean_cell).alias("cells"))
    read = wide.withColumn("names", F.transform(text.folded_cells(F.col("header")), F.lower)).withColumn("folded", text.folded_cells(F.col("cells")))
    special = F.array(*map(F.lit, (COUNT, *OPTIONAL)))
    places = {k: F.array_position("names", k) for k in (COUNT, TITLE, *OPTIONAL)}
    at = lambda cells, k: F.coalesce(F.try_element_at(cells, F.nullif(places[k], F.lit(0)).cast("int")), F.lit(""))
    # A second column of such a name is one like any other.
    first = lambda i: F.array_position("names", F.get("names", i)) == i + 1
    key = F.filter(
        F.transform("folded", lambda c, i: F.when(F.array_contains(special, F.get("names", i)) & first(i), F.lit(None).cast("string")).otherwise(F.lower(F.when(i + 1 == places[TITLE], letters(c)).otherwise(c)))),
        lambda c: c.isNotNull(),
    )
    count = F.when(places[COUNT] == 0, F.lit(1)).otherwise(parse.to_count(at(F.col("cells"), COUNT)))
    bare = read.select("source_id", "tab", "row_ord", "names", "header", "cells", key.alias("key"), count.alias("_count"), *[at(F.col("folded"), k).alias(f"own_{k}") for k in OPTIONAL])
    optional = {k: (at(F.col("cells"), k), f(F.col(f"own_{k}"))) for k, f in OPTIONAL.items()}
    keys = ("source_id", "tab", "key")
    merged = numbered(merge(bare, {k: F.col(k) for k in keys}, optional, F.col("_count"), ["row_ord"], ["names", "header", "cells"]), keys)
    back = F.transform("cells", lambda c, i: F.when(F.get("names", i) == COUNT, F.when(first(i), F.col("n").cast("string")).otherwise(c)).otherwise(_filled(c, i, first)))
    return merged.select("source_id", "tab", F.col("key_at.row_ord").alias("key_row"), "entry", F.col("at.row_ord").alias("row_ord"), "header", back.alias("cells"), F.col("n").alias("count"))


def _filled(c: Column, i: Column, first: Callable[[Column], Column]) -> Column:
    """The merged optional value where cell i holds one, else the cell."""
    out = c
    for k in OPTIONAL:
        out = F.when((F.get("names", i) == k) & first(i), F.col(k)).otherwise(out)
    return out


def totals(before: DataFrame, after: DataFrame, count: str = "count") -> DataFrame:
    """One row: rows before, rows after, and the sum of their counts."""
    a = before.agg(F.count("*").alias("rows_before"))
    b = after.agg(F.count("*").alias("rows_after"), F.coalesce(F.sum(count), F.lit(0)).alias("total_count"))
    return a.join(b)  # one row each

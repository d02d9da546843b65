"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

Documents become pieces of at most `capacity` tokens; full pieces are sequences of their own. The rest is dealt by hash
into shards of about SHARD pieces, so a task's work is bounded at any corpus size. A shard is packed on several islands
(tasks): each holds a population that starts from best fit, decreasing and in random orders; crossover injects whole
well-filled bins of one parent into the other, bins that hold a duplicate are emptied, displaced pieces take the place
of one or two smaller ones in other bins where that fills those better, and what is left over is put back by best fit. After each epoch an island's elite migrates to the next island through a shuffle.

Bins that are not nearly full (LOOSE) are then emptied and packed together at the next level, and so on until one shard
holds them all, or until that takes as many bins as before. So a shard's emptiest bin costs nothing yet, and the shard is
settled where no packing of what its other bins hold takes fewer: their waste is less than a bin. The last shard is
settled at the lower bound of all that it holds (tokens / capacity, rounded up). A shard that is settled stops.

Null and empty texts are documents of the end id alone. Repeated rows are packed once each. An empty table gives no rows.
"""

from __future__ import annotations

import os
import random
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklane.llm import common
from tracklane.llm.word_pieces import Pieces, ragged

CAPACITY, END_ID = 2048, 0
SHARD, ISLANDS, EPOCHS, POPULATION, GENERATIONS = 4096, 3, 4, 8, 8
#: Tasks of a level, where the session does not ask for more; a task holds several islands beyond that.
MOST_TASKS = 2000
#: Displaced pieces that may be swapped into bins at a time.
SWAPPED = 48
#: Bins filled less than this go on to the next level.
LOOSE = 0.995
#: Word pieces in one text for the library; bytes of text in one step of a task.
LINES, STEP_BYTES = 500, 12_000_000
_PIECES = "piece int, start bigint, length bigint, ids_crc32 bigint"


class Library:
    """Token ids from the tokenizer's library."""

    def __init__(self, path: str):
        # Spark runs one task a core; the library's own threads would only fight over them.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        # Pieces are lower-cased and split already: many of them, a line each, are one text for the merges alone.
        self.lines = Tokenizer(self.whole.model)
        self.lines.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split("\n", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        ids = self.whole.get_vocab()
        self.ends = np.zeros(max(ids.values()) + 1, bool)
        mark = self.whole.model.end_of_word_suffix
        self.ends[[i for x, i in ids.items() if mark and x.endswith(mark)]] = True

    def __call__(self, plain: list[str], whole: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.lines.encode_batch_fast(["\n".join(plain[k : k + LINES]) for k in range(0, len(plain), LINES)], add_special_tokens=False)
        lines = np.fromiter(chain.from_iterable(e.ids for e in found), np.uint32)
        sizes = np.diff(np.flatnonzero(self.ends[lines]), prepend=-1)
        if len(sizes) != len(plain):  # a piece without an end mark: its character is not in the vocabulary
            return self(([]), [*plain, *whole])
        rest = [e.ids for e in self.whole.encode_batch_fast(whole, add_special_tokens=False)]
        return np.concatenate([lines, np.fromiter(chain.from_iterable(rest), np.uint32)]), np.concatenate([sizes, np.fromiter(map(len, rest), np.int64, len(rest))])


@lru_cache(maxsize=2)
def piece_ids(path: str) -> Pieces:
    return Pieces(path, Library(path))


def pieces(df: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of each document's tokens, then `end_id`; one narrow stage.

    The vocabulary must cut at white space (a text's ids are then those of its words in turn).
    """
    schema = f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, {_PIECES}" + ", ids array<int>" * keep_ids
    names = [id_col, "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = piece_ids(vocabulary)
        for batch in batches:
            for part in common.slices(batch, "t", STEP_BYTES):
                words, at = common.split_words(part.column("t"))
                coded = words.dictionary_encode()
                ids, begin, size = own.of(coded.dictionary)
                code = coded.indices.to_numpy(zero_copy_only=False)
                sizes = size[code]
                flat = ragged(ids, begin[code], sizes)
                ends = np.concatenate([[0], np.cumsum(sizes)])[at[1:]]
                flat = np.ascontiguousarray(np.insert(flat, ends, end_id), dtype="<u4")
                length = np.diff(ends, prepend=0) + 1
                number = -(-length // capacity)
                row = np.repeat(np.arange(part.num_rows), number)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
                begins = np.repeat(np.cumsum(length) - length, number) + piece * capacity
                held = np.minimum(capacity, np.repeat(length, number) - piece * capacity)
                raw = memoryview(flat).cast("B")
                crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(begins.tolist(), held.tolist(), strict=True)]
                arrays = [part.column("i").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(piece * capacity, pa.int64()), pa.array(held, pa.int64()), pa.array(crc, pa.int64())]
                if keep_ids:
                    arrays.append(pa.ListArray.from_arrays(pa.array(np.append(begins, len(flat)), pa.int32()), pa.array(flat.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return df.select(df[id_col].alias("i"), df[text_col].alias("t")).mapInArrow(run, schema)


class Bins:
    """A packing under construction; bit f of `open` is set where some bin has f free."""

    def __init__(self, capacity: int):
        self.capacity, self.open = capacity, 0
        self.free: dict[int, list[int]] = {}
        self.items: list[list[int]] = []

    def add_bin(self, items: list[int], free: int) -> None:
        self.free.setdefault(free, []).append(len(self.items))
        self.items.append(items)
        self.open |= 1 << free

    def best_fit(self, item: int, size: int) -> None:
        fits = self.open >> size
        if not fits:
            return self.add_bin([item], self.capacity - size)
        f = size + (fits & -fits).bit_length() - 1
        own = self.free[f]
        b = own.pop()
        if not own:
            self.open ^= 1 << f
        self.items[b].append(item)
        self.free.setdefault(f - size, []).append(b)
        self.open |= 1 << (f - size)
        return None


Packing = list[list[int]]


def packed(order, sizes: list[int], capacity: int) -> Packing:
    bins = Bins(capacity)
    for i in order:
        bins.best_fit(i, sizes[i])
    return bins.items


def improved(kept: Packing, displaced: list[int], sizes: list[int], capacity: int) -> list[int]:
    """Change `kept` in place: one or two pieces of a bin give way to one or two displaced ones that fill it better.

    Returns what is displaced then. The biggest SWAPPED displaced pieces take part; all the others wait for best fit.
    """
    displaced = sorted(displaced, key=lambda i: -sizes[i])
    out, rest = displaced[:SWAPPED], displaced[SWAPPED:]

    def sums(items: list[int]) -> tuple[list[int], list[tuple[int, ...]]]:
        pairs = [(sizes[i] + sizes[j], (i, j)) for k, i in enumerate(items) for j in items[:k]]
        of = sorted([(sizes[i], (i,)) for i in items] + pairs)
        return [n for n, _ in of], [x for _, x in of]

    totals, sets = sums(out)
    for x in kept:
        free = capacity - sum(sizes[i] for i in x)
        if not free or not out:
            continue
        best = (0, (), ())
        for k, i in enumerate(x):
            for away in [(i,), *[(i, j) for j in x[:k]]]:
                gone = sum(sizes[j] for j in away)
                at = bisect_right(totals, gone + free) - 1
                if at >= 0 and totals[at] - gone > best[0]:
                    best = (totals[at] - gone, away, sets[at])
        if best[0]:
            _, away, new = best
            x[:] = [i for i in x if i not in away] + [*new]
            out = [i for i in out if i not in new] + [*away]
            totals, sets = sums(out)
    return out + rest


def replaced(kept: Packing, displaced: list[int], sizes: list[int], capacity: int) -> Packing:
    """`kept`, improved by displaced pieces, and the others by best fit, decreasing."""
    left = improved(kept, displaced, sizes, capacity)
    bins = Bins(capacity)
    for x in kept:
        bins.add_bin(x, capacity - sum(sizes[i] for i in x))
    for i in sorted(left, key=lambda i: -sizes[i]):
        bins.best_fit(i, sizes[i])
    return bins.items


def crossover(a: Packing, b: Packing, sizes: list[int], capacity: int, rng: random.Random) -> Packing:
    """`a` with some of the best-filled bins of `b` put in whole."""
    fullest = sorted(b, key=lambda x: -sum(sizes[i] for i in x))
    injected = fullest[: rng.randint(1, max(1, len(fullest) * 2 // 3))]
    inside = {i for x in injected for i in x}
    kept = [list(x) for x in injected] + [list(x) for x in a if inside.isdisjoint(x)]
    displaced = [i for x in a if not inside.isdisjoint(x) for i in x if i not in inside]
    return replaced(kept, displaced, sizes, capacity)


def mutated(a: Packing, sizes: list[int], capacity: int, rng: random.Random) -> Packing:
    """`a` with its emptiest bins and a few others emptied, their pieces put back."""
    by_fill = sorted(a, key=lambda x: sum(sizes[i] for i in x))
    gone = min(len(a), 2 + rng.randint(0, 4))
    rest = by_fill[gone:]
    rng.shuffle(rest)
    return replaced([list(x) for x in rest[gone:]], [i for x in by_fill[:gone] + rest[:gone] for i in x], sizes, capacity)


def settled(packing: Packing, sizes: list[int], capacity: int, last: bool = True) -> bool:
    """No packing of its pieces takes fewer bins; where loose bins go on (not last), of the pieces outside of its emptiest bin."""
    waste = [capacity - sum(sizes[i] for i in x) for x in packing]
    return sum(waste) - (0 if last else max(waste, default=0)) < capacity


def evolve(sizes: list[int], elites: list[Packing], capacity: int, seed: int, last: bool = True) -> Packing:
    """The best packing after GENERATIONS of one island, or the first that is settled."""
    rng = random.Random(seed)
    # Fewer bins first; of equals the one with the fullest full bins, which leave the most room elsewhere.
    worth = lambda p: (len(p), -sum(sum(sizes[i] for i in x) ** 2 for x in p))
    falling = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    people = [*elites] or [packed(falling, sizes, capacity)]
    if settled(first := min(people, key=worth), sizes, capacity, last):
        return first
    while len(people) < POPULATION:
        order = falling[:]
        # A few swaps keep the decreasing order's quality but give another packing.
        for _ in range(max(1, len(order) // 8)):
            i = rng.randrange(len(order))
            j = min(len(order) - 1, i + rng.randint(1, 32))
            order[i], order[j] = order[j], order[i]
        people.append(packed(order, sizes, capacity))
    for _ in range(GENERATIONS):
        people.sort(key=worth)
        if settled(people[0], sizes, capacity, last):
            break
        keep = people[: POPULATION // 2]
        people = keep + [mutated(crossover(*rng.sample(keep, 2), sizes, capacity, rng), sizes, capacity, rng) for _ in range(POPULATION - len(keep))]
    return min(people, key=worth)


_STATE = "shard bigint, island int, rid bigint, length bigint, bin int, offset bigint, fill bigint, bins int, settled boolean"


def _island(capacity: int, last: bool):
    """One epoch of the island that `group` holds: its pieces once for each elite that it begins with (elite -1: none)."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["rid", "elite"], kind="stable")
        one = group[group["elite"] == group["elite"].iloc[0]]
        sizes = one["length"].tolist()
        elites = []
        for _, own in group[group["elite"] >= 0].groupby("elite"):
            got: dict[int, list[int]] = {}
            for i, b in enumerate(own["bin"].tolist()):
                got.setdefault(b, []).append(i)
            elites.append(list(got.values()))
        shard, island = int(one["shard"].iloc[0]), int(one["island"].iloc[0])
        best = evolve(sizes, elites, capacity, shard * 1009 + island + 7919 * len(elites), last)
        order = [i for x in best for i in x]
        length = np.array(sizes, np.int64)[order]
        bin_of = np.repeat(np.arange(len(best)), [len(x) for x in best])
        before = np.cumsum(length) - length
        first = np.flatnonzero(np.diff(bin_of, prepend=-1))
        fill = np.add.reduceat(length, first)
        return pd.DataFrame({
            "shard": shard, "island": np.int32(island), "rid": one["rid"].to_numpy()[order], "length": length, "bin": bin_of.astype(np.int32), "offset": before - before[first][bin_of],
            "fill": fill[bin_of], "bins": np.int32(len(best)), "settled": settled(best, sizes, capacity, last),
        })

    return run


def _level(items: DataFrame, n: int, capacity: int, level: int) -> DataFrame:
    """One level over (rid, length): the best island's state of every shard."""
    last = n <= SHARD
    shards = max(1, ceil(n / SHARD))
    every = F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])).alias("island")
    # Islands are few bytes and much work: a named number of partitions keeps Spark from putting them together.
    parts = min(shards * ISLANDS, max(int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")), MOST_TASKS))
    islands = lambda df: df.repartition(parts, "shard", "island").groupBy("shard", "island").applyInPandas(_island(capacity, last), _STATE)
    dealt = items.select(F.pmod(F.xxhash64("rid", F.lit(level)), F.lit(shards)).alias("shard"), "rid", "length")
    start = dealt.select("shard", every, "rid", "length", F.lit(-1).alias("bin"), F.lit(-1).alias("elite"))
    state = common.cut(islands(start))
    best = lambda s: s.groupBy("shard").agg(F.min_by("island", F.struct(~F.col("settled"), "bins", "island")).alias("island"), F.bool_or("settled").alias("settled"))
    for _ in range(EPOCHS - 1):
        unsolved = best(state).filter("NOT settled").select("shard")
        own = state.join(unsolved, "shard", "left_semi")
        cols = ["shard", "island", "rid", "length", "bin"]
        migrants = own.select("shard", ((F.col("island") + 1) % ISLANDS).alias("island"), "rid", "length", "bin", F.lit(1).alias("elite"))
        moved = own.select(*cols, F.lit(0).alias("elite")).union(migrants)
        again = islands(moved)
        state = common.cut(state.join(unsolved, "shard", "left_anti").select(*again.columns).union(again))
    chosen = best(state).select("shard", "island")
    return state.join(chosen, ["shard", "island"], "left_semi").select("shard", "rid", "length", "bin", "offset", "fill")


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(rid, sequence_id, offset) for (rid unique, length <= capacity) rows; sequence ids are below 0 for full pieces."""
    full = items.filter(F.col("length") >= capacity).select("rid", (-1 - F.col("rid")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    rest, out, level = items.filter(F.col("length") < capacity).select("rid", "length"), full, 0
    n, columns = rest.count(), ["rid", "sequence_id", "offset"]
    before = None  # the loose bins of the level before, as they are, and how many
    while n:
        state = common.cut(_level(rest, n, capacity, level))
        placed = state.select("rid", (F.lit(level << 56) + F.call_function("shiftleft", F.col("shard"), F.lit(20)) + F.col("bin")).alias("sequence_id"), "offset", "length", "fill")
        firm, begins = F.col("fill") >= LOOSE * capacity, F.col("offset") == 0
        found = state.agg(F.count_if(begins).alias("bins"), F.count_if(begins & ~firm).alias("loose"), F.count_if(~firm).alias("left")).first()
        if before is not None and found.bins >= before[1]:
            return out.union(before[0])
        if n <= SHARD:
            return out.union(placed.select(*columns))
        out, before = out.union(placed.filter(firm).select(*columns)), (placed.filter(~firm).select(*columns), found.loose)
        rest, n, level = placed.filter(~firm).select("rid", "length"), found.left, level + 1
    return out


def pack_documents(df: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of all documents with the sequence and the place in it that each got."""
    # The number of each row is written with it, so that later reads agree.
    cut = common.cut(pieces(df, vocabulary, capacity, end_id, keep_ids, id_col, text_col).withColumn("_rid", F.monotonically_increasing_id()))
    where = pack(cut.select(F.col("_rid").alias("rid"), "length"), capacity)
    return cut.join(where, cut["_rid"] == where["rid"]).drop("_rid", "rid")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(common.table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))

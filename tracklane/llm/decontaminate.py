"""Benchmark decontamination by greedy string tiling.

Texts become runs of word hashes (lower case, letters and digits only). Documents and benchmark items that share a seed,
`least` words in a row, are joined on the seed; each such pair is tiled: the longest unmarked common runs are found by a
running Karp-Rabin hash and marked, longest first, down to runs of `least` words, so reordered passages still add up. A
document is contaminated where the tiles cover at least `threshold` of some item's words. An item of fewer words than
`least` has one seed, all of its words, and one tile.

Only pairs that can reach a coverage of `floor` are tiled, and found by few seeds. Tiles that cover c words hold at least
c / least of the item's seeds, so a pair that reaches the floor shares one even when an item's most frequent seeds, one
less than that number, are left out of the join; a stock phrase of many documents and items is thus no key of the join.
Then the words inside shared seeds bound the coverage from above, and a pair below the floor is not tiled. Items of equal
words are one item, that of the least id. For documents whose best item stays below the floor no item is named.

Before the join, document seeds pass a bitmap of the items' seeds, of about BITS_A_SEED bits a seed and two hash
functions, at most MAX_BITS in all; it lets no true seed fail, and the join is exact. Of a document only the words inside
seeds that passed are kept, since a tile holds no other word: texts are never shuffled.

Null and empty texts share no seed. Repeated rows are judged one by one; of several items of equal coverage the least id
is named. Very long texts are like any others. Empty tables: no documents, no rows; no items, nothing contaminated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracklane.llm import common

LEAST, THRESHOLD = 5, 0.8
#: The bitmap: bits for each seed of the items, and bounds of their number (8 MB).
BITS_A_SEED, MIN_BITS, MAX_BITS = 256, 1 << 20, 1 << 26
_BASE = 0x9E3779B97F4A7C15  # odd: the hash's multiplier modulo 2^64


def token_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the texts' words without marks (never 0), flat, and each text's offsets."""
    words, at = common.split_words(pc.utf8_lower(pc.fill_null(texts, "")))
    coded = words.dictionary_encode()
    bare = pc.replace_substring_regex(coded.dictionary, r"[^\p{L}\p{N}]+", "").cast(pa.binary()).to_pylist()
    own = np.fromiter((xxhash.xxh64_intdigest(w, 17) | 1 if w else 0 for w in bare), np.uint64, len(bare))
    h = own[coded.indices.to_numpy(zero_copy_only=False)] if len(words) else np.empty(0, np.uint64)
    full = h != 0
    return h[full], np.concatenate([[0], np.cumsum(full)])[at]


def seed_hashes(h: np.ndarray, at: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Karp-Rabin hashes of all runs of `least` words inside a text, and where they start."""
    n = len(h) - least + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(least):
            out = out * np.uint64(_BASE) + h[k : k + n]
    start = np.flatnonzero(np.arange(n) + least <= np.repeat(at[1:], np.diff(at))[:n])
    return out[start], start


def tile(p: list[int], t: list[int], least: int, first: int = 32) -> list[tuple[int, int, int]]:
    """Tiles (start in p, start in t, length) of the greedy string tiling of p and t; 0 in t matches nothing."""
    used_p, used_t, tiles, size = bytearray(len(p)), bytearray(len(t)), [], max(first, least)
    mod = (1 << 61) - 1

    def windows(x: list[int], used: bytearray, n: int) -> Iterator[tuple[int, int]]:
        top, h, free = pow(_BASE, n, mod), 0, 0
        for i, w in enumerate(x):
            free = 0 if used[i] or not w else free + 1
            h = (h * _BASE + w) % mod if free > 1 else w % mod
            if free > n:
                h = (h - x[i - n] * top) % mod
            if free >= n:
                yield i - n + 1, h

    while True:
        at: dict[int, list[int]] = {}
        for i, h in windows(p, used_p, size):
            at.setdefault(h, []).append(i)
        found: dict[int, list[tuple[int, int]]] = {}
        for j, h in windows(t, used_t, size) if at else ():
            for i in at.get(h, ()):
                if i and j and p[i - 1] == t[j - 1] and not used_p[i - 1] and not used_t[j - 1]:
                    continue  # the same run, found from its start
                n = 0
                while i + n < len(p) and j + n < len(t) and p[i + n] == t[j + n] and not used_p[i + n] and not used_t[j + n]:
                    n += 1
                if n >= size:
                    found.setdefault(n, []).append((i, j))
        while found:
            n = max(found)
            for i, j in sorted(found.pop(n)):
                # What an earlier tile has taken is cut off; what remains waits for its own length.
                run = None
                for k in range(n + 1):
                    if k < n and not used_p[i + k] and not used_t[j + k]:
                        run = k if run is None else run
                    elif run is not None:
                        if run == 0 and k == n:
                            tiles.append((i, j, n))
                            used_p[i : i + n] = used_t[j : j + n] = b"\1" * n
                        elif k - run >= size:
                            found.setdefault(k - run, []).append((i + run, j + run))
                        run = None
        if size == least:
            return tiles
        size = max(least, size // 2)


def seeds_of(h: np.ndarray, at: np.ndarray, sizes: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray | int]:
    """Hashes of all runs of each of `sizes` words inside a text, where they start and their sizes, by start."""
    with np.errstate(over="ignore"):
        marked = lambda s, n: s * np.uint64(2) + np.uint64(n) * np.uint64(_BASE)
        found = [(marked(s, n), start, n) for n in sizes for s, start in [seed_hashes(h, at, n)]]
    if len(found) == 1:
        return found[0]
    s, start = (np.concatenate([f[k] for f in found]) for k in (0, 1))
    size = np.repeat(sizes, [len(f[0]) for f in found])
    order = np.argsort(start, kind="stable")
    return s[order], start[order], size[order]


def _items(benchmark: DataFrame, least: int) -> DataFrame:
    """(item, item_id, p, n, seeds) of the benchmark's different items; written once. A short item's one seed is all of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, "t"):
                h, at = token_hashes(part.column("t"))
                seeds = []
                for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                    own = h[a:b]
                    seeds.append(seeds_of(own, np.array([0, b - a]), [min(least, b - a)])[0].view(np.int64) if b > a else np.empty(0, np.int64))
                toks = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("id"), toks, pa.array(seeds, pa.list_(pa.int64()))], names=["id", "p", "seeds"])

    schema = f"id {benchmark.schema['id'].dataType.simpleString()}, p array<bigint>, seeds array<bigint>"
    rows = benchmark.mapInArrow(run, schema).filter(F.size("p") > 0)
    distinct = rows.groupBy(F.sha2(F.concat_ws(",", F.transform("p", lambda x: x.cast("string"))), 256).alias("key")).agg(F.min("id").alias("item_id"), F.first("p").alias("p"), F.first("seeds").alias("seeds"))
    return common.cut(distinct.drop("key").withColumn("item", F.monotonically_increasing_id()).withColumn("n", F.size("p")))


def _place(s: np.ndarray, bits: int, k: int) -> np.ndarray:
    """The k-th place (0 or 1) of each seed among `bits`."""
    with np.errstate(over="ignore"):
        return (s if k == 0 else s * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(32)) & np.uint64(bits - 1)


def _bitmap(seeds: DataFrame, n: int) -> np.ndarray:
    """The bitmap of column `seed`, n in number: at most MAX_BITS / 64 rows come to the driver, as Arrow."""
    bits = MIN_BITS
    while bits < min(MAX_BITS, BITS_A_SEED * n):
        bits *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = batch.column("seed").to_numpy(zero_copy_only=False).view(np.uint64)
            place = np.concatenate([_place(s, bits, k) for k in (0, 1)])
            yield pa.RecordBatch.from_arrays([pa.array((place >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (place & np.uint64(63))).view(np.int64))], names=["at", "bit"])

    rows = seeds.select("seed").mapInArrow(run, "at bigint, bit bigint").groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return out.view(np.uint64)


def _parts(docs: DataFrame, bitmap: np.ndarray, sizes: list[int]) -> DataFrame:
    """(uid, id, toks, seeds) of every document (id, t): the words inside seeds that pass the bitmap, 0 between runs."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)  # of at most MAX_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        here = lambda place: (bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) != 0
        for batch in batches:
            for part in common.slices(batch, "t"):
                h, at = token_hashes(part.column("t"))
                s, start, size = seeds_of(h, at, sizes)
                hit = np.flatnonzero(here(_place(s, len(bits) * 64, 0)))
                hit = hit[here(_place(s[hit], len(bits) * 64, 1))]
                s, start, size = s[hit], start[hit], size[hit] if isinstance(size, np.ndarray) else size
                inside = np.zeros(len(h) + 1, np.int64)
                np.add.at(inside, start, 1)
                np.add.at(inside, start + size, -1)
                inside = np.cumsum(inside[:-1]) > 0
                toks, seeds, first = [], [], np.searchsorted(start, at)
                for k in range(part.num_rows):
                    a, b = first[k], first[k + 1]
                    if a == b:
                        toks.append(None)
                        seeds.append(None)
                        continue
                    mine = np.flatnonzero(inside[at[k] : at[k + 1]]) + at[k]
                    breaks = np.flatnonzero(np.diff(mine) > 1) + 1
                    toks.append(np.insert(h[mine].view(np.int64), breaks, 0))
                    seeds.append(np.unique(s[a:b]).view(np.int64))
                kind = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(toks, kind), pa.array(seeds, kind)], names=["id", "toks", "seeds"])

    schema = f"id {docs.schema['id'].dataType.simpleString()}, toks array<bigint>, seeds array<bigint>"
    return common.cut(docs.mapInArrow(run, schema).withColumn("uid", F.monotonically_increasing_id()))


def candidates(some: DataFrame, items: DataFrame, least: int, floor: float) -> DataFrame:
    """(uid, item) of all pairs of documents (uid, seeds) and items that can reach a coverage of `floor`; and some others."""
    held = some.select("uid", F.explode("seeds").alias("seed"))
    of_items = items.select("item", "n", F.explode("seeds").alias("seed")).groupBy("item", "n", "seed").agg(F.count("*").alias("times"))
    often = held.groupBy("seed").agg(F.count("*").alias("often"))
    known = of_items.join(often, "seed")
    # Of its most frequent seeds an item leaves out as many as do not matter: one less than must be shared.
    w = W.partitionBy("item").orderBy(F.desc("often"), "seed").rowsBetween(W.unboundedPreceding, W.currentRow)
    spare = F.ceil(F.lit(floor) * F.col("n") / F.least(F.lit(least), F.col("n"))) - 1
    index = known.withColumn("before", F.sum("times").over(w)).filter(F.col("before") > spare).select("seed", "item")
    return held.join(index, "seed").select("uid", "item").distinct()


def contamination(
    docs: DataFrame, benchmark: DataFrame, least: int = LEAST, threshold: float = THRESHOLD, floor: float | None = None,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(id, item, n_tiles, n_covered, n_item_words, coverage, contaminated) for each document.

    item is the one covered most; null, with zeros, where none is covered by `floor` (half of the threshold if not given).
    """
    floor = threshold / 2 if floor is None else min(floor, threshold)
    items = _items(benchmark.select(benchmark[item_col].alias("id"), benchmark[item_text_col].alias("t")), least)
    seeds = items.select(F.explode("seeds").alias("seed")).distinct()
    # Sizes of seeds: `least`, and those of the items that are shorter.
    sizes = sorted({least, *(r.n for r in items.filter(F.col("n") < least).select("n").distinct().collect())})
    own = docs.select(docs[id_col].alias("id"), docs[text_col].alias("t"))
    parts = _parts(own, _bitmap(seeds, seeds.count()), sizes)
    some = parts.filter(F.col("seeds").isNotNull())
    pairs = candidates(some, items, least, floor)
    texts = items.select("item", "item_id", "p")
    both = pairs.join(some.select("uid", F.col("toks").alias("t")), "uid").join(texts, "item")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = []
            for k in range(batch.num_rows):
                p, t = (batch.column(c)[k].values.to_numpy() for c in "pt")
                size = min(least, len(p))
                # What the tiles can cover at most: the words inside seeds that the text has too.
                (a, i, _), (b, _, _) = (seeds_of(x.view(np.uint64), np.array([0, len(x)]), [size]) for x in (p, t))
                inside = np.zeros(len(p) + 1, np.int64)
                i = i[np.isin(a, b)]
                np.add.at(inside, i, 1)
                np.add.at(inside, i + size, -1)
                if (np.cumsum(inside[:-1]) > 0).sum() < floor * len(p):
                    got.append((0, 0, len(p)))
                    continue
                tiles = tile(p.tolist(), t.tolist(), size)
                got.append((len(tiles), sum(n for _, _, n in tiles), len(p)))
            cols = [pa.array([g[k] for g in got], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("item_id"), *cols], names=["uid", "item_id", "n_tiles", "n_covered", "n_item_words"])

    kind = texts.schema["item_id"].dataType.simpleString()
    tiled = both.select("uid", "item_id", "p", "t").mapInArrow(run, f"uid bigint, item_id {kind}, n_tiles bigint, n_covered bigint, n_item_words bigint")
    tiled = tiled.withColumn("coverage", F.col("n_covered") / F.col("n_item_words")).filter(F.col("coverage") >= floor)
    best = tiled.groupBy("uid").agg(F.min_by(F.struct("item_id", "n_tiles", "n_covered", "n_item_words", "coverage"), F.struct(-F.col("coverage"), F.col("item_id"))).alias("b"))
    zero = lambda k: F.coalesce(F.col("b")[k], F.lit(0).cast("bigint")).alias(k)
    return parts.select("uid", "id").join(best, "uid", "left").select(
        F.col("id").alias(id_col), F.col("b.item_id").alias(item_col), zero("n_tiles"), zero("n_covered"), zero("n_item_words"),
        F.coalesce(F.col("b.coverage"), F.lit(0.0)).alias("coverage"), F.coalesce(F.col("b.coverage") >= threshold, F.lit(False)).alias("contaminated"),
    )


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(common.table(spark, sf_dir, "documents", "doc_id", "text"), common.table(spark, sf_dir, "benchmark", "item_id", "text"), floor=THRESHOLD)

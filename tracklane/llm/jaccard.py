"""Near-duplicates of a corpus: all pairs of texts whose 5-word shingle sets have a Jaccard similarity of 0.8 or more.

A prefix-filtered join. Shingles have one order over the corpus, rare ones first by a counting sketch of fixed size, equal
ones by hash. Of a set of n shingles the first n - ceil(0.8 n) + 1 are its prefix; two sets of similarity 0.8 or more share
a shingle of their prefixes, and at the first one they share, what is left of either set still reaches the overlap needed.
The sketch decides the order only: any order gives the same pairs, a good one few candidates.

Buckets are the shingles that prefixes of different sets share. Pairs that links known before join already need no check.
Buckets of up to SMALL sets compare all others; in larger ones all sets are compared with the most central one, which is
then done with, and only buckets that still hold different components go on. After ROUNDS such rounds what is left is
compared pair by pair, so every pair is either joined already or checked; that last step is quadratic in the sets of one
bucket that are similar to none of its central ones. Of a pair first the sets' histograms are compared, CELLS counts of
shingles by hash: two sets share no more than the sum of the lesser counts, and where that is too little the pair goes
without its sets. All other checks are exact on the sets of 64-bit shingle hashes. Texts of pairs are found by their ids in
a bitmap of fixed size first, so that the others are not shuffled for that.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklane.llm import common, simhash_dedup
from tracklane.llm.components import components

SHINGLE, SMALL, ROUNDS = 5, simhash_dedup.SMALL, 4
#: Slots of the counting sketch, and how many of them one row of a partial sketch holds.
SLOTS, CHUNK = 1 << 18, 1 << 12
#: Counts in a set's histogram, of 16 bits each; CELL_BITS first bits of a hash name the cell.
CELL_BITS = 7
CELLS = 1 << CELL_BITS
#: Bits of the map by which most texts that no pair needs are told before a shuffle; a row of it while it is made holds MAP_ROW.
MAP, MAP_ROW = 1 << 23, 1 << 15
_SLICE = 2_000_000


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text in rising order, flat, and each text's offsets."""
    h, at = simhash_dedup.shingle_hashes(*common.split_words(texts, lower=True), SHINGLE)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    by = np.lexsort((h, row))
    h, row = h[by], row[by]
    if len(h):
        first = np.concatenate([[True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])])
        h, row = h[first], row[first]
    return h, np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(at) - 1))])


def sketch(texts: DataFrame) -> np.ndarray:
    """How many shingles of all texts (column t) fall in each slot."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for part in common.slices(batch, "t", _SLICE):
                total += np.bincount((shingle_sets(part.column("t"))[0] & np.uint64(SLOTS - 1)).astype(np.int64), minlength=SLOTS)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(SLOTS // CHUNK), pa.int32()), pa.array([x.tobytes() for x in total.reshape(-1, CHUNK)], pa.binary())], names=["k", "n"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(CHUNK, np.int64)
        for x in table.column("n"):
            total += np.frombuffer(x.as_py(), np.int64)
        return pa.table({"k": table.column("k").slice(0, 1), "n": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros((SLOTS // CHUNK, CHUNK), np.int64)
    for r in texts.mapInArrow(count, "k int, n binary").groupBy("k").applyInArrow(add, "k int, n binary").collect():
        out[r.k] = np.frombuffer(r.n, np.int64)
    return out.reshape(-1)


def histograms(h: np.ndarray, row: np.ndarray, n: int) -> list[bytes]:
    """How many of each of n sets' hashes fall in each cell. A set with a count of over 16 bits has the most in all: no bound."""
    counts = np.bincount(row * CELLS + (h >> np.uint64(64 - CELL_BITS)).astype(np.int64), minlength=n * CELLS).reshape(n, CELLS)
    counts[(counts >= 1 << 16).any(1)] = (1 << 16) - 1
    return [x.tobytes() for x in counts.astype(np.uint16)]


@functools.lru_cache(maxsize=1)
def _shared_at_most():
    """A UDF: the sum of the lesser counts of two histograms. Made when it is used: that needs a session."""

    def bound(a: pa.Array, b: pa.Array) -> pa.Array:
        x, y = (np.frombuffer(b"".join(c.to_pylist()), np.uint16).reshape(-1, CELLS) for c in (a, b))
        return pa.array(np.minimum(x, y).sum(1, dtype=np.int64))

    return F.arrow_udf(bound, "bigint")


def prefixes(rows: DataFrame, counts: np.ndarray, id_col: str) -> DataFrame:
    """(id, fp, sid, n, central, prefix, cells): SimHash, name and size of the shingle set, mean log count of its shingles, its prefix, its histogram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, "t", _SLICE):
                fp = simhash_dedup.simhash(*simhash_dedup.shingle_hashes(*common.split_words(part.column("t"), lower=True), 3))
                h, at = shingle_sets(part.column("t"))
                n = np.diff(at)
                seen = counts[(h & np.uint64(SLOTS - 1)).astype(np.int64)]
                row = np.repeat(np.arange(len(n)), n)
                ordered = h[np.lexsort((h, seen, row))]
                size = np.where(n > 0, n - (4 * n + 4) // 5 + 1, 0)
                head = ordered[np.arange(len(h)) - np.repeat(at[:-1], n) < np.repeat(size, n)]
                central = common.sums(np.log1p(seen), at) / np.maximum(n, 1)
                sid = np.array([xxhash.xxh64_intdigest(h[a:b].tobytes(), simhash_dedup.SEED) for a, b in zip(at[:-1], at[1:], strict=True)], np.uint64)
                heads = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(head.view(np.int64)))
                cells = pa.array(histograms(h, row, len(n)), pa.binary())
                arrays = [part.column("i"), pa.array(fp.view(np.int64)), pa.array(sid.view(np.int64)), pa.array(n.astype(np.int32)), pa.array(central), heads, cells]
                yield pa.RecordBatch.from_arrays(arrays, names=[id_col, "fp", "sid", "n", "central", "prefix", "cells"])

    schema = f"`{id_col}` {rows.schema['i'].dataType.simpleString()}, fp bigint, sid bigint, n int, central double, prefix array<bigint>, cells binary"
    return rows.mapInArrow(run, schema)


def full_sets(rows: DataFrame) -> DataFrame:
    """(sid, fp, all): the whole shingle set of each (sid, fp, t)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, "t", _SLICE):
                h, at = shingle_sets(part.column("t"))
                sets = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("sid"), part.column("fp"), sets], names=["sid", "fp", "all"])

    return rows.mapInArrow(run, "sid bigint, fp bigint, all array<bigint>")


def possible(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """All rows of `texts` whose id (column i) is in `wanted`, and some others: no more than share a bit of a map of MAP bits."""
    slot = F.pmod(F.xxhash64("i"), F.lit(MAP))
    part = wanted.select(slot.alias("k")).groupBy(F.floor(F.col("k") / MAP_ROW).alias("part"))
    bits = np.zeros((MAP // MAP_ROW, MAP_ROW // 8), np.uint8)
    for r in part.agg(F.bitmap_construct_agg(F.col("k") % MAP_ROW).alias("bits")).collect():
        bits[r.part] = np.frombuffer(r.bits, np.uint8)
    bits = bits.reshape(-1)

    def there(k: pa.Array) -> pa.Array:
        x = k.to_numpy(zero_copy_only=False)
        return pa.array((bits[x >> 3] >> (x & 7).astype(np.uint8) & 1).astype(bool))

    return texts.filter(F.arrow_udf(there, "boolean")(slot))


def _candidates(met: DataFrame, buckets: DataFrame, small: int | None) -> DataFrame:
    """Distinct pairs (a, b) of sets to check: all of buckets up to `small` (None: of any size), of others those with the leader."""
    left = met.join(buckets, "h")
    right = met.select("h", F.col("sid").alias("sid_b"), F.col("n").alias("n_b"), F.col("pos").alias("pos_b"), F.col("root").alias("root_b"))
    # At the first shingle that two sets share, the rest of each must hold 4/9 of both sizes: Jaccard 0.8.
    reach = 9 * F.least(F.col("n") - F.col("pos"), F.col("n_b") - F.col("pos_b")) >= 4 * (F.col("n") + F.col("n_b"))
    pick = lambda x, y: x.join(y, "h").filter(reach & (F.col("root") != F.col("root_b")))
    few = left if small is None else left.filter(F.col("members") <= small)
    pairs = pick(few, right).filter("sid < sid_b").select(F.col("sid").alias("a"), F.col("sid_b").alias("b"))
    if small is not None:
        led = pick(left.filter((F.col("members") > small) & (F.col("sid") == F.col("leader.sid"))), right)
        pairs = pairs.union(led.select(F.least("sid", "sid_b").alias("a"), F.greatest("sid", "sid_b").alias("b")))
    return pairs.distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", small: int = SMALL, rounds: int = ROUNDS) -> DataFrame:
    """(id, component_id): the least id of each row's component under SimHash links of radius 2 and Jaccard links of 0.8.

    Ids must be told apart by their text: one id stands for one text.
    """
    texts = df.select(df[id_col].alias("i"), df[text_col].alias("t"))
    rows = common.cut(prefixes(texts, sketch(texts.select("t")), "id"))
    least = common.cut(rows.groupBy("fp").agg(F.min("id").alias("least")))
    # Sets of equal shingles may still differ in fingerprint: their order or repeats differ.
    sets = common.cut(rows.groupBy("sid").agg(F.min("fp").alias("fp"), F.min("id").alias("id"), F.first("n").alias("n"), F.first("central").alias("central"), F.first("prefix").alias("prefix"), F.first("cells").alias("cells")))
    # The prefixes of repeated sets are not needed again.
    whole, rows = rows, common.cut(rows.select("id", "fp", "sid"))
    common.discard(whole)
    alike = rows.select("sid", F.col("fp").alias("a")).distinct().join(sets.select("sid", F.col("fp").alias("b")), "sid").filter("a <> b").select("a", "b")
    edges = common.cut(simhash_dedup.links(least.select("fp")).select("a", "b").union(alike))
    tree = common.cut(components(edges))

    def rooted(met: DataFrame) -> DataFrame:
        out = common.cut(met.drop("root").join(tree.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp")))
        common.discard(met)
        return out

    # Most shingles are in one set's prefix only: what else is known of a set is put to the others, once they are found.
    # They are found by the shingles alone, since a set has each once, and written, so that this shuffle's files go before the next.
    one = sets.select("sid", F.posexplode("prefix").alias("pos", "h"))
    shared = common.cut(one.groupBy("h").agg(F.count("*").alias("members")).filter("members > 1").select("h"))
    places = common.cut(one.join(shared, "h"))
    common.discard(shared)
    met = common.cut(places.join(sets.select("sid", "fp", "n", "central"), "sid"))
    common.discard(places)
    cells = sets.select("sid", "n", "cells")
    side = lambda x: cells.select(F.col("sid").alias(x), F.col("n").alias(f"n_{x}"), F.col("cells").alias(f"cells_{x}"))
    for k in range(rounds + 1):
        met = rooted(met)
        across = met.groupBy("h").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("members"), F.max(F.struct("central", "sid")).alias("leader")).filter("lo < hi")
        buckets = common.cut(across.select("h", "members", "leader"))
        if buckets.isEmpty():
            break
        # The pairs come first: whole sets are made, and travel, only for texts of pairs that share enough by their histograms.
        close = 9 * _shared_at_most()("cells_a", "cells_b") >= 4 * (F.col("n_a") + F.col("n_b"))
        pairs = common.cut(_candidates(met, buckets, None if k == rounds else small).join(side("a"), "a").join(side("b"), "b").filter(close).select("a", "b"))
        wanted = common.cut(pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct().join(sets.select("sid", "fp", F.col("id").alias("i")), "sid"))
        if not wanted.isEmpty():
            full = common.cut(full_sets(possible(texts, wanted).join(wanted, "i").dropDuplicates(["i"]).select("sid", "fp", "t")))
            of = lambda x: full.select(F.col("sid").alias(x), F.col("fp").alias(f"fp_{x}"), F.col("all").alias(f"all_{x}"))  # noqa: E731, B023
            both = F.size(F.array_intersect("all_a", "all_b"))
            found = common.cut(pairs.join(of("a"), "a").join(of("b"), "b").filter(9 * both >= 4 * (F.size("all_a") + F.size("all_b"))).select(F.col("fp_a").alias("a"), F.col("fp_b").alias("b")))
            common.discard(full)
            tree = common.cut(components(tree.select(F.col("node").alias("a"), F.col("root").alias("b")).union(found)))
        if k == rounds:
            break
        met = met.join(buckets.filter(F.col("members") > small), "h").filter("sid <> leader.sid").drop("members", "leader")
    labels = common.cut(least.join(tree, least["fp"] == tree["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))
    out = labels.join(labels.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return rows.select("id", "fp").join(out, "fp").select(F.col("id").alias(id_col), "component_id")

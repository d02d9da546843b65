"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints of 64 bits come from one narrow Arrow stage. Each bit position gets one of the 2^(r+1)-1 nonzero vectors of
r+1 bits; table v keeps the positions whose vector has an odd product with v. Any r or fewer positions miss at least one
v, so two fingerprints within radius r agree on all kept positions of that table: every such pair meets in a bucket.

Distinct fingerprints only are put in buckets. Buckets of up to SMALL members compare their members; in larger ones
members meet through common one-bit neighbours: two fingerprints are within 2 bits exactly when some value is within
one bit of both, so linking each member to those values joins the same components with a number of links linear in the
bucket, for any size.

Null and empty texts have fingerprint 0 and link like any other. A null id never is the least id of a component that has
another; a component of null ids only has a null id. Repeated rows each keep their row. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklane.llm import common
from tracklane.llm.components import components

BITS, RADIUS, SEED = 64, 2, 42
#: Members up to which a bucket's pairs are compared one by one.
SMALL = 24


def shingle_hashes(words: pa.Array, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of each text's shingles, flat, and each text's offsets. Texts of fewer words give one: the whole of them."""
    n = np.diff(at)
    if len(words) >= size:
        starts = np.flatnonzero(np.arange(len(words)) + size <= np.repeat(at[1:], n))
        whole = pc.binary_join_element_wise(*[words.slice(k, len(words) - size + 1) for k in range(size)], " ").take(pa.array(starts))
        h = np.fromiter((xxhash.xxh64_intdigest(x, SEED) for x in whole.cast(pa.binary()).to_pylist()), np.uint64, len(starts))
    else:
        starts, h = np.empty(0, np.int64), np.empty(0, np.uint64)
    each = np.maximum(n - size + 1, 0)
    if len(short := np.flatnonzero((n > 0) & (n < size))):
        own = [xxhash.xxh64_intdigest(" ".join(words.slice(at[i], n[i]).to_pylist()).encode(), SEED) for i in short]
        h = np.insert(h, np.concatenate([[0], np.cumsum(each)])[short], np.array(own, np.uint64))
        each[short] = 1
    return h, np.concatenate([[0], np.cumsum(each)])


def simhash(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A fingerprint for each range of hashes: a bit is set where over half of them have it; 0 for an empty range."""
    n = np.diff(at)
    out = np.zeros(len(n), np.uint64)
    if full := np.flatnonzero(n).tolist():
        ones = np.add.reduceat(np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"), at[full], axis=0, dtype=np.int32)
        out[full] = np.packbits(ones * 2 > n[full, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def fingerprints(df: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp long) of each row: words are lower-cased (A-Z) and cut at ASCII white space."""
    schema = f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, fp bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, "t", 2_000_000):
                h, at = shingle_hashes(*common.split_words(part.column("t"), lower=True), shingle)
                yield pa.RecordBatch.from_arrays([part.column("i"), pa.array(simhash(h, at).view(np.int64))], names=[id_col, "fp"])

    return df.select(df[id_col].alias("i"), df[text_col].alias("t")).mapInArrow(run, schema)


def covering_masks(bits: int = BITS, radius: int = RADIUS) -> list[int]:
    """One mask for each nonzero v of radius + 1 bits; any `radius` positions lie outside of at least one mask."""
    count = 2 ** (radius + 1)
    vector = [1 + i % (count - 1) for i in range(bits)]
    return [sum(1 << i for i, m in enumerate(vector) if (m & v).bit_count() % 2) for v in range(1, count)]


def _long(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame, radius: int = RADIUS, small: int = SMALL) -> DataFrame:
    """Edges (a, b) over the distinct values of column fp whose components are those of "within `radius` bits".

    A value that is nobody's fingerprint may stand between two fingerprints (see above). Only radius 1 and 2 have that
    exact way for large buckets.
    """
    if radius not in (1, 2):
        raise ValueError("radius must be 1 or 2")
    masks = covering_masks(BITS, radius)
    keyed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_long(m))) for m in masks])).alias("t", "key"))
    sizes = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1")
    met = common.cut(keyed.join(sizes, ["t", "key"]))
    near = lambda a, b: (F.bit_count(a.bitwiseXOR(b)) <= radius) & (a < b)
    # At most `small` values are gathered for a bucket.
    few = met.filter(F.col("n") <= small).groupBy("t", "key").agg(F.collect_list("fp").alias("all"))
    one = few.select("all", F.explode("all").alias("a"))
    pairs = one.select("a", F.explode("all").alias("b")).filter(near(F.col("a"), F.col("b"))).distinct()
    many = met.filter(F.col("n") > small)
    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_long(1 << k))) for k in range(BITS)])
    around = many.select("fp").distinct().select("fp", F.explode(flips).alias("c"))
    if radius == 1:  # then the value between must itself be a fingerprint
        around = around.join(fps.select(F.col("fp").alias("c")), "c", "left_semi")
    shared = around.groupBy("c").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).filter("lo < hi")
    hubs = around.join(shared.select("c", "lo"), "c").filter("fp <> lo").select(F.col("fp").alias("a"), F.col("lo").alias("b"))
    return pairs.union(hubs)


def classes(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, component_id) of the distinct fingerprints in (id, fp) rows, linked within `radius` bits."""
    least = common.cut(fps.groupBy("fp").agg(F.min("id").alias("least")))
    tree = common.cut(components(links(least.select("fp"), radius)))
    rooted = least.join(tree, least["fp"] == tree["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    return rooted.select("fp", "root").join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")


def near_duplicates(df: DataFrame, shingle: int = 3, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id): each row with its fingerprint in hex and the least id of its component."""
    fps = common.cut(fingerprints(df, shingle, id_col, text_col).select(F.col(id_col).alias("id"), "fp"))
    # The join's left side may have one very frequent fingerprint; the right side has each once.
    out = fps.join(classes(fps, radius), "fp")
    return out.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "documents", "doc_id", "text"))

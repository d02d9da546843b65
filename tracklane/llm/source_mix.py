"""Mixing sources to target weights by the cube method.

A document of a source whose target is m times its size is taken floor(m) times, and once more with the probability that
is left, the same for all documents of the source. The cube method makes a choice of those probabilities: it moves them
along directions in the null space of the constraints (the words taken, and the number of documents taken), so that both
totals stay what they were, until each probability met 0 or 1 and only a small landing problem remains.

Two documents of one size are such a direction by themselves: probability moves from one to the other and neither total
changes. So all documents of a source and a size settle at once, but for one of them at most, by counting them; which
ones are taken is by a hash of their ids. That is done by groups with partial sums, and places by range partitions
(operators/order.py), so a source or a size that holds a third of all rows is no task's. What is left, at most one document
a size, settles in flights over three sizes at a time, whose direction is the cross product of the constraints' rows; a
source has as many such rows as its texts have different lengths, whatever the number of documents.

Landing: at most two probabilities are left between 0 and 1. They are rounded so that the words taken come nearest to the
target; what is missing or over is then settled by taking or leaving whole documents, the longest that fit first, and at
last by exchanging one for another as long as that comes nearer. Seeds come from the sources' names, so that reruns agree,
whatever the partitions.

Edge cases. A null text has size 0; documents of size 0 are taken like others and add nothing. A null source is a source,
the last one. Null and repeated ids: each row is a document; equal rows are interchangeable. A source of size 0 has target
0. An empty table gives no rows. Columns other than the three named ones are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklane.llm import common
from tracklane.operators.order import placed

#: Weights of the sources in order, repeating; the most that a source, and a document, may be taken.
WEIGHTS, MOST = (1, 2, 3), 3
_NEAR = 1e-9


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): the number of words of each text."""
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(common.WORD)), F.lit(0)).cast("bigint").alias("size"))


def with_targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target, times, rest) of (source, source_size): each one's target, and its quotient by the size.

    times is the whole part, rest the fraction. Targets share the sum of all sizes by weight. A source whose share is over
    `most` times its size gets that, and the others share the rest by weight, until none is above; each step is one sum
    over the sources, and sums are whole numbers, so that nothing depends on their order.
    """
    numbered = common.cut(placed(sources, [], [F.asc_nulls_last("source")], "place"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") - 1) % len(weights) + 1).cast("bigint")
    rows = numbered.select("source", "source_size", weight.alias("weight"))
    exact = lambda x: x.cast("decimal(38,0)")
    cap = exact(F.col("source_size")) * most
    share = Fraction(0)  # what a weight of one gets
    while True:
        above = cap * F.lit(share.denominator) < exact(F.col("weight")) * F.lit(share.numerator)
        got = rows.agg(F.sum(exact(F.col("source_size"))).alias("all"), F.sum(F.when(above, cap)).alias("capped"), F.sum(F.when(~above, F.col("weight"))).alias("weight")).first()
        now = Fraction(int(got["all"] or 0) - int(got["capped"] or 0), int(got["weight"])) if got["weight"] else share
        if now == share:
            break
        share = now
    n, d = F.lit(share.numerator), F.lit(share.denominator)
    parts = rows.select("source", "source_size", F.least(exact(F.col("weight")) * n, cap * d).alias("held"), (exact(F.col("source_size")) * d).alias("one"))  # both times d
    counted = parts.withColumn("times", F.when(F.col("one") > 0, F.expr("held div nullif(one, 0)")).otherwise(F.lit(0).cast("bigint")))
    rest = F.when(F.col("one") > 0, (F.col("held") - F.col("one") * F.col("times")).cast("double") / F.nullif(F.col("one"), F.lit(0)).cast("double")).otherwise(F.lit(0.0))
    return counted.select("source", "source_size", (F.col("held").cast("double") / d).alias("target"), "times", rest.alias("rest"))


def flight(size: np.ndarray, chance: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The probabilities moved, keeping their sum and that of size times probability, until at most two are not 0 or 1."""
    p = chance.copy()
    open_ = [i for i in range(len(p)) if _NEAR < p[i] < 1 - _NEAR]
    window, at = open_[:3], 3
    while len(window) == 3:
        a, b, c = (size[i] for i in window)
        u = np.array([b - c, c - a, a - b], float) if a != b or b != c else np.array([1.0, -1.0, 0.0])
        x = p[window]
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.min(np.where(u > 0, (1 - x) / u, np.where(u < 0, -x / u, np.inf)))
            down = np.min(np.where(u > 0, x / u, np.where(u < 0, (x - 1) / u, np.inf)))
        # Up with the odds that leave each probability's mean what it is.
        x = x + u * up if rng.random() * (up + down) < down else x - u * down
        x = np.where(x < _NEAR, 0.0, np.where(x > 1 - _NEAR, 1.0, x))
        p[window] = x
        window = [i for i in window if 0 < p[i] < 1]
        more = open_[at : at + 3 - len(window)]
        window, at = window + more, at + len(more)
    return p


def landed(size: np.ndarray, taken: np.ndarray, number: np.ndarray, chance: np.ndarray, wanted: float) -> np.ndarray:
    """How many of the `number` documents of each size are taken: `taken`, and the open `chance`s rounded, near `wanted` words."""
    taken = taken.copy()
    open_ = [i for i in range(len(chance)) if 0 < chance[i] < 1]
    sure = taken + (chance == 1)
    choices = [[i for k, i in enumerate(open_) if bits >> k & 1] for bits in range(1 << len(open_))]
    words = int((size * sure).sum())
    taken = sure
    taken[min(choices, key=lambda c: (abs(words + sum(int(size[i]) for i in c) - wanted), len(c)))] += 1
    missing = wanted - int((size * taken).sum())
    sign = 1 if missing > 0 else -1
    missing = abs(missing)
    for i in np.argsort(-size, kind="stable"):
        if size[i] > 0:
            free = number[i] - taken[i] if sign > 0 else taken[i]
            k = min(int(free), int(missing // size[i]))
            taken[i] += sign * k
            missing -= k * int(size[i])
    # What is left is less than the shortest that can be moved: exchange one for another, as long as that comes nearer.
    while True:
        more = np.flatnonzero(number > taken if sign > 0 else taken > 0)
        less = np.flatnonzero(taken > 0 if sign > 0 else number > taken)
        more, gain = np.append(more, -1), np.append(size[more], 0)
        less, loss = np.append(less, -1), np.append(size[less], 0)  # -1: none
        by = np.argsort(gain, kind="stable")
        near = np.clip(np.searchsorted(gain[by], loss + missing)[:, None] + np.array([-1, 0]), 0, len(by) - 1)
        off = np.abs(gain[by][near] - loss[:, None] - missing)
        k, side = np.unravel_index(np.argmin(off), off.shape)
        if off[k, side] >= missing - _NEAR:
            return taken
        i, j = more[by[near[k, side]]], less[k]
        missing -= gain[by[near[k, side]]] - loss[k]
        if i >= 0:
            taken[i] += sign
        if j >= 0:
            taken[j] -= sign
        sign, missing = (sign, missing) if missing >= 0 else (-sign, -missing)


def extra(name: str | None, size: np.ndarray, number: np.ndarray, rest: float) -> np.ndarray:
    """How many of the `number` documents of each size of a source are taken once more. `size` falls."""
    mass = number * rest
    taken = np.floor(mass + _NEAR).astype(np.int64)
    chance = np.clip(mass - taken, 0.0, 1.0)
    chance[chance < _NEAR] = 0.0
    rng = np.random.default_rng([zlib.crc32((name or "").encode()), name is None])
    return landed(size, taken, number, flight(size.astype(float), chance, rng), rest * float((size * number).sum()))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of documents (doc_id, source, text)."""
    thin = common.cut(sizes(docs))
    classes = common.cut(thin.groupBy("source", "size").agg(F.count("*").alias("number")))
    targets = with_targets(classes.groupBy("source").agg(F.sum(F.col("size") * F.col("number")).cast("bigint").alias("source_size")), weights, most)
    t = targets.withColumnRenamed("source", "_source")
    held = classes.join(t, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")

    def chosen(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("size", ascending=False, kind="stable")
        name = part["source"].iloc[0]
        part["more"] = extra(None if pd.isna(name) else str(name), part["size"].to_numpy(), part["number"].to_numpy(), float(part["rest"].iloc[0]))
        return part

    columns = ["source", "size", "number", "source_size", "target", "times", "rest", "more"]
    kind = thin.schema["source"].dataType.simpleString()
    plan = common.cut(held.groupBy("source").applyInPandas(lambda p: chosen(p)[columns], f"source {kind}, size bigint, number bigint, source_size bigint, target double, times bigint, rest double, more bigint"))
    key = lambda p: p.select(F.col("source").alias("_source"), F.col("size").alias("_size"), "source_size", "target", "times", "more")
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size"))
    # Rows of one id are told apart by their place in the table, so that they too are dealt to many tasks.
    ordered = placed(thin.withColumn("_row", F.monotonically_increasing_id()), ["source", "size"], [F.xxhash64("doc_id"), F.asc_nulls_first("doc_id"), "_row"], "place")
    again = (F.col("place") <= F.col("more")).cast("bigint")
    return ordered.join(key(plan), same).select("doc_id", "size", "source_size", "target", (F.col("size") * (F.col("times") + again)).alias("taken"))


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(common.table(spark, sf_dir, "documents", "doc_id", "source", "text"))

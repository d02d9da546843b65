"""Mixing: targets against a plain loop, balance, bounds and reruns."""

from collections import defaultdict
from fractions import Fraction

import numpy as np
from conftest import DATA
from helpers import no_docs, odd_docs

from tracklane.llm import source_mix as sm


def plain_targets(sizes: dict, weights=(1, 2, 3), most=3):
    """Target of each source: shares by weight, capped; the excess shared again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped: set = set()
    while True:
        left = sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        open_ = [s for s in order if s not in capped]
        total = sum(weight[s] for s in open_)
        target = {s: Fraction(left * weight[s], total) for s in open_}
        above = {s for s in open_ if target[s] > most * sizes[s]}
        if not above:
            return {s: float(target.get(s, most * sizes[s])) for s in order}
        capped |= above


def checked(rows, texts):
    """Holds rows of `mix` against (doc_id, source, size) triples; how far each source's words are from its target."""
    by, size = defaultdict(list), defaultdict(int)
    for i, s, n in texts:
        by[i, n].append(s)
        size[s] += n
    targets = plain_targets(size)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.size) for r in rows) == sorted((i is not None, i or 0, n) for i, s, n in texts)
    taken, source_of = defaultdict(int), {(size[s], targets[s]): s for s in size}
    for r in rows:
        s = source_of[r.source_size, r.target]
        assert s in by[r.doc_id, r.size]
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[s] += r.taken
    return {s: abs(taken[s] - targets[s]) for s in targets}


def test_documents_of_the_tables(spark):
    sf = f"{DATA}/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "text").collect()
    rows = sm.op12_source_mix(spark, sf).collect()
    off = checked(rows, [(d.doc_id, d.source, len((d.text or "").encode().split())) for d in docs])
    assert max(off.values()) <= 5
    assert sorted(rows) == sorted(sm.op12_source_mix(spark, sf).collect())
    cut_apart = spark.read.parquet(f"{sf}/documents.parquet").repartition(7)
    assert sorted(rows) == sorted(sm.mix(cut_apart).collect())


def test_hot_null_and_tiny_sources_and_one_large_document(spark):
    texts = [(i, "hot", 5 if i % 3 else 1 + i % 40) for i in range(600)] + [(7, "hot", 5)] * 300 + [(None, None, 4)] * 20 + [(i, "a", 2) for i in range(3)] + [(9, "b", 0), (10, "z", 3000)]
    docs = spark.createDataFrame([(i, s, "w " * n if n else None) for i, s, n in texts], "doc_id bigint, source string, text string")
    off = checked(sm.mix(docs).collect(), texts)
    assert off.pop("z") <= 1500 and max(off.values()) <= 2.5


def test_odd_documents(spark):
    assert sm.mix(no_docs(spark).selectExpr("doc_id", "cast(null as string) AS source", "text")).count() == 0
    docs = odd_docs(spark, "one two three").selectExpr("*", "'s' AS source", "1 AS place", "1 AS size", "1 AS number", "1 AS more")
    rows = sm.mix(docs).collect()
    assert len(rows) == docs.count() and sum(r.taken for r in rows) == sum(r.size for r in rows)


def test_targets_equal_the_plain_loop(spark):
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 40):
        sizes = {f"s{i}": int(rng.integers(0, 10 ** int(rng.integers(1, 12)))) for i in range(n)} | {None: 17}
        got = sm.with_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")).collect()
        assert {r.source: r.target for r in got} == plain_targets(sizes)
        assert all(abs((r.times + r.rest) * r.source_size - r.target) <= 1e-9 * max(1, r.target) and 0 <= r.rest < 1 for r in got)


def test_flight_keeps_totals_and_means():
    rng = np.random.default_rng(1)
    size, chance = rng.integers(1, 60, 40).astype(float), rng.uniform(0, 1, 40)
    mean = np.zeros(40)
    for k in range(3000):
        p = sm.flight(size, chance, np.random.default_rng(k))
        assert ((p > 0) & (p < 1)).sum() <= 2
        assert abs(p.sum() - chance.sum()) < 1e-6 and abs((p * size).sum() - (chance * size).sum()) < 1e-6
        mean += p / 3000
    assert np.abs(mean - chance).max() < 0.05

"""Fingerprints and components against all pairs."""

import random
import re

import xxhash
from conftest import DATA
from helpers import no_docs, odd_docs

from tracklane.llm import common, simhash_dedup


def plain_print(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    parts = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(values, radius=2):
    """value -> least value of its component, by all pairs."""
    values, up = list(values), {}
    find = lambda x: x if up.get(x, x) == x else find(up[x])
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= radius:
                ra, rb = sorted((find(a), find(b)))
                up[rb] = ra
    return {v: find(v) for v in values}


def test_documents_equal_all_pairs(spark):
    rows = common.table(spark, f"{DATA}/sf0.001", "documents", "doc_id", "text").collect()
    prints = {r.doc_id: plain_print(r.text) for r in rows}
    root = roots(set(prints.values()))
    least = {}
    for i, p in prints.items():
        least[root[p]] = min(i, least.get(root[p], i))
    got = simhash_dedup.op2_simhash_dedup(spark, f"{DATA}/sf0.001").collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{p:016x}", least[root[p]]) for i, p in prints.items()}


def test_large_buckets_equal_all_pairs(spark):
    rng = random.Random(5)
    values = {0}
    for _ in range(6):
        x = rng.getrandbits(64)
        for _ in range(30):
            x ^= 1 << rng.randrange(64)
            if rng.random() < 0.5:
                x ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
            values.add(x)
    own = simhash_dedup._long
    fps = spark.createDataFrame([(own(v), own(v)) for v in values], "id bigint, fp bigint")
    for radius in (1, 2):
        want = {}
        for v, r in roots(values, radius).items():
            want.setdefault(r, set()).add(own(v))
        for small in (1, 24):
            tree = simhash_dedup.components(simhash_dedup.links(fps.select("fp"), radius, small)).collect()
            up = {r.node: r.root for r in tree}
            got = {}
            for v in map(own, values):
                got.setdefault(up.get(v, v), set()).add(v)
            assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_masks_cover_every_pair_of_positions():
    masks = simhash_dedup.covering_masks()
    assert all(any(not (m >> a & 1 or m >> b & 1) for m in masks) for a in range(64) for b in range(a))


def test_odd_and_empty_tables(spark):
    got = simhash_dedup.near_duplicates(odd_docs(spark)).collect()
    assert len(got) == 7
    assert {r.component_id for r in got if r.fingerprint == "0" * 16} == {1}
    assert {r.doc_id for r in got if r.fingerprint == "0" * 16} == {1, 2, 3}
    assert simhash_dedup.near_duplicates(no_docs(spark)).count() == 0

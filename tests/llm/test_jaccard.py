"""Jaccard near-duplicates against all pairs."""

import os
import random
import re
import time

import pytest
from conftest import DATA
from helpers import no_docs, odd_docs
from pyspark.sql import functions as F
from test_simhash_dedup import plain_print

from tracklane.llm import common, jaccard, simhash_dedup


def plain_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return frozenset(" ".join(w[i : i + 5]) for i in range(len(w) - 4)) or frozenset([" ".join(w)] if w else [])


def plain_least(texts):
    """id -> least id of its component, by all pairs."""
    ids, up = sorted(texts), {i: i for i in texts}
    prints, sets = {i: plain_print(t) for i, t in texts.items()}, {i: plain_set(t) for i, t in texts.items()}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if (prints[a] ^ prints[b]).bit_count() <= 2 or both and 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return {i: find(i) for i in ids}


def changed(rng, words, n):
    out = list(words)
    for k in rng.sample(range(len(out)), n):
        out[k] = f"new{rng.randrange(10**9)}"
    return " ".join(out)


@pytest.mark.parametrize(("small", "rounds"), [(24, 4), (3, 1), (3, 0)])
def test_equals_all_pairs(spark, small, rounds):
    rng = random.Random(3)
    texts = []
    for size, copies in ((146, 60), (80, 12), (300, 5), (9, 3)):
        base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        texts += [changed(rng, base, rng.randrange(min(7, size))) for _ in range(copies)]
    line = " ".join(f"common{k}" for k in range(12))
    texts += [line + " " + " ".join(f"v{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 60))) for _ in range(30)]
    rng.shuffle(texts)
    texts = dict(enumerate(texts))
    got = jaccard.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"), small=small, rounds=rounds).collect()
    want = plain_least(texts)
    assert {r.doc_id: r.component_id for r in got} == want
    simhash = {r.doc_id: r.component_id for r in simhash_dedup.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()}
    assert len(set(simhash.values())) > len(set(want.values()))


def test_stage_joins_what_simhash_misses(spark):
    import corpus_pipeline

    rng = random.Random(1)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    for _ in range(50):
        other = changed(rng, base, 3)
        if (plain_print(" ".join(base)) ^ plain_print(other)).bit_count() > 2:
            break
    docs = spark.createDataFrame([(1, " ".join(base)), (2, other), (3, " ".join(base[::-1]))], "doc_id bigint, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == [1, 3]


def test_documents_equal_all_pairs(spark):
    docs = common.table(spark, f"{DATA}/sf0.001", "documents", "doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs).collect()} == plain_least(texts)


def test_texts_of_pairs_are_told_before_a_shuffle(spark):
    texts = spark.range(20_000).select(F.struct(F.when(F.col("id") % 10 > 0, F.col("id")).alias("doc_id"), "id").alias("i"), F.lit("t").alias("t"))
    wanted = texts.filter("i.id % 50 = 0").select("i")
    got = {r.i.id for r in jaccard.possible(texts, wanted).collect()}
    assert set(range(0, 20_000, 50)) <= got and len(got) < 450
    assert jaccard.possible(texts, wanted.limit(0)).count() == 0


def test_shuffle_files_go_with_the_write(spark):
    files = lambda: [f for d, _, names in os.walk(spark.conf.get("spark.local.dir")) for f in names if f.startswith("shuffle_")]
    there = set(files())
    assert len(common.cut(spark.range(1000, numPartitions=3).groupBy((F.col("id") % 7).alias("k")).count()).collect()) == 7
    for _ in range(50):
        if not (left := [f for f in files() if f not in there and f.endswith(".data")]):
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(common.SHUFFLES_GO, None) in (None, "false")


def test_odd_and_empty_tables(spark):
    got = jaccard.near_duplicates(odd_docs(spark)).collect()
    assert len(got) == 7
    assert {r.doc_id for r in got if r.component_id == 1} == {1, 2, 3}
    assert jaccard.near_duplicates(no_docs(spark)).count() == 0

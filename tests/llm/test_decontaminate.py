"""Passages whole, cut, reordered and marked up, and a plain tiling."""

import random

from helpers import no_docs, odd_docs

from tracklane.llm import decontaminate

ITEM = "the quick brown fox jumps over a lazy dog while seven wizards box with heavy quartz near the old mill pond"


def rows(spark, *texts):
    return odd_docs(spark, *texts)


def test_passages(spark):
    w, rng = ITEM.split(), random.Random(1)
    noise = lambda n: " ".join(f"n{rng.randrange(10**6)}" for _ in range(n))
    texts = [
        f"{noise(50)} {ITEM} {noise(50)}", f"{noise(9)} {' '.join(w[10:])} {noise(9)} {' '.join(w[:10])} {noise(4)}", f"{noise(20)} {' '.join(w[:10])} {noise(20)}",
        noise(200), ITEM.upper().replace(" ", ",  "), " ".join(reversed(w)), f"{ITEM} {ITEM}",
    ]
    items = spark.createDataFrame([(7, ITEM), (3, ITEM), (8, "too short"), (9, None), (10, "")], "item_id bigint, text string")
    got = {r.doc_id: r for r in decontaminate.contamination(rows(spark, *texts), items).collect() if r.doc_id is not None and r.doc_id >= 10}
    assert [got[10 + k].contaminated for k in range(7)] == [True, True, False, False, True, False, True]
    assert got[10].item_id == 3
    assert (got[11].n_tiles, got[11].n_covered, got[11].n_item_words) == (2, len(w), len(w))
    assert (got[12].n_tiles, got[12].n_covered) == (1, 10)
    assert got[16].n_covered == len(w)


def plain_tiles(p, t, least):
    """Greedy string tiling by comparing all places."""
    up, ut, tiles = set(), set(), []
    while True:
        best, found = least - 1, []
        for i in range(len(p)):
            for j in range(len(t)):
                n = 0
                while i + n < len(p) and j + n < len(t) and p[i + n] == t[j + n] and t[j + n] and i + n not in up and j + n not in ut:
                    n += 1
                if n > best:
                    best, found = n, [(i, j)]
                elif n == best and n >= least:
                    found.append((i, j))
        if best < least:
            return tiles
        for i, j in found:
            if not any(i + k in up or j + k in ut for k in range(best)):
                tiles.append((i, j, best))
                up |= {i + k for k in range(best)}
                ut |= {j + k for k in range(best)}


def test_tiles_cover_what_a_plain_tiling_covers():
    rng = random.Random(4)
    for _ in range(150):
        p = [rng.randint(1, 3) for _ in range(rng.randint(0, 40))]
        t = [rng.randint(0, 3) for _ in range(rng.randint(0, 40))]
        got = decontaminate.tile(p, t, 3, first=rng.choice([3, 8, 32]))
        assert all(p[i : i + n] == t[j : j + n] and 0 not in t[j : j + n] and n >= 3 for i, j, n in got)
        assert len({i + k for i, _, n in got for k in range(n)}) == len({j + k for _, j, n in got for k in range(n)}) == sum(n for *_, n in got)
        want = plain_tiles(p, t, 3)
        assert sorted(n for *_, n in got)[-1:] == sorted(n for *_, n in want)[-1:]
        assert sum(n for *_, n in got) == sum(n for *_, n in want)


def test_all_documents_equal_a_plain_tiling_of_all_pairs(spark):
    """Random texts of few words: best items and coverage against the tiling of every pair."""
    rng = random.Random(8)
    texts = lambda n, lo, hi: [(k, " ".join(rng.choice("abcd") for _ in range(rng.randint(lo, hi)))) for k in range(n)]
    items, docs = texts(40, 1, 24), texts(60, 0, 40)
    number = {w: k + 1 for k, w in enumerate("abcd")}
    ids = lambda t: [number[w] for w in t.split()]
    for floor in (0.4, 0.8):
        got = {r.doc_id: r for r in decontaminate.contamination(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), floor=floor).collect()}
        for k, t in docs:
            cover = {i: sum(n for *_, n in plain_tiles(ids(p), ids(t), min(5, len(p.split())))) / len(p.split()) for i, p in items}
            best = min(cover, key=lambda i: (-cover[i], i))
            if cover[best] >= floor:
                assert (got[k].item_id, got[k].coverage, got[k].contaminated) == (best, cover[best], cover[best] >= 0.8)
            else:
                assert (got[k].item_id, got[k].n_covered, got[k].contaminated) == (None, 0, False)


def test_a_stock_phrase_makes_no_pairs(spark):
    """A phrase that all documents and all items hold is no key of the join; whole items still match."""
    rng = random.Random(9)
    words = lambda n: " ".join(f"w{rng.randrange(10**7)}" for _ in range(n))
    phrase = "all rights are reserved by the owner"
    items = [(k, f"{words(20)} {phrase} {words(20)}") for k in range(300)]
    docs = [(k, f"{words(30)} {phrase} {words(30)}") for k in range(300)] + [(1000, f"{words(9)} {items[7][1]}")]
    d, i = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    own = decontaminate._items(i.select(i.item_id.alias("id"), i.text.alias("t")), 5)
    seeds = own.selectExpr("explode(seeds) AS seed").distinct()
    some = decontaminate._parts(d.select(d.doc_id.alias("id"), d.text.alias("t")), decontaminate._bitmap(seeds, seeds.count()), [5]).filter("seeds IS NOT NULL")
    assert some.count() == 301
    assert decontaminate.candidates(some, own, 5, 0.8).count() <= 3
    got = decontaminate.contamination(d, i).filter("contaminated").collect()
    assert [(r.doc_id, r.item_id, r.coverage) for r in got] == [(1000, 7, 1.0)]


def test_short_items_match_whole(spark):
    items = spark.createDataFrame([(1, "Deep Thought"), (2, "Answer!"), (3, "!!")], "item_id bigint, text string")
    got = decontaminate.contamination(rows(spark, "They asked deep thought for it", "thought deep", "the answer, at last: Deep, Thought"), items).collect()
    assert {r.doc_id: r.item_id for r in got if r.contaminated} == {10: 1, 12: 1}


def test_odd_and_empty_tables(spark):
    items = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    assert decontaminate.contamination(odd_docs(spark), items).filter("not contaminated and item_id is null").count() == 7
    assert decontaminate.contamination(odd_docs(spark), items.filter("false")).filter("not contaminated").count() == 7
    assert decontaminate.contamination(no_docs(spark), items).count() == 0

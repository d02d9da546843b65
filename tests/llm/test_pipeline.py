"""The stages one after another against what each must keep, on real and on odd documents."""

import itertools
import re

import corpus_pipeline
import pytest
from conftest import DATA
from helpers import odd_docs
from test_quality_rules import plain
from test_simhash_dedup import plain_print, roots

from tracklane.llm import common

SF = f"{DATA}/sf0.001"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


@pytest.fixture(scope="module")
def stages(spark):
    docs = common.table(spark, SF, "documents")
    out = [docs]
    for _, f in corpus_pipeline.STAGES:
        out.append(common.cut(f(spark, out[-1], SF)))
    return out


def test_each_stage(spark, stages):
    docs, good, unique, clean, private, packed = stages
    assert good.columns == unique.columns == clean.columns == private.columns == docs.columns
    texts = [{r.doc_id: r.text for r in x.collect()} for x in stages[:5]]
    failed = {i for i, t in texts[0].items() if (s := plain(t))[0] < 50 or 100 * s[4] > 50 * s[0]}
    assert failed.isdisjoint(texts[1])
    # The stage's own contract: SimHash links of radius 2, and all pairs of 5-word shingle sets of Jaccard 0.8 or more.
    prints = {i: plain_print(t) for i, t in texts[1].items()}
    root = roots(set(prints.values()))
    group = {i: i for i in prints}
    find = lambda i: i if group[i] == i else find(group[i])
    sets = {i: shingles(t) for i, t in texts[1].items()}
    for i, j in itertools.combinations(sorted(prints), 2):
        if root[prints[i]] == root[prints[j]] or 9 * len(sets[i] & sets[j]) >= 4 * (len(sets[i]) + len(sets[j])):
            a, b = sorted((find(i), find(j)))
            group[b] = a
    assert set(texts[2]) == {i for i in prints if find(i) == i}
    words = lambda t: " ".join(filter(None, (re.sub(r"[\W_]+", "", w) for w in t.lower().split())))
    items = [words(r.text) for r in common.table(spark, SF, "benchmark").collect()]
    held = {i for i, t in texts[2].items() if any(x in words(t) for x in items)}
    assert held.isdisjoint(texts[3])
    assert len(texts[3]) == len(texts[2]) - len(held)
    assert texts[4].keys() == texts[3].keys()
    assert all(t == texts[3][i] or re.search(r"\d|@|\b[MHSГΚ]", texts[3][i]) for i, t in texts[4].items())
    assert {r.doc_id for r in packed.collect()} == texts[4].keys()


def test_odd_documents(spark):
    prose = " ".join(f"word{k} and" for k in range(70))
    docs = odd_docs(spark, prose, prose, prose + " end").withColumnRenamed("text_", "n_chars")
    docs = docs.withColumn("n_chars", docs["n_chars"].try_cast("bigint"))
    extra = docs.filter("doc_id = 10")
    out = docs.unionByName(extra).unionByName(docs.filter("doc_id = 10").withColumn("doc_id", docs["doc_id"] * 0 + 99))
    for _, f in corpus_pipeline.STAGES[:-1]:
        then = common.cut(f(spark, out, SF))
        assert then.columns == docs.columns
        out = then
    assert sum(r.doc_id == 10 for r in out.collect()) == 1
    assert out.filter("doc_id in (11, 99)").count() == 0
    none = docs.filter("false")
    for _, f in corpus_pipeline.STAGES:
        none = common.cut(f(spark, none, SF))
    assert none.count() == 0


def test_a_run_leaves_only_its_result(spark):
    """Of all the tables that a run writes, those are left that its result reads; also with a column of the stages' own name."""
    import os

    here = common.shared_dir(spark)
    before = set(os.listdir(here))
    out = corpus_pipeline.run(spark, SF)
    left = set(os.listdir(here)) - before
    assert len(left) == 1 and left == {f.split("/")[-2] for f in out.inputFiles()}
    assert out.count() > 0
    docs = common.table(spark, SF, "documents").withColumn(corpus_pipeline.KEY, common.F.lit("x"))
    assert common.cut(corpus_pipeline.decontamination(spark, docs, SF)).columns == docs.columns


def test_queries_leave_only_what_their_results_read(spark):
    import os

    from tracklane.llm import registry

    here = common.shared_dir(spark)
    for name in ("op2_simhash_dedup", "op4_decontaminate", "op9_secret_scan"):
        before = set(os.listdir(here))
        out = registry.QUERIES[name](spark, SF)
        assert set(os.listdir(here)) - before <= {f.split("/")[-2] for f in out.inputFiles()}, name
        assert out.count() > 0

"""Scores against a plain model of dictionaries, and probabilities that sum to 1."""

import re
import zlib
from collections import Counter
from math import isclose, log10

import numpy as np
from conftest import DATA
from helpers import no_docs, odd_docs

from tracklane.llm import common, katz_lm

END, BEGIN, OTHER = "</s>", "<s>", "?"


class Plain:
    def __init__(self, texts):
        self.c1, self.c2 = Counter(), Counter()
        for toks in texts:
            self.c1.update(toks)
            self.c1[BEGIN] += 1
            self.c2.update(zip([BEGIN, *toks], toks))
        n_begin = self.c1.pop(BEGIN, 0)
        tally = lambda c: np.array([sum(x == r for x in c.values()) for r in range(1, katz_lm.K + 2)], float)
        self.n, self.v = sum(self.c1.values()), len(self.c1)
        self.lower, self.d = katz_lm.Lower(self.n, tally(self.c1)), katz_lm.discounts(tally(self.c2))
        self.total = self.c1 | Counter({BEGIN: n_begin})
        self.after = {}
        for (h, w), c in self.c2.items():
            self.after.setdefault(h, {})[w] = c

    def p1(self, w):
        return float(self.lower.p(np.array([self.c1[w]]))[0])

    def p(self, h, w):
        ch, seen = self.total[h], self.after.get(h, {})
        if not ch:
            return self.p1(w)
        freed = sum((1 - self.d[c]) * c for c in seen.values() if c <= katz_lm.K)
        below = ch if freed > 0 else ch + 1
        if w in seen:
            return seen[w] * (self.d[seen[w]] if seen[w] <= katz_lm.K else 1.0) / below
        return (freed if freed > 0 else 1.0) / below / (1 - sum(map(self.p1, seen))) * self.p1(w)


def tokens(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", text), END]


def check(spark, df):
    rows = [(r.doc_id, tokens(r.text)) for r in df.collect()]
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    m = Plain([t for i, t in rows if not held(i)])
    want = sorted(((i is None, i or 0), held(i), len(t), sum(m.c1[w] > 0 for w in t), m.n, sum(log10((m.c1[w] + 1) / (m.n + m.v + 1)) for w in t), sum(log10(m.p(h, w)) for h, w in zip([BEGIN, *t], t))) for i, t in rows)
    got = sorted(((r.doc_id is None, r.doc_id or 0), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in katz_lm.score(df).collect())
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5]
        assert isclose(a[5], b[5], rel_tol=1e-9, abs_tol=1e-6)
        assert isclose(a[6], b[6], rel_tol=1e-9, abs_tol=1e-6)
    return m


def test_documents_equal_a_plain_model(spark):
    m = check(spark, common.table(spark, f"{DATA}/sf0.001", "documents", "doc_id", "text"))
    for h in [BEGIN, "never seen", *list(m.c1)[:20]]:
        assert isclose(sum(m.p(h, w) for w in [*m.c1, OTHER]), 1, rel_tol=1e-9)


def test_many_blocks_and_frequent_histories(spark, monkeypatch):
    monkeypatch.setattr(katz_lm, "BLOCK", 3000)
    monkeypatch.setattr(katz_lm, "PER_BUCKET", 2000)
    check(spark, common.table(spark, f"{DATA}/sf0.001", "documents", "doc_id", "text").repartition(5))


def test_odd_and_empty_tables(spark):
    check(spark, odd_docs(spark).select("doc_id", "text", "block"))
    assert katz_lm.score(no_docs(spark)).count() == 0

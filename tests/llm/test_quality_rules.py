"""Statistics against a plain count; the learned list on rows it has not seen."""

import re
from collections import Counter

from conftest import DATA
from helpers import no_docs, odd_docs
from pyspark.sql import functions as F

from tracklane.llm import common, quality_rules

NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside))


def test_statistics_equal_plain_counts(spark):
    docs = odd_docs(spark, "a b c a b c d", "x\nx\ny\n \nx", "a a a a", "été <#> $5 & |", "a b c d a b c", "\n\n")
    docs = docs.select("doc_id", "text").union(common.table(spark, f"{DATA}/sf0.001", "documents", "doc_id", "text"))
    s = quality_rules.base_stats(F.col("text"))
    for r in docs.select("text", s.alias("s")).collect():
        assert tuple(r.s[k] for k in NAMES) == plain(r.text), r.text


def test_list_rejects_bad_rows_it_has_not_seen(spark):
    docs, labels = (common.table(spark, f"{DATA}/sf0.1", t) for t in ("documents", "labels"))
    seen = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    rules = quality_rules.learn(docs, labels.filter(seen))
    got = quality_rules.judge(docs, rules).select("doc.doc_id", "quality.*").join(labels.filter(~seen), "doc_id")
    c = got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"), F.avg((~F.col("base_failed") & ~F.col("kept")).cast("int")).alias("by_rule")).collect()
    c = {r.quality: r for r in c}
    assert c[1].by_rule < 0.01
    assert c[0].kept < 0.2


def test_odd_and_empty_tables(spark):
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1), (4, 1), (4, 0)], "doc_id bigint, quality int")
    docs = odd_docs(spark)
    got = quality_rules.judge(docs, quality_rules.learn(docs, labels)).select("doc.*", "quality.kept")
    assert got.count() == 7
    assert got.drop("kept").columns == docs.columns
    assert quality_rules.learn(docs, labels.filter("false")).rules == ()
    assert quality_rules.judge(no_docs(spark), quality_rules.learn(no_docs(spark), labels)).count() == 0

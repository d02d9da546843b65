"""Rows that every operator must take: nulls, empty and very long texts, repeats, columns with clashing names."""

EXTRA = "i string, t string, s string, m string, doc string, rule string, uid string, fp string, id string, key string, odd string, block string, text_ string"


def odd_docs(spark, *texts):
    rows = [(1, None), (2, ""), (3, " \t\n "), (None, "no id here"), (4, "same text twice"), (4, "same text twice"), (5, "word " * 60_000), *[(10 + k, t) for k, t in enumerate(texts)]]
    n = len(EXTRA.split(","))
    return spark.createDataFrame([(a, b, *["x"] * n) for a, b in rows], f"doc_id bigint, text string, {EXTRA}")


def no_docs(spark):
    return spark.createDataFrame([], "doc_id bigint, text string")

"""The corpus pipeline: quality rules, near-duplicates, benchmark decontamination, PII, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows of docs; all but the last return the columns of docs. Rows
with a null text have no words and go in the first stage; of rows equal in id and text the second keeps one; null ids
are ids like any other, after all others. Columns besides doc_id, text and n_chars pass through untouched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklane.llm import common, decontaminate, jaccard, packing, pii_surrogates, quality_rules

KEY = "_row_key_of_stage"


def _free(docs: DataFrame) -> str:
    """A column name that docs has not."""
    name = KEY
    while name in docs.columns:
        name += "_"
    return name


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned decision list keep; no shuffle of texts."""
    rules = quality_rules.learn(docs, common.table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality_rules.judge(docs, rules).filter("quality.kept").select("doc.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each group that SimHash (radius 2) or a 5-word-shingle Jaccard of 0.8 links."""
    own, key = _free(docs), common.row_key(F.col("doc_id"), F.col("text"))
    rows = docs.select(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", key.alias("key")).alias("row"), "text")
    kept = jaccard.near_duplicates(rows, id_col="row").filter("row = component_id").select(F.unhex("row.key").alias(own)).distinct()
    return docs.withColumn(own, F.unhex(key)).join(common.cut(kept), own, "left_semi").dropDuplicates([own]).drop(own)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. The keys of the others are written first, so that Spark knows how few they are."""
    own, key = _free(docs), common.row_key(F.col("doc_id"), F.col("text"))
    benchmark = common.table(spark, sf_dir, "benchmark", "item_id", "text")
    found = decontaminate.contamination(docs.select(key.alias("key"), "text"), benchmark, id_col="key", floor=decontaminate.THRESHOLD)
    held = common.cut(found.filter("contaminated").select(F.unhex("key").alias(own)).distinct())
    return docs.withColumn(own, F.unhex(key)).join(held, own, "left_anti").drop(own)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by surrogates."""
    text = F.col("pii.text")
    fresh = {"text": text, "n_chars": F.length(text).cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    key = spark.conf.get("spark.tracklane.pii.key", pii_surrogates.KEY)
    return pii_surrogates.replace(docs, key).select(*[fresh.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    import public_tokenizers

    return packing.pack_documents(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", common.tidy(quality)),
    ("simhash_dedup", common.tidy(near_dedup)),
    ("decontaminate", common.tidy(decontamination)),
    ("pii_surrogates", common.tidy(pii)),
    ("best_fit_packing", common.tidy(pack)),
]
#: The learned rules, the hashes and the packing have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        # Once its rows are written, nothing else of a stage is needed, nor of the one before.
        before, docs = docs, common.tidy(lambda docs=docs, stage=stage: common.cut(stage(spark, docs, sf_dir)))()
        common.discard(before)
    return docs

"""URL filter: longest host/path rule, else a weighted vocabulary found by an Aho-Corasick automaton.

A term counts only where both neighbours are no ASCII letter or digit. A url is rejected on one strict term, or on two
or more distinct soft terms whose weights sum to `soft_limit`. The vocabulary is a parameter, and may come from a table
(term, weight) of at most MAX_TERMS rows by `read_vocabulary`; it is the only thing that every task gets. Null urls, and urls without "://", have an empty host and path; the vocabulary still
reads the whole url (null: nothing, so it is allowed). Repeated rows give repeated rows.
"""

from __future__ import annotations

import csv
import pkgutil
import string
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklane.llm import common
from tracklane.llm.term_hits import automaton, hits

#: A weight of STRICT_WEIGHT makes a term strict.
STRICT_WEIGHT, SOFT_LIMIT, MAX_TERMS = 100.0, 2.0, 1_000_000
#: The setting that names a table (term, weight) to use in place of the terms that come with this module.
SETTING = "spark.tracklane.url.vocabulary"
#: (action, host and path) of the production rules, fixed by the query's contract.
RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))


def read_vocabulary(table: DataFrame) -> tuple[tuple[str, ...], dict[str, float]]:
    """(strict terms, soft terms with weights) of a table (term, weight): lower case, of equal terms the greatest weight."""
    rows = table.filter("trim(term) <> '' AND weight > 0").groupBy(F.lower(F.trim("term")).alias("term")).agg(F.max("weight").alias("weight")).limit(MAX_TERMS + 1).collect()
    if len(rows) > MAX_TERMS:
        raise ValueError(f"more than {MAX_TERMS} terms")
    return tuple(sorted(r.term for r in rows if r.weight >= STRICT_WEIGHT)), {r.term: float(r.weight) for r in rows if r.weight < STRICT_WEIGHT}


def own_terms() -> list[tuple[str, float]]:
    """The (term, weight) pairs that come with this module, be it a file or in an archive."""
    text = pkgutil.get_data("tracklane.llm", "url_terms.csv").decode()
    return [(r["term"], float(r["weight"])) for r in csv.DictReader(text.splitlines())]


STRICT = tuple(t for t, w in own_terms() if w >= STRICT_WEIGHT)
SOFT = {t: w for t, w in own_terms() if w < STRICT_WEIGHT}


def vocabulary(spark: SparkSession) -> tuple[tuple[str, ...], dict[str, float]]:
    """The strict and soft terms of the table that the setting names, else of those that come with this module."""
    named = spark.conf.get(SETTING, None)
    return read_vocabulary(spark.read.parquet(named) if named else spark.createDataFrame(own_terms(), "term string, weight double"))


def host_path(url: Column) -> tuple[Column, Column]:
    whole = F.coalesce(url, F.lit(""))
    part = lambda k: F.regexp_extract(whole, r"(?s)^.*?://([^/?#]*)([^?#]*)", k)
    return F.translate(part(1), string.ascii_uppercase, string.ascii_lowercase), part(2)


def filter_urls(
    df: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    strict: Sequence[str] = STRICT,
    soft: Mapping[str, float] = SOFT,
    soft_limit: float = SOFT_LIMIT,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """(id, host, path, rule, verdict, n_strict, n_soft, soft_weight): one narrow stage; only id and url are read."""
    strict, weights = tuple(strict), dict(soft)
    schema = f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, url string, n_strict int, n_soft int, soft_weight double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = automaton(strict, tuple(weights))
        for batch in batches:
            found = [hits(own, u) for u in batch.column("u").to_pylist()]
            columns = [pa.array([len(x[k]) for x in found], pa.int32()) for k in (0, 1)] + [pa.array([sum(weights[t] for t in x[1]) for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column("i"), batch.column("u"), *columns], names=[id_col, "url", "n_strict", "n_soft", "soft_weight"])

    counted = df.select(df[id_col].alias("i"), df[url_col].alias("u")).mapInArrow(run, schema)
    host, path = host_path(F.col("url"))
    counted = counted.select(F.col(id_col), host.alias("host"), path.alias("path"), "n_strict", "n_soft", "soft_weight")
    rule = action = None
    for what, text in sorted(rules, key=lambda r: -len(r[1])):  # the longest first
        h, _, p = text.partition("/")
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith("/" + p)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        action = F.when(fits, what) if action is None else action.when(fits, what)
    several = (F.col("n_soft") >= 2) & (F.col("soft_weight") >= soft_limit)
    method = F.when((F.col("n_strict") > 0) | several, "block").otherwise("allow")
    return counted.select(
        id_col, "host", "path", (rule if rule is not None else F.lit(None).cast("string")).alias("rule"),
        (F.coalesce(action, method) if action is not None else method).alias("verdict"), "n_strict", "n_soft", "soft_weight",
    )


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    strict, soft = vocabulary(spark)
    return filter_urls(common.table(spark, sf_dir, "pages", "page_id", "url"), strict=strict, soft=soft)


def _sql() -> str:
    one = lambda t: f"CAST(regexp_matches(u, '(^|[^a-z0-9]){t}([^a-z0-9]|$)') AS INT)"
    some = lambda terms: " + ".join(map(one, terms))
    weight = " + ".join(f"{w} * {one(t)}" for t, w in SOFT.items())
    rules = sorted(RULES, key=lambda r: -len(r[1]))
    fits = lambda t: f"((host = '{(h := t.partition('/')[0])}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{t.partition('/')[2]}'))"
    rule = "CASE " + " ".join(f"WHEN {fits(t)} THEN '{t}'" for _, t in rules) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fits(t)} THEN '{a}'" for a, t in rules) + f" WHEN n_strict > 0 OR n_soft >= 2 AND soft_weight >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END"
    return f"""
WITH p AS (
  SELECT page_id, lower(coalesce(url, '')) AS u,
    translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', 1), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
    regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
c AS (SELECT page_id, host, path, CAST({some(STRICT)} AS INT) AS n_strict, CAST({some(SOFT)} AS INT) AS n_soft, CAST({weight} AS DOUBLE) AS soft_weight FROM p)
SELECT page_id, host, path, {rule} AS rule, {verdict} AS verdict, n_strict, n_soft, soft_weight FROM c"""


ORACLE_SQL = _sql()

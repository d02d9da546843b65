import os
import random
import re
import subprocess
import sys
from types import SimpleNamespace

from conftest import DATA

from tracklane.llm import url_filter


def test_equals_sql(spark, same_as_sql):
    same_as_sql(url_filter.op8_url_filter(spark, f"{DATA}/sf0.001"), url_filter.ORACLE_SQL, f"{DATA}/sf0.001")


def test_rules_and_vocabulary(spark, same_as_sql, tmp_path):
    rng = random.Random(1)
    terms = [*url_filter.STRICT, *url_filter.SOFT, "sunbet", "freedom", "a", "7", "8"]
    urls = [
        None, "", "example.com/en/7", "HTTP://Example.COM/en/71?x", "https://a.b.net/de/1", "http://example.net/de/8#f", "http://notexample.net/de/8", "http://x.org/es/1", "http://org/es/", "http://h?/a://b", "http://example.com/en",
        *["http://" + "".join(rng.choice([*".-/?_", *terms]) for _ in range(9)) for _ in range(200)],
    ]
    df = spark.createDataFrame([(k, u, "x") for k, u in enumerate([*urls, urls[3]])], "page_id bigint, url string, u string")
    df.write.parquet(str(tmp_path / "p"))
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/p/*.parquet'")
    con.execute(f"SELECT * FROM ({url_filter.ORACLE_SQL}) ORDER BY page_id")
    names = [x[0] for x in con.description]
    assert [tuple(r[c] for c in names) for r in url_filter.filter_urls(df).orderBy("page_id").collect()] == con.fetchall()
    by = {r.page_id: (r.rule, r.verdict) for r in url_filter.filter_urls(df).collect()}
    assert [by[k] for k in (0, 3, 4, 5, 6, 7, 8)] == [(None, "allow"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("net/de/", "allow"), ("org/es/", "block"), ("org/es/", "block")]
    assert url_filter.filter_urls(df.filter("false")).count() == 0


def test_the_query_reads_the_table_that_the_setting_names(spark, tmp_path):
    spark.createDataFrame([("www", 100.0)], "term string, weight double").write.parquet(str(tmp_path / "terms"))
    own = {r.page_id: r.n_strict for r in url_filter.op8_url_filter(spark, f"{DATA}/sf0.001").collect()}
    spark.conf.set(url_filter.SETTING, str(tmp_path / "terms"))
    try:
        other = {r.page_id: (r.n_strict, r.n_soft) for r in url_filter.op8_url_filter(spark, f"{DATA}/sf0.001").collect()}
    finally:
        spark.conf.unset(url_filter.SETTING)
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{DATA}/sf0.001/pages.parquet").collect()}
    assert other.keys() == own.keys() and all(n == (int("www" in re.split("[^a-z0-9]", (urls[k] or "").lower())), 0) for k, n in other.items())


def test_vocabulary_of_a_table_with_weights(spark):
    rows = [(" Evil ", 100.0), ("soft", 1.5), ("Soft", 0.5), ("mild", 0.5), ("faint", 0.25), ("", 9.0), (None, 9.0), ("none", 0.0)]
    strict, soft = url_filter.read_vocabulary(spark.createDataFrame(rows, "term string, weight double"))
    assert (strict, soft) == (("evil",), {"soft": 1.5, "mild": 0.5, "faint": 0.25})
    urls = ["http://h/evil", "http://h/soft", "http://h/soft-mild", "http://h/soft/soft", "http://h/mild-faint", "http://h/devil-softmild"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = url_filter.filter_urls(df, rules=(), strict=strict, soft=soft).orderBy("page_id").collect()
    assert [r.verdict for r in got] == ["block", "allow", "block", "allow", "allow", "allow"]
    assert [r.soft_weight for r in got] == [0.0, 1.5, 2.0, 1.5, 0.75, 0.0]
    assert url_filter.filter_urls(df, rules=(), strict=(), soft={}).filter("verdict = 'allow'").count() == len(urls)


def test_the_modules_that_a_cluster_gets_find_their_terms(tmp_path):
    import __spark_entry__ as entry

    sent = []
    entry._ship(SimpleNamespace(sparkContext=SimpleNamespace(applicationId=str(tmp_path), master="spark://none", addPyFile=sent.append)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = "import sys; sys.path.insert(0, sys.argv[1]); from tracklane.llm import url_filter as u; print(u.__file__, len(u.own_terms()), u.hits(u.automaton(u.STRICT, ()), 'http://h/' + u.STRICT[0]))"
    said = subprocess.run([sys.executable, "-c", code, sent[0]], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert said.stdout == f"{sent[0]}/tracklane/llm/url_filter.py {len(url_filter.own_terms())} {({url_filter.STRICT[0]}, set())}\n", said.stderr

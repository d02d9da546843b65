"""Queries on cells: cleaning, folding, parsing, aligning, merging."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracklane.functions import parse, text
from tracklane.operators import files, first_fit, grid, tracks
from tracklane.plans.base import SPACE, Registry, fold_sql, strip_sql, table

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles


@R.add(f"SELECT lower(regexp_replace({fold_sql('p_name')}, '[^\\p{{L}}\\p{{N}}]', '', 'g')) AS title_key, CAST(count(*) AS BIGINT) AS n, CAST(sum(p_size) AS BIGINT) AS total_size FROM part GROUP BY 1")
def title_key_summary(spark, sf_dir):
    parts = table(spark, sf_dir, "part", "p_name", "p_size")
    # The fold runs once for each distinct name.
    by_name = parts.groupBy("p_name").agg(F.count("*").alias("n"), F.sum("p_size").alias("s"))
    return by_name.groupBy(text.title_key(F.col("p_name")).alias("title_key")).agg(F.sum("n").alias("n"), F.sum("s").alias("total_size"))


@R.add(f"""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
u AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS line_no FROM l),
b AS (SELECT doc_id, line_no, regexp_replace({strip_sql('line')}, '^\\x{{FEFF}}+', '') AS bare FROM u)
SELECT doc_id, CAST(line_no AS INT) AS line_no, regexp_replace(bare, '{SPACE}+', ' ', 'g') AS line FROM b
WHERE bare <> '' AND NOT (line_no = 0 AND starts_with(lower(bare), 'sep='))""")
def line_clean(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    rows = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return rows.withColumn("line", text.clean_line(F.col("line"), F.col("line_no"))).filter(F.col("line").isNotNull())


@R.add(f"SELECT conv_id, turn, {strip_sql('role')} AS role, {fold_sql('text')} AS folded FROM conversations")
def cell_strip_fold(spark, sf_dir):
    return table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").select("conv_id", "turn", text.strip(F.col("role")).alias("role"), text.fold(F.col("text")).alias("folded"))


@R.add("""
SELECT CAST(c_name AS VARCHAR) AS "Title", CAST(c_mktsegment AS VARCHAR) AS "Genre", CAST(c_custkey AS VARCHAR) AS key, '' AS nation, 1 AS "Count" FROM customer
UNION ALL SELECT s_name, '', CAST(s_suppkey AS VARCHAR), CAST(s_nationkey AS VARCHAR), 1 FROM supplier""")
def union_by_name_align(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("Key"), F.col("c_name").alias(" Title "), F.col("c_mktsegment").alias("GENRE"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("title"), F.col("s_suppkey").alias("key"), F.col("s_nationkey").alias("Nation"))
    return grid.align([a, b])


_FIT = """
WITH r AS (SELECT p_name, p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_brand END AS brand, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_type END AS type FROM part),
g AS (SELECT p_name, list({'b': brand, 't': type, 'n': CAST(1 AS BIGINT), 'f': p_partkey} ORDER BY p_partkey) AS rows FROM r GROUP BY 1),
m AS (SELECT p_name, list_reduce(list_transform(rows, lambda x: [x]), lambda acc, y:
  CASE WHEN len(list_filter(acc, lambda e: (e.b = '' OR y[1].b = '' OR e.b = y[1].b) AND (e.t = '' OR y[1].t = '' OR e.t = y[1].t))) = 0 THEN list_concat(acc, y)
  ELSE list_transform(acc, lambda e: CASE WHEN e.f = list_filter(acc, lambda z: (z.b = '' OR y[1].b = '' OR z.b = y[1].b) AND (z.t = '' OR y[1].t = '' OR z.t = y[1].t))[1].f
    THEN {'b': CASE WHEN e.b = '' THEN y[1].b ELSE e.b END, 't': CASE WHEN e.t = '' THEN y[1].t ELSE e.t END, 'n': e.n + y[1].n, 'f': e.f} ELSE e END) END) AS es FROM g),
x AS (SELECT p_name, unnest(es) AS e, unnest(range(len(es))) AS entry FROM m)
SELECT p_name, CAST(entry AS INT) AS entry, e.b AS brand, e.t AS type, e.n AS n, e.f AS first_key FROM x"""


@R.add(_FIT)
def first_fit_merge(spark, sf_dir):
    p = table(spark, sf_dir, "part", "p_name", "p_partkey", "p_brand", "p_type")
    brand = F.when(F.col("p_partkey") % 3 == 0, "").otherwise(F.col("p_brand"))
    kind = F.when(F.col("p_partkey") % 5 == 0, "").otherwise(F.col("p_type"))
    out = first_fit.merge(p, {"p_name": F.col("p_name")}, {"brand": (brand, brand), "type": (kind, kind)}, F.lit(1), ["p_partkey"])
    return first_fit.numbered(out, ["p_name"]).select("p_name", "entry", "brand", "type", "n", F.col("at.p_partkey").alias("first_key"))


@R.add(f"""
WITH r AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place, role FROM conversations)
SELECT conv_id, turn, CAST(place AS INT) AS place, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS INT) AS kept_place FROM r WHERE role <> 'user'""")
def ordinal_before_filter(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role")
    return files.ordinals(rows, ["conv_id"], ["turn"], F.col("role") != "user").select("conv_id", "turn", "place", "kept_place")


_RAW = """
r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_partkey % 7 = 0 THEN ' ' ELSE ' T' || l_partkey || ' ' END AS title, CASE WHEN l_suppkey % 11 = 0 THEN '' ELSE 'A' || l_suppkey END AS artist,
  printf('%d:%02d', l_suppkey % 70, CAST(l_quantity AS INT) + 15) AS length,
  CASE l_partkey % 4 WHEN 0 THEN CAST(90 + l_suppkey % 40 AS VARCHAR) WHEN 1 THEN '1e2' WHEN 2 THEN '12x' ELSE ' ' || (90 + l_suppkey % 40) || '.50' END AS bpm,
  CASE l_partkey % 3 WHEN 0 THEN CAST(year(l_shipdate) AS VARCHAR) WHEN 1 THEN year(l_shipdate) || '.0' ELSE '' END AS year,
  CASE l_linenumber % 4 WHEN 0 THEN '7:05' WHEN 1 THEN '19:30:10' WHEN 2 THEN '12:05 am' ELSE '1:05 PM' END AS play_time FROM lineitem)"""


def _raw(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    p, s, n = F.col("l_partkey"), F.col("l_suppkey"), F.lit("")
    year = F.year("l_shipdate").cast("string")
    bpm = (F.lit(90) + s % 40).cast("string")
    return l.select(
        "l_orderkey", "l_linenumber", F.col("l_linenumber").alias("play_order"), n.alias("label"), F.when(p % 7 == 0, " ").otherwise(F.concat(F.lit(" T"), p.cast("string"), F.lit(" "))).alias("title"), n.alias("remix"),
        F.when(s % 11 == 0, "").otherwise(F.concat(F.lit("A"), s.cast("string"))).alias("artist"), n.alias("comment"), n.alias("genre"), F.format_string("%d:%02d", s % 70, F.col("l_quantity").cast("int") + 15).alias("length"),
        F.when(p % 4 == 0, bpm).when(p % 4 == 1, "1e2").when(p % 4 == 2, "12x").otherwise(F.concat(F.lit(" "), bpm, F.lit(".50"))).alias("bpm"),
        F.when(p % 3 == 0, year).when(p % 3 == 1, F.concat(year, F.lit(".0"))).otherwise("").alias("year"),
        F.when(F.col("l_linenumber") % 4 == 0, "7:05").when(F.col("l_linenumber") % 4 == 1, "19:30:10").when(F.col("l_linenumber") % 4 == 2, "12:05 am").otherwise("1:05 PM").alias("play_time"),
    )


_NUM = "regexp_matches(trim({x}), '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$')"
_DOUBLE = f"CASE WHEN {_NUM.format(x='bpm')} THEN TRY_CAST(trim(bpm) AS DOUBLE) END"
_LENGTH = "CASE WHEN regexp_matches(length, '^[0-9]{1,3}:[0-9]{2}$') AND CAST(string_split(length, ':')[2] AS INT) < 60 THEN CAST(string_split(length, ':')[1] AS INT) * 60 + CAST(string_split(length, ':')[2] AS INT) END"


@R.add(f"""WITH {_RAW}
SELECT l_orderkey, l_linenumber, l_linenumber AS play_order, trim(title) AS title, artist, {_LENGTH} AS length_secs, {_DOUBLE} AS bpm,
  CASE WHEN regexp_matches(year, '^[0-9]+$') THEN CAST(year AS INT) END AS release_year, CASE WHEN regexp_matches(play_time, '^[0-9]{{1,2}}:[0-9]{{2}}(:[0-9]{{2}})?$') THEN play_time END AS play_time
FROM r WHERE trim(title) <> '' AND artist <> ''""")
def typed_track_projection(spark, sf_dir):
    return tracks.typed(_raw(spark, sf_dir)).drop("label", "remix", "comment", "genre")


@R.add(f"""WITH {_RAW}
SELECT l_orderkey, l_linenumber, trim(title) AS title, {_LENGTH} AS length_secs, CAST(TRY_CAST(nullif(year, '') AS DOUBLE) AS INT) AS release_year,
  CASE l_linenumber % 4 WHEN 0 THEN '7:05' WHEN 1 THEN '19:30:10' WHEN 2 THEN '00:05' ELSE '13:05' END AS play_time
FROM r WHERE trim(title) <> '' AND artist <> ''""")
def typed_old_workbooks(spark, sf_dir):
    return tracks.typed(_raw(spark, sf_dir), old_workbooks=True).select("l_orderkey", "l_linenumber", "title", "length_secs", "release_year", "play_time")


@R.add("""
WITH r AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INT) AS q, CAST(l_suppkey % 75 AS INT) AS m FROM lineitem),
t AS (SELECT *, CASE q % 3 WHEN 0 THEN printf('%d:%02d', m, q) WHEN 1 THEN printf('00:%d:%02d', m, q) ELSE printf('1:%02d:%02d', m, q) END AS raw FROM r)
SELECT l_orderkey, l_linenumber, raw, CASE WHEN m >= 60 THEN raw WHEN q % 3 = 2 THEN printf('1:%02d:%02d', m, q) ELSE printf('%d:%02d', m, q) END AS length_key FROM t""")
def length_key(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_suppkey")
    q, m = F.col("l_quantity").cast("int"), (F.col("l_suppkey") % 75).cast("int")
    raw = F.when(q % 3 == 0, F.format_string("%d:%02d", m, q)).when(q % 3 == 1, F.format_string("00:%d:%02d", m, q)).otherwise(F.format_string("1:%02d:%02d", m, q))
    return l.select("l_orderkey", "l_linenumber", raw.alias("raw")).withColumn("length_key", parse.length_key(F.col("raw")))


@R.add("""
WITH r AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INT) AS q, CAST(90 + l_suppkey % 60 AS INT) AS b FROM lineitem),
t AS (SELECT *, CASE q % 4 WHEN 0 THEN CAST(b AS VARCHAR) WHEN 1 THEN b || '.0' WHEN 2 THEN b || '.250' ELSE b || ' bpm' END AS raw FROM r)
SELECT l_orderkey, l_linenumber, CASE q % 4 WHEN 0 THEN CAST(b AS VARCHAR) WHEN 1 THEN CAST(b AS VARCHAR) WHEN 2 THEN b || '.25' ELSE raw END AS bpm_key FROM t""")
def bpm_key(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_suppkey")
    q, b = F.col("l_quantity").cast("int"), (90 + F.col("l_suppkey") % 60).cast("string")
    raw = F.when(q % 4 == 0, b).when(q % 4 == 1, F.concat(b, F.lit(".0"))).when(q % 4 == 2, F.concat(b, F.lit(".250"))).otherwise(F.concat(b, F.lit(" bpm")))
    return l.select("l_orderkey", "l_linenumber", parse.bpm_key(raw).alias("bpm_key"))

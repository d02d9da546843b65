"""Queries on sheets: tracks and payloads, the year's summary, its merge, and what sinks make of them."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from tracklane import modes
from tracklane.operators import files, first_fit, grid, summaries, tracks
from tracklane.plans.base import Registry, fold_sql, scratch, table
from tracklane.sources import archives, sinks, stores
from tracklane.sources import files as sources

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles

_TABS = {
    "a": [" Title ", "ARTIST", "Genre", "Notes", "length", "BPM"],
    "b": ["artist", "Title", "Comment", "Year", "title"],
    "c": ["Other", "Notes"],
    "d": ["Title", "Artist"],
}
_CELLS = """CASE o_orderkey % 4 WHEN 0 THEN 'b' WHEN 3 THEN 'c' ELSE 'a' END AS tab, CAST(o_orderkey AS INT) AS row_ord, CAST(year(o_orderdate) AS VARCHAR) AS source_id,
  CASE o_custkey % 6 WHEN 0 THEN 'Té ' WHEN 1 THEN 'te-' WHEN 2 THEN ' TE ' ELSE 'Song' END || o_custkey % 12 AS title, CASE o_orderkey % 23 WHEN 0 THEN ' ' WHEN 1 THEN 'ＡＢＣ' ELSE 'Abc' END AS artist,
  CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'House' ELSE ' house' END AS genre, CASE o_orderkey % 7 WHEN 0 THEN '２:５４' WHEN 1 THEN '00:2:54' WHEN 2 THEN '3:00' WHEN 3 THEN '' ELSE '2:54' END AS length,
  CASE o_orderkey % 9 WHEN 0 THEN '100' WHEN 1 THEN '100.0' WHEN 2 THEN '98.50' ELSE '' END AS bpm, CASE o_orderkey % 11 WHEN 0 THEN 'x' WHEN 1 THEN 'y ' ELSE '' END AS comment,
  CASE WHEN o_orderkey % 13 = 0 THEN '2020' ELSE '' END AS year"""


def _sheets(spark, sf_dir):
    """A grid: a source for each year, three tabs of ragged rows, and a tab of a header only."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    title = F.concat(F.when(c % 6 == 0, "Té ").when(c % 6 == 1, "te-").when(c % 6 == 2, " TE ").otherwise("Song"), (c % 12).cast("string"))
    artist = F.when(k % 23 == 0, " ").when(k % 23 == 1, "ＡＢＣ").otherwise("Abc")
    genre = F.when(k % 5 == 0, "").when(k % 5 == 1, "House").otherwise(" house")
    length = F.when(k % 7 == 0, "２:５４").when(k % 7 == 1, "00:2:54").when(k % 7 == 2, "3:00").when(k % 7 == 3, "").otherwise("2:54")
    bpm = F.when(k % 9 == 0, "100").when(k % 9 == 1, "100.0").when(k % 9 == 2, "98.50").otherwise("")
    comment, year = F.when(k % 11 == 0, "x").when(k % 11 == 1, "y ").otherwise(""), F.when(k % 13 == 0, "2020").otherwise("")
    note = F.lit("n")
    # Rows are ragged where what follows is blank; some rows hold nothing but a column that is dropped.
    a = F.when(k % 29 == 0, F.array(F.lit(""), F.lit(" "), F.lit(""), note)).when((k % 5 == 0) & (k % 7 == 3) & (k % 9 > 2), F.array(title, artist)).otherwise(F.array(title, artist, genre, note, length, bpm))
    b = F.when(k % 29 == 0, F.array(F.lit(" "), F.lit(""))).otherwise(F.array(artist, F.lit("old"), comment, year, title, F.lit("too long")))
    tab = F.when(k % 4 == 0, "b").when(k % 4 == 3, "c").otherwise("a")
    source = F.year("o_orderdate").cast("string")
    rows = o.select(source.alias("source_id"), tab.alias("tab"), k.cast("int").alias("row_ord"), F.when(tab == "a", a).when(tab == "b", b).otherwise(F.array(note, note)).alias("cells"))
    heads = o.select(source.alias("source_id")).distinct().crossJoin(spark.createDataFrame(list(_TABS.items()), "tab string, cells array<string>"))  # a few years, four tabs
    return rows.unionByName(heads.select("source_id", "tab", F.lit(0).alias("row_ord"), "cells"))


# Blank rows vanish; rows that hold only a dropped column stay, blank.
_ROWS = f"""r AS (SELECT {_CELLS} FROM orders), s AS (SELECT source_id, tab, row_ord,
  CASE WHEN row_ord % 29 = 0 THEN '' ELSE trim(title) END AS "Title", CASE WHEN row_ord % 29 = 0 THEN '' ELSE trim(artist) END AS "Artist", CASE WHEN tab = 'b' THEN trim(comment) ELSE '' END AS "Comment",
  CASE WHEN row_ord % 29 = 0 OR tab = 'b' THEN '' ELSE trim(genre) END AS "Genre", CASE WHEN tab = 'b' THEN year ELSE '' END AS "Year", CASE WHEN row_ord % 29 = 0 OR tab = 'b' THEN '' ELSE bpm END AS "BPM",
  CASE WHEN row_ord % 29 = 0 OR tab = 'b' THEN '' ELSE length END AS "Length" FROM r WHERE tab <> 'c' AND NOT (tab = 'b' AND row_ord % 29 = 0))"""
_SHOWN = '"Title", "Artist", "Comment", "Genre", "Year", "BPM", "Length"'


@R.add(f'WITH {_ROWS} SELECT source_id, tab, row_ord, {_SHOWN}, 1 AS "Count" FROM s')
def summary_combined(spark, sf_dir):
    return summaries.combined(_sheets(spark, sf_dir)).withColumns({c: F.col("at")[c] for c in summaries.PLACE}).drop("at")


@R.add(f'WITH {_ROWS} SELECT source_id, tab, row_ord, "Title", CAST(row_number() OVER (ORDER BY "Title", source_id, tab, row_ord) AS INT) AS place FROM s')
def summary_order(spark, sf_dir):
    return grid.sorted_summary(grid.summary_rows(_sheets(spark, sf_dir))).select("source_id", "tab", "row_ord", "Title", "place")


def _merge_sql(rows: str, group: str, optional: list[str], order: str, count: str = "1") -> str:
    """CTEs `merged` (group columns, entry number, shown optional values, n, pos): a plain first-fit loop over `rows`.

    `rows` has for each optional column x a compared value k_x and a shown value v_x.
    """
    fields = ", ".join(f"'k_{x}': k_{x}, 'v_{x}': v_{x}" for x in optional)
    fits = lambda e: " AND ".join(f"({e}.k_{x} = '' OR y[1].k_{x} = '' OR {e}.k_{x} = y[1].k_{x})" for x in optional)
    filled = ", ".join(f"'k_{x}': CASE WHEN e.k_{x} = '' THEN y[1].k_{x} ELSE e.k_{x} END, 'v_{x}': CASE WHEN e.k_{x} = '' AND y[1].k_{x} <> '' THEN y[1].v_{x} ELSE e.v_{x} END" for x in optional)
    return f"""g AS (SELECT {group}, list({{{fields}, 'n': CAST({count} AS BIGINT), 'pos': {order}}} ORDER BY {order}) AS rows FROM {rows} GROUP BY {group}),
m AS (SELECT {group}, list_reduce(list_transform(rows, lambda x: [x]), lambda acc, y: CASE WHEN len(list_filter(acc, lambda e: {fits('e')})) = 0 THEN list_concat(acc, y)
  ELSE list_transform(acc, lambda e: CASE WHEN e.pos = list_filter(acc, lambda z: {fits('z')})[1].pos THEN {{{filled}, 'n': e.n + y[1].n, 'pos': e.pos}} ELSE e END) END) AS es FROM g),
merged AS (SELECT {group}, unnest(es) AS e, unnest(range(len(es))) AS entry FROM m)"""


_LEN = """CASE {x} WHEN '２:５４' THEN '2:54' WHEN '00:2:54' THEN '2:54' ELSE {x} END"""
_BPM = """CASE {x} WHEN '100.0' THEN '100' WHEN '98.50' THEN '98.5' ELSE {x} END"""
_KEYED = f"""k AS (SELECT *, lower(regexp_replace({fold_sql('"Title"')}, '[^\\p{{L}}\\p{{N}}]', '', 'g')) AS tk, CASE WHEN lower("Artist") = 'ａｂｃ' OR "Artist" = 'ＡＢＣ' THEN 'abc' ELSE lower("Artist") END AS ak,
  {{'t': "Title", 's': source_id, 'b': tab, 'r': row_ord}} AS pos, "Comment" AS k_c, "Comment" AS v_c, "Genre" AS k_g, "Genre" AS v_g, "Year" AS k_y, "Year" AS v_y, {_LEN.format(x='"Length"')} AS k_l, "Length" AS v_l,
  {_BPM.format(x='"BPM"')} AS k_b, "BPM" AS v_b FROM s)"""
_SUMMARY = f"WITH {_ROWS}, {_KEYED}, {_merge_sql('k', 'tk, ak', ['c', 'g', 'y', 'l', 'b'], 'pos')}"


@R.add(f"""{_SUMMARY} SELECT e.pos.t AS "Title", s."Artist", e.v_c AS "Comment", e.v_g AS "Genre", e.v_y AS "Year", e.v_b AS "BPM", e.v_l AS "Length", e.n AS "Count", e.pos.r AS row_ord
FROM merged JOIN s ON s.source_id = e.pos.s AND s.tab = e.pos.b AND s.row_ord = e.pos.r""")
def summary_merged(spark, sf_dir):
    return modes.run("summaries", _sheets(spark, sf_dir)).withColumn("row_ord", F.col("first_at.at.row_ord")).drop("first_at", "key_at")


@R.add(f"""{_SUMMARY}, o AS (SELECT *, min(e.pos) OVER (PARTITION BY tk, ak) AS kp FROM merged)
SELECT e.pos.t AS "Title", e.pos.r AS row_ord, CAST(dense_rank() OVER (ORDER BY kp) AS BIGINT) AS key_rank, CAST(entry AS INT) AS entry, e.n AS "Count" FROM o""")
def summary_places(spark, sf_dir):
    """The order of a de-duplicated sheet: keys by first appearance, and a key's entries as they were made."""
    merged = first_fit.ranked(modes.run("summaries", _sheets(spark, sf_dir)), "first_at")
    return first_fit.numbered(merged, ["key_at"], "first_at").select("Title", F.col("first_at.at.row_ord").alias("row_ord"), "key_rank", "entry", "Count")


@R.add(f"{_SUMMARY} SELECT (SELECT count(*) FROM s) AS rows_before, count(*) AS rows_after, CAST(sum(e.n) AS BIGINT) AS total_count FROM merged")
def summary_totals(spark, sf_dir):
    rows = summaries.combined(_sheets(spark, sf_dir))
    return first_fit.totals(rows, first_fit.deduplicate(rows, ["at"]), "Count")


_COUNTED = """r AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS source_id, CASE WHEN o_custkey % 2 = 0 THEN 'with' ELSE 'without' END AS tab, CAST(o_orderkey AS INT) AS row_ord, 'T' || o_custkey % 9 AS t,
  CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'ｈouse' ELSE 'House' END AS v_g, CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'house' ELSE 'House' END AS k_g, CASE o_orderkey % 7 WHEN 0 THEN '2' WHEN 1 THEN 'two' ELSE ' 1 ' END AS c,
  CASE o_orderkey % 6 WHEN 0 THEN 'a' || chr(160) || 'b' ELSE 'A b' END AS note FROM orders),
k AS (SELECT *, CASE WHEN tab = 'without' THEN 1 WHEN c = 'two' THEN 0 ELSE CAST(trim(c) AS INT) END AS n, lower(t) AS tk, CASE WHEN tab = 'without' THEN '' ELSE 'a b' END AS nk FROM r)"""


@R.add(f"""WITH {_COUNTED}, {_merge_sql('k', 'source_id, tab, tk', ['g'], 'row_ord', 'n')}
SELECT source_id, tab, min(e.pos) OVER (PARTITION BY source_id, tab, tk) AS key_row, CAST(entry AS INT) AS entry, e.pos AS row_ord, e.n AS count, CASE WHEN tab = 'with' THEN ['Ｔｉｔｌｅ', ' GENRE', 'Note', 'count'] ELSE ['title', 'Genre'] END AS header,
  CASE WHEN tab = 'with' THEN [r.t || '!', e.v_g, CASE WHEN e.pos % 6 = 0 THEN 'a b' ELSE 'A b' END, CAST(e.n AS VARCHAR)] ELSE [r.t || '!', e.v_g] END AS cells
FROM merged JOIN (SELECT row_ord AS ro, t FROM r) r ON ro = e.pos""")
def grid_merged(spark, sf_dir):
    """Sheets with and without a count, headers in odd forms, ragged and long rows."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    genre = F.when(k % 5 == 0, "").when(k % 5 == 1, "ｈouse").otherwise("House")
    count = F.when(k % 7 == 0, "2").when(k % 7 == 1, "two").otherwise(" 1 ")
    note = F.when(k % 6 == 0, "a b").otherwise("A b")
    title = F.concat(F.lit("T"), (c % 9).cast("string"), F.lit("!"))
    has = c % 2 == 0
    cells = F.when(has, F.array(title, genre, note, count, F.lit("cut"))).when(k % 5 == 0, F.array(title)).otherwise(F.array(title, genre))
    header = F.when(has, F.array(*map(F.lit, ("Ｔｉｔｌｅ", " GENRE", "Note", "count")))).otherwise(F.array(F.lit("title"), F.lit("Genre")))
    rows = o.select(F.year("o_orderdate").cast("string").alias("source_id"), F.when(has, "with").otherwise("without").alias("tab"), k.cast("int").alias("row_ord"), header.alias("header"), cells.alias("cells"))
    return first_fit.deduplicate_grid(rows)


_TRACKS = f"""WITH r AS (SELECT {_CELLS} FROM orders), s AS (SELECT source_id, row_ord, tab, CASE WHEN row_ord % 29 = 0 THEN '' ELSE trim(title) END AS title, CASE WHEN row_ord % 29 = 0 THEN '' ELSE trim(artist) END AS artist, trim(genre) AS genre, length, bpm FROM r WHERE tab = 'a'),
t AS (SELECT source_id, tab, row_ord AS play_order, title, artist, nullif(genre, '') AS genre, CASE length WHEN '3:00' THEN 180 WHEN '2:54' THEN 174 END AS length_secs, CASE WHEN bpm <> '' THEN CAST(bpm AS DOUBLE) END AS bpm FROM s WHERE title <> '' AND artist <> '')"""
_NONE = "CAST(NULL AS VARCHAR)"


@R.add(f"{_TRACKS} SELECT *, {_NONE} AS label, {_NONE} AS remix, {_NONE} AS comment, CAST(NULL AS INT) AS release_year, {_NONE} AS play_time FROM t")
def sheet_tracks(spark, sf_dir):
    """The first tab of each sheet as typed tracks."""
    return modes.run("tracks", grid.first_tabs(_sheets(spark, sf_dir)))


def _meta(spark, sf_dir):
    """What is known of the sets: of repeated rows the last counts, one year is unknown, one has no venue."""
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    year = (F.lit(1992) + F.col("n_nationkey") % 6).cast("string")
    return n.select(year.alias("source_id"), F.concat(year, F.lit("-01-01")).alias("date"), F.when(F.col("n_nationkey") == 22, "").otherwise(F.col("n_name")).alias("venue"), F.concat(F.lit("L"), F.col("n_nationkey").cast("string")).alias("label"), F.col("n_nationkey").alias("ord"))


@R.add(f"""{_TRACKS}, b AS (SELECT source_id, count(*) AS n_tracks, string_agg('{{"play_order":' || play_order || ',"label":null,"title":"' || title || '","remix":null,"artist":"' || artist || '","comment":null,"genre":' ||
    coalesce('"' || genre || '"', 'null') || ',"length_secs":' || coalesce(CAST(length_secs AS VARCHAR), 'null') || ',"bpm":' || coalesce(CAST(bpm AS VARCHAR), 'null') || ',"release_year":null,"play_time":null}}', ',' ORDER BY play_order) AS ts FROM t GROUP BY 1),
  l AS (SELECT CAST(1992 + n_nationkey % 6 AS VARCHAR) AS source_id, max(n_nationkey) AS k FROM nation GROUP BY 1), m AS (SELECT l.source_id, n_name, n_nationkey FROM l JOIN nation ON n_nationkey = k)
SELECT b.source_id, n_tracks, '{{"set_date":' || coalesce('"' || m.source_id || '-01-01"', 'null') || ',"venue":' || coalesce('"' || CASE WHEN n_nationkey <> 22 THEN n_name END || '"', 'null') ||
  ',"source_file":"' || coalesce('L' || n_nationkey, b.source_id) || '","tracks":[' || ts || ']}}' AS payload FROM b LEFT JOIN m ON m.source_id = b.source_id""")
def sheet_payloads(spark, sf_dir):
    """Whole payloads, from the cells of sheets."""
    return tracks.payloads(modes.run("tracks", grid.first_tabs(_sheets(spark, sf_dir))), _meta(spark, sf_dir))


@R.add("""WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_partkey % 2 = 0 THEN 10 * l_linenumber END AS p FROM lineitem)
SELECT l_orderkey, l_linenumber, coalesce(p, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS INT)) AS play_order FROM r""")
def fallback_order(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    rows = rows.withColumn("play_order", F.when(F.col("l_partkey") % 2 == 0, (10 * F.col("l_linenumber")).cast("int")))
    return tracks.with_order(rows, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").select("l_orderkey", "l_linenumber", "play_order")


_OLD = """r AS (SELECT CAST(o_orderkey AS INT) AS k, CAST(year(o_orderdate) AS VARCHAR) AS source_id, CASE o_orderkey % 5 WHEN 0 THEN '1:02:03' WHEN 1 THEN 'T02:52:00' WHEN 2 THEN '2:05' WHEN 3 THEN '0:75:00' ELSE 'x' END AS length,
  CASE o_orderkey % 4 WHEN 0 THEN '9:05 pm' WHEN 1 THEN 'T21:07:00' WHEN 2 THEN '12:00 AM' ELSE '7' END AS at, CASE o_orderkey % 3 WHEN 0 THEN '1999.0' WHEN 1 THEN '1e3' ELSE 'y' END AS year FROM orders WHERE o_orderkey > 0)"""


@R.add(f"""WITH {_OLD} SELECT source_id, 't' AS tab, k AS play_order, 'T' || k AS title, 'A' AS artist, CASE k % 5 WHEN 0 THEN 3723 WHEN 1 THEN 172 WHEN 2 THEN 125 WHEN 3 THEN 4500 END AS length_secs, CAST(NULL AS DOUBLE) AS bpm,
  CASE k % 3 WHEN 0 THEN 1999 WHEN 1 THEN 1000 END AS release_year, CASE k % 4 WHEN 0 THEN '21:05' WHEN 1 THEN '21:07:00' WHEN 2 THEN '00:00' END AS play_time FROM r""")
def old_workbook_tracks(spark, sf_dir):
    """Old headers by their other names, native and wide forms of lengths, times and years."""
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate").filter("o_orderkey > 0")
    length = F.when(k % 5 == 0, "1:02:03").when(k % 5 == 1, "T02:52:00").when(k % 5 == 2, "2:05").when(k % 5 == 3, "0:75:00").otherwise("x")
    at = F.when(k % 4 == 0, "9:05 pm").when(k % 4 == 1, "T21:07:00").when(k % 4 == 2, "12:00 AM").otherwise("7")
    year = F.when(k % 3 == 0, "1999.0").when(k % 3 == 1, "1e3").otherwise("y")
    source = F.year("o_orderdate").cast("string").alias("source_id")
    rows = o.select(source, F.lit("t").alias("tab"), k.cast("int").alias("row_ord"), F.array(F.concat(F.lit("T"), k.cast("string")), F.lit("A"), length, at, year).alias("cells"))
    heads = o.select(source).distinct().select("source_id", F.lit("t").alias("tab"), F.lit(0).alias("row_ord"), F.array(*map(F.lit, ("Title", "Artist", "Duration", "Play Time", "Release Year"))).alias("cells"))
    return modes.run("old-workbooks", rows.unionByName(heads)).drop("label", "remix", "comment", "genre")


@R.add("""SELECT l_orderkey, l_linenumber, CAST(l_partkey % 3 AS VARCHAR) AS title, 'A' AS artist, CASE WHEN l_suppkey % 2 <> 0 THEN CAST(l_suppkey % 2 AS DOUBLE) END AS bpm FROM lineitem WHERE l_partkey % 3 <> 0""")
def zero_is_blank(spark, sf_dir):
    """Cells that are numbers: zero counts as blank."""
    l = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    none = F.lit("")
    raw = l.select(
        "l_orderkey", "l_linenumber", F.col("l_linenumber").alias("play_order"), (F.col("l_partkey") % 3).alias("title"), F.lit("A").alias("artist"), (F.col("l_suppkey") % 2).cast("double").alias("bpm"),
        *[none.alias(c) for c in ("label", "remix", "comment", "genre", "length", "year", "play_time")],
    )
    return tracks.typed(raw).select("l_orderkey", "l_linenumber", "title", "artist", "bpm")


_SENT = """s AS (SELECT o_orderkey, CAST(o_custkey % 5 AS BIGINT) AS n_tracks, CASE WHEN o_orderstatus = 'P' THEN 'HTTP 500' END AS error FROM orders)"""


def _sent(spark, sf_dir):
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    return o.select(F.col("o_orderkey").alias("label"), (F.col("o_custkey") % 5).cast("bigint").alias("n_tracks"), F.when(F.col("o_orderstatus") == "P", "HTTP 500").alias("error"))


@R.add(f"WITH {_SENT} SELECT count(*) FILTER (error IS NULL) AS sets_sent, count(error) AS sets_failed, CAST(coalesce(sum(n_tracks), 0) AS BIGINT) AS total_tracks FROM s WHERE n_tracks > 0")
def ingest_summary(spark, sf_dir):
    return tracks.ingest_summary(_sent(spark, sf_dir))


@R.add(f"WITH {_SENT} SELECT o_orderkey AS label, error FROM s WHERE n_tracks > 0 AND error IS NOT NULL")
def ingest_failures(spark, sf_dir):
    return tracks.ingest_failures(_sent(spark, sf_dir))


@R.add("""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents), u AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS line_no FROM l),
b AS (SELECT doc_id, line_no, regexp_replace(regexp_replace(coalesce(line, ''), '^\\s+|\\s+$', '', 'g'), '^\\x{FEFF}+', '') AS bare FROM u)
SELECT doc_id, string_agg(regexp_replace(bare, '\\s+', ' ', 'g'), chr(10) ORDER BY line_no) AS value FROM b WHERE bare <> '' AND NOT (line_no = 0 AND starts_with(lower(bare), 'sep=')) GROUP BY 1""")
def clean_texts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return sinks.clean_texts(sources.clean_lines(docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))), "doc_id")


@R.add("""SELECT CAST(o_orderkey AS BIGINT) AS v, CAST(year(o_orderdate) AS INT) AS year FROM orders WHERE year(o_orderdate) NOT IN (1994, 1995)
UNION ALL SELECT -CAST(o_orderkey AS BIGINT), CAST(year(o_orderdate) AS INT) FROM orders WHERE year(o_orderdate) = 1995""")
def yearly_tables(spark, sf_dir):
    """A table by year: all years written, one overwritten, one dropped, read back."""
    path = scratch(spark, "years")
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate").select(F.col("o_orderkey").alias("v"), F.year("o_orderdate").alias("year"))
    sinks.overwrite_years(o, path)
    sinks.overwrite_years(o.filter("year = 1995").withColumn("v", -F.col("v")), path)
    sinks.drop_years(spark, path, [1994])
    return spark.read.parquet(path)


@R.add(f"""{_SUMMARY}, o AS (SELECT *, row_number() OVER (ORDER BY kp, e.pos) AS place FROM (SELECT *, min(e.pos) OVER (PARTITION BY tk, ak) AS kp FROM merged))
SELECT e.pos.t AS "Title", s."Artist", e.v_g AS "Genre", e.v_l AS "Length", e.n AS "Count", CAST(place AS INT) AS place, 1995 AS year FROM o JOIN s ON s.source_id = e.pos.s AND s.tab = e.pos.b AND s.row_ord = e.pos.r""")
def summary_written(spark, sf_dir):
    """The combined table, written, and the merge of the written copy in the order of a de-duplicated sheet, read back."""
    path = scratch(spark, "summary")
    sinks.write_summary(spark, summaries.combined(_sheets(spark, sf_dir)), 1995, path, lambda rows: first_fit.in_order(first_fit.deduplicate(rows, ["at"])))
    return spark.read.parquet(f"{path}/summary").select("Title", "Artist", "Genre", "Length", "Count", "place", "year")


@R.add("SELECT CAST(year(o_orderdate) AS INT) AS source_id, CASE WHEN o_custkey % 2 = 0 THEN 'x' ELSE 'y' END AS tab, CASE WHEN o_custkey % 2 = 0 THEN -o_orderkey ELSE o_orderkey END AS v FROM orders")
def tabs_rewritten(spark, sf_dir):
    """Tabs cleared and rewritten while the others stay."""
    path = scratch(spark, "tabs")
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate", "o_custkey")
    rows = o.select(F.year("o_orderdate").alias("source_id"), F.when(F.col("o_custkey") % 2 == 0, "x").otherwise("y").alias("tab"), F.col("o_orderkey").alias("v"))
    sinks.overwrite_tabs(rows, path)
    sinks.overwrite_tabs(rows.filter("tab = 'x'").withColumn("v", -F.col("v")), path)
    return spark.read.parquet(path)


_NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
_REL = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def _workbook(rows) -> bytes:
    """A small workbook: the second of two sheets is active; a text, a time of day, a duration and a number a row."""
    text = lambda x: f'<c t="inlineStr"><is><t>{x}</t></is></c>'
    cells = [f'<row>{text("Title")}{text("Duration")}{text("Play Time")}{text("BPM")}</row>']
    cells += [f'<row>{text(r.name)}<c s="2"><v>{r.secs / 86400!r}</v></c><c s="1"><v>{r.minute / 1440!r}</v></c><c><v>{r.bpm}</v></c></row>' for r in rows]
    sheet = lambda body: f"<worksheet {_NS}><sheetData>{body}</sheetData></worksheet>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {_NS} {_REL}><bookViews><workbookView activeTab="1"/></bookViews><sheets><sheet name="a" r:id="r1"/><sheet name="b" r:id="r2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/><Relationship Id="r2" Target="worksheets/sheet2.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f'<styleSheet {_NS}><cellXfs><xf numFmtId="0"/><xf numFmtId="21"/><xf numFmtId="46"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", sheet("<row><c><v>1</v></c></row>"))
        z.writestr("xl/worksheets/sheet2.xml", sheet("".join(cells)))
    return out.getvalue()


#: Parts whose workbooks lie in one archive, so that archives are many and not large.
_PER_ARCHIVE = 4000


def _archives(folder: str):
    """Writes the archive of each group: a workbook for each of its dates, a broken one, and files that are no sets."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        name = f"{pdf['region'].iloc[0]}-{pdf['n'].iloc[0]}.zip"
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for day, rows in pdf.sort_values("k").groupby("day"):
                z.writestr(f"sets/{day} Club.xlsx", _workbook(list(rows.itertuples())))
            z.writestr("sets/2001-01-01 Broken.xlsx", b"no workbook")
            z.writestr("__MACOSX/sets/2001-01-02 Club.xlsx", b"")
            z.writestr("sets/notes.txt", b"")
        return pd.DataFrame({"archive": [name], "bytes": [stores.write_whole(f"{folder}/{name}", iter([out.getvalue()]))]})

    return run


def _archive_folder(spark, sf_dir) -> str:
    """A folder of archives made of the parts."""
    k, folder = F.col("p_partkey"), scratch(spark, "archives")
    p = table(spark, sf_dir, "part", "p_partkey", "p_size")
    rows = p.select(
        k.alias("k"), (F.col("p_size") % 5).alias("region"), F.floor(k / _PER_ARCHIVE).alias("n"), F.concat(F.lit("2001-02-"), F.lpad((1 + k % 9).cast("string"), 2, "0")).alias("day"), F.concat(F.lit("T"), k.cast("string")).alias("name"),
        (k % 7000).alias("secs"), (k % 1440).alias("minute"), F.col("p_size").alias("bpm"),
    )
    rows.groupBy("region", "n").applyInPandas(_archives(folder), "archive string, bytes bigint").write.format("noop").mode("overwrite").save()
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return folder


_PARTS = f"""p AS (SELECT p_partkey AS k, (p_size % 5) || '-' || (p_partkey // {_PER_ARCHIVE}) AS name, '2001-02-' || lpad(CAST(1 + p_partkey % 9 AS VARCHAR), 2, '0') AS day, p_partkey % 7000 AS secs, p_partkey % 1440 AS m, p_size AS bpm FROM part),
r AS (SELECT *, row_number() OVER (PARTITION BY name, day ORDER BY k) AS row_ord FROM p)"""


@R.add(f"""WITH {_PARTS}
SELECT name || '.zip' AS archive, 'sets/' || day || ' Club.xlsx' AS path, CAST(row_ord AS INT) AS row_ord, 'T' || k AS title, (secs // 3600) || ':' || lpad(CAST(secs // 60 % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(secs % 60 AS VARCHAR), 2, '0') AS length,
  'T' || lpad(CAST(m // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(m % 60 AS VARCHAR), 2, '0') || ':00' AS play_time, CAST(bpm AS VARCHAR) AS bpm, false AS failed FROM r
UNION ALL SELECT DISTINCT name || '.zip', 'sets/2001-02-' || lpad(CAST(1 + k % 9 AS VARCHAR), 2, '0') || ' Club.xlsx', 0, 'Title', 'Duration', 'Play Time', 'BPM', false FROM p
UNION ALL SELECT DISTINCT name || '.zip', 'sets/2001-01-01 Broken.xlsx', -1, NULL, NULL, NULL, NULL, true FROM p""")
def workbook_cells(spark, sf_dir):
    """Archives of workbooks: entries that are sets, each read by its place; the active sheet, native times and durations; a broken one is told."""
    folder = _archive_folder(spark, sf_dir)
    sets = files.archive_sets(archives.read(spark, folder, partition_bytes=1 << 18).filter(~F.col("path").startswith("__MACOSX") | F.col("path").isNull()), keep=True)
    cell = lambda i: F.get("cells", i)
    return sources.workbook_rows(sets).select(sources.file_name(F.col("archive")).alias("archive"), "path", "row_ord", cell(0).alias("title"), cell(1).alias("length"), cell(2).alias("play_time"), cell(3).alias("bpm"), F.col("error").isNotNull().alias("failed"))


@R.add(f"WITH {_PARTS} SELECT name || '.zip' AS archive, count(*) AS n_rows FROM p WHERE day = '2001-02-03' GROUP BY 1")
def archive_entry_of_day(spark, sf_dir):
    """One day's entry of each archive: planning looks it up in the archives' directories, and nothing else is read."""
    folder = _archive_folder(spark, sf_dir)
    day = archives.read(spark, folder).filter("path = 'sets/2001-02-03 Club.xlsx'")
    return sources.workbook_rows(day).filter("row_ord > 0").groupBy(sources.file_name(F.col("archive")).alias("archive")).agg(F.count("*").alias("n_rows"))

"""Queries on file names: parsing, routing, duplicates, renames, readiness."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracklane.functions import text
from tracklane.operators import collection, files
from tracklane.operators.order import placed
from tracklane.plans.base import Registry, scratch, table
from tracklane.sources import files as sources

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles

_NAMES = """
n AS (SELECT o_orderkey, o_orderdate, CASE o_orderkey % 6
  WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') || ' Venue ' || o_custkey || '.csv' WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') || '_Set_' || o_custkey || '.CSV'
  WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') || ' - Set ' || o_custkey || '.xlsx' WHEN 3 THEN 'Set ' || o_custkey || '.csv'
  WHEN 4 THEN 'FAILED_' || strftime(o_orderdate, '%Y-%m-%d') || ' Venue ' || o_custkey || '.csv' ELSE strftime(o_orderdate, '%Y-%m-%d') || '.xlsx' END AS name FROM orders)"""


def _names(spark, sf_dir):
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    d, c, k = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_custkey").cast("string"), F.col("o_orderkey") % 6
    name = (
        F.when(k == 0, F.concat(d, F.lit(" Venue "), c, F.lit(".csv"))).when(k == 1, F.concat(d, F.lit("_Set_"), c, F.lit(".CSV"))).when(k == 2, F.concat(d, F.lit(" - Set "), c, F.lit(".xlsx")))
        .when(k == 3, F.concat(F.lit("Set "), c, F.lit(".csv"))).when(k == 4, F.concat(F.lit("FAILED_"), d, F.lit(" Venue "), c, F.lit(".csv"))).otherwise(F.concat(d, F.lit(".xlsx")))
    )
    return o.select("o_orderkey", "o_orderdate", name.alias("name"))


@R.add(f"""WITH {_NAMES},
b AS (SELECT *, regexp_replace(name, '\\.[^.]*$', '') AS base FROM n),
p AS (SELECT *, nullif(regexp_extract(name, '^([0-9]{{4}})[-_]', 1), '') AS year, ends_with(lower(name), '.csv') AS is_csv,
  nullif(regexp_extract(base, '^([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})\\s+(.+)$', 1), '') AS set_date, nullif(regexp_extract(base, '^([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})\\s+(.+)$', 2), '') AS venue FROM b)
SELECT o_orderkey, name, year, is_csv, base AS base_name, set_date, venue,
  CASE WHEN year IS NULL THEN 'bad_filename' WHEN NOT is_csv THEN 'other' WHEN set_date IS NULL THEN 'bad_set_name' ELSE 'set' END AS route FROM p""")
def set_name_parse(spark, sf_dir):
    return files.routed(_names(spark, sf_dir)).drop("o_orderdate")


@R.add(f"""WITH {_NAMES}
SELECT o_orderkey, regexp_extract(name, '^([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})[-_ ]*(.*)$', 1) AS date,
  CASE WHEN regexp_matches(name, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN regexp_extract(name, '^([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})[-_ ]*(.*)$', 2) ELSE name END AS title,
  '=HYPERLINK("https://x.example.com/' || o_orderkey || '", "' || name || '")' AS link FROM n""")
def collection_labels(spark, sf_dir):
    n = _names(spark, sf_dir)
    url = F.concat(F.lit("https://x.example.com/"), F.col("o_orderkey").cast("string"))
    return n.select("o_orderkey", text.date_title(F.col("name")).alias("t"), text.hyperlink(url, F.col("name")).alias("link")).select("o_orderkey", "t.*", "link")


@R.add(f"""WITH {_NAMES}
SELECT 'y/' || name AS path, strftime(o_orderdate, '%Y-%m-%d') AS set_date, CASE WHEN o_orderkey % 6 = 5 THEN 'Unknown' ELSE regexp_extract(name, ' - (.*)\\.xlsx$', 1) END AS venue, regexp_replace(name, '\\.xlsx$', '') AS source_file
FROM n WHERE ends_with(name, '.xlsx')""")
def archive_name_parse(spark, sf_dir):
    return files.archive_sets(_names(spark, sf_dir).select(F.concat(F.lit("y/"), "name").alias("path")))


_PAGES = """p AS (SELECT page_id, regexp_extract(url, '/([0-9]+)[^/]*$', 1) || '.csv' AS name, CAST(page_id % 3 AS INT) AS year FROM pages),
s AS (SELECT CAST(s_suppkey AS VARCHAR) AS base, CAST(s_nationkey % 3 AS INT) AS year FROM supplier)"""


def _pages(spark, sf_dir):
    """Incoming files named by the pages, and files named by the suppliers that exist."""
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    there = table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey").select(F.concat(F.col("s_suppkey").cast("string"), F.lit(".txt")).alias("name"), (F.col("s_nationkey") % 3).cast("int").alias("year"))
    return pages.select("page_id", F.concat(F.regexp_extract("url", "/([0-9]+)[^/]*$", 1), F.lit(".csv")).alias("name"), (F.col("page_id") % 3).cast("int").alias("year")), there


@R.add(f"""WITH {_PAGES}, b AS (SELECT *, regexp_replace(name, '\\.[^.]*$', '') AS base FROM p),
x AS (SELECT b.*, EXISTS (SELECT 1 FROM s WHERE s.year = b.year AND s.base = b.base) AS there FROM b)
SELECT page_id, name, year, CASE WHEN there THEN 'duplicate' ELSE 'new' END AS status, CASE WHEN there THEN 'possible_duplicate_' || name ELSE name END AS out_name FROM x""")
def duplicate_semi(spark, sf_dir):
    return files.with_duplicates(*_pages(spark, sf_dir)).select("page_id", "name", "year", "status", "out_name")


@R.add(f"""WITH {_PAGES}, b AS (SELECT *, regexp_replace(name, '\\.[^.]*$', '') AS base FROM p)
SELECT page_id, name, year FROM b WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.year = b.year AND s.base = b.base)""")
def new_files_anti(spark, sf_dir):
    return files.new_files(*_pages(spark, sf_dir)).select("page_id", "name", "year")


@R.add("""
WITH f AS (SELECT doc_id, lang AS folder_id, CASE doc_id % 4 WHEN 0 THEN 'Copy of ' WHEN 1 THEN 'failed_' ELSE '' END || source || '_' || doc_id % 50 || '.csv' AS name FROM documents),
t AS (SELECT *, regexp_replace(name, '^(?i:FAILED_|possible_duplicate_|Copy of )', '') AS target FROM f),
w AS (SELECT *, row_number() OVER (PARTITION BY folder_id, target ORDER BY doc_id) AS k FROM t WHERE target <> name AND (folder_id, target) NOT IN (SELECT folder_id, name FROM f))
SELECT t.doc_id, t.folder_id, t.name, CASE WHEN w.k = 1 THEN t.target ELSE t.name END AS new_name FROM t LEFT JOIN w ON t.doc_id = w.doc_id""")
def rename_first_wins(spark, sf_dir):
    d = table(spark, sf_dir, "documents", "doc_id", "lang", "source")
    prefix = F.when(F.col("doc_id") % 4 == 0, "Copy of ").when(F.col("doc_id") % 4 == 1, "failed_").otherwise("")
    rows = d.select("doc_id", F.col("lang").alias("folder_id"), F.concat(prefix, "source", F.lit("_"), (F.col("doc_id") % 50).cast("string"), F.lit(".csv")).alias("name"))
    return files.repaired_names(rows, order="doc_id").select("doc_id", "folder_id", "name", "new_name")


_CHAINS = "CASE doc_id % 5 WHEN 0 THEN 'Copy of ' WHEN 1 THEN 'FAILED_failed_' WHEN 2 THEN 'failed_' WHEN 3 THEN 'Possible_Duplicate_FAILED_failed_' ELSE '' END || source || doc_id % 4"


@R.add(f"""
WITH f AS (SELECT doc_id, lang AS folder_id, CASE WHEN doc_id % 97 = 0 THEN 'FAILED_' ELSE {_CHAINS} END AS name FROM documents),
p AS (SELECT *, regexp_replace(name, '^(?i:FAILED_|possible_duplicate_|Copy of )', '') AS rest, regexp_replace(name, '^(?i:FAILED_|possible_duplicate_|Copy of )+', '') AS family FROM f),
w AS (SELECT *, CASE WHEN rest <> name AND rest <> '' THEN rest END AS target FROM p),
g AS (SELECT folder_id, family, list(DISTINCT name) AS names, list({{'k': doc_id, 'n': name, 't': target}} ORDER BY doc_id) FILTER (target IS NOT NULL) AS wishes FROM w GROUP BY 1, 2),
r AS (SELECT folder_id, list_reduce(list_prepend({{'names': names, 'n': '', 't': '', 'k': -1::BIGINT, 'done': []::STRUCT(k BIGINT, n VARCHAR)[]}}, list_transform(wishes, lambda x: {{'names': []::VARCHAR[], 'n': x.n, 't': x.t, 'k': x.k, 'done': []::STRUCT(k BIGINT, n VARCHAR)[]}})),
  lambda a, x: CASE WHEN list_contains(a.names, x.t) THEN {{'names': a.names, 'n': '', 't': '', 'k': -1::BIGINT, 'done': list_append(a.done, {{'k': x.k, 'n': x.n}})}}
    ELSE {{'names': list_append(list_filter(a.names, lambda z: z <> x.n), x.t), 'n': '', 't': '', 'k': -1::BIGINT, 'done': list_append(a.done, {{'k': x.k, 'n': x.t}})}} END).done AS done FROM g WHERE wishes IS NOT NULL),
u AS (SELECT unnest(done) AS d FROM r)
SELECT f.doc_id, f.folder_id, f.name, coalesce(u.d.n, f.name) AS new_name FROM f LEFT JOIN u ON u.d.k = f.doc_id""")
def rename_in_turn(spark, sf_dir):
    """Names repaired one after the other: what one frees, the next may take."""
    d = table(spark, sf_dir, "documents", "doc_id", "lang", "source")
    k = F.col("doc_id")
    prefix = F.when(k % 5 == 0, "Copy of ").when(k % 5 == 1, "FAILED_failed_").when(k % 5 == 2, "failed_").when(k % 5 == 3, "Possible_Duplicate_FAILED_failed_").otherwise("")
    name = F.when(k % 97 == 0, "FAILED_").otherwise(F.concat(prefix, "source", (k % 4).cast("string")))
    return files.names_in_turn(d.select("doc_id", F.col("lang").alias("folder_id"), name.alias("name")), order="doc_id")


@R.add("""
WITH f AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, CASE WHEN o_orderkey % 4999 = 17 THEN 'FAILED_' ELSE '' END || o_orderkey || '.csv' AS name FROM orders),
y AS (SELECT year, count(*) AS n_files, bool_or(starts_with(name, 'FAILED_') OR contains(name, '_Cleaned')) AS unready FROM f GROUP BY 1)
SELECT year, CAST(n_files AS BIGINT) AS n_files, CASE WHEN year = '1996' THEN 'deduplicate' WHEN year = '1998' THEN 'skip_similar' WHEN unready THEN 'skip_unready' ELSE 'generate' END AS action FROM y
UNION ALL SELECT '1890', 0, 'generate' UNION ALL SELECT '1891', 0, 'deduplicate'""")
def year_readiness(spark, sf_dir):
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    rows = o.select(F.year("o_orderdate").cast("string").alias("year"), F.concat(F.when(F.col("o_orderkey") % 4999 == 17, "FAILED_").otherwise(""), F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("name"))
    there = spark.createDataFrame([("1996 Summary",), ("Old 1998 Summary",), ("1891 Summary",)], "name string")
    folders = rows.select("year").distinct().union(spark.createDataFrame([("1890",), ("1891",), ("Summary",)], "year string"))
    return files.year_actions(rows, there, years=folders)


_FILES = f"""{_NAMES}, f AS (SELECT CASE WHEN o_orderkey % 50 = 0 THEN 'Summary' WHEN o_orderkey % 50 = 1 THEN 'Archive' ELSE CAST(year(o_orderdate) AS VARCHAR) END AS folder, o_orderkey AS file_id, name,
  CASE WHEN o_orderkey % 7 = 0 THEN 'text/csv' ELSE 'application/vnd.google-apps.spreadsheet' END AS mime_type FROM n)"""


def _files(spark, sf_dir):
    k = F.col("o_orderkey")
    folder = F.when(k % 50 == 0, "Summary").when(k % 50 == 1, "Archive").otherwise(F.year("o_orderdate").cast("string"))
    return _names(spark, sf_dir).select(folder.alias("folder"), k.alias("file_id"), "name", F.when(k % 7 == 0, "text/csv").otherwise(files.SPREADSHEET).alias("mime_type"), k.alias("listing_ord"))


_URL = "'https://docs.google.com/spreadsheets/d/' || file_id"
_ITEMS = f"""{_FILES}, i AS (SELECT folder, CAST(file_id AS VARCHAR) AS id, file_id AS ord, name, folder = 'Summary' AS is_summary, {_URL} AS url, regexp_extract(name, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AS date,
  CASE WHEN regexp_matches(name, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN regexp_replace(name[11:], '^[-_ ]+', '') ELSE name END AS title FROM f WHERE folder <> 'Archive' AND mime_type LIKE '%spreadsheet')"""


@R.add(f"""WITH {_ITEMS}, c AS (SELECT folder, is_summary, name, ord, CASE WHEN NOT is_summary THEN CASE WHEN date = '' THEN '' ELSE chr(39) || date END END AS date_cell,
  CASE WHEN NOT is_summary THEN CASE WHEN title = '' THEN '' ELSE chr(39) || title END END AS title_cell, '=HYPERLINK("' || url || '", "' || name || '")' AS link FROM i)
SELECT folder, date_cell, title_cell, link, CAST(row_number() OVER (PARTITION BY folder ORDER BY CASE WHEN is_summary THEN name ELSE date_cell END DESC, ord) AS INT) AS tab_row FROM c""")
def collection_rows(spark, sf_dir):
    return collection.sheet_rows(collection.items(_files(spark, sf_dir)))


_SNAPSHOT = f"""{_ITEMS}, j AS (SELECT folder, CASE WHEN is_summary THEN '{{"label":"' || name || '","url":"' || url || '","spreadsheet_id":"' || id || '"}}'
  ELSE '{{"date":"' || date || '","title":"' || title || '","label":"' || name || '","url":"' || url || '","spreadsheet_id":"' || id || '"}}' END AS item,
  row_number() OVER (PARTITION BY folder ORDER BY CASE WHEN is_summary THEN '' ELSE date END DESC, name DESC, ord) AS place FROM i)"""


@R.add(f"WITH {_SNAPSHOT} SELECT folder, CAST(place AS INT) AS place, item FROM j")
def collection_snapshot(spark, sf_dir):
    return collection.snapshot(collection.items(_files(spark, sf_dir)))


@R.add(f"WITH {_SNAPSHOT} SELECT folder, count(*) AS n_items, '[' || string_agg(item, ',' ORDER BY place) || ']' AS items FROM j GROUP BY 1")
def collection_nested(spark, sf_dir):
    return collection.nested(collection.snapshot(collection.items(_files(spark, sf_dir))))


@R.add(f"""WITH {_SNAPSHOT}, e AS (SELECT *, max(place) OVER (PARTITION BY folder) AS last FROM j) SELECT folder || '.json' AS file, item || CASE WHEN place < last THEN ',' ELSE '' END AS line FROM e
UNION ALL SELECT DISTINCT folder || '.json', '{{"name":"' || folder || '","items":[' FROM j UNION ALL SELECT DISTINCT folder || '.json', ']}}' FROM j""")
def collection_files(spark, sf_dir):
    """A file of each folder, written by many tasks and read back."""
    path = scratch(spark, "folders")
    collection.write_folders(collection.snapshot(collection.items(_files(spark, sf_dir))), path)
    return spark.read.text(path).select(sources.file_name(F.col("_metadata.file_path")).alias("file"), F.col("value").alias("line"))


@R.add(f"""WITH {_SNAPSHOT}, e AS (SELECT *, max(place) OVER (PARTITION BY folder) AS last, dense_rank() OVER (ORDER BY folder DESC) AS k FROM j)
SELECT item || CASE WHEN place < last THEN ',' WHEN k = (SELECT max(k) FROM e) THEN ']}}]}}' ELSE ']}},' END AS line FROM e
UNION ALL SELECT DISTINCT '{{"name":"' || folder || '","items":[' FROM j UNION ALL SELECT '{{"folders":['""")
def collection_file(spark, sf_dir):
    """The whole snapshot as one file, written by many tasks and read back."""
    path = scratch(spark, "collection")
    collection.write_snapshot(collection.snapshot(collection.items(_files(spark, sf_dir))), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@R.add(f"""WITH {_FILES} SELECT count(DISTINCT folder) AS folders_processed, count(DISTINCT folder) FILTER (mime_type LIKE '%spreadsheet' AND folder NOT IN ('Archive', 'Summary')) AS tabs_written,
  count(*) FILTER (mime_type LIKE '%spreadsheet' AND folder NOT IN ('Archive', 'Summary')) AS total_sets FROM f""")
def collection_totals(spark, sf_dir):
    return collection.totals(_files(spark, sf_dir))


@R.add(f"WITH {_FILES}, g AS (SELECT folder, count(*) AS n_files FROM f GROUP BY 1) SELECT folder, n_files, CAST(row_number() OVER (ORDER BY folder DESC) AS INT) AS place FROM g")
def folders_descending(spark, sf_dir):
    return files.sub_folders(_files(spark, sf_dir))


@R.add(f"WITH {_FILES} SELECT folder, file_id, name FROM f WHERE folder = 'Summary' AND mime_type LIKE '%spreadsheet' AND file_id % 9 <> 0")
def folder_listing(spark, sf_dir):
    listed = _files(spark, sf_dir).withColumn("trashed", F.col("file_id") % 9 == 0)
    return sources.folder_files(listed, "Summary", files.SPREADSHEET).select("folder", "file_id", "name")


_AUDIO = """a AS (SELECT event_id, CASE WHEN event_id % 97 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS file_id, CASE event_type WHEN 'click' THEN 'audio/flac' WHEN 'view' THEN 'audio/mpeg' WHEN 'error' THEN 'text/csv' ELSE 'audio/ogg' END AS mime_type,
  event_id % 13 = 0 AS trashed FROM events)"""


def _audio(spark, sf_dir):
    e, t = table(spark, sf_dir, "events", "event_id", "user_id", "event_type"), F.col("event_type")
    return e.select(
        F.when(F.col("event_id") % 97 == 0, "").otherwise(F.col("user_id").cast("string")).alias("file_id"),
        F.when(t == "click", "audio/flac").when(t == "view", "audio/mpeg").when(t == "error", "text/csv").otherwise("audio/ogg").alias("mime_type"), (F.col("event_id") % 13 == 0).alias("trashed"), F.col("event_id").alias("listing_ord"),
    )


@R.add(f"""WITH {_AUDIO}, r AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY CASE mime_type WHEN 'audio/mpeg' THEN 1 WHEN 'audio/flac' THEN 6 ELSE 8 END, event_id) AS k FROM a WHERE NOT trashed AND file_id <> '' AND mime_type <> 'text/csv')
SELECT file_id, mime_type, event_id AS listing_ord FROM r WHERE k = 1""")
def audio_listing(spark, sf_dir):
    return sources.audio_files(_audio(spark, sf_dir)).select("file_id", "mime_type", "listing_ord")


@R.add(f"WITH {_AUDIO} SELECT file_id, mime_type, event_id AS listing_ord FROM a WHERE NOT trashed AND mime_type = 'text/csv'")
def audio_listing_fallback(spark, sf_dir):
    """A folder without audio files is listed whole."""
    return sources.audio_files(_audio(spark, sf_dir).filter("mime_type = 'text/csv'")).select("file_id", "mime_type", "listing_ord")


@R.add(f"""WITH {_PAGES} SELECT page_id, name, year, CASE WHEN page_id % 5 = 0 THEN 'FAILED_' || name ELSE name END AS out_name FROM p""")
def failed_rename(spark, sf_dir):
    rows, _ = _pages(spark, sf_dir)
    return files.failed_names(rows.withColumn("status", F.when(F.col("page_id") % 5 == 0, "failed").otherwise("imported"))).select("page_id", "name", "year", "out_name")


def _parents(spark, sf_dir):
    """Files that belong in a folder, and the folders in which files lie."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey").select(F.col("o_orderkey").alias("file_id"), (F.col("o_custkey") % 10).cast("int").alias("folder_id"))
    l = table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey").select(F.col("l_orderkey").alias("file_id"), (F.col("l_suppkey") % 10).cast("int").alias("folder_id"))
    return o, l


_LIES = "EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_suppkey % 10 = o_custkey % 10)"


@R.add(f"SELECT o_orderkey AS file_id, CAST(o_custkey % 10 AS INT) AS folder_id FROM orders WHERE NOT {_LIES}")
def archive_moves(spark, sf_dir):
    return files.to_archive(*_parents(spark, sf_dir))


@R.add(f"SELECT o_orderkey AS file_id, CAST(o_custkey % 10 AS INT) AS folder_id FROM orders WHERE {_LIES}")
def already_in_folder(spark, sf_dir):
    return files.in_folder(*_parents(spark, sf_dir))


@R.add("""SELECT c_custkey, (1992 + c_custkey % 9) || ' Summary' AS name FROM customer
WHERE c_custkey % 4 = 0 AND 1992 + c_custkey % 9 IN (SELECT year(o_orderdate) FROM orders WHERE o_orderdate >= DATE '1996-01-01')""")
def stale_summaries(spark, sf_dir):
    k = F.col("c_custkey")
    kept = table(spark, sf_dir, "customer", "c_custkey").select("c_custkey", F.concat((F.lit(1992) + k % 9).cast("string"), F.when(k % 4 == 0, " Summary").otherwise(" Summary (old)")).alias("name"))
    years = table(spark, sf_dir, "orders", "o_orderdate").filter("o_orderdate >= date'1996-01-01'").select(F.year("o_orderdate").cast("string").alias("year"))
    return files.stale_summaries(kept, years).select("c_custkey", "name")


@R.add(f"""WITH {_NAMES} SELECT 'y/' || name AS path, strftime(o_orderdate, '%Y-%m-%d') AS set_date, regexp_replace(name, '\\.xlsx$', '') AS source_file FROM n WHERE ends_with(name, '.xlsx') AND year(o_orderdate) = 1996""")
def archive_of_year(spark, sf_dir):
    """The sets of one year of an archive's listing."""
    entries = _names(spark, sf_dir).select(F.concat(F.lit("y/"), "name").alias("path"))
    return files.archive_sets(entries, year="1996").select("path", "set_date", "source_file")


@R.add(f"""WITH {_NAMES} SELECT CAST(row_number() OVER (ORDER BY strftime(o_orderdate, '%Y-%m-%d'), 'y/' || name) AS INT) AS place, 'y/' || name AS path
FROM n WHERE ends_with(name, '.xlsx')""")
def archive_by_date(spark, sf_dir):
    """The order by date as numbers; the collection's own workbook is no set."""
    own = spark.createDataFrame([("y/DJ Set Collection.xlsx",), ("y/1998-01-02 DJ Set Collection.xlsx",)], "path string")
    entries = _names(spark, sf_dir).select(F.concat(F.lit("y/"), "name").alias("path")).union(own)
    return placed(files.archive_sets(entries), [], ["set_date", "path"], "place").select("place", "path")

"""Queries on play histories, playlists, candidates and paged services."""

from __future__ import annotations

import contextlib

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tracklane.functions import text
from tracklane.operators import live, playlists, routing
from tracklane.plans.base import Registry, scratch, table
from tracklane.sources import files as sources
from tracklane.sources import ordered, paged, posts
from tracklane.streaming import incoming

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles


def _history(spark, sf_dir):
    """Lines of history files, one a day, made of the events: information lines, paths and remarks."""
    e = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type")
    k, d = F.col("event_id"), F.date_format("ts", "yyyy-MM-dd")
    info = F.concat(
        F.lit("#EXTVDJ:<time>"), F.date_format("ts", "HH:mm"), F.lit("</time>"), F.when(k % 9 != 0, F.concat(F.lit("<artist>"), "event_type", F.lit("</artist>"))).otherwise(""), F.lit("<title>T"), F.col("user_id").cast("string"), F.lit("</title>")
    )
    line = F.when(k % 4 == 0, "#EXTM3U").when(k % 4 == 1, "/music/x.mp3").otherwise(info)
    return e.select(F.concat(F.lit("file:/h/"), d, F.lit(".m3u")).alias("path"), k.cast("int").alias("line_no"), line.alias("line"))


_ENTRIES = """e AS (SELECT event_id, ts, 'file:/h/' || strftime(ts, '%Y-%m-%d') || '.m3u' AS path, strftime(ts, '%Y-%m-%d %H:%M') AS dt, 'T' || user_id AS title, CASE WHEN event_id % 9 <> 0 THEN event_type ELSE '' END AS artist FROM events WHERE event_id % 4 > 1)"""


@R.add(f"WITH {_ENTRIES} SELECT path, CAST(event_id AS INT) AS line_no, dt, title, artist FROM e")
def history_lines(spark, sf_dir):
    return sources.history_entries(_history(spark, sf_dir))


@R.add(f"""WITH {_ENTRIES}, p AS (SELECT *, date_trunc('minute', ts) AS t, timezone('UTC', timezone('America/Chicago', date_trunc('minute', ts))) AS utc FROM e WHERE artist <> ''),
o AS (SELECT path, event_id, '{{"played_at":"' || strftime(t, '%Y-%m-%dT%H:%M:%S') || CASE WHEN t < utc THEN '-' ELSE '+' END || printf('%02d:%02d', abs(date_diff('minute', utc, t)) // 60, abs(date_diff('minute', utc, t)) % 60) ||
  '","title":"' || title || '","artist":"' || artist || '"}}' AS play FROM p)
SELECT path, count(*) AS n_plays, '{{"plays":[' || string_agg(play, ',' ORDER BY event_id) || ']}}' AS payload FROM o GROUP BY 1""")
def live_payloads(spark, sf_dir):
    return live.payload(live.plays(sources.history_entries(_history(spark, sf_dir))), "path")


@R.add("""SELECT event_id, CASE WHEN event_id % 5 = 0 OR event_id % 7 = 0 THEN 'WARN' ELSE 'SUCCESS' END AS severity,
  CASE WHEN event_id % 5 = 0 OR event_id % 7 = 0 THEN 'Completed with issues: plays_failed=' || CASE WHEN event_id % 5 = 0 THEN 3 ELSE 0 END || ', files_failed=' || CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END || '.'
  ELSE 'Run completed successfully.' || CASE WHEN event_id % 2 = 0 THEN ' Skipped (no service is set).' WHEN event_id % 3 = 0 THEN ' No .m3u files found.' ELSE '' END END AS text FROM events""")
def live_finding(spark, sf_dir):
    """A finding for each of many runs."""
    k = F.col("event_id")
    runs = table(spark, sf_dir, "events", "event_id").select(
        "event_id", (k % 2 != 0).alias("base_url_set"), (k % 3 != 0).alias("had_files"), F.when(k % 5 == 0, 3).otherwise(0).alias("plays_failed"), F.when(k % 7 == 0, 1).otherwise(0).alias("files_failed")
    )
    return live.finding(runs, "event_id")


_SETS = """s AS (SELECT o_custkey AS c, list('uri:' || o_orderkey % 7 ORDER BY o_orderkey) AS uris, 'P' || o_custkey AS name FROM orders GROUP BY o_custkey)"""


@R.add(f"""WITH {_SETS}, d AS (SELECT name, list(u ORDER BY i) AS uris FROM (SELECT name, u, min(i) AS i FROM (SELECT name, unnest(uris) AS u, unnest(range(len(uris))) AS i FROM s) GROUP BY 1, 2) GROUP BY 1)
SELECT s.name, CASE WHEN c % 2 = 0 THEN 'refresh' ELSE 'create' END AS action, CASE WHEN c % 2 = 0 THEN 'id' || c END AS playlist_id, CASE WHEN c % 2 = 0 THEN s.uris ELSE d.uris END AS uris FROM s JOIN d ON d.name = s.name""")
def playlist_writes(spark, sf_dir):
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    uri = F.struct("o_orderkey", F.concat(F.lit("uri:"), (F.col("o_orderkey") % 7).cast("string")).alias("u"))
    sets = o.groupBy("o_custkey").agg(F.transform(F.array_sort(F.collect_list(uri)), lambda x: x["u"]).alias("uris")).select(F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("name"), "uris")
    c = table(spark, sf_dir, "customer", "c_custkey").filter("c_custkey % 2 = 0")
    there = c.select(F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("name"), F.concat(F.lit("id"), F.col("c_custkey").cast("string")).alias("id"))
    return playlists.write_plan(there, sets)


#: A playlist for each part, as a service would say it: fields are there, null or left out.
_RAW = {"uri": 3, "type": 4, "snapshot_id": 5, "public": 6, "collaborative": 7}
_SAID = {"uri": "'u' || p_partkey", "type": "'mix'", "snapshot_id": "'s' || p_size", "public": "true", "collaborative": "true"}


def _field(k: str, n: int) -> str:
    """Left out where the key's remainder is 0, null where it is 1, else said; of Spark and DuckDB alike."""
    said = _SAID[k] if k in ("public", "collaborative") else f"'\"' || {_SAID[k]} || '\"'"
    return f"CASE p_partkey % {n} WHEN 0 THEN '' WHEN 1 THEN '\"{k}\":null,' ELSE '\"{k}\":' || {said} || ',' END"


_ANSWER = " || ".join([
    "'{'", *[_field(k, n) for k, n in _RAW.items()], "CASE p_partkey % 9 WHEN 0 THEN '' WHEN 1 THEN '\"owner\":null,' WHEN 2 THEN '\"owner\":{\"id\":null},' ELSE '\"owner\":{\"id\":\"o' || p_size || '\",\"display_name\":\"O\"},' END",
    "CASE p_partkey % 10 WHEN 0 THEN '' WHEN 1 THEN '\"external_urls\":null,' WHEN 2 THEN '\"external_urls\":{\"spotify\":null},' ELSE '\"external_urls\":{\"spotify\":\"http://x/' || p_partkey || '\"},' END",
    "CASE p_partkey % 8 WHEN 0 THEN '' WHEN 1 THEN '\"tracks\":{},' ELSE '\"tracks\":{\"total\":' || p_size || '},' END", "CASE p_partkey % 11 WHEN 0 THEN '' WHEN 1 THEN '\"id\":null,' ELSE '\"id\":\"' || p_partkey || '\",' END", "'\"name\":\"' || p_name || '\"}'",
])
_WITH = {k: f"CASE p_partkey % {n} WHEN 0 THEN {{}} WHEN 1 THEN {'NULL' if k in ('uri', 'type', 'snapshot_id') else '{}'} ELSE {_SAID[k]} END" for k, n in _RAW.items()}


@R.add(f"""SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, {_WITH['uri'].format("''")} AS uri, {_WITH['type'].format("'playlist'")} AS type, {_WITH['public'].format('true', 'true')} AS public,
  {_WITH['collaborative'].format('false', 'false')} AS collaborative, {_WITH['snapshot_id'].format("''")} AS snapshot_id, CASE WHEN p_partkey % 10 < 3 THEN '' ELSE 'http://x/' || p_partkey END AS url,
  CASE WHEN p_partkey % 8 < 2 THEN 0 ELSE p_size END AS tracks_total, CASE WHEN p_partkey % 9 < 2 THEN '' WHEN p_partkey % 9 > 2 THEN 'o' || p_size END AS owner_id, CASE WHEN p_partkey % 9 < 3 THEN '' ELSE 'O' END AS owner_name
FROM part WHERE p_partkey % 11 > 1""")
def playlist_fields(spark, sf_dir):
    """A field that is left out is not one that is null."""
    raw = table(spark, sf_dir, "part", "p_partkey", "p_size", "p_name").select(F.expr(_ANSWER).alias("raw"))
    return playlists.flattened(playlists.read(raw))


@R.add("""WITH p AS (SELECT '{"id":"' || n_nationkey || '","name":"' || n_name || '","uri":"","type":"playlist","public":' || CASE WHEN n_nationkey % 2 = 0 THEN 'true' ELSE 'false' END || ',"collaborative":false,"snapshot_id":"s' || n_regionkey || '","url":"","tracks_total":' || n_nationkey ||
  ',"owner_id":"","owner_name":""}' AS j, CAST(n_nationkey AS VARCHAR) AS id FROM nation)
SELECT count(*) AS n_playlists, '{"playlists":[' || string_agg(j, ',' ORDER BY id) || ']}' AS payload FROM p""")
def playlist_snapshot(spark, sf_dir):
    n, k = table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey"), F.col("n_nationkey")
    fields = F.struct(
        k.cast("string").alias("id"), F.col("n_name").alias("name"), F.when(k % 2 == 0, F.lit(None).cast("boolean")).otherwise(False).alias("public"),
        F.concat(F.lit("s"), F.col("n_regionkey").cast("string")).alias("snapshot_id"), F.struct(k.alias("total")).alias("tracks"),
    )
    return playlists.snapshot_payload(playlists.flattened(playlists.read(n.select(F.to_json(fields).alias("raw")))))


@R.add("""SELECT event_id, CASE WHEN event_id % 6 IN (0, 1) THEN event_id % 40 END AS upserted, CASE WHEN event_id % 6 = 0 THEN 5 WHEN event_id % 6 = 1 THEN 0 END AS unchanged FROM events""")
def service_answers(spark, sf_dir):
    """Answers with and without counts, of other shapes, or broken."""
    k = F.col("event_id")
    n = (k % 40).cast("string")
    answer = (
        F.when(k % 6 == 0, F.concat(F.lit('{"data":{"upserted":'), n, F.lit(',"unchanged":5}}'))).when(k % 6 == 1, F.concat(F.lit('{"data":{"upserted":'), n, F.lit("}}"))).when(k % 6 == 2, F.lit('{"data":{"unchanged":2}}'))
        .when(k % 6 == 3, F.lit('{"data":[1]}')).when(k % 6 == 4, F.lit("<html>")).otherwise(F.lit(None))
    )
    return playlists.upserted(table(spark, sf_dir, "events", "event_id").select("event_id", answer.alias("response"))).drop("response")


@R.add("SELECT event_id, 'confidence=' || CASE WHEN event_id % 3 = 0 THEN 'N/A' ELSE printf('%.3f', value) END || CASE WHEN event_id % 4 = 0 THEN ', id=m' || event_id ELSE ', id=r' || event_id END || CASE WHEN event_id % 5 <> 0 THEN ', title=T' ELSE '' END || ', artist=' || event_type AS candidate, concat_ws(', ', 'title=T', CASE WHEN user_id % 2 = 0 THEN 'artist=A' END, CASE WHEN user_id % 3 <> 0 THEN 'year=' || user_id % 3 END) AS metadata FROM events")
def identified_texts(spark, sf_dir):
    e, k, u = table(spark, sf_dir, "events", "event_id", "value", "event_type", "user_id"), F.col("event_id"), F.col("user_id")
    candidate = F.struct(
        F.when(k % 3 != 0, F.col("value")).alias("confidence"), F.when(k % 4 == 0, F.concat(F.lit("m"), k.cast("string"))).otherwise("").alias("mbid"), F.concat(F.lit("r"), k.cast("string")).alias("recording_id"),
        F.when(k % 5 != 0, "T").alias("title"), F.col("event_type").alias("artist"),
    )
    meta = F.struct(F.lit("T").alias("title"), F.when(u % 2 == 0, "A").otherwise("").alias("artist"), (u % 3).alias("year"))
    rows = e.select("event_id", candidate.alias("c"), meta.alias("m"))
    return rows.select("event_id", routing.candidate_text(F.col("c")).alias("candidate"), routing.metadata_text(F.col("m")).alias("metadata"))


@R.add("""WITH r AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id DESC) AS k FROM events)
SELECT user_id, list(event_id ORDER BY k) AS best FROM r WHERE k <= 5 GROUP BY 1""")
def best_candidates(spark, sf_dir):
    e = table(spark, sf_dir, "events", "user_id", "event_id", "value")
    held = e.groupBy("user_id").agg(F.collect_list(F.struct(F.col("value").alias("confidence"), "event_id")).alias("c"))
    return held.select("user_id", F.transform(routing.best_candidates(F.col("c")), lambda x: x["event_id"]).alias("best"))


@R.add("SELECT s_suppkey, ['a=' || s_nationkey, 'k=' || s_suppkey, 'z='] AS tags FROM supplier")
def sorted_tags(spark, sf_dir):
    s = table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    tags = F.create_map(F.lit("z"), F.lit(None).cast("string"), F.lit("k"), F.col("s_suppkey").cast("string"), F.lit("a"), F.col("s_nationkey").cast("string"))
    return s.select("s_suppkey", routing.sorted_tags(tags).alias("tags"))


@R.add("SELECT user_id AS id, min(event_id) AS listing_ord FROM events WHERE event_type <> 'error' AND user_id IS NOT NULL GROUP BY 1")
def union_or_all(spark, sf_dir):
    """None of the wanted types is there, so that the whole listing is taken."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), F.col("event_id").alias("listing_ord"), "event_type")
    everything = routing.union_distinct([e.filter("event_type <> 'error'")]).select("id", "listing_ord")
    wanted = [e.filter(f"event_type = '{k}'").select("id", "listing_ord") for k in ("none", "nothing")]
    return routing.listed_or_all(wanted, everything)


@R.add("SELECT page_id, regexp_replace(trim(url), '/+$', '') AS base FROM (SELECT page_id, ' ' || url || CASE WHEN page_id % 2 = 0 THEN '//' ELSE '' END || ' ' AS url FROM pages)")
def service_urls(spark, sf_dir):
    p = table(spark, sf_dir, "pages", "page_id", "url")
    url = F.concat(F.lit(" "), "url", F.when(F.col("page_id") % 2 == 0, "//").otherwise(""), F.lit(" "))
    return p.select("page_id", text.base_url(url).alias("base"))


_ROWS = "SELECT CAST(c_custkey AS BIGINT) AS id, CASE WHEN c_custkey % 3 = 0 THEN 'odd' ELSE 'even' END AS type, c_mktsegment AS name FROM customer"


def _customers(spark, sf_dir):
    c = table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    return c.select(F.col("c_custkey").cast("bigint").alias("id"), F.when(F.col("c_custkey") % 3 == 0, "odd").otherwise("even").alias("type"), F.col("c_mktsegment").alias("name"))


@R.add(f"SELECT * FROM ({_ROWS}) WHERE type = 'odd'")
def paged_service(spark, sf_dir):
    """A paged service read page by page while there is a next one; the filter goes to the service."""
    folder = scratch(spark, "pages")
    paged.write_pages(_customers(spark, sf_dir), folder, ["id"], 500)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(paged.source("tracklane_pages", "id bigint, type string, name string", paged.file_service(folder)))
    return spark.read.format("tracklane_pages").option("limit", 500).load().filter("type = 'odd'")


@R.add(_ROWS)
def polled_pages(spark, sf_dir):
    """The same service as a stream, polled twice: pages that have come by then, and the rest with the last, shorter page."""
    folder, rows = scratch(spark, "polled"), _customers(spark, sf_dir)
    spark.dataSource.register(paged.source("tracklane_polled", "id bigint, type string, name string", paged.file_service(f"{folder}/pages")))

    def poll(closed: bool) -> None:
        stream = spark.readStream.format("tracklane_polled").option("limit", 100).option("closed", str(closed).lower()).load()
        incoming.run_available(stream, f"{folder}/checkpoint", lambda df, _: df.write.mode("append").parquet(f"{folder}/out"))

    paged.write_pages(rows.filter("id <= 100"), f"{folder}/pages", ["id"], 100)
    poll(False)
    paged.write_pages(rows.filter("id > 100"), f"{folder}/pages", ["id"], 100, before=1)
    poll(True)
    return spark.read.parquet(f"{folder}/out")


@R.add("""SELECT 'C' || c_custkey AS key, CASE WHEN c_custkey % 13 = 0 THEN 0 ELSE 1 END AS times, CASE WHEN c_custkey % 13 <> 0 THEN '{"segment":"' || c_mktsegment || '"}' END AS payload,
  c_custkey % 13 <> 0 AS ok, CASE WHEN c_custkey % 13 = 0 THEN 'HTTP 422' END AS error FROM customer""")
def posted_once(spark, sf_dir):
    """Payloads of a stream; the first run ends midway through its batch, the next one sends what is left, and refusals are told."""
    path = scratch(spark, "posts")
    c = table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    payload = F.to_json(F.struct(F.col("c_mktsegment").alias("segment")))
    c.select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("key"), payload.alias("payload"), (F.col("c_custkey") % 13).alias("k")).write.parquet(f"{path}/in")
    inbox = posts.Inbox(f"{path}/inbox")

    def send(key: str, payload: str) -> None:
        if int(key[1:]) % 13 == 0:
            raise ValueError("HTTP 422")
        inbox(key, payload)

    def half(df, batch: int) -> None:
        posts.post_batch(df.filter("xxhash64(key) % 2 = 0"), batch, path, send, close=inbox.close)
        raise RuntimeError("the run ends here")

    for each in (half, lambda df, batch: posts.post_batch(df, batch, path, send, close=inbox.close)):
        with contextlib.suppress(StreamingQueryException):
            stream = spark.readStream.schema("key string, payload string, k bigint").parquet(f"{path}/in")
            incoming.run_available(stream, f"{path}/checkpoint", each)
    got = spark.read.schema("key string, payload string").json(inbox.folder)
    answers = spark.read.parquet(f"{path}/answers").select("key", "ok", "error")
    return answers.join(got.groupBy("key").agg(F.count("*").alias("times"), F.first("payload").alias("payload")), "key", "left").na.fill(0, ["times"]).select("key", F.col("times").cast("int").alias("times"), "payload", "ok", "error")


@R.add("""SELECT 'S' || s_suppkey || '.csv' AS name, 'text/csv' AS mime_type, s_name AS line, CAST(row_number() OVER (ORDER BY 'S' || s_suppkey || '.csv') AS INT) AS listing_ord FROM supplier""")
def archived_files(spark, sf_dir):
    """Files that arrive in two runs, read once each, and moved to an archive, whose listing is read."""
    path = scratch(spark, "arriving")
    s = table(spark, sf_dir, "supplier", "s_suppkey", "s_name").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string"), F.lit(".csv")).alias("name"), F.col("s_name").alias("line"), (F.col("s_suppkey") % 2).alias("run"))
    each = incoming.archived_batch(lambda df, _: df.select("name", "line").write.mode("append").parquet(f"{path}/out"), f"{path}/archive")
    for run in (0, 1):
        ordered.write(s.filter(F.col("run") == run), f"{path}/in", F.col("name"), F.col("line"), ["line"], lambda f: F.lit("sep=,\n"), lambda f: F.lit("\n")).count()
        incoming.run_available(incoming.incoming_lines(spark, f"{path}/in"), f"{path}/checkpoint", each)
    lines = spark.read.parquet(f"{path}/out")
    return sources.listing(spark, f"{path}/archive").join(lines, "name").select("name", "mime_type", "line", "listing_ord")


@R.add("""WITH y AS (SELECT CAST(year(o_orderdate) AS INT) AS year, count(*) AS expected FROM orders GROUP BY ROLLUP (1)) SELECT year, expected, CAST(row_number() OVER (ORDER BY year NULLS LAST) AS INT) AS place FROM y""")
def report_order(spark, sf_dir):
    o = table(spark, sf_dir, "orders", "o_orderdate").select("o_orderdate", F.lit("imported").alias("status"), F.lit(1).alias("n_tracks"))
    return routing.sorted_report(routing.yearly_report(o, F.year("o_orderdate"))).select("year", "expected", "place")


@R.add("SELECT n_name AS line FROM nation UNION ALL SELECT r_name FROM region")
def incoming_stream(spark, sf_dir):
    """Files that arrive in two runs of a stream, each read once, cleaned and written."""
    path = scratch(spark, "stream")
    for name, column in (("nation", "n_name"), ("region", "r_name")):
        lines = table(spark, sf_dir, name, column).select(F.concat(F.lit(" "), column, F.lit("  ")).alias("value"))
        lines.coalesce(1).write.mode("append").text(f"{path}/in")
        stream = incoming.incoming_lines(spark, f"{path}/in")
        incoming.run_available(stream, f"{path}/checkpoint", lambda df, _: df.select("line").write.mode("append").parquet(f"{path}/out"))
    return spark.read.parquet(f"{path}/out")

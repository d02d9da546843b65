"""Queries on sets, plays and playlists: lookups, reports, counters, payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracklane.functions import parse
from tracklane.operators import live, playlists, routing, tracks
from tracklane.plans.base import Registry, scratch, table

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles


@R.add("""
SELECT o_orderkey, coalesce(m.label, CAST(o_orderkey AS VARCHAR)) AS label, nullif(m.venue, '') AS venue FROM orders LEFT JOIN
  (SELECT c_custkey, c_name AS label, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END AS venue FROM customer WHERE c_mktsegment <> 'MACHINERY') m ON o_custkey = c_custkey""")
def lookup_left_default(spark, sf_dir):
    meta = table(spark, sf_dir, "customer").filter("c_mktsegment <> 'MACHINERY'").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("label"), F.when(F.col("c_custkey") % 4 == 0, "").otherwise(F.col("c_mktsegment")).alias("venue"))
    out = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey").join(meta, "o_custkey", "left")
    return out.select("o_orderkey", F.coalesce("label", F.col("o_orderkey").cast("string")).alias("label"), F.nullif("venue", F.lit("")).alias("venue"))


@R.add("""
WITH c AS (SELECT lower(p_name) AS t, lower(p_brand) AS a, min('uri:' || p_partkey) AS uri FROM part WHERE p_size > 25 GROUP BY 1, 2),
m AS (SELECT p_partkey, uri FROM part LEFT JOIN c ON lower(p_name) = t AND lower(p_brand) = a),
x AS (SELECT l_orderkey, count(uri) AS n_found, count(*) - count(uri) AS n_missing, min(uri) AS first_uri FROM lineitem JOIN m ON l_partkey = p_partkey GROUP BY 1)
SELECT l_orderkey, CAST(n_found AS BIGINT) AS n_found, CAST(n_missing AS BIGINT) AS n_missing, first_uri FROM x""")
def catalogue_match_split(spark, sf_dir):
    p = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_size")
    known = p.filter("p_size > 25").select(F.col("p_name").alias("title"), F.col("p_brand").alias("artist"), F.concat(F.lit("uri:"), F.col("p_partkey").cast("string")).alias("uri"))
    m = playlists.matched(p.select("p_partkey", F.col("p_name").alias("title"), F.col("p_brand").alias("artist")), known).select(F.col("p_partkey").alias("l_partkey"), "uri")
    return table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey").join(m, "l_partkey").groupBy("l_orderkey").agg(F.count("uri").alias("n_found"), F.count_if(F.col("uri").isNull()).alias("n_missing"), F.min("uri").alias("first_uri"))


_STATUS = "CASE WHEN o_orderstatus = 'P' THEN 'failed' WHEN o_orderkey % 10 = 3 THEN 'skipped' ELSE 'imported' END"


@R.add(f"""
WITH s AS (SELECT CAST(year(o_orderdate) AS INT) AS year, {_STATUS} AS status, coalesce(n, 0) AS n FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey)
SELECT year, CAST(count(*) AS BIGINT) AS expected, CAST(count(*) FILTER (status = 'imported') AS BIGINT) AS imported, CAST(count(*) FILTER (status = 'skipped') AS BIGINT) AS skipped,
  CAST(count(*) FILTER (status = 'failed') AS BIGINT) AS failed, CAST(coalesce(sum(n) FILTER (status = 'imported'), 0) AS BIGINT) AS tracks FROM s GROUP BY ROLLUP (year)""")
def yearly_report(spark, sf_dir):
    n = table(spark, sf_dir, "lineitem", "l_orderkey").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n_tracks"))
    status = F.when(F.col("o_orderstatus") == "P", "failed").when(F.col("o_orderkey") % 10 == 3, "skipped").otherwise("imported")
    s = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderdate").join(n, "o_orderkey", "left").select("o_orderdate", status.alias("status"), F.coalesce("n_tracks", F.lit(0)).alias("n_tracks"))
    return routing.yearly_report(s, F.year("o_orderdate"))


_RUN = """
f AS (SELECT CASE WHEN event_id % 50 = 0 THEN 'bad_filename' WHEN event_id % 50 < 4 THEN 'other' WHEN event_id % 50 < 6 THEN 'bad_set_name' ELSE 'set' END AS route,
  CASE WHEN event_type = 'error' THEN 'failed' WHEN event_id % 11 = 0 THEN 'duplicate' WHEN event_id % 211 = 0 THEN 'error' ELSE 'imported' END AS status, CASE WHEN event_id % 3 > 0 THEN event_id % 3 = 1 END AS renamed,
  CASE WHEN event_id % 301 <> 0 THEN CAST(user_id % 40 AS BIGINT) END AS n_tracks,
  CASE WHEN event_id % 17 = 0 THEN 'failed' WHEN event_id % 17 = 1 THEN 'no_tracks' WHEN event_id % 17 = 2 THEN 'unset' ELSE 'sent' END AS ingest, event_id % 503 = 0 AS playlist_failed, event_id FROM events),
i AS (SELECT * FROM f WHERE route IN ('set', 'bad_set_name') AND status = 'imported'),
c AS (SELECT count(*) FILTER (route IN ('set', 'bad_set_name')) AS sets_attempted, (SELECT count(*) FROM i) AS sets_imported, count(*) FILTER (route IN ('set', 'bad_set_name') AND (status = 'error' OR status = 'failed' AND coalesce(renamed, true))) AS sets_failed,
  count(*) FILTER (route = 'other') AS sets_skipped, count(*) FILTER (route = 'bad_filename') AS unrecognized_filename_skips, count(*) FILTER (route IN ('set', 'bad_set_name') AND status = 'duplicate') AS duplicate_csv_count,
  (SELECT CAST(coalesce(sum(n_tracks), 0) AS BIGINT) FROM i) AS total_tracks, (SELECT count(*) FROM i WHERE ingest IN ('sent', 'failed')) AS ingest_attempted, (SELECT count(*) FROM i WHERE ingest = 'failed') AS ingest_failed,
  (SELECT count(*) FROM i WHERE playlist_failed) AS spotify_failed, (SELECT count(*) FROM i WHERE route = 'bad_set_name') AS bad_filename_in_file, (SELECT count(*) FROM i WHERE ingest = 'no_tracks') AS ingest_skipped_no_tracks,
  (SELECT count(*) FROM i WHERE ingest = 'unset') AS ingest_skipped_env_missing, (SELECT count(*) FROM i WHERE n_tracks IS NULL) AS track_read_failed FROM f)"""


def _run_files(spark, sf_dir):
    """Files of a run with what became of them, made of the events."""
    e, k = table(spark, sf_dir, "events", "event_id", "event_type", "user_id"), F.col("event_id")
    m = k % 17
    return e.select(
        "event_id", F.concat(F.lit("2024-01-01 S"), k.cast("string"), F.lit(".csv")).alias("name"),
        F.when(k % 50 == 0, "bad_filename").when(k % 50 < 4, "other").when(k % 50 < 6, "bad_set_name").otherwise("set").alias("route"),
        F.when(F.col("event_type") == "error", "failed").when(k % 11 == 0, "duplicate").when(k % 211 == 0, "error").otherwise("imported").alias("status"), F.when(k % 3 > 0, k % 3 == 1).alias("renamed"), F.when(k % 301 != 0, F.col("user_id").cast("bigint") % 40).alias("n_tracks"),
        F.when(m == 0, "failed").when(m == 1, "no_tracks").when(m == 2, "unset").otherwise("sent").alias("ingest"), F.when(k % 503 == 0, "failed").otherwise("sent").alias("playlist"),
    )


@R.add(f"WITH {_RUN} SELECT *, ingest_failed = 0 AS api_ingest_success FROM c")
def run_counters(spark, sf_dir):
    return routing.run_counters(_run_files(spark, sf_dir))


@R.add(f"WITH {_RUN} SELECT * REPLACE (spotify_failed + 1 AS spotify_failed), ingest_failed = 0 AS api_ingest_success FROM c")
def observed_counters(spark, sf_dir):
    """The same counters, taken while the files are written, of a run whose last push failed."""
    path = scratch(spark, "run")
    return routing.counted_while(_run_files(spark, sf_dir), lambda df: df.write.parquet(path), push_failed=True)


@R.add(f"""WITH {_RUN}, p AS (SELECT *, concat_ws('; ', CASE WHEN sets_failed > 0 THEN 'sets_failed=' || sets_failed END, CASE WHEN ingest_failed > 0 THEN 'ingest_failed=' || ingest_failed END,
  CASE WHEN spotify_failed > 0 THEN 'spotify_failed=' || spotify_failed END, CASE WHEN bad_filename_in_file > 0 THEN 'bad_filename_in_file=' || bad_filename_in_file END,
  CASE WHEN track_read_failed > 0 THEN 'track_read_failed=' || track_read_failed END) AS said FROM c)
SELECT CASE WHEN said <> '' THEN 'WARN' ELSE 'SUCCESS' END AS severity, CASE WHEN said <> '' THEN 'Completed with issues: ' || said END AS text, 'ingest_attempted=' || ingest_attempted || ' ingest_failed=' || ingest_failed ||
  ' spotify_failed=' || spotify_failed || ' bad_filename_in_file=' || bad_filename_in_file || ' ingest_skipped_no_tracks=' || ingest_skipped_no_tracks || ' ingest_skipped_env_missing=' || ingest_skipped_env_missing ||
  ' track_read_failed=' || track_read_failed AS extra FROM p""")
def run_finding(spark, sf_dir):
    return routing.finding(routing.run_counters(_run_files(spark, sf_dir)))


@R.add("SELECT 'SUCCESS' AS severity, CAST(NULL AS VARCHAR) AS text, 'seen=' || count(*) AS extra FROM events")
def run_finding_without_issues(spark, sf_dir):
    """Skipped names and duplicates alone are no issue."""
    n = table(spark, sf_dir, "events", "event_id").agg(F.lit(0).alias("sets_failed"), F.lit(3).alias("unrecognized_filename_skips"), F.lit(2).alias("duplicate_csv_count"), F.count("*").alias("seen"))
    return routing.finding(n)


@R.add(f"WITH {_RUN} SELECT '2024-01-01 S' || event_id AS label FROM f WHERE route IN ('set', 'bad_set_name') AND status = 'failed' AND coalesce(renamed, true)")
def run_failed_labels(spark, sf_dir):
    return routing.failed_labels(_run_files(spark, sf_dir))


@R.add("""
WITH e AS (SELECT event_id, strftime(ts, '%Y-%m-%d') AS file, date_trunc('minute', ts) AS t, 'u' || user_id AS title, event_type AS artist FROM events),
u AS (SELECT *, timezone('UTC', timezone('America/Chicago', t)) AS utc FROM e WHERE file = (SELECT max(file) FROM e) AND artist <> 'error')
SELECT event_id, title, artist, strftime(t, '%Y-%m-%dT%H:%M:%S') || CASE WHEN t < utc THEN '-' ELSE '+' END || printf('%02d:%02d', abs(date_diff('minute', utc, t)) // 60, abs(date_diff('minute', utc, t)) % 60) AS played_at FROM u""")
def latest_file_plays(spark, sf_dir):
    e = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type")
    rows = e.select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("file"), F.date_format("ts", "yyyy-M-d H:m").alias("dt"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("title"), F.when(F.col("event_type") != "error", F.col("event_type")).alias("artist"))
    return live.plays(live.latest_file(rows)).select("event_id", "title", "artist", "played_at")


@R.add("""
SELECT event_id, CAST(coalesce(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before,
  coalesce(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < 200 AS scanned FROM events""")
def running_cap(spark, sf_dir):
    e = table(spark, sf_dir, "events", "event_id", "ts", "event_type")
    return routing.capped(e, F.col("event_type") == "purchase", ["ts", "event_id"]).select("event_id", "before", "scanned")


@R.add("""
WITH t AS (SELECT user_id AS id, event_id AS listing_ord, event_type, 0 AS k FROM events WHERE event_type = 'click' UNION ALL SELECT user_id, event_id, event_type, 1 FROM events WHERE event_type = 'view')
SELECT id, listing_ord, event_type FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY k, listing_ord) AS r FROM t WHERE id IS NOT NULL) WHERE r = 1""")
def union_distinct_first(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), F.col("event_id").alias("listing_ord"), "event_type")
    return routing.union_distinct([e.filter("event_type = 'click'"), e.filter("event_type = 'view'")])


@R.add("SELECT conv_id, role, min(turn) AS first_at FROM conversations GROUP BY 1, 2")
def ordered_distinct(spark, sf_dir):
    return playlists.ordered_distinct(table(spark, sf_dir, "conversations", "conv_id", "role", "turn"), ["conv_id"], "role", "turn")


@R.add("SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r <= 5")
def keep_last_n(spark, sf_dir):
    e = table(spark, sf_dir, "events", "user_id", "event_id", "ts")
    return playlists.keep_last(e, ["user_id"], [F.desc("ts"), F.desc("event_id")], 5).select("user_id", "event_id")


@R.add("""
SELECT CAST(event_id AS VARCHAR) AS id, event_type AS name, coalesce(CASE WHEN event_id % 3 = 0 THEN NULL ELSE value > 10 END, true) AS public, CAST(coalesce(CAST(json_extract_string(props, '$.k') AS INT), 0) AS INT) AS tracks_total,
  CASE WHEN event_id % 2 = 0 THEN 'https://x.example.com/' || event_id ELSE '' END AS url FROM events WHERE event_type <> 'error'""")
def playlist_defaults(spark, sf_dir):
    e, k = table(spark, sf_dir, "events", "event_id", "event_type", "value", "props"), F.col("event_id")
    none = F.lit(None).cast("string")
    rows = e.select(
        k.cast("string").alias("id"), F.when(F.col("event_type") != "error", F.col("event_type")).alias("name"), none.alias("uri"), none.alias("type"), F.when(k % 3 != 0, F.col("value") > 10).alias("public"), F.lit(None).cast("boolean").alias("collaborative"), none.alias("snapshot_id"),
        F.when(k % 2 == 0, F.struct(F.concat(F.lit("https://x.example.com/"), k.cast("string")).alias("spotify"))).alias("external_urls"), F.struct(F.from_json("props", "k int")["k"].alias("total")).alias("tracks"), F.struct(none.alias("id"), none.alias("display_name")).alias("owner"),
    )
    return playlists.flattened(rows).select("id", "name", "public", "tracks_total", "url")


@R.add("""
WITH a AS (SELECT user_id AS id, max(event_id) AS v FROM events WHERE ts < TIMESTAMP '2024-01-10' GROUP BY 1), b AS (SELECT user_id AS id, max(event_id) AS v FROM events WHERE event_type <> 'view' AND ts < TIMESTAMP '2024-01-11' GROUP BY 1)
SELECT coalesce(a.id, b.id) AS id, CASE WHEN b.id IS NULL THEN 'kept' WHEN a.id IS NULL THEN 'inserted' WHEN a.v = b.v THEN 'unchanged' ELSE 'updated' END AS change FROM a FULL OUTER JOIN b ON a.id = b.id""")
def upsert_diff(spark, sf_dir):
    e = table(spark, sf_dir, "events", "user_id", "event_id", "ts", "event_type")
    last = lambda df: df.groupBy(F.col("user_id").alias("id")).agg(F.max("event_id").alias("snapshot_id"))
    return playlists.upsert(last(e.filter("ts < timestamp_ntz'2024-01-10'")), last(e.filter("event_type <> 'view' AND ts < timestamp_ntz'2024-01-11'")))


_SURE = "coalesce(CASE WHEN event_id % 9 <> 0 THEN value / 25 END, 0)"
_ROUTED = f"""r AS (SELECT event_id, ts, CASE WHEN event_type = 'error' OR {_SURE} < 0.9 THEN 'in_place' ELSE 'move' END AS action,
  CASE WHEN event_type = 'error' THEN 'no_candidates' WHEN {_SURE} < 0.9 THEN 'low_confidence:' || printf('%.3f', {_SURE}) ELSE 'identified' END AS reason, event_id % 2 = 0 AS tagged FROM events)"""


def _identified(spark, sf_dir):
    """Audio files with what was found about them, made of the events."""
    e, k = table(spark, sf_dir, "events", "event_id", "event_type", "value", "ts"), F.col("event_id")
    return e.select("event_id", "ts", (F.col("event_type") != "error").alias("has_candidate"), F.when(k % 9 != 0, F.col("value") / 25).alias("confidence"), (k % 2 == 0).alias("has_metadata"))


@R.add(f"WITH {_ROUTED} SELECT event_id, action, reason, tagged FROM r")
def confidence_route(spark, sf_dir):
    return routing.routed(_identified(spark, sf_dir)).select("event_id", "action", "reason", "tagged")


@R.add(f"""WITH {_ROUTED} SELECT event_id AS file_id, 0 AS k, CASE WHEN action = 'move' THEN 'upload' ELSE 'update' END AS step, CASE WHEN action = 'move' THEN 'destination' ELSE 'source' END AS target FROM r
UNION ALL SELECT event_id, 1, 'delete', 'source' FROM r WHERE action = 'move'""")
def file_writes(spark, sf_dir):
    return routing.writes(routing.routed(_identified(spark, sf_dir)).withColumnRenamed("event_id", "file_id"))


#: Which step fails: of a file's number, the first of these that divides it, where the step is planned.
_FAILING = {"download": 37, "identify": 41, "tag": 43, "rename": 47, "upload": 29, "update": 31, "delete": 23}
_PLACES = {"download": 0, "identify": 1, "tag": 2, "rename": 3, "upload": 4, "update": 4, "delete": 5}
_STOP = "least(" + ", ".join(
    f"CASE WHEN event_id % {n} = 0{' AND tagged' if k in ('tag', 'rename') else ''}{' AND ' + chr(39) + ('in_place' if k == 'update' else 'move') + chr(39) + ' = action' if k in ('upload', 'update', 'delete') else ''} THEN {_PLACES[k]} ELSE 9 END"
    for k, n in _FAILING.items()
) + ")"
_HANDLED = f"""{_ROUTED}, f AS (SELECT *, {_STOP} AS stop FROM r),
d AS (SELECT event_id, ts, CAST(stop > 0 AS INT) AS downloaded, CAST(action = 'move' AND stop >= 4 AS INT) AS identified, CAST(tagged AND stop > 2 AS INT) AS tagged, CAST(stop > 4 AS INT) AS uploaded,
  CAST(action = 'move' AND stop > 5 AS INT) AS deleted, CAST(stop < 9 AS INT) AS failed FROM f),
h AS (SELECT *, coalesce(sum(uploaded) OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < 200 AS scanned FROM d),
n AS (SELECT count(*) FILTER (scanned) AS scanned, {", ".join(f"CAST(coalesce(sum({k}) FILTER (scanned), 0) AS BIGINT) AS {k}" for k in routing.DELTAS)}, count(*) FILTER (NOT scanned) AS skipped FROM h)"""


def _deltas(spark, sf_dir):
    files = routing.routed(_identified(spark, sf_dir).withColumnRenamed("event_id", "file_id"))
    fails = F.explode(F.array_compact(F.array(*[F.when(F.col("file_id") % n == 0, k) for k, n in _FAILING.items()])))
    return files, routing.deltas(routing.attempted(routing.steps(files), files.select("file_id", fails.alias("step"))))


def _retagged(spark, sf_dir):
    return routing.retag_counters(routing.retag_run(*_deltas(spark, sf_dir), ["ts", "file_id"]))


@R.add(f"WITH {_HANDLED} SELECT event_id AS file_id, {', '.join(f'CAST({k} AS BIGINT) AS {k}' for k in routing.DELTAS)} FROM d")
def retag_deltas(spark, sf_dir):
    """What happened to each file, whose steps fail here and there."""
    return _deltas(spark, sf_dir)[1]


@R.add(f"WITH {_HANDLED} SELECT * FROM n")
def retag_counters(spark, sf_dir):
    return _retagged(spark, sf_dir)


@R.add(f"""WITH {_HANDLED} SELECT CASE WHEN failed > 0 THEN 'WARN' ELSE 'SUCCESS' END AS severity,
  CASE WHEN failed > 0 THEN 'Completed with issues: failed=' || failed || ' of scanned=' || scanned || '. Check AcoustID/MusicBrainz logs for identification failures.' END AS text,
  uploaded AS sets_imported, failed AS sets_failed, skipped AS sets_skipped, scanned AS total_tracks, scanned, {", ".join(routing.DELTAS)} FROM n""")
def retag_finding(spark, sf_dir):
    return routing.retag_finding(_retagged(spark, sf_dir))


@R.add("""
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem WHERE l_partkey % 7 <> 0),
j AS (SELECT l_orderkey AS source_id, count(*) AS n_tracks, sum(l_linenumber) AS orders_sum, sum(CAST(l_quantity AS INT)) AS bpm_sum FROM t GROUP BY 1)
SELECT source_id, CAST(n_tracks AS BIGINT) AS n_tracks, 'O' || source_id AS source_file, strftime(o_orderdate, '%Y-%m-%d') AS set_date, CAST(NULL AS VARCHAR) AS venue, CAST(orders_sum AS BIGINT) AS orders_sum, CAST(bpm_sum AS DOUBLE) AS bpm_sum
FROM j JOIN orders ON source_id = o_orderkey""")
def set_payloads(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    none = F.lit("")
    raw = l.select(F.col("l_orderkey").alias("source_id"), F.col("l_linenumber").alias("play_order"), *[none.alias(c) for c in ("label", "remix", "comment", "genre", "length", "year", "play_time")], F.when(F.col("l_partkey") % 7 != 0, F.lit("T")).otherwise(" ").alias("title"), F.lit("A").alias("artist"), F.col("l_quantity").cast("int").cast("string").alias("bpm"))
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    sets = o.select(F.col("o_orderkey").alias("source_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), none.alias("venue"), F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("label"), F.lit(0).alias("ord"))
    out = tracks.payloads(tracks.typed(raw), sets)
    back = F.from_json("payload", "set_date string, venue string, source_file string, tracks array<struct<play_order: int, bpm: double>>")
    return out.select("source_id", "n_tracks", back.alias("p")).select(
        "source_id", "n_tracks", "p.source_file", "p.set_date", "p.venue", F.aggregate("p.tracks", F.lit(0).cast("bigint"), lambda a, x: a + x["play_order"]).alias("orders_sum"), F.aggregate("p.tracks", F.lit(0.0), lambda a, x: a + x["bpm"]).alias("bpm_sum")
    )


@R.add("""
SELECT count(*) FILTER (event_type = 'view') AS files_ok, count(*) FILTER (event_type <> 'view' OR event_type IS NULL) AS files_failed, CAST(coalesce(sum(CAST(value AS INT)) FILTER (event_type = 'view'), 0) AS BIGINT) AS plays_sent,
  CAST(coalesce(sum(CAST(value AS INT)) FILTER (event_type = 'error'), 0) AS BIGINT) AS plays_failed FROM (SELECT event_type, floor(value) AS value FROM events)""")
def live_summary(spark, sf_dir):
    e = table(spark, sf_dir, "events", "event_type", "value")
    status = F.when(F.col("event_type") == "view", "sent").when(F.col("event_type") == "error", "api_error").otherwise("error")
    return live.summary(e.select(status.alias("status"), F.floor("value").alias("n_plays")))


@R.add("""
WITH h AS (SELECT event_id, date_trunc('minute', ts) + to_days(CAST(event_id % 366 AS INT)) AS t FROM events), u AS (SELECT *, timezone('UTC', timezone('America/Chicago', t)) AS utc FROM h)
SELECT event_id, strftime(t, '%Y-%m-%dT%H:%M:%S') || CASE WHEN t < utc THEN '-' ELSE '+' END || printf('%02d:%02d', abs(date_diff('minute', utc, t)) // 60, abs(date_diff('minute', utc, t)) % 60) AS played_at FROM u""")
def local_instants(spark, sf_dir):
    e = table(spark, sf_dir, "events", "event_id", "ts")
    t = F.expr("date_trunc('MINUTE', cast(ts as timestamp)) + make_interval(0, 0, 0, cast(event_id % 366 as int))")
    return parse.with_instant(e.select("event_id", F.date_format(t, "yyyy-MM-dd HH:mm").alias("dt")), F.col("dt"), live.ZONE).select("event_id", "played_at")

"""Operators on small tables."""

import io
import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from tracklane import modes
from tracklane.operators import collection, files, first_fit, grid, live, order, playlists, routing, tracks
from tracklane.sources import files as sources
from tracklane.sources import archives, ordered, paged, posts, sinks, stores
from tracklane.streaming import incoming

GRID = "source_id string, tab string, row_ord int, cells array<string>"


def sheet(spark, *rows, source="s", tab="t"):
    return spark.createDataFrame([(source, tab, i, list(r)) for i, r in enumerate(rows)], GRID)


def test_merge_chain_depends_on_order(spark):
    def merged(*genres):
        rows = spark.createDataFrame([(i, "T", g) for i, g in enumerate(genres)], "i int, Title string, Genre string")
        return [(r.Genre, r.Count) for r in first_fit.deduplicate(rows, ["i"]).orderBy("first_at").collect()]

    assert merged("x", "", "y") == [("x", 2), ("y", 1)]
    assert merged("y", "", "x") == [("y", 2), ("x", 1)]
    assert merged("", "House") == [("House", 2)]
    assert merged("House", "Techno") == [("House", 1), ("Techno", 1)]


def test_merge_equals_a_plain_loop(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice("AB"), rng.choice(["", "x", "y"]), rng.choice(["", "1:00", "2:00"]), rng.choice(["1", "2", "z"])) for i in range(300)]
    got = first_fit.deduplicate(spark.createDataFrame(rows, "i int, Title string, Genre string, Length string, Count string"), ["i"])
    entries: dict[str, list[list]] = {}
    for _, t, g, n, c in rows:
        c = int(c) if c.isdigit() else 0
        for e in entries.setdefault(t, []):
            if (not e[0] or not g or e[0] == g) and (not e[1] or not n or e[1] == n):
                e[:] = [e[0] or g, e[1] or n, e[2] + c]
                break
        else:
            entries[t].append([g, n, c])
    assert sorted((r.Title, r.Genre, r.Length, r.Count) for r in got.collect()) == sorted((t, *e) for t, es in entries.items() for e in es)


def plain_merge(rows):
    """First fit by looking at all entries: [(values, n)] of rows of values, blanks empty."""
    entries = []
    for x in rows:
        for e in entries:
            if all(not a or not b or a == b for a, b in zip(e[0], x, strict=True)):
                e[0][:] = [a or b for a, b in zip(e[0], x, strict=True)]
                e[1] += 1
                break
        else:
            entries.append([list(x), 1])
    return [(tuple(v), n) for v, n in entries]


def test_entries_equal_a_plain_loop_whatever_the_pattern_of_blanks():
    rng = random.Random(8)
    for _ in range(200):
        width = rng.randrange(1, 5)
        rows = [[rng.choice(["", "", "a", "b", "c"]) for _ in range(width)] for _ in range(rng.randrange(60))]
        e = first_fit.Entries(width)
        for x in rows:
            e.add(x, x, 1, ())
        assert [(tuple(v), n[0]) for v, _, n, _ in e.rows] == plain_merge(rows)


def test_merge_of_a_hot_key(spark):
    """One key holds all rows, nearly each of which is another combination: comments are free texts, every column has blanks."""
    n = 200_000
    word = lambda k, m: F.concat(F.lit("w"), (F.xxhash64("id", F.lit(k)) % m).cast("string"))
    rows = spark.range(n).select("id", F.when(F.col("id") % 50 != 3, word(1, 10**9)).otherwise("").alias("a"), F.when(F.col("id") % 7 > 0, word(2, 40)).otherwise("").alias("b"))
    got = first_fit.merge(rows, {"k": F.lit("x")}, {c: (F.col(c), F.col(c)) for c in "ab"}, F.lit(1), ["id"])
    assert got.agg(F.sum("n")).first()[0] == n
    part = rows.filter("id < 3000")
    small = first_fit.merge(part, {"k": F.lit("x")}, {c: (F.col(c), F.col(c)) for c in "ab"}, F.lit(1), ["id"]).orderBy("key_at", "at").collect()
    assert [((r.a, r.b), r.n) for r in small] == plain_merge([(r.a, r.b) for r in part.orderBy("id").collect()])


def test_large_keys_are_split_by_columns_without_blanks(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice("AB"), rng.choice("xyz"), rng.choice(["", "1", "2"])) for i in range(400)]
    df = spark.createDataFrame(rows, "i int, k string, a string, b string")
    merged = lambda split: first_fit.merge(df, {"k": F.col("k")}, {c: (F.col(c), F.col(c)) for c in "ab"}, F.lit(1), ["i"], split=split).orderBy("key_at", "at").collect()
    assert merged(2) == merged(10**6) and len(merged(2)) > 10


def test_a_merged_sheet_keeps_the_order_of_keys_and_entries(spark):
    rows = [(0, "b", "x"), (1, "a", "x"), (2, "b", "y"), (3, "c", ""), (4, "a", "y"), (5, "b", "")]
    got = first_fit.deduplicate(spark.createDataFrame(rows, "i int, Title string, Genre string"), ["i"])
    order_ = first_fit.numbered(first_fit.ranked(got, "first_at"), ["key_at"], "first_at").orderBy("key_rank", "entry").collect()
    assert [(r.Title, r.Genre, r.Count, r.key_rank, r.entry) for r in order_] == [("b", "x", 2, 1, 0), ("b", "y", 1, 1, 1), ("a", "x", 1, 2, 0), ("a", "y", 1, 2, 1), ("c", "", 1, 3, 0)]


def test_summary_and_merge_of_a_sheet(spark):
    g = sheet(spark, ["Title", "Artist", "Ignored", "Genre"], [" A ", " X ", "foo", " House "], ["a", "x"], ["B", "Y", "", ""], ["", "", " "])
    rows = grid.summary_rows(g).collect()
    assert [(r.Title, r.Artist, r.Genre, r.Count) for r in rows] == [("A", "X", "House", 1), ("a", "x", "", 1), ("B", "Y", "", 1)]
    assert sorted((r.Title, r.Count) for r in modes.run("summaries", g).collect()) == [("A", 2), ("B", 1)]
    assert grid.summary_rows(sheet(spark, ["Title", "Artist"])).count() == 0
    with pytest.raises(ValueError, match="unknown mode"):
        modes.run("nothing", g)


def test_tracks_keep_their_place(spark):
    g = sheet(spark, ["Title", "Artist", "Length", "BPM"], ["Song", "Artist", "02:30", "100.5"], ["", "B"], ["C", " "], ["D", "E", "x", "y"])
    rows = tracks.typed(grid.known_columns(g)).orderBy("play_order").collect()
    assert [(r.play_order, r.title, r.length_secs, r.bpm, r.genre) for r in rows] == [(1, "Song", 150, 100.5, None), (4, "D", None, None, None)]
    meta = spark.createDataFrame([("s", "", "", "old", 0), ("s", "2024-01-01", "", "L", 1)], "source_id string, date string, venue string, label string, ord int")
    (p,) = tracks.payloads(tracks.typed(grid.known_columns(g)), meta).collect()
    body = json.loads(p.payload)
    assert (p.n_tracks, body["set_date"], body["venue"], body["source_file"], [t["title"] for t in body["tracks"]]) == (2, "2024-01-01", None, "L", ["Song", "D"])


def test_names(spark):
    f = spark.createDataFrame([("d", "Copy of A.csv", 1), ("d", "failed_A.csv", 2), ("d", "Copy of B.csv", 3), ("d", "B.csv", 4), ("e", "FAILED_B.csv", 5)], "folder_id string, name string, listing_ord int")
    assert [r.new_name for r in files.repaired_names(f).orderBy("listing_ord").collect()] == ["A.csv", "failed_A.csv", "Copy of B.csv", "B.csv", "B.csv"]
    there = spark.createDataFrame([("track_one.txt", 1), ("track_one.mp3", 1), ("x.csv", 2)], "name string, year int")
    new = spark.createDataFrame([("track_one.csv", 1), ("track_one (1).csv", 1), ("x.csv", 1)], "name string, year int")
    assert {r.name: r.out_name for r in files.with_duplicates(new, there).collect()} == {"track_one.csv": "possible_duplicate_track_one.csv", "track_one (1).csv": "track_one (1).csv", "x.csv": "x.csv"}
    years = spark.createDataFrame([("2023", "a"), ("2024", "FAILED_b"), ("2025", "c_Cleaned"), ("2026", "d"), ("2022", "e")], "year string, name string")
    known = spark.createDataFrame([("2023 Summary",), ("Old 2022 Summary",)], "name string")
    assert {r.year: r.action for r in files.year_actions(years, known).collect()} == {"2023": "deduplicate", "2024": "skip_unready", "2025": "skip_unready", "2026": "generate", "2022": "skip_similar"}
    paths = ["a/2024-01-01 X.xlsx", "__MACOSX/2024-01-01 X.xlsx", "a/Summary/2024-01-01 X.xlsx", "a/2024-01-01/", "a/other.xlsx"]
    assert [r.path for r in files.archive_sets(spark.createDataFrame([(p,) for p in paths], "path string")).collect()] == paths[:1]


def test_plays(spark):
    rows = spark.createDataFrame([("2024-06-01 14:30", "T", "A"), ("bad", "T", "A"), ("2024-06-01 14:31", "", "A"), ("2024-06-01 14:32", "T", None)], "dt string, title string, artist string")
    assert [r.played_at for r in live.plays(rows).collect()] == ["2024-06-01T14:30:00-05:00"]


def test_playlists(spark):
    p = spark.createDataFrame([("1", "n", "u", "t", None, None, "s", None, None, None), (None, "n", "u", "t", True, True, "s", None, None, None), ("2", "m", "u", "t", False, True, "s", ("url",), (3,), ("o", "d"))], playlists.SCHEMA)
    got = [(r.id, r.public, r.collaborative, r.url, r.tracks_total, r.owner_id) for r in playlists.flattened(p).orderBy("id").collect()]
    assert got == [("1", True, False, "", 0, None), ("2", False, True, "url", 3, "o")]
    plan = playlists.write_plan(p, spark.createDataFrame([("n", ["a", "a", "b"]), ("new", ["a", "a", "b"]), ("none", [])], "name string, uris array<string>"))
    assert sorted((r.name, r.action, r.uris) for r in plan.collect()) == [("n", "refresh", ["a", "a", "b"]), ("new", "create", ["a", "b"])]


def test_union_and_fallback(spark):
    a = spark.createDataFrame([("1", 2), (None, 3)], "id string, listing_ord int")
    b = spark.createDataFrame([("1", 1), ("2", 1)], "id string, listing_ord int")
    assert sorted((r.id, r.listing_ord) for r in routing.union_distinct([a, b]).collect()) == [("1", 2), ("2", 1)]
    none = a.filter("false")
    assert routing.listed_or_all([none, none], b).count() == 2
    assert routing.listed_or_all([a, none], b).count() == 1


def test_cap_and_finding(spark):
    rows = spark.createDataFrame([(i // 3, i) for i in range(9)], "day int, i int")
    got = routing.capped(rows, F.lit(True), ["day", "i"], limit=4).orderBy("i").collect()
    assert [r.scanned for r in got] == [i < 4 for i in range(9)]
    assert routing.capped(rows, F.lit(True), ["day", "i"], limit=0).filter("scanned").count() == 9
    (f,) = routing.finding(spark.createDataFrame([(0, 2, 1, 5, 9)], "bad_filename_in_file int, ingest_failed int, sets_failed int, seen int, total_tracks int")).collect()
    assert (f.severity, f.text, f.extra) == ("WARN", "Completed with issues: sets_failed=1; ingest_failed=2", "bad_filename_in_file=0 ingest_failed=2 seen=5")
    (f,) = routing.finding(spark.createDataFrame([(0, 7)], "sets_failed int, unrecognized_filename_skips int")).collect()
    assert (f.severity, f.text, f.extra) == ("SUCCESS", None, "")
    c = spark.createDataFrame([([(0.5, "b"), (0.9, "a")],)], "c array<struct<confidence: double, mbid: string>>").select(routing.best_candidates(F.col("c"), 1).alias("c")).first().c
    assert [x.mbid for x in c] == ["a"]


def test_collection(spark):
    rows = [("2024", "1", "2024-01-01 A", 1), ("2024", "2", "2024-01-01 B", 2), ("2024", "3", "2024-05-01 C", 3), ("Archive", "4", "x", 1), ("Summary", "5", "2023 Summary", 1)]
    f = spark.createDataFrame([(a, b, c, files.SPREADSHEET, o) for a, b, c, o in rows], "folder string, file_id string, name string, mime_type string, listing_ord int")
    i = collection.items(f)
    tab = collection.sheet_rows(i).filter("folder = '2024'").orderBy("tab_row").collect()
    assert [(r.date_cell, r.title_cell) for r in tab] == [("'2024-05-01", "'C"), ("'2024-01-01", "'A"), ("'2024-01-01", "'B")]
    snap = {r.folder: json.loads(r["items"]) for r in collection.nested(collection.snapshot(i)).collect()}
    assert [x["label"] for x in snap["2024"]] == ["2024-05-01 C", "2024-01-01 B", "2024-01-01 A"]
    assert list(snap["2024"][0]) == ["date", "title", "label", "url", "spreadsheet_id"] and list(snap["Summary"][0]) == ["label", "url", "spreadsheet_id"]
    assert tuple(collection.totals(f).first()) == (3, 1, 3)


def test_a_hot_key_is_split_by_a_column_that_is_never_blank(spark):
    """The merge of one key with many rows equals the plain loop, and its combinations come in many pieces."""
    rng = random.Random(4)
    rows = [(i, "", f"c{rng.randrange(400)}", rng.choice(["", "x", "y"])) for i in range(3000)]
    got = first_fit.deduplicate(spark.createDataFrame(rows, "i int, Title string, Comment string, Genre string"), ["i"])
    entries: list[list] = []
    for _, _, c, g in rows:
        for e in entries:
            if e[0] == c and (not e[1] or not g or e[1] == g):
                e[:] = [c, e[1] or g, e[2] + 1]
                break
        else:
            entries.append([c, g, 1])
    assert sorted((r.Comment, r.Genre, r.Count) for r in got.collect()) == sorted(map(tuple, entries))


def test_running_sums_cross_partitions(spark):
    rows = spark.createDataFrame([(g, k, k % 3) for g in ("a", None) for k in range(40)], "g string, k int, v int")
    got = order.running_before(rows, F.col("v"), ["g"], ["k"], "before").collect()
    assert all(r.before == sum(j % 3 for j in range(r.k)) for r in got) and len(got) == 80
    assert [r.place for r in order.placed(rows, ["g"], [F.desc("k")], "place").filter("g IS NULL").orderBy(F.desc("k")).collect()] == list(range(1, 41))
    assert order.placed(rows.filter("false"), [], ["k"], "place").count() == 0


def test_places_of_texts_that_share_their_beginning(spark):
    rows = spark.range(4000).select(F.concat(F.lit("the same long beginning of all texts "), F.lpad(F.col("id").cast("string"), 6, "0")).alias("t"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would else be put together
    try:
        sizes = [r.n for r in order.ranged(rows, [], ["t"]).groupBy("_part").agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(sizes) < 2 * sum(sizes) / len(sizes)
    assert [r.place for r in order.placed(rows, [], [F.desc("t")], "place").orderBy(F.desc("t")).collect()] == list(range(1, 4001))


def test_summary_order_without_titles(spark):
    g = sheet(spark, ["Artist", "Genre"], ["b", "x"], ["a", "y"], ["a", "x"])
    assert grid.present_columns(g) == ["Artist", "Genre"]
    rows = grid.sorted_summary(grid.summary_rows(g).select("source_id", "tab", "row_ord", "Artist", "Genre", "Count")).collect()
    assert [(r.Artist, r.Genre, r.place) for r in rows] == [("a", "x", 1), ("a", "y", 2), ("b", "x", 3)]


def test_modes_go_on_after_a_failure(spark, tmp_path):
    sheet(spark, ["Title", "Artist"], ["A", "B"]).write.parquet(str(tmp_path / "in"))
    args = ["tracks", str(tmp_path / "in"), str(tmp_path / "missing"), str(tmp_path / "out")]
    assert modes.main(args) == 1
    assert spark.read.parquet(str(tmp_path / "out" / "0")).count() == 1
    assert modes.main(["tracks", str(tmp_path / "in"), str(tmp_path / "none"), "--dry-run"]) == 0
    assert not (tmp_path / "none").exists()
    assert modes.main([*args, "--outcomes", str(tmp_path / "outcomes.json")]) == 1
    told = [json.loads(x) for x in (tmp_path / "outcomes.json").read_text().splitlines()]
    assert [(o["ok"], o["rows"], o["error"] is None) for o in told] == [(True, 1, True), (False, None, False)]


def test_modes_read_archives_of_one_year(spark, tmp_path):
    cell = lambda x: f'<c t="inlineStr"><is><t>{x}</t></is></c>'
    row = lambda *cells: f"<row>{''.join(map(cell, cells))}</row>"
    with zipfile.ZipFile(tmp_path / "sets.zip", "w") as z:
        for year in (2023, 2024):
            book = io.BytesIO()
            with zipfile.ZipFile(book, "w") as w:
                body = row("Title", "Artist", "Duration") + row(f"T{year}", "A", "1:02:03") + row("", "B", "")
                w.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{body}</sheetData></worksheet>')
            z.writestr(f"a/{year}-01-02 Club.xlsx", book.getvalue())
        z.writestr("a/2024-05-06 Broken.xlsx", b"x")
        z.writestr("a/DJ Set Collection.xlsx", b"x")
    assert modes.main(["old-workbooks", str(tmp_path / "sets.zip"), str(tmp_path / "out"), "--year", "2024"]) == 0
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r.source_id, r.title, r.length_secs) for r in got] == [("2024-01-02 Club", "T2024", 3723)]


def test_settings_come_from_the_environment(monkeypatch):
    for k, v in {"ZONE": "UTC", "MIN_CONFIDENCE": "0.5", "MAX_CANDIDATES": "2", "MAX_UPLOADS": "7", "SERVICE": " http://x/ ", "SUMMARY_FOLDER": "S", "SNAPSHOT_PATH": "p"}.items():
        monkeypatch.setenv(f"TRACKLANE_{k}", v)
    s = modes.Settings()
    assert (s.zone, s.min_confidence, s.max_candidates, s.max_uploads, s.service, s.summary_folder, s.snapshot_path) == ("UTC", 0.5, 2, 7, "http://x", "S", "p")
    monkeypatch.undo()
    assert modes.Settings() == modes.Settings(zone="America/Chicago", min_confidence=0.9, max_candidates=5, max_uploads=200)


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a b.csv").write_text('h,"x, y"\n1,"say ""hi"""\n')
    (tmp_path / "in" / "2024-06-01.m3u").write_text("#EXTM3U\n#EXTVDJ:<time>14:30</time><artist>A</artist><title>T</title>\n/x.mp3\n")
    assert sorted((r.name, r.mime_type, r.listing_ord) for r in sources.listing(spark, str(tmp_path / "in")).collect()) == [("2024-06-01.m3u", "audio/x-mpegurl", 1), ("a b.csv", "text/csv", 2)]
    cells = sources.csv_grid(sources.clean_lines(sources.lines(spark, str(tmp_path / "in" / "a b.csv")))).orderBy("row_ord").collect()
    assert [r.cells for r in cells] == [["h", "x, y"], ["1", 'say "hi"']]
    got = sources.history_entries(sources.lines(spark, str(tmp_path / "in" / "2024-06-01.m3u"))).collect()
    assert [(r.dt, r.title, r.artist) for r in got] == [("2024-06-01 14:30", "T", "A")]
    sheet_xml = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData><row><c r="A1" t="inlineStr"><is><t>Title</t></is></c><c r="C1"><v>7</v></c></row></sheetData></worksheet>'
    book = io.BytesIO()
    with zipfile.ZipFile(book, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", sheet_xml)
    with zipfile.ZipFile(tmp_path / "sets.zip", "w") as z:
        z.writestr("a/2024-01-01 X.xlsx", book.getvalue())
        z.writestr("a/broken.xlsx", b"no zip")
    got = sources.workbook_archives(spark, str(tmp_path / "sets.zip")).orderBy("path").collect()
    assert [(r.path, r.cells, r.error is None) for r in got] == [("a/2024-01-01 X.xlsx", ["Title", "", "7"], True), ("a/broken.xlsx", [], False)]
    (tmp_path / "bad.zip").write_bytes(b"no archive")
    got = sources.workbook_archives(spark, [str(tmp_path / "sets.zip"), str(tmp_path / "bad.zip")]).collect()
    assert sorted(r.error is None for r in got) == [False, False, True]
    sinks.write_clean_folders(sources.clean_lines(sources.lines(spark, str(tmp_path / "in" / "a b.csv"))).withColumn("name", F.lit("a")), str(tmp_path / "clean"))
    assert [r.value for r in spark.read.text(str(tmp_path / "clean" / "name=a")).collect()] == ['h,"x, y"', '1,"say ""hi"""']
    sinks.write_json(spark.createDataFrame([("é", None)], "a string, b string"), str(tmp_path / "json"), ascii_only=True)
    assert spark.read.text(str(tmp_path / "json")).first().value == '{"a":"\\u00E9","b":null}'
    for n in (1, 2):
        sinks.overwrite_years(spark.createDataFrame([(2023 + n, n), (2024, n * 10)], "year int, v int"), str(tmp_path / "years"))
    assert sorted((r.year, r.v) for r in spark.read.parquet(str(tmp_path / "years")).collect()) == [(2024, 20), (2025, 2)]


def test_paged_source_and_posts(spark, tmp_path):
    target = str(tmp_path / "sent")

    def send(payload):
        with open(target, "a") as f:
            f.write(payload + "\n")

    spark.dataSource.register(paged.source("pages_of_numbers", "id int, type string", lambda o, n, where: [(i, "x") for i in range(o, min(o + n, 120))]))
    assert spark.read.format("pages_of_numbers").option("total", 120).load().agg(F.sum("id")).first()[0] == sum(range(120))
    spark.dataSource.register(paged.source("pages_with_next", "id int, type string", lambda o, n, where: {"items": [(o, "x")], "next": o < 200} if o < 1000 else None))
    assert [r.id for r in spark.read.format("pages_with_next").load().collect()] == [0, 50, 100, 150, 200]
    spark.dataSource.register(paged.source("no_pages", "id int, type string", lambda o, n, where: "an error"))
    assert spark.read.format("no_pages").load().count() == 0
    spark.dataSource.register(sinks.post_sink("posts", send, pause=0))
    spark.createDataFrame([("k", "body")], "key string, payload string").write.format("posts").mode("append").save()
    assert open(target).read() == "body\n"


def test_stream_reads_each_file_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in (1, 2):
        (tmp_path / "in" / f"{k}.csv").write_text(f"sep=,\na,{k}\n")
        incoming.run_available(incoming.incoming_lines(spark, str(tmp_path / "in")), str(tmp_path / "check"), lambda df, _: df.write.mode("append").parquet(str(tmp_path / "out")))
        assert sorted(r.line for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [f"a,{i}" for i in range(1, k + 1)]

"""Sources and sinks that tasks read and write themselves."""

import contextlib
import io
import json
import random
import zipfile

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from tracklane.operators import collection, files, playlists, routing
from tracklane.plans import feeds
from tracklane.sources import archives, ordered, paged, posts, sinks, stores
from tracklane.streaming import incoming


def test_archives_are_dealt_by_entry(spark, tmp_path):
    rng = random.Random(1)
    data = {f"d/{k}.xlsx": rng.randbytes(rng.randrange(5000)) * 2 for k in range(40)}
    for method, name in ((zipfile.ZIP_DEFLATED, "packed.zip"), (zipfile.ZIP_STORED, "stored.zip")):
        with zipfile.ZipFile(tmp_path / name, "w", method) as z:
            for k, v in data.items():
                z.writestr(k, v)
            z.writestr("notes.txt", "x")
    df = archives.read(spark, str(tmp_path), partition_bytes=20_000)
    assert df.rdd.getNumPartitions() > 8
    for name in ("packed.zip", "stored.zip"):
        got = df.filter(F.col("archive").endswith(name)).collect()
        assert {r.path: bytes(r.content) for r in got} == data and all(r.error is None for r in got)


def test_archive_filters_reach_planning(tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        for k in range(10):
            z.writestr(f"{k}.xlsx", "x")
    reader = archives.ArchiveReader({"path": str(tmp_path), "suffix": ".xlsx", "partitionBytes": "1"})
    left = list(reader.pushFilters([archives.StringStartsWith(("path",), "3"), archives.EqualTo(("error",), "x")]))
    assert [type(f) for f in left] == [archives.EqualTo]
    assert [e.path for p in reader.partitions() for e in p.entries] == ["3.xlsx"]


def test_broken_archives_and_entries_are_told(spark, tmp_path):
    (tmp_path / "no.zip").write_bytes(b"no archive")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.writestr("good.xlsx", b"good")
        z.writestr("bad.xlsx", b"not as it was")
    (tmp_path / "half.zip").write_bytes(out.getvalue().replace(b"not as it was", b"not as it is!"))
    got = {(r.archive.rpartition("/")[2], r.path): (r.content, r.error is None) for r in archives.read(spark, str(tmp_path)).collect()}
    assert got == {("no.zip", None): (None, False), ("half.zip", "good.xlsx"): (b"good", True), ("half.zip", "bad.xlsx"): (None, False)}


def test_ordered_files_over_many_tasks(spark, tmp_path):
    lines = spark.range(5000).select(F.when(F.col("id") % 3 > 0, "large").otherwise(F.concat(F.lit("f"), (F.col("id") % 10).cast("string"))).alias("f"), "id", F.concat(F.lit("é "), F.col("id").cast("string")).alias("t"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        done = ordered.write(lines, str(tmp_path / "out"), F.col("f"), F.col("t"), [F.desc("id")], lambda f: F.concat(F.lit("<"), f, F.lit(">\n")), lambda f: F.lit("\nend"), "\n")
        assert {r.file: r.bytes for r in done.collect()} == {f.name: f.stat().st_size for f in (tmp_path / "out").iterdir()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want: dict[str, list[str]] = {}
    for i in reversed(range(5000)):
        want.setdefault("large" if i % 3 else f"f{i % 10}", []).append(f"é {i}")
    assert {f.name: f.read_text() for f in (tmp_path / "out").iterdir()} == {k: f"<{k}>\n" + "\n".join(v) + "\nend" for k, v in want.items()}
    ordered.write(lines.filter("f = 'f3' AND id < 100"), str(tmp_path / "out"), F.col("f"), F.col("t"), ["id"], lambda f: F.lit(""), lambda f: F.lit(""))
    assert (tmp_path / "out" / "f3").read_text().split("\n")[0] == "é 3" and (tmp_path / "out" / "large").exists()


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    lines = spark.range(50).select(F.lit("f").alias("f"), "id", F.when(F.col("id") == 40, F.raise_error(F.lit("no"))).otherwise("x").alias("t"))
    with pytest.raises(Exception, match="no"):
        ordered.write(lines, str(tmp_path / "out"), F.col("f"), F.col("t"), ["id"], lambda f: F.lit(""), lambda f: F.lit(""))
    assert not any((tmp_path / "out").iterdir()) if (tmp_path / "out").exists() else True


def test_collection_snapshot_as_one_file(spark, tmp_path):
    rows = [("2024", 1, '{"label":"b"}'), ("2024", 2, '{"label":"a"}'), ("Summary", 1, '{"label":"s"}'), ('9"', 1, '{"label":"q"}')]
    snap = spark.createDataFrame(rows, "folder string, place int, item string")
    collection.write_snapshot(snap, str(tmp_path))
    got = json.loads((tmp_path / "collection.json").read_text())
    assert got == {"folders": [{"name": n, "items": [json.loads(i) for f, _, i in rows if f == n]} for n in ("Summary", '9"', "2024")]}
    collection.write_folders(snap, str(tmp_path / "folders"))
    assert sorted(json.loads(f.read_text())["name"] for f in (tmp_path / "folders").iterdir()) == ["2024", '9"', "Summary"]


def test_posts_of_a_batch_that_ends_midway(spark, tmp_path):
    box = str(tmp_path / "box")

    def send(key, payload):
        if key == "5" and not stores.exists(f"{tmp_path}/up"):
            raise ConnectionError("away")
        if key == "7":
            raise ValueError("HTTP 400")
        with open(box, "a") as f:
            f.write(f"{key}={payload}\n")

    spark.range(20).select(F.col("id").cast("string").alias("key"), F.lit("p").alias("payload")).coalesce(1).write.parquet(str(tmp_path / "in"))

    def run():
        stream = spark.readStream.schema("key string, payload string").parquet(str(tmp_path / "in"))
        incoming.run_available(stream, str(tmp_path / "check"), lambda df, n: posts.post_batch(df, n, str(tmp_path / "posts"), send, tries=2, pause=0))

    with contextlib.suppress(Exception):
        run()
    early = len(open(box).read().split()) if stores.exists(box) else 0
    assert early < 19
    (tmp_path / "up").write_text("")
    run()
    run()
    assert sorted(open(box).read().split()) == sorted(f"{k}=p" for k in range(20) if k != 7)
    answers = spark.read.parquet(str(tmp_path / "posts" / "answers")).collect()
    assert sorted((r.key, r.ok) for r in answers) == sorted((str(k), k != 7) for k in range(20))


def test_posts_need_a_file_a_task_not_a_payload(spark, same_as_sql):
    df = feeds.QUERIES["posted_once"](spark, f"{DATA}/sf0.01")
    assert 0 < len([f for f in df.inputFiles() if "/inbox/" in f]) <= 2 * posts.BUCKETS
    same_as_sql(df, feeds.ORACLES["posted_once"], f"{DATA}/sf0.01")


def test_polled_pages_come_once(spark, tmp_path):
    folder = str(tmp_path / "pages")
    spark.dataSource.register(paged.source("polled_numbers", "id bigint", paged.file_service(folder)))
    seen = []

    def poll(closed):
        stream = spark.readStream.format("polled_numbers").option("limit", 10).option("closed", closed).load()
        incoming.run_available(stream, str(tmp_path / "check"), lambda df, _: seen.extend(r.id for r in df.collect()))
        return sorted(seen)

    paged.write_pages(spark.range(35).select("id"), folder, ["id"], 10)
    assert poll("false") == list(range(30))
    assert poll("false") == list(range(30))
    assert poll("true") == list(range(35))


def test_moves_twice_move_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x")
    plan = spark.createDataFrame([(str(tmp_path / "a.csv"), str(tmp_path / "old" / "a.csv")), (str(tmp_path / "b"), str(tmp_path / "old" / "b"))], "source string, target string")
    assert sorted(r.done for r in sinks.moves(plan).collect()) == ["missing", "moved"]
    assert sorted(r.done for r in sinks.moves(plan).collect()) == ["already", "missing"]
    assert (tmp_path / "old" / "a.csv").read_text() == "x"


def test_spark_archives_what_it_has_read(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in (1, 2):
        (tmp_path / "in" / f"{k}.csv").write_text("a\n")
        incoming.run_available(incoming.incoming_lines(spark, str(tmp_path / "in"), archive=str(tmp_path / "old")), str(tmp_path / "check"), lambda df, _: df.write.mode("append").parquet(str(tmp_path / "out")))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_files_of_a_batch_are_looked_up_by_few_tasks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(100):
        (tmp_path / "in" / f"{k}.csv").write_text(f"a{k}\n")
    before, seen, tracker = spark.conf.get(incoming.LISTING), [], spark.sparkContext.statusTracker()

    def each(df, _):
        lines = df.count()
        stages = [s for j in tracker.getJobIdsForGroup(str(spark.streams.active[0].runId)) for s in tracker.getJobInfo(j).stageIds]
        seen.append((lines, max(i.numTasks for s in stages if (i := tracker.getStageInfo(s)))))

    incoming.run_available(incoming.incoming_lines(spark, str(tmp_path / "in")), str(tmp_path / "check"), each)
    assert len(seen) == 1 and seen[0][0] == 100 and seen[0][1] < 50
    assert spark.conf.get(incoming.LISTING) == before


def test_names_in_turn_equal_a_plain_loop(spark):
    rng = random.Random(7)
    names = ["a", "FAILED_a", "failed_FAILED_a", "Copy of a", "copy of FAILED_a", "b", "possible_duplicate_b", "FAILED_", "FAILED_FAILED_", "Copy of FAILED_", None]
    rows = [(rng.choice("xyz"), k, rng.choice(names), "extra") for k in range(120)]
    got = {r.listing_ord: r.new_name for r in files.names_in_turn(spark.createDataFrame(rows, "folder_id string, listing_ord int, name string, _name2 string")).collect()}
    want = {}
    for folder in "xyz":
        own = [(k, n) for f, k, n, _ in rows if f == folder]
        there = {n for _, n in own if n}
        for k, n in own:
            p = next((p for p in ("failed_", "possible_duplicate_", "copy of ") if (n or "").lower().startswith(p)), None)
            new = n[len(p) :] if p else None
            if new and new not in there:
                there.discard(n)
                there.add(new)
                want[k] = new
            else:
                want[k] = n
    assert got == want


def test_left_out_fields_are_not_null_ones(spark):
    raw = ['{"id":"1","name":"n"}', '{"id":"2","name":"n","uri":null,"type":null,"snapshot_id":null,"owner":{"id":null},"public":null}', '{"id":"3","name":"n","owner":"x","tracks":[],"external_urls":7}', '{"name":"n"}', "[1]", "no json", None]
    got = {r.id: r for r in playlists.flattened(playlists.read(spark.createDataFrame([(x,) for x in raw], "raw string"))).collect()}
    assert sorted(got) == ["1", "2", "3"]
    assert (got["1"].uri, got["1"].type, got["1"].snapshot_id, got["1"].owner_id, got["1"].owner_name) == ("", "playlist", "", "", "")
    assert (got["2"].uri, got["2"].type, got["2"].snapshot_id, got["2"].owner_id, got["2"].owner_name, got["2"].public) == (None, None, None, None, "", True)
    assert (got["3"].owner_id, got["3"].tracks_total, got["3"].url) == ("", 0, "")


def test_steps_of_a_file_end_at_the_one_that_fails(spark):
    rows = [("a", True, 0.95, True), ("b", True, 0.95, True), ("c", False, None, False), ("d", True, 0.5, True), ("e", True, 0.99, False), (None, True, 0.99, True)]
    routed = routing.routed(spark.createDataFrame(rows, "file_id string, has_candidate boolean, confidence double, has_metadata boolean"))
    failing = spark.createDataFrame([("a", "delete"), ("b", "rename"), ("c", "download"), ("d", "upload")], "file_id string, step string")
    deltas = routing.deltas(routing.attempted(routing.steps(routed), failing))
    got = {r.file_id: tuple(r)[1:] for r in deltas.collect()}
    # downloaded, identified, tagged, uploaded, deleted, failed; d never comes to an upload
    assert got == {"a": (1, 1, 1, 1, 0, 1), "b": (1, 0, 1, 0, 0, 1), "c": (0, 0, 0, 0, 0, 1), "d": (1, 0, 1, 1, 0, 0), "e": (1, 1, 0, 1, 1, 0)}
    run = routing.retag_run(routed.withColumn("n", F.monotonically_increasing_id()), deltas, ["n"], limit=2)
    n = routing.retag_counters(run).first()
    assert n.scanned + n.skipped == 6 and n.uploaded == 2
    f = routing.retag_finding(routing.retag_counters(run)).first()
    assert f.severity == "WARN" and f.sets_imported == n.uploaded and f.sets_skipped == n.skipped and f.total_tracks == n.scanned

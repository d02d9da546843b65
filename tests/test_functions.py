"""Cells and file names, value by value."""

import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tracklane.functions import parse, text


def one(spark, f, *values):
    """f applied to each value."""
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.out for r in rows.select("i", f(F.col("v")).alias("out")).orderBy("i").collect()]


CASES = [
    (text.strip, {" a ": "a", "\ta b\n": "a b", None: ""}),
    (text.clean_cell, {"\u00a0a\u00a0b ": "a b", None: ""}),
    (text.text_cell, {"2024": "'2024", "": ""}),
    (text.base_url, {" https://x.example.com// ": "https://x.example.com", "": ""}),
    (text.title_key, {"Beyoncé - Halo!": "beyoncehalo", "beyonce halo": "beyoncehalo", "": ""}),
    (text.fold, {"P!nk": "P!nk", "ｆｕｌｌ  width": "full width", "so­ft": "soft"}),
    (text.base_name, {"a.b.csv": "a.b", ".hidden": ".hidden", "..x.csv": "..x", "none": "none", "a.": "a"}),
    (text.without_status, {"Copy of 2024 X.csv": "2024 X.csv", "failed_a": "a", "FAILED_": "FAILED_", "plain": "plain"}),
    (text.year_of_name, {"2024-01-15_My Set.csv": "2024", "2024_x": "2024", "My Set.csv": None, "": None}),
    (parse.length_seconds, {"2:30": 150, "02:60": None, "1:02:30": None, "": None, None: None}),
    (parse.length_seconds_long, {"00:2:52": 172, "2:30": 150}),
    (parse.length_key, {"00:2:54": "2:54", "0:02:54": "2:54", "2:54": "2:54", "75:00": "75:00", "x": "x", ": 2 :: 05:": "2:05", "1:2:3:4": "1:2:3:4", "-1:00": "-1:00", "1_0:05": "10:05", "2:5": "2:05"}),
    (parse.bpm_key, {"100": "100", "100.0": "100", "100.50": "100.5", "nan": "nan", "fast": "fast"}),
    (parse.to_count, {"3": 3, "2.0": 0, "x": 0, "": 0, None: 0}),
    (parse.to_int, {"2020": 2020, "2020.0": None, "1_000": 1000, "-3": -3}),
    (parse.to_int_via_double, {"2020.0": 2020, "x": None, "1e2": 100, "inf": None}),
    (parse.play_time, {"19:30": "19:30", "12:05 AM": None}),
    (parse.play_time_ampm, {"12:05 AM": "00:05", "1:05 pm": "13:05", "7:00": "7:00"}),
    (lambda c: parse.local_instant(c, "America/Chicago"), {"2024-11-03 01:30": "2024-11-03T01:30:00-06:00", "2024-03-10 02:30": "2024-03-10T02:30:00-06:00", "2024-6-1 14:30": "2024-06-01T14:30:00-05:00", "soon": None}),
]


@pytest.mark.parametrize("k", range(len(CASES)))
def test_values(spark, k):
    f, cases = CASES[k]
    assert dict(zip(cases, one(spark, f, *cases), strict=True)) == cases


def test_dates_of_names(spark):
    got = one(spark, text.date_venue, "2024-01-15 Harbor Swing", "No Date")
    assert [tuple(x) for x in got] == [("2024-01-15", "Harbor Swing"), (None, None)]
    got = one(spark, text.date_title, "2024-03-15_Harbor_Swing.csv", "2024-03-15 - My Set", "No Date Here", "2024-01-01")
    assert [tuple(x) for x in got] == [("2024-03-15", "Harbor_Swing.csv"), ("2024-03-15", "My Set"), ("", "No Date Here"), ("2024-01-01", "")]
    got = one(spark, text.archive_entry, "y/2024-01-01.xlsx", "y/2024-01-01 - Club.XLSX", "y/notes.xlsx")
    assert [tuple(x) for x in got] == [("2024-01-01", "Unknown", "2024-01-01"), ("2024-01-01", "Club", "2024-01-01 - Club"), (None, "Unknown", "notes")]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=12), min_size=1, max_size=60))
def test_fold_is_the_unicode_one(spark, values):
    def model(s):
        s = unicodedata.normalize("NFKD", s.strip())
        s = unicodedata.normalize("NFKC", "".join(c for c in s if unicodedata.category(c) != "Mn"))
        return " ".join("".join(c for c in s if unicodedata.category(c) != "Cf").split())

    values = [v.encode("utf-8", "ignore").decode() for v in values]
    assert one(spark, text.fold, *values) == [model(v) for v in values]


@pytest.mark.parametrize(
    ("raw", "clean"),
    [("a,b,c\n1,2,3\n4,5,6\n", "a,b,c\n1,2,3\n4,5,6"), ("sep=,\na,b\n1,2\n", "a,b\n1,2"), ("﻿a,b\n1,2\n", "a,b\n1,2"), ("\n\na,b\n\n1,2\n\n\n3,4\n", "a,b\n1,2\n3,4"), ("a,   b,   c\n1,\t2,\t3\n", "a, b, c\n1, 2, 3"), ("﻿sep=,\n\na,   b\n\n1,\t 2\n", "a, b\n1, 2")],
)
def test_clean_files(spark, tmp_path, raw, clean):
    from tracklane.sources import files, sinks

    (tmp_path / "in put.csv").write_text(raw, encoding="utf-8")
    sinks.write_clean_files(files.clean_lines(files.lines(spark, str(tmp_path / "in put.csv"))), str(tmp_path / "out"))
    assert [r.value for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [clean]

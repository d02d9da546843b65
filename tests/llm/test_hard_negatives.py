"""Hard negatives against the SQL and against all inner products."""

import math
import os
import random
import subprocess
import sys

import numpy as np
from conftest import DATA
from pyspark.sql import functions as F

from tracklane.llm import hard_negatives as hn


def test_equals_sql(spark, same_as_sql):
    same_as_sql(hn.op11_hard_negatives(spark, f"{DATA}/sf0.001"), hn.ORACLE_SQL, f"{DATA}/sf0.001")


def plain(rows):
    good = [(i, label, v) for i, v, label in rows if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) and abs(x) < hn.LARGEST for x in v)]
    good = [(i, (lab + 1) % 10 if i % 7 == 0 else lab, [math.floor(256 * x) for x in v]) for i, lab, v in good]
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out, done = [], set()
    for i, label, v in sorted(good):
        if i % 100 or i in done:
            continue
        done.add(i)
        others = sorted(((-score(v, w), j, m) for j, m, w in good if j != i))
        for p, j, _ in [x for x in others if x[2] == label][:5]:
            near = [x for x in others if x[2] != label and -30 * p <= -100 * x[0] <= -90 * p][:10]
            out += [(i, j, k + 1, n, -p, -s) for k, (s, n, _) in enumerate(near)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id bigint, embedding array<float>, label int, id string, x string")


def found(df):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def test_odd_rows_and_ties(spark):
    rng = random.Random(2)
    near = [[rng.choice([-0.5, 0.25, 0.5]) for _ in range(6)] for _ in range(8)]
    rows = [(rng.choice([k, 100 * rng.randrange(6)]) if k % 5 else 100 * (k // 5 % 9), rng.choice(near), rng.randrange(4)) for k in range(500)]
    rows += [(200, None, 1), (300, [0.5, None, 0.1, 0.0, 0.0, 0.0], 1), (400, [float("nan")] * 6, 2), (401, [float("inf")] * 6, 2), (None, near[0], 1), (500, near[1], None), (501, [], 1), (502, [0.5], 2), (503, [1e30] * 6, 1)]
    df = frame(spark, rows)
    assert found(hn.mine(df)) == plain(rows)
    assert found(hn.mine(df.filter(F.lit(False)))) == []
    assert found(hn.mine(df.filter("vec_id % 100 <> 0"))) == []


def test_many_blocks_on_leading_components(spark, monkeypatch):
    rng = np.random.default_rng(4)
    axes = np.linalg.qr(rng.normal(size=(24, 24)))[0] * np.array([8, 4, 2, 1, *[0.1] * 20])[:, None]
    rows = [(int(i), [float(x) for x in np.float32(rng.normal(size=24) @ axes)], int(i) % 3) for i in rng.permutation(3000)]
    monkeypatch.setattr(hn, "ROWS", 128)
    monkeypatch.setattr(hn, "ANCHORS", 8)
    got = found(hn.mine(frame(spark, rows).repartition(3)))
    assert got == plain(rows) and len(got) > 1000


def test_pairs_go_early_and_none_is_lost():
    rng = np.random.default_rng(6)
    x = np.int32(rng.normal(size=(2000, 32)) * np.array([200, 100, 50, *[5] * 29]))
    axes = np.linalg.eigh((x.T @ x).astype(float))[1][:, ::-1]
    part = lambda a, low, high: hn._Block(len(a), a[:, 0].astype(np.int64).tobytes(), np.zeros(len(a), np.int64).tobytes(), a[:, 1:].astype(np.int32).tobytes(), low, high, axes, cuts)
    cuts = [4, 8, 16, 32]
    rows = np.column_stack([np.arange(2000), x])
    low, high = np.full((20, 1), -(1 << 61)).tobytes(), np.full((20, 1), 1 << 61).tobytes()
    anchors, others = part(rows[:20], low, high), part(rows, b"", b"")
    lists = hn._Lists(anchors, 1, 5)
    left = []
    real = hn._hopeful
    hn._hopeful = lambda *a: left.append(real(*a)) or left[-1]
    try:
        hn._scan(anchors, others, lists, cuts, True)
    finally:
        hn._hopeful = real
    want = [sorted((-int(np.dot(x[i].astype(np.int64), x[j])), j) for j in range(2000) if j != i)[:5] for i in range(20)]
    assert [[(-int(s), int(j)) for s, j in zip(lists.score[i, 0], lists.id[i, 0], strict=True)] for i in range(20)] == want
    assert sum(a.sum() for a in left[4::4]) < 0.2 * 20 * 2000  # of later slices, what the first four components leave


def test_several_groups_of_anchors(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(int(i) * 20, [float(x) for x in rng.choice([-0.5, 0.25, 0.5], 6)], int(i) % 3) for i in rng.permutation(600)]
    monkeypatch.setattr(hn, "ROWS", 64)
    monkeypatch.setattr(hn, "ANCHORS", 16)
    monkeypatch.setattr(hn, "GROUP", 40)
    groups = []
    monkeypatch.setattr(hn, "_groups", lambda *a, real=hn._groups: groups.append(real(*a)) or groups[-1])
    got = found(hn.mine(frame(spark, rows).repartition(3)))
    assert got == plain(rows) and len(got) > 1000
    assert [len(x) > 2 for x in groups] == [True, True] and all(a <= b < c for x in groups for (a, b), (c, _) in zip(x, x[1:], strict=False))


def test_what_the_driver_gets_does_not_grow_with_the_partitions(tmp_path):
    code = """
import random, sys
from pyspark.sql import SparkSession
from tracklane.llm import hard_negatives as hn
conf = {"spark.sql.shuffle.partitions": "400", "spark.driver.maxResultSize": "3m", "spark.ui.enabled": "false", "spark.local.dir": sys.argv[1], "spark.sql.warehouse.dir": sys.argv[1] + "/w"}
spark = SparkSession.builder.master("local[2]").config(map=conf).getOrCreate()
rng = random.Random(1)
rows = [(50 * k, [rng.gauss(0, 1) for _ in range(32)], k % 3) for k in range(2000)]
df = hn.mine(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").coalesce(1))
print(df.select("anchor_id").distinct().count())
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    said = subprocess.run([sys.executable, "-c", code, str(tmp_path)], cwd=tmp_path, env=os.environ | {"PYTHONPATH": root}, capture_output=True, text=True)
    assert said.stdout.strip() == "1000", said.stderr[-3000:]

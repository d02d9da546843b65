"""Conversation repair against a plain search over all edits."""

import functools
import hashlib
import random
import re
import sys
import zlib

from conftest import DATA
from helpers import EXTRA
from pyspark.sql import functions as F

from tracklane.llm import conversation_repair as cr

NAMES = {"u": "user", "a": "assistant"}


def plain(rows):
    """The columns of one conversation from its rows (turn, role, text, after damage), by recursion over (cost, audit)."""
    sys.setrecursionlimit(20_000)
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
    seen, faults = set(), []
    for _, role, text in rows:
        last = text.rstrip("\t\n\x0b\x0c\r ")[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    n = len(rows)
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @functools.cache
    def best(i, q, inserted):
        """(cost, audit, repaired rows) from row i on, where q is the last role's initial."""
        found = []
        if i == n and q in ("", "a"):
            found.append((0, "", ()))
        if inserted < 3:
            for r in "ua":
                if (q, r) in after:
                    c, audit, out = best(i, r, inserted + 1)
                    found.append((c + 2, "I" + audit, ((NAMES[r], ""), *out)))
        if i < n:
            _, role, text = rows[i]
            c, audit, out = best(i + 1, q, 0)
            found.append((c + 3, "D" + audit, out))
            if faults[i] not in ("blank", "duplicate"):
                extra = faults[i] == "truncated"
                if (q, role[:1]) in after:
                    c, audit, out = best(i + 1, role[:1], 0)
                    found.append((c + extra, "K" + audit, ((role, text), *out)))
                for r in "ua":
                    if (q, r) in after:
                        c, audit, out = best(i + 1, r, 0)
                        found.append((c + 2 + extra, "R" + audit, ((NAMES[r], text), *out)))
        return min(found, key=lambda x: x[:2]) if found else (10**9, "", ())

    cost, audit, out = best(0, "", 0)
    turns = {t for t, _, _ in rows if t is not None}
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    text = "\n".join(f"{r}:{t}" for r, t in out)
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit,
        hashlib.sha256(text.encode()).hexdigest(),
    )


def plain_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        here = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        how = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if how:
            text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
            here += [(turn, "user" if how == 4 else role, text)] * (2 if how == 3 else 1)
    return {conv: plain(rs) for conv, rs in out.items()}


def found(df):
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = df.collect()
    assert len({r[0] for r in got}) == len(got)
    return {r[0]: tuple(r)[1:] for r in got}


def test_equals_a_plain_search_on_the_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(cr.op13_conversation_repair(spark, f"{DATA}/sf0.01")) == plain_damage(rows)


def test_equals_a_plain_search_on_odd_conversations(spark):
    rng = random.Random(5)
    roles, texts = ["system", "user", "assistant", "tool", "", None, "User", "a"], ["Yes.", "no", "", " \n", None, "Why?\x0b", "So!", " "]
    rows = [(rng.choice([*range(40), None]), rng.choice([*range(9), None]), rng.choice(roles), rng.choice(texts)) for _ in range(400)]
    rows += [(100, t, "user", "x.") for t in range(300)] + [(101, 1, "user", "same.")] * 50
    df = spark.createDataFrame([(*r, *["x"] * len(EXTRA.split(","))) for r in rows], f"conv_id bigint, turn bigint, role string, text string, {EXTRA}")
    assert found(cr.repair(cr.damaged(df))) == plain_damage(rows)


def test_batches_cut_conversations_anywhere(spark):
    rows = [(c, t, "ua"[t % 2] + "x", f"text {t}" + "."[: t % 3]) for c in range(7) for t in range(40)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    want = plain_damage(rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert found(cr.repair(cr.damaged(df))) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_all_dropped_and_no_rows(spark):
    dropped = next(t for t in range(200) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(1, dropped, "user", "a")], "conv_id bigint, turn bigint, role string, text string")
    assert found(cr.repair(cr.damaged(df))) == {1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert found(cr.repair(cr.damaged(df.filter(F.lit(False))))) == {}


def test_the_automaton_stays_small_and_is_used_again():
    rng, r = random.Random(1), cr.Repairs()
    for _ in range(300):
        r.repair(bytes(rng.choice([0, 1, 2, 3, 4, 5, 6, 7, 8]) for _ in range(rng.randrange(60))))
    seen = len(r.vectors)
    cost, audit = r.repair(bytes([2, 4] * 100_000))
    assert (cost, audit) == (0, "K" * 200_000) and len(r.vectors) == seen < 100

"""Conversation structure repair by a lazily determinised weighted automaton.

A repair keeps, renames, deletes and inserts messages until the roles' initials read (s?(ua)+)?. Its cost is a shortest
path over four states (nothing yet, after s, after u, after a). Read from the last row to the first, the least costs to
go from the four states are a vector; less its least part it is one of a small number of vectors, and those are the states
of a deterministic automaton over ten kinds of rows. Its transitions and their weights are made when they are first met and
kept in a table, so that a conversation's cost is one scan of table look-ups. The trace goes back against the scan, from
the first row to the last, along arcs that are tight (arc + cost to go = cost here); at each step the least letter is the
least audit, since a letter leads to one state only.

Two shuffles. The first holds no texts: the kinds of a conversation's rows pass in order through one task, which keeps
three bytes a row, no more than the audit, one value of the result, has itself. The second takes whole texts: a
conversation's audit comes first, then its rows in order, and the repaired text is hashed as they pass; nothing of it is
held. The hash is one of a sequence, so a conversation's rows pass through one task by its definition; what finds faults
(which rows came before, what is blank or cut off) is spread over all tasks whatever a conversation's size.

Edge cases. Null role and text are one space each (such a text is blank), a null id or turn is one space in the damage's
key. A null conv_id is a conversation like any other. Null turns come first; rows of one turn are taken by role, then by
MD5 of role and text (equal rows next to each other, all but the first duplicates). The initial of an empty role is none
of s, u, a; initials are case-sensitive. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklane.llm import common

#: Costs of the edits, and of leaving a row that is cut off.
KEEP, RENAME, DELETE, INSERT, CUT_OFF = 0, 2, 3, 2, 1
#: Roles by code: s, u, a, any other. A row's kind is twice its role's code, one more where it is cut off.
INITIALS = "sua"
#: Kind of a row that must go, and of a row that the damage dropped, which only shows that its conversation exists.
GONE, DROPPED = 8, 9
#: State after a row of role s, u, a; None where the pattern does not allow it. States: 0 nothing yet, 1 s, 2 u, 3 a.
_AFTER = ((1, None, None, None), (2, 2, None, 2), (None, None, 3, None), (None, None, None, None))
#: State after the one role that an inserted or renamed row can have there, and that role.
_NEXT, _ROLE = (2, 2, 3, 2), ("user", "user", "assistant", "user")


class Repairs:
    """The automaton, made as it is used. State 0 is the end of a conversation."""

    def __init__(self):
        self.vectors: list[tuple[int, ...]] = []
        self.number: dict[tuple[int, ...], int] = {}
        self.table: list[list[tuple[int, int] | None]] = []
        self.traced: dict[tuple[int, int, int], tuple[str, int]] = {}
        self._state(self._inserted((0, None, None, 0)))

    def _state(self, vector: tuple[int, ...]) -> int:
        if vector not in self.number:
            self.number[vector] = len(self.vectors)
            self.vectors.append(vector)
            self.table.append([None] * DROPPED)
        return self.number[vector]

    @staticmethod
    def _inserted(costs: tuple[int | None, ...]) -> tuple[int, ...]:
        """The costs where rows may be inserted first."""
        out = [1 << 30 if c is None else c for c in costs]
        for _ in range(3):
            out = [min(c, INSERT + out[_NEXT[q]]) for q, c in enumerate(out)]
        return tuple(out)

    def _arcs(self, after: int, kind: int, q: int) -> list[tuple[str, int, int]]:
        """(letter, cost to the end, next state) of the arcs that consume a row of `kind` in q; `after`: the scan's state behind it."""
        togo = self.vectors[after]
        arcs = [("D", DELETE + togo[q], q)]
        if kind != GONE:
            role, cut = divmod(kind, 2)
            if (to := _AFTER[role][q]) is not None:
                arcs.append(("K", KEEP + CUT_OFF * cut + togo[to], to))
            arcs.append(("R", RENAME + CUT_OFF * cut + togo[_NEXT[q]], _NEXT[q]))
        return arcs

    def _costs(self, after: int, kind: int) -> tuple[int, ...]:
        return self._inserted(tuple(min(c for _, c, _ in self._arcs(after, kind, q)) for q in range(4)))

    def step(self, after: int, kind: int) -> tuple[int, int]:
        """The scan's state before a row of `kind`, and the weight of that transition."""
        found = self.table[after][kind]
        if found is None:
            costs = self._costs(after, kind)
            least = min(costs)
            found = self.table[after][kind] = (self._state(tuple(c - least for c in costs)), least)
        return found

    def _tight(self, after: int, kind: int, q: int) -> tuple[str, int]:
        """The least letters up to and with that of the row, and the state behind it."""
        key = (after, kind, q)
        if key not in self.traced:
            costs, letters = self._costs(after, kind), ""
            while True:
                arcs = [*self._arcs(after, kind, q), ("I", INSERT + costs[_NEXT[q]], _NEXT[q])]
                letter, _, q = min(a for a in arcs if a[1] == costs[q])
                letters += letter
                if letter != "I":
                    break
            self.traced[key] = (letters, q)
        return self.traced[key]

    def repair(self, kinds: bytes) -> tuple[int, str]:
        """(cost, audit) of a conversation of rows of such kinds."""
        states, now, cost = np.zeros(len(kinds), np.uint16), 0, 0
        for i in range(len(kinds) - 1, -1, -1):
            states[i] = now
            now, weight = self.step(now, kinds[i])
            cost += weight
        cost += self.vectors[now][0]
        q, audit = 0, []
        for after, kind in zip(states.tolist(), kinds, strict=True):
            letters, q = self._tight(after, kind, q)
            audit.append(letters)
        return cost, "".join(audit) + {0: "", 1: "II", 2: "I", 3: ""}[q]


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, dropped) of the rows of `conversations`, damaged by the checksum of their id and turn."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = conversations.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("how"),
    )
    text = F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.explode(F.when(F.col("how") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    out = rows.select("conv_id", "turn", F.when(F.col("how") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("how") == 0).alias("dropped"), times.alias("_copy"))
    return out.drop("_copy")


def digest(role: Column, text: Column) -> Column:
    """What rows of equal role and text share."""
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))


def _turn() -> Column:
    return F.struct(F.col("turn").isNotNull().alias("there"), "turn")


def with_kinds(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, mark, kind) of rows (conv_id, turn, role, text, dropped); a repeat in the same turn is not yet marked."""
    text, initial = F.col("text"), F.substring("role", 1, 1)
    last = F.substring(F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", "     ")), -1, 1)
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    blank, cut = ~text.rlike(r"[^\x20\x09-\x0D]"), ~last.isin(".", "!", "?")
    thin = rows.select(
        "conv_id", "turn", "role", digest(F.col("role"), text).alias("mark"), blank.alias("blank"), code.cast("int").alias("role_code"),
        F.when(F.col("dropped"), DROPPED).when(blank, GONE).otherwise(2 * code + cut.cast("int")).cast("int").alias("kind"),
    )
    # Only of repeated messages must be known when they came first; partial minimums before the shuffle.
    first = thin.filter((F.col("kind") < GONE)).groupBy("conv_id", "mark").agg(F.count("*").alias("n"), F.min(_turn()).alias("first")).filter("n > 1")
    first = first.select(F.col("conv_id").alias("_c"), F.col("mark").alias("_m"), "first")
    out = thin.join(first, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("mark") == F.col("_m")) & (F.col("kind") < GONE), "left")
    later = F.coalesce(_turn() > F.col("first"), F.lit(False))
    return out.select("conv_id", "turn", "role", "mark", "role_code", "blank", later.alias("again"), "kind")


_FOUND = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def _ordered(rows: DataFrame, *first: str) -> DataFrame:
    """Each conversation's rows in one partition, in order."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *first, F.asc_nulls_first("turn"), "role", "mark")


class _Conversation:
    """What the scan keeps of the conversation that is passing."""

    def __init__(self, id_):
        self.id, self.kinds, self.low, self.high, self.turns = id_, bytearray(), None, None, 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.last = None

    def add(self, turn, mark, code, blank, again, kind) -> None:
        if kind == DROPPED:
            return
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        if self.last is not None and (self.last[2], code) not in ((0, 1), (1, 2), (2, 1)):
            self.illegal += 1
        if blank:
            self.blank += 1
        elif again or self.last is not None and self.last[:2] == (turn, mark):
            self.duplicate += 1
            kind = GONE
        else:
            self.truncated += kind & 1
        self.last = (turn, mark, code)
        self.kinds.append(kind)

    def found(self, repairs: Repairs) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (self.id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, *repairs.repair(bytes(self.kinds)))


def audits(kinds: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of rows as with_kinds gives them."""
    kind_of_id = kinds.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairs, now, done = Repairs(), None, []
        schema = None
        for batch in batches:
            schema = schema or pa.schema([batch.schema.field("conv_id"), *[pa.field(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], pa.field("audit", pa.string())])
            for id_, *row in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "turn", "mark", "role_code", "blank", "again", "kind")], strict=True):
                if now is None or id_ != now.id:
                    if now is not None:
                        done.append(now.found(repairs))
                    now = _Conversation(id_)
                now.add(*row)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*done, strict=True), schema, strict=True)], schema=schema)
                done = []
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(now.found(repairs), schema, strict=True)], schema=schema)

    return _ordered(kinds).mapInArrow(run, f"conv_id {kind_of_id}, {_FOUND}")


class _Repaired:
    """The hash of a repaired conversation, whose rows pass in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.q, self.hash, self.any = audit, 0, 0, hashlib.sha256(), False

    def _say(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
        self.any = True

    def _insert(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._say(_ROLE[self.q], "")
            self.q, self.at = _NEXT[self.q], self.at + 1

    def add(self, role: str, text: str) -> None:
        self._insert()
        letter, self.at = self.audit[self.at], self.at + 1
        if letter == "K":
            self._say(role, text)
            self.q = _AFTER[INITIALS.index(role[0])][self.q]
        elif letter == "R":
            self._say(_ROLE[self.q], text)
            self.q = _NEXT[self.q]

    def hex(self) -> str:
        self._insert()
        return self.hash.hexdigest()


def repair(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of rows as `damaged` gives them.

    A conversation all of whose rows are dropped has zeros, an empty audit and the hash of nothing.
    """
    found = common.cut(audits(with_kinds(rows)))
    none = lambda kind: F.lit(None).cast(kind)
    names = [c for c in found.columns if c != "conv_id"]
    heads = found.select("conv_id", F.lit(0).alias("step"), none("bigint").alias("turn"), none("string").alias("role"), none("binary").alias("mark"), none("string").alias("text"), F.struct(*names).alias("found"))
    texts = rows.filter(~F.col("dropped")).select("conv_id", F.lit(1).alias("step"), "turn", "role", digest(F.col("role"), F.col("text")).alias("mark"), "text", none(found.select(F.struct(*names)).schema[0].dataType).alias("found"))
    kind_of_id = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, last = None, None
        for batch in batches:
            ids, done = batch.column("conv_id"), []
            for i, (found_here, role, text) in enumerate(zip(batch.column("found").to_pylist(), batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True)):
                if found_here is not None:
                    if now is not None:
                        done.append((*last, now.hex()))
                    last, now = (ids[i].as_py(), *(found_here[c] for c in names)), _Repaired(found_here["audit"])
                else:
                    now.add(role, text)
            if done:
                yield _table(done, ids.type)
        if now is not None:
            yield _table([(*last, now.hex())], ids.type)

    def _table(rows_: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        types = [id_type, *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows_, strict=True), types, strict=True)], names=["conv_id", *names, "repaired_sha256"])

    return _ordered(heads.union(texts), "step").mapInArrow(run, f"conv_id {kind_of_id}, {_FOUND}, repaired_sha256 string")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(common.table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")))

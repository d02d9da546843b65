"""Secret scan: fixed patterns, and formats that are learned from labelled credentials.

The base kinds are regular expressions. Their finds in a bounded sample of documents are the labelled credentials: each
kind's strings with their counts, as character classes, make a prefix tree whose statistically compatible states are
merged (Hoeffding bound) into a probabilistic automaton; runs of credential characters that no base kind covers make the
background's. Then every run of MIN_VALUE or more such characters in every document is
scored, whatever the lengths of the labelled ones: it is a secret where some kind's automaton likes it far better than the background's does, and about as well as
that kind's own credentials. A secret run that a base span holds whole is not named again; the others are added as spans
of the kind "format".

Only the learning has bounds: MAX_DOCUMENTS documents, MAX_STRINGS strings of a kind, MAX_BACKGROUND background runs, and
of strings longer than MAX_LENGTH characters (as in very long texts without a gap) none is learned from; they are scored
like all others. Null and empty texts have no spans. Repeated rows give repeated rows. Without labelled credentials
nothing is added to the base spans. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from math import log, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklane.llm import common

#: Documents, about, whose base finds are the labelled credentials; strings that an automaton learns from, and their length.
MAX_DOCUMENTS, MAX_STRINGS, MAX_BACKGROUND, MAX_LENGTH = 20_000, 400, 4_000, 256
ALPHA, UNSEEN, MARGIN, SLACK = 0.05, 1e-5, 6.0, 0.25
KINDS = ("assign", "access", "hex", "format")
#: Fixed patterns of the query's contract.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24
LONG_HEX = re.compile(r"[0-9a-f]{%d,}" % MIN_HEX)  # the same finds: a run is maximal either way
RUN = re.compile(r"[A-Za-z0-9+/_.=-]+")
GAP = r"[^A-Za-z0-9+/_.=-]+"
#: Texts without a match (RE2) have no assignment.
MAY_ASSIGN = r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"
#: Classes of credential characters, and the end.
SYMBOLS = 12
#: Distinct shapes of runs whose scores a worker remembers.
CACHE_SHAPES = 500_000


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, end, kind number, value) of the base kinds; each kind leftmost and non-overlapping."""
    out = [(m.start(), m.end(), 0, m.group(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= MIN_VALUE]
    out += [(m.start(), m.end(), 1, m.group()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    return out + [(m.start(), m.end(), 2, m.group()) for m in LONG_HEX.finditer(text)]


def free_runs(text: str, base: list[tuple[int, int, int, str]]) -> Iterator[tuple[int, int, str, bool]]:
    """Runs of credential characters (start, end, run, whether it is apart from all base spans) that no base span holds whole."""
    taken = sorted((a, b) for a, b, _, _ in base)
    for m in RUN.finditer(text):
        a, b = m.span()
        if b - a >= MIN_VALUE:
            near = [(x, y) for x, y in taken if x < b and y > a] if taken else []
            if not any(x <= a and b <= y for x, y in near):
                yield a, b, m.group(), not near


_CLASS = str.maketrans({c: k for k, chars in {"d": "0123456789", "h": "abcdef", "l": "ghijklmnopqrstuvwxyz", "H": "ABCDEF", "U": "GHIJKLMNOPQRSTUVWXYZ"}.items() for c in chars})


class Automaton:
    """A prefix tree of class strings whose compatible states are merged, first found first."""

    def __init__(self, strings: Mapping[str, int] | Sequence[str], alpha: float = ALPHA):
        counts = strings if isinstance(strings, Mapping) else Counter(strings)
        self.go: list[dict[str, int]] = [{}]
        self.seen: list[dict[str, int]] = [{}]
        self.ends: list[int] = [0]
        for s, n in counts.items():
            at = 0
            for c in s.translate(_CLASS):
                self.seen[at][c] = self.seen[at].get(c, 0) + n
                if c not in self.go[at]:
                    self.go[at][c] = len(self.go)
                    self.go.append({})
                    self.seen.append({})
                    self.ends.append(0)
                at = self.go[at][c]
            self.ends[at] += n
        self.bound = sqrt(0.5 * log(2 / alpha))
        self._merge_states()
        floor = [self.score(s) / (len(s) + 1) for s in counts]
        #: Per symbol, what all but the oddest twentieth of the strings reach.
        self.usual = sorted(floor)[len(floor) // 20] if floor else 0.0

    def _total(self, q: int) -> int:
        return self.ends[q] + sum(self.seen[q].values())

    def _alike(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            m, n = self._total(a), self._total(b)
            far = self.bound * (1 / sqrt(m or 1) + 1 / sqrt(n or 1))
            if abs(self.ends[a] / (m or 1) - self.ends[b] / (n or 1)) > far:
                return False
            for c in self.go[a].keys() | self.go[b].keys():
                if abs(self.seen[a].get(c, 0) / (m or 1) - self.seen[b].get(c, 0) / (n or 1)) > far:
                    return False
                if c in self.go[a] and c in self.go[b] and self.go[a][c] != self.go[b][c]:
                    todo.append((self.go[a][c], self.go[b][c]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the subtree b to state a."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.ends[a] += self.ends[b]
            for c, n in self.seen[b].items():
                self.seen[a][c] = self.seen[a].get(c, 0) + n
                if c in self.go[a]:
                    todo.append((self.go[a][c], self.go[b][c]))
                else:
                    self.go[a][c] = self.go[b][c]

    def _merge_states(self) -> None:
        red, known = [0], {0}
        while True:
            fringe = next(((q, c, t) for q in red for c, t in sorted(self.go[q].items()) if t not in known), None)
            if fringe is None:
                break
            q, c, t = fringe
            for r in red:
                if self._alike(r, t):
                    self.go[q][c] = r
                    self._fold(r, t)
                    break
            else:
                red.append(t)
                known.add(t)
        number = {q: k for k, q in enumerate(red)}
        self.go = [{c: number[t] for c, t in self.go[q].items()} for q in red]
        self.seen, self.ends = [self.seen[q] for q in red], [self.ends[q] for q in red]
        self.logs = [{c: log(n / self._total(q)) for c, n in self.seen[q].items()} for q in range(len(red))]
        self.log_end = [log(max(UNSEEN, self.ends[q] / (self._total(q) or 1))) for q in range(len(red))]

    def score(self, s: str) -> float:
        """Log likelihood of the string's format; a step that no labelled string took costs UNSEEN and stays."""
        at, total = 0, 0.0
        for c in s.translate(_CLASS):
            total += self.logs[at].get(c, log(UNSEEN))
            at = self.go[at].get(c, at)
        return total + self.log_end[at]


class Formats:
    """The kinds' automata and the background's."""

    def __init__(self, strings: Mapping[str, Mapping[str, int] | Sequence[str]], background: Mapping[str, int] | Sequence[str]):
        self.kinds = [Automaton(s) for _, s in sorted(strings.items()) if s]
        self.background = Automaton(background)
        self.known: dict[str, bool] = {}

    def likes(self, run: str) -> bool:
        if not self.kinds:
            return False
        shape = run.translate(_CLASS)
        if shape not in self.known:
            if len(self.known) >= CACHE_SHAPES:
                self.known.clear()
            n = len(run) + 1
            # A run that is like none of the background's is at least one of any characters.
            usual = max(self.background.score(run), -n * log(SYMBOLS))
            scores = [(a.score(run), a.usual) for a in self.kinds]
            self.known[shape] = any(s - usual > MARGIN and s / n >= floor - SLACK for s, floor in scores)
        return self.known[shape]


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: Counter[tuple[str, str]] = Counter()
        for t in batch.column("t").to_pylist():
            base = base_spans(t or "")
            found.update((KINDS[k], v) for _, _, k, v in base)
            found.update(("background", s) for _, _, s, apart in free_runs(t or "", base) if apart)
        rows = [(k, v, n) for (k, v), n in found.items() if len(v) <= MAX_LENGTH]
        kinds, values, counts = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(values, pa.string()), pa.array(counts, pa.int64())], names=["kind", "value", "n"])


def learn(df: DataFrame, max_documents: int = MAX_DOCUMENTS, max_strings: int = MAX_STRINGS, max_background: int = MAX_BACKGROUND, text_col: str = "text") -> Formats:
    """Automata from the base finds, with their counts, in about `max_documents` documents.

    At most `max_strings` strings of a kind and `max_background` background runs come to the driver.
    """
    n = df.count()
    some = df.select(df[text_col].alias("t")).filter(F.pmod(F.xxhash64("t"), F.lit(1_000_000)) < int(1e6 * min(1, max_documents / max(n, 1))))
    found = common.cut(some.mapInArrow(_strings, "kind string, value string, n bigint").groupBy("kind", "value").agg(F.sum("n").alias("n")))
    bound = {**dict.fromkeys(KINDS[:3], max_strings), "background": max_background}
    got = {k: {r.value: r.n for r in found.filter(F.col("kind") == k).orderBy(F.xxhash64("value"), "value").limit(m).collect()} for k, m in bound.items()}
    common.discard(found)
    return Formats({k: v for k, v in got.items() if k != "background"}, got["background"])


def liked_texts(texts: pa.Array, formats: Formats) -> tuple[np.ndarray, np.ndarray]:
    """Which texts hold a run that some format likes, and which hold one long enough for the base kinds; each distinct run is scored once."""
    lists = pc.split_pattern_regex(pc.fill_null(texts, ""), GAP)
    runs, at = lists.flatten(), np.asarray(lists.offsets, dtype=np.int64)
    at = at - at[0]
    size = pc.binary_length(runs).to_numpy(zero_copy_only=False)
    enough = size >= MIN_VALUE
    coded = runs.filter(pa.array(enough)).dictionary_encode()
    liked = np.fromiter(map(formats.likes, coded.dictionary.to_pylist()), bool, len(coded.dictionary))
    good = np.zeros(len(size), np.int64)
    good[enough] = liked[coded.indices.to_numpy(zero_copy_only=False)]
    return common.sums(good, at) > 0, common.sums(size >= MIN_ACCESS, at) > 0


def scan(df: DataFrame, formats: Formats, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans array<struct<kind, start, end>>) by start, then kind as in KINDS; one narrow stage."""
    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, "t"):
                texts = part.column("t")
                liked, long = liked_texts(texts, formats)
                assign = pc.fill_null(pc.match_substring_regex(texts, MAY_ASSIGN), False).to_numpy(zero_copy_only=False)
                out: list[list[dict]] = [[] for _ in range(part.num_rows)]
                for k in np.flatnonzero(assign | long | liked).tolist():
                    t = texts[k].as_py()
                    base = base_spans(t)
                    spans = [(a, n, b) for a, b, n, _ in base]
                    if liked[k]:
                        spans += [(a, 3, b) for a, b, s, _ in free_runs(t, base) if formats.likes(s)]
                    out[k] = [{"kind": KINDS[n], "start": a, "end": b} for a, n, b in sorted(spans)]
                yield pa.RecordBatch.from_arrays([part.column("i"), pa.array(out, pa.list_(kind))], names=[id_col, "spans"])

    schema = f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, spans array<struct<kind: string, start: int, end: int>>"
    return df.select(df[id_col].alias("i"), df[text_col].alias("t")).mapInArrow(run, schema)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents", "doc_id", "text")
    s = F.col("spans")
    of = lambda k: F.size(F.filter(s, lambda x: x["kind"] == k)).cast("bigint").alias(f"n_{k}")
    text = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter(s, lambda x: x["kind"] != "format")
    return scan(docs, learn(docs)).select("doc_id", of("assign"), of("access"), of("hex"), F.sha2(text(base), 256).alias("base_sha256"), text(s).alias("spans"), of("format"))


def digest(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()

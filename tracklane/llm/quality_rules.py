"""Quality rules: text statistics in Spark expressions, and a learned decision list over them.

Sequential covering: one rule at a time, a conjunction of `feature >= t` / `feature < t` literals is grown by
information gain on two thirds of the labelled rows and pruned on the rest; rows it covers leave, and the next rule is
learned from what remains. The rules that stand become an ordered `CASE WHEN` that Spark evaluates next to the
statistics. Only counts by (feature, bin, label) reach the driver.

Null and empty texts have no words, so they fail the base rule. A document labelled twice counts once, by its lowest
label; null labels and ids count for nothing. Without labelled rows no rule is learned and the base rule alone decides.
Each row of the input is judged by its own text, repeated rows alike.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklane.llm import common
from tracklane.llm.common import let

#: Labelled rows that the decision list is fitted on, about, whatever the corpus's size.
MAX_LABELLED = 20_000
MAX_RULES, MAX_LITERALS, MIN_PRECISION, MIN_SHARE = 8, 3, 0.9, 0.002
PERCENTILES = [0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.85, 0.9, 0.93, 0.95, 0.97, 0.98, 0.99, 0.995]


def _repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more.

    Each window is one long: its hash with the window's place in the low bits. After a sort, equal windows are
    neighbours; the words themselves are compared, so unequal windows never count.
    """

    def of(w: Column) -> Column:
        bits = F.length(F.bin(F.size(w)))
        low = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1
        window = lambda i: F.call_function("shiftleft", F.xxhash64(w[i], w[i + 1], w[i + 2]), bits).bitwiseOR(i.cast("bigint"))
        place = lambda x: x.bitwiseAND(low).cast("int")
        same = lambda x, y: (
            (F.call_function("shiftright", x, bits) == F.call_function("shiftright", y, bits))
            & (w[place(x)] == w[place(y)]) & (w[place(x) + 1] == w[place(y) + 1]) & (w[place(x) + 2] == w[place(y) + 2])
        )
        found = let(
            F.array_sort(F.transform(F.sequence(F.lit(0), F.size(w) - 3), window)),
            lambda s: F.filter(s, lambda x, i: (same(x, F.get(s, i - 1)) & (i > 0)) | F.coalesce(same(x, F.get(s, i + 1)), F.lit(False))),
        )
        places = F.array_sort(F.transform(found, place))
        return let(places, lambda p: F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))), F.lit(0), lambda a, x: a + x))

    return let(words, lambda w: F.when(F.size(w) >= 4, of(w)).otherwise(0))


def base_stats(text: Column) -> Column:
    """Struct of the contract's statistics and what the features need besides, of one whole text (null: empty)."""

    def of(t: Column) -> Column:
        words = F.filter(F.split(t, common.GAP), lambda w: w != "")
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(common.WORD))
        gone = lambda chars: (F.length(t) - F.length(F.regexp_replace(t, f"[{chars}]+", ""))).cast("bigint")
        return F.struct(
            let(words, lambda w: F.struct(F.size(w).cast("bigint").alias("n_words"), F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"), _repeat_words(w).cast("bigint").alias("n_repeat_words"))).alias("w"),
            gone("#*$%&|<>").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
            gone("A-Z").alias("n_upper"),
            gone("!?").alias("n_bangs"),
            gone("0-9").alias("n_digits"),
        )

    s = let(F.coalesce(text, F.lit("")), of)
    return let(
        s,
        lambda s: F.struct(
            s["w"]["n_words"].alias("n_words"), s["w"]["word_chars"].alias("word_chars"), s["n_symbols"].alias("n_symbols"), s["n_dup_lines"].alias("n_dup_lines"),
            s["w"]["n_repeat_words"].alias("n_repeat_words"), s["n_upper"].alias("n_upper"), s["n_bangs"].alias("n_bangs"), s["n_digits"].alias("n_digits"),
        ),
    )


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


def features(s: Column) -> dict[str, Column]:
    words = F.greatest(s["n_words"], F.lit(1))
    share = {k: s[v] / words for k, v in {"symbols_per_word": "n_symbols", "chars_per_word": "word_chars", "repeat_share": "n_repeat_words", "dup_lines_per_word": "n_dup_lines", "bangs_per_word": "n_bangs", "digits_per_word": "n_digits"}.items()}
    return share | {"upper_share": s["n_upper"] / F.greatest(s["word_chars"], F.lit(1)), "n_words": s["n_words"].cast("double")}


@dataclass(frozen=True)
class Literal:
    feature: str
    at_least: bool
    threshold: float

    def holds(self, values: dict[str, Column]) -> Column:
        x = values[self.feature]
        return (x >= self.threshold) if self.at_least else (x < self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


@dataclass(frozen=True)
class DecisionList:
    """Ordered rejecting rules; what none of them covers is kept."""

    rules: tuple[tuple[Literal, ...], ...] = ()

    def rule(self, s: Column) -> Column:
        """The first rule that covers the row, as text; null if none does."""
        values, out = features(s), None
        for r in self.rules:
            hit = _all([x.holds(values) for x in r])
            name = " and ".join(map(str, r))
            out = F.when(hit, name) if out is None else out.when(hit, name)
        return F.lit(None).cast("string") if out is None else out


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def learn(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DecisionList:
    """Fit the list on about `max_labelled` labelled documents, drawn by the hash of their ids (0 is bad, else good)."""
    known = labels.select(F.col(id_col).alias("i"), (F.col(label_col) == 0).alias("bad")).dropna().groupBy("i").agg(F.max("bad").alias("bad"))
    n = known.count()
    if not n:
        return DecisionList()
    known = known.filter(F.pmod(F.xxhash64("i", F.lit(11)), F.lit(1_000_000)) < int(1e6 * min(1, max_labelled / n)))
    # The sample is bounded by max_labelled, so every executor may hold it.
    sample = docs.select(docs[id_col].alias("i"), docs[text_col].alias("t")).join(F.broadcast(known), "i").select("i", "bad", base_stats(F.col("t")).alias("s"))
    names = list(features(F.col("s")))
    sample = common.cut(sample.select("i", "bad", *[v.alias(k) for k, v in features(F.col("s")).items()]).coalesce(8))
    at = sample.agg(*[F.percentile(k, PERCENTILES).alias(k) for k in names]).first()
    cuts = {k: sorted(set(at[k] or ())) for k in names}
    bins = [_bin(k, cuts[k]).alias(k) for k in names]
    rows = common.cut(sample.select("bad", (F.pmod(F.xxhash64("i", F.lit(5)), F.lit(3)) < 2).alias("grow"), *bins))
    total = sample.count()
    common.discard(sample)

    binned = lambda lits: _all([(F.col(k) > b) if up else (F.col(k) <= b) for k, up, b in lits])
    rules: list[list[tuple[str, bool, int]]] = []
    while len(rules) < MAX_RULES:
        left = rows.filter(~F.coalesce(_any([binned(r) for r in rules]), F.lit(False)))
        rule = _grow(left.filter("grow"), names, cuts, binned)
        rule, right, wrong = _prune(left.filter("not grow"), rule, binned)
        if not rule or right < max(2, MIN_SHARE * total / 3) or right < MIN_PRECISION * (right + wrong):
            break
        rules.append(rule)
    common.discard(rows)
    return DecisionList(tuple(tuple(Literal(k, up, cuts[k][b]) for k, up, b in r) for r in rules))


def _bin(name: str, cuts: list[float]) -> Column:
    """How many of the ascending cuts the value reaches."""
    if not cuts:
        return F.lit(0)
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda t: F.col(name) >= t))


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def _grow(rows: DataFrame, names: list[str], cuts: dict, binned) -> list[tuple[str, bool, int]]:
    """Add the literal of most information gain until no bad row's neighbour is good, or none gains."""
    rule: list[tuple[str, bool, int]] = []
    while len(rule) < MAX_LITERALS:
        # One row for each (feature, bin): bounded by the features and percentiles, not by the rows.
        counts = (
            rows.filter(binned(rule)).select("bad", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(k).alias("b")) for k in names])).alias("x"))
            .groupBy("x.k", "x.b").agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).collect()
        )
        by = {(r.k, r.b): (r.p, r.n) for r in counts}
        p0, n0 = (sum(v[j] for (k, _), v in by.items() if k == names[0]) for j in (0, 1))
        if not p0 or not n0:
            break
        best, gain = None, 1e-9
        for k in names:
            for b in range(len(cuts[k])):
                up = [sum(by.get((k, x), (0, 0))[j] for x in range(b + 1, len(cuts[k]) + 1)) for j in (0, 1)]
                for at_least, p, n in ((True, *up), (False, p0 - up[0], n0 - up[1])):
                    if p and (g := p * (log2(p / (p + n)) - log2(p0 / (p0 + n0)))) > gain:
                        best, gain = (k, at_least, b), g
        if best is None:
            break
        rule.append(best)
    return rule


def _prune(rows: DataFrame, rule: list, binned) -> tuple[list, int, int]:
    """Drop final literals while (bad - good) / (bad + good) on the held-back rows doesn't fall; with its counts."""
    if not rule:
        return [], 0, 0
    heads = [rule[:k] for k in range(1, len(rule) + 1)]
    got = rows.agg(*[F.count_if(binned(h) & (F.col("bad") == bad)).alias(f"{k}{bad}") for k, h in enumerate(heads) for bad in (True, False)]).first()
    scored = [((got[2 * k] - got[2 * k + 1]) / max(1, got[2 * k] + got[2 * k + 1]), -len(h), h, got[2 * k], got[2 * k + 1]) for k, h in enumerate(heads)]
    return max(scored, key=lambda x: x[:2])[2:]


def judge(docs: DataFrame, rules: DecisionList, text_col: str = "text") -> DataFrame:
    """(doc, quality): each row of `docs` as a struct, and the statistics, base_failed, kept, and the rule that rejects it."""
    s = F.col("s")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")).withColumn("s", base_stats(F.col("doc")[text_col])).withColumn("rule", rules.rule(s))
    return rows.select("doc", F.struct("s.*", base_failed(s).alias("base_failed"), (~base_failed(s) & F.col("rule").isNull()).alias("kept"), "rule").alias("quality"))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents", "doc_id", "text")
    rules = learn(docs, common.table(spark, sf_dir, "labels", "doc_id", "quality"))
    q = F.col("quality")
    return judge(docs, rules).select("doc.doc_id", *[q[k].alias(k) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")])

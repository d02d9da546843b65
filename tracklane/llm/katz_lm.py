"""A bigram language model with Katz backoff that scores every document.

P(w | h) is the Good-Turing discounted d(c) c(h, w) / c(h) of a bigram seen in training (counts above K are trusted), else
alpha(h) P(w), with alpha(h) such that the probabilities after h sum to exactly 1 over the training words, the end and
one class for all unknown words. P(w) is discounted the same way; what it frees is the unknown class's. After an unseen
history P(w | h) = P(w). Where nothing is freed (no count up to K), the denominator is one more, and that one is freed.

Texts are read once into blocks of about BLOCK tokens (a table in the shared folder), each with its own small vocabulary.
A block sends its distinct words, with training counts, to hash buckets, and gets corpus counts and numbers back; then
its distinct bigrams likewise, to the bucket of their history. Only distinct items of a block travel, so a frequent word
weighs no more than the number of blocks, and bigrams of the most frequent histories are dealt by both words, their
backoff sums being joined from all buckets. Nothing that grows with the corpus reaches the driver or is broadcast.

Words and bigrams are compared by 64-bit hashes of the words. Null and empty texts are the end alone. A null id is hashed
as an empty text and so is in training. Repeated rows count and are scored each. Without any training document all words
are unknown: N and V are 0 and the score is 0 (the unknown class has all the probability). An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklane.llm import common

K = 5
BLOCK = 2_000_000
#: Distinct items that a bucket gets on average, and how many buckets' worth of tokens make a history frequent.
PER_BUCKET, FREQUENT = 400_000, 0.25
FOLDS, HELD_OUT = 7, 2
#: No word has a space in it.
END, BEGIN_NUMBER = xxhash.xxh64_intdigest(b" end", 42), 0
#: All rows that travel: kind 0 a block, 1 its words' answers, 2 a block's bigrams in a bucket, 3 their answers,
#: 4 a bucket's counts of counts, 5 its part of a frequent history's sums, 6 a block's wish for these, 7 the answer.
ROW = "block bigint, kind int, k bigint, a binary, b binary, c binary, d binary, v array<double>"
_ARROW = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("k", pa.int64()), *[(x, pa.binary()) for x in "abcd"], ("v", pa.list_(pa.float64()))])


def packed(x: np.ndarray) -> bytes:
    """int64 or float64 values as compressed bytes, the values' first bytes first: small numbers take few."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).tobytes()) if len(x) else b""


def unpacked(raw: bytes | None, kind=np.int64) -> np.ndarray:
    if not raw:
        return np.empty(0, kind)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(kind)[:, 0]


def _rows(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist([{k: None for k in _ARROW.names} | r for r in rows], schema=_ARROW)


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(8)


def _by_bucket(bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by bucket, the buckets that occur, and their ranges in that order."""
    order = np.argsort(bucket, kind="stable")
    own, first = np.unique(bucket[order], return_index=True)
    return order, own, np.append(first, len(bucket))


def is_held_out(ids: list) -> np.ndarray:
    return np.array([zlib.crc32(b"" if i is None else str(i).encode()) % FOLDS == HELD_OUT for i in ids], bool)


def blocks(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Kind 0: a tokens as places in b, the block's words by falling frequency; c document sizes and folds; d ids; v tallies."""

    def block(number: int, tokens: list, sizes: list, ids: list) -> pa.Table:
        h, size = np.concatenate(tokens), np.concatenate(sizes)
        ids = pa.chunked_array(ids).combine_chunks()
        held = is_held_out(ids.to_pylist())
        words, at, n = np.unique(h, return_inverse=True, return_counts=True)
        falling = np.argsort(-n, kind="stable")
        place = np.empty(len(words), np.int64)
        place[falling] = np.arange(len(words))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, pa.schema([("id", ids.type)])) as out:
            out.write_batch(pa.RecordBatch.from_arrays([ids], names=["id"]))
        return _rows([{"block": number, "kind": 0, "a": packed(place[at]), "b": packed(words[falling].view(np.int64)), "c": packed(size * 2 + held), "d": sink.getvalue().to_pybytes(), "v": [float((~held).sum()), float(size[~held].sum()), float(len(words)), float(len(h))]}])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, have = TaskContext.get().partitionId() << 32, 0
        tokens, sizes, ids = [], [], []
        for batch in batches:
            for part in common.slices(batch, "t"):
                words, at = common.split_words(part.column("t"), lower=True)
                coded = words.dictionary_encode()
                own = np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in coded.dictionary.cast(pa.binary()).to_pylist()), np.uint64, len(coded.dictionary))
                h = own[coded.indices.to_numpy(zero_copy_only=False)] if len(words) else np.empty(0, np.uint64)
                tokens.append(np.insert(h, at[1:], np.uint64(END)))
                sizes.append(np.diff(at) + 1)
                ids.append(part.column("i"))
                have += len(tokens[-1])
                if have >= BLOCK:
                    yield from block(number, tokens, sizes, ids).to_batches()
                    number, have, tokens, sizes, ids = number + 1, 0, [], [], []
        if have:
            yield from block(number, tokens, sizes, ids).to_batches()

    return common.cut(df.select(df[id_col].alias("i"), df[text_col].alias("t")).mapInArrow(run, ROW))


class Block:
    """A kind 0 row, and with its kind 1 rows the corpus's counts of its words."""

    def __init__(self, rows: dict, answers: list[dict], buckets: int, train_docs: float):
        self.tokens, self.words = unpacked(rows["a"]), unpacked(rows["b"]).view(np.uint64)
        c = unpacked(rows["c"])
        self.size, self.held = c >> 1, (c & 1).astype(bool)
        self.ids = rows["d"]
        self.start = np.cumsum(self.size) - self.size
        self.v = len(self.words)
        self.of_doc = np.repeat(np.arange(len(self.size)), self.size)
        if answers:
            order, own, at = _by_bucket((self.words % np.uint64(buckets)).astype(np.int64))
            found = {r["k"]: r for r in answers}
            # The place after the words is the beginning of a text.
            self.number, self.total = np.zeros(self.v + 1, np.int64), np.zeros(self.v + 1, np.int64)
            for k, a, b in zip(own.tolist(), at[:-1], at[1:], strict=True):
                self.number[order[a:b]], self.total[order[a:b]] = unpacked(found[k]["a"]), unpacked(found[k]["b"])
            self.number[-1], self.total[-1] = BEGIN_NUMBER, int(train_docs)

    def train_counts(self) -> np.ndarray:
        return np.bincount(self.tokens[~self.held[self.of_doc]], minlength=self.v)

    def bigrams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The places h and w of the distinct bigrams, and each token's bigram."""
        before = np.roll(self.tokens, 1)
        before[self.start] = self.v
        pair, of_token = np.unique(before * (self.v + 1) + self.tokens, return_inverse=True)
        return pair // (self.v + 1), pair % (self.v + 1), of_token

    def dealt(self, h: np.ndarray, w: np.ndarray, frequent: float, buckets: int) -> np.ndarray:
        x = self.number[h]
        often = self.total[h] > frequent
        return (_mixed(np.where(often, x * 1_000_003 + self.number[w], x)) % np.uint64(buckets)).astype(np.int64)


def discounts(counts: np.ndarray) -> np.ndarray:
    """d(0..K) from the numbers of items counted 1..K+1 times.

    Good-Turing's own values where they lie inside (0, 1); else those of the numbers' log-linear fit; r / (r + 1) if
    these do not either (too few items).
    """
    r = np.arange(1, K + 1)

    def of(n: np.ndarray) -> np.ndarray:
        with np.errstate(all="ignore"):
            rest = (K + 1) * n[K] / n[0]
            return ((r + 1) * n[1:] / (r * n[:-1]) - rest) / (1 - rest)

    good = lambda d: np.all(np.isfinite(d) & (d > 0) & (d < 1))
    d = of(counts)
    if not good(d) and np.all(counts > 0):
        x = np.log(np.arange(1, K + 2))
        slope, level = np.polyfit(x, np.log(counts), 1)
        d = of(np.exp(level + slope * x))
    return np.concatenate([[1.0], d if good(d) else r / (r + 1)])


class Lower:
    """P(w) of a word by its training count alone."""

    def __init__(self, n: float, counts: np.ndarray):
        self.d = discounts(counts)
        freed = float(((1 - self.d[1:]) * np.arange(1, K + 1) * counts[:K]).sum())
        self.n = n if freed > 0 else n + 1
        self.unknown = (freed if freed > 0 else 1.0) / self.n

    def p(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, c * np.where(c <= K, self.d[np.minimum(c, K)], 1.0) / self.n, self.unknown)


def _split(table: pa.Table) -> dict[int, list[dict]]:
    out: dict[int, list[dict]] = {}
    for r in table.to_pylist():
        out.setdefault(r["kind"], []).append(r)
    return out


def word_counts(blocks_: DataFrame, buckets: int) -> DataFrame:
    """Kinds 1 and 4 (v: numbers of words counted at all, and 1..K+1 times)."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                own = Block(r, [], buckets, 0)
                n = own.train_counts()
                order, ks, at = _by_bucket((own.words % np.uint64(buckets)).astype(np.int64))
                yield from _rows([{"block": r["block"], "kind": 1, "k": k, "a": packed(own.words[order[a:b]].view(np.int64)), "b": packed(n[order[a:b]])} for k, a, b in zip(ks.tolist(), at[:-1], at[1:], strict=True)]).to_batches()

    def answer(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        words, n = [unpacked(r["a"]) for r in rows], [unpacked(r["b"]) for r in rows]
        distinct, of = np.unique(np.concatenate(words), return_inverse=True)
        total = np.bincount(of, np.concatenate(n), len(distinct)).astype(np.int64)
        number = 1 + np.arange(len(distinct)) * buckets + rows[0]["k"]
        out, a = [], 0
        for r, x in zip(rows, words, strict=True):
            mine = of[a : a + len(x)]
            a += len(x)
            out.append({"block": r["block"], "kind": 1, "k": r["k"], "a": packed(number[mine]), "b": packed(total[mine])})
        tally = [float((total > 0).sum()), *[float((total == k).sum()) for k in range(1, K + 2)]]
        return _rows([*out, {"block": -1, "kind": 4, "v": tally}])

    return common.cut(blocks_.mapInArrow(send, ROW).groupBy("k").applyInArrow(answer, ROW))


def bigram_counts(blocks_: DataFrame, words: DataFrame, word_buckets: int, buckets: int, frequent: float, train_docs: float, lower: Lower) -> DataFrame:
    """Kinds 3 (a: counts of the block's bigrams, b: sums of its histories), 4, 5 and 6."""

    def send(table: pa.Table) -> pa.Table:
        kinds = _split(table)
        own = Block(kinds[0][0], kinds[1], word_buckets, train_docs)
        h, w, of_token = own.bigrams()
        n = np.bincount(of_token, (~own.held[own.of_doc]).astype(float), len(h)).astype(np.int64)
        order, ks, at = _by_bucket(own.dealt(h, w, frequent, buckets))
        number = kinds[0][0]["block"]
        out = []
        for k, a, b in zip(ks.tolist(), at[:-1], at[1:], strict=True):
            i = order[a:b]
            often = own.total[h[i]] > frequent
            out.append({"block": number, "kind": 2, "k": k, "a": packed(own.number[h[i]] * 2 + often), "b": packed(own.number[w[i]]), "c": packed(own.total[w[i]]), "d": packed(n[i])})
        often = np.unique(own.number[h[own.total[h] > frequent]]).tolist()
        return _rows(out + [{"block": number, "kind": 6, "k": k} for k in often])

    def answer(table: pa.Table) -> pa.Table:
        kinds = _split(table)
        if 6 in kinds:
            return _rows(kinds[6])
        rows = kinds[2]
        h, w, c1, n = (np.concatenate([unpacked(r[x]) for r in rows]) for x in "abcd")
        order = np.lexsort((w, h))
        new = np.append(True, (np.diff(h[order]) != 0) | (np.diff(w[order]) != 0))
        of = np.empty(len(h), np.int64)
        of[order] = np.cumsum(new) - 1
        total = np.bincount(of, n).astype(np.int64)
        first = order[new]
        history, hist_of = np.unique(h[first], return_inverse=True)
        sums = np.stack([np.bincount(hist_of, total == r, len(history)) for r in range(1, K + 1)] + [np.bincount(hist_of, np.where(total > 0, lower.p(c1[first]), 0.0), len(history))])
        of_row = hist_of[of]
        out, a = [], 0
        for r in rows:
            m = len(unpacked(r["a"]))
            mine = h[a : a + m]
            starts = np.flatnonzero(np.diff(mine, prepend=-1))
            # The sums of each run of one history.
            got = sums[:, of_row[a : a + m][starts]]
            out.append({"block": r["block"], "kind": 3, "k": r["k"], "a": packed(total[of[a : a + m]]), "b": packed(got[:K].astype(np.int64).ravel()), "c": packed(got[K].copy())})
            a += m
        often = np.flatnonzero(history & 1)
        return _rows([*out, {"block": -1, "kind": 4, "v": [float((total == r).sum()) for r in range(1, K + 2)]}, *[{"block": -1, "kind": 5, "k": int(history[j] >> 1), "v": sums[:, j].tolist()} for j in often]])

    sent = blocks_.union(words.filter("kind = 1")).groupBy("block").applyInArrow(send, ROW)
    # Wishes go through in groups of their own.
    return common.cut(sent.groupBy("k", (F.col("kind") == 6).alias("wish")).applyInArrow(answer, ROW))


def score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row of `df`, learning from the training folds."""
    all_blocks = blocks(df, id_col, text_col)
    t = all_blocks.agg(*[F.coalesce(F.sum(F.col("v")[k]), F.lit(0.0)).alias(f"x{k}") for k in range(4)], F.count("*").alias("n")).first()
    train_docs, n, entries, tokens = t.x0, t.x1, t.x2, t.x3
    word_buckets, buckets = max(1, ceil(entries / PER_BUCKET)), max(1, ceil(tokens / PER_BUCKET))
    words = word_counts(all_blocks, word_buckets)

    def tallies(rows: DataFrame, k: int) -> np.ndarray:
        got = rows.filter("kind = 4").agg(*[F.sum(F.col("v")[i]).alias(f"x{i}") for i in range(k)]).first()
        return np.array([x or 0.0 for x in got])

    v, *counts = tallies(words, K + 2)
    lower, frequent = Lower(n, np.array(counts)), FREQUENT * tokens / buckets
    found = bigram_counts(all_blocks, words, word_buckets, buckets, frequent, train_docs, lower)
    d = discounts(tallies(found, K + 1))
    parts = found.filter("kind = 5").groupBy("k").agg(F.array(*[F.sum(F.col("v")[i]) for i in range(K + 1)]).alias("v"))
    wishes = found.filter("kind = 6").select("block", "k").join(parts, "k")
    nothing = [F.lit(None).cast("binary").alias(x) for x in "abcd"]
    answers = wishes.select("block", F.lit(7).alias("kind"), "k", *nothing, "v")

    def run(table: pa.Table) -> pa.Table:
        kinds = _split(table)
        own = Block(kinds[0][0], kinds[1], word_buckets, train_docs)
        h, w, of_token = own.bigrams()
        order, ks, at = _by_bucket(own.dealt(h, w, frequent, buckets))
        got = {r["k"]: r for r in kinds[3]}
        c, seen_low, seen = np.zeros(len(h), np.int64), np.zeros((K, own.v + 1)), np.zeros(own.v + 1)
        for k, a, b in zip(ks.tolist(), at[:-1], at[1:], strict=True):
            i, r = order[a:b], got[k]
            c[i] = unpacked(r["a"])
            runs = h[i][np.flatnonzero(np.diff(own.number[h[i]], prepend=-1))]
            seen_low[:, runs], seen[runs] = unpacked(r["b"]).reshape(K, -1), unpacked(r["c"], np.float64)
        if 7 in kinds:
            place = {x: p for p, x in enumerate(own.number.tolist())}
            for r in kinds[7]:
                seen_low[:, place[r["k"]]], seen[place[r["k"]]] = r["v"][:K], r["v"][K]
        freed = ((1 - d[1:]) * np.arange(1, K + 1)) @ seen_low
        ch = own.total.astype(float)
        below = np.where(freed > 0, ch, ch + 1)
        alpha = np.where(ch > 0, np.where(freed > 0, freed, 1.0) / below / np.maximum(1 - seen, 1e-300), 1.0)
        c1 = own.total[w]
        with np.errstate(divide="ignore"):
            p = np.where(c > 0, np.where(c <= K, d[np.minimum(c, K)], 1.0) * c / below[h], alpha[h] * lower.p(c1))
            log_p = np.log10(p)[of_token]
        known = own.total[own.tokens]
        sums = lambda x: np.add.reduceat(x, own.start)
        ids = pa.ipc.open_stream(own.ids).read_all().column("id")
        base = np.log10((known + 1) / (n + v + 1))
        return pa.table([ids, pa.array(own.held), pa.array(own.size), pa.array(sums((known > 0).astype(np.int64))), pa.array(np.full(len(own.size), int(n))), pa.array(sums(base)), pa.array(sums(log_p))], names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    kind = df.schema[id_col].dataType.simpleString()
    gathered = all_blocks.union(words.filter("kind = 1")).union(found.filter("kind = 3")).union(answers)
    out = gathered.groupBy("block").applyInArrow(run, f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
    return out.withColumnRenamed("id", id_col)


def op7_katz_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(common.table(spark, sf_dir, "documents", "doc_id", "text"))

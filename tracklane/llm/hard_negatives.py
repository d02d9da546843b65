"""Hard negatives by exact inner-product search over rows turned into their principal axes.

The rows' second-moment matrix is summed over all rows; its eigenvectors, largest first, are an orthogonal rotation, under
which inner products stay what they are while the first components hold most of them. For a block of anchors and a block
of rows the products of the leading components are accumulated, step by step; what the components to come can still add is
at most the product of the remainders' norms, plus some slack for rounding. A pair that can no longer come into any list
is discarded; the products of those that are left are computed again from the whole numbers. So results are exact
whatever the rotation: it decides only how early pairs go.

Rows are packed in blocks of a bounded number of rows where they are read. The query set, every row whose id is divisible
by 100, is packed likewise. Its blocks are searched for in groups of bounded size, one after the other: a group is
broadcast and meets the rows' blocks, dealt evenly over tasks, each of which keeps lists of the best rows so far of the
group's anchors. The lists of all tasks, each of bounded length, are merged by a window before the next group. So what is
broadcast, kept in a task or written on the way does not grow with the table. Positives are found first; their scores then
bound the search for negatives.

Edge cases. Rows with a null id, label or vector, or a null or non-finite component, take no part, nor do those with a
component of 2^17 or more in size, whose products might not fit a long. Missing components of shorter vectors count as 0. Repeated
rows are rows; rows of an anchor's own id are never its positives or negatives; of repeated anchors the least row by label
and vector is searched, once. Ties go by id. An empty table, or one without anchors, gives no rows.
"""

from __future__ import annotations

import contextlib
import functools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracklane.llm import common

QUERY_STEP, POSITIVES, NEGATIVES, LABELS, SHIFT_STEP, SCALE = 100, 5, 10, 10, 7, 256
#: Rows of a block of rows, and how many of them are looked at at once; anchors of a block; pairs of blocks that one Arrow
#: batch holds.
ROWS, SLICE, ANCHORS, PAIRS = 4096, 256, 512, 8
#: Anchors of a group, and bytes of their blocks: what is broadcast, and has its lists in a task, at once.
GROUP, GROUP_BYTES = 16_384, 32_000_000
#: Leading components after which pairs are discarded, as parts of all.
STEPS = (0.125, 0.25, 0.5, 1.0)
LARGEST = float(1 << 17)
#: Rounding: errors of products of doubles are far below this part of the norms' product.
SLACK = 1e-11
_LOW, _HIGH = -(1 << 62), 1 << 62


def whole_rows(embeddings: DataFrame) -> DataFrame:
    """(id, label, x): the rows that take part, components as whole numbers."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("id"), F.col("label").cast("bigint").alias("label"), x.alias("x"))
    good = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < LARGEST))
    shifted = F.when(F.col("id") % SHIFT_STEP == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & good).select("id", shifted.alias("label"), F.transform("x", lambda v: F.floor(SCALE * v).cast("int")).alias("x"))


def _matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    """Lists as rows of a matrix, zeros where they are short."""
    at = np.asarray(lists.offsets, np.int64)
    flat = lists.values.to_numpy(zero_copy_only=False)[at[0] : at[-1]]
    n = np.diff(at)
    if len(n) and (n == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(n), width), np.int32)
    out[np.repeat(np.arange(len(n)), n), np.arange(len(flat)) - np.repeat(at[:-1] - at[0], n)] = flat
    return out


def rotation(rows: DataFrame, width: int) -> np.ndarray:
    """Orthogonal columns, the principal axes of all rows, largest first."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            x = _matrix(batch.column("x"), width).astype(float)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())], names=["k", "m"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(width)
        for x in table.column("m"):
            total += np.frombuffer(x.as_py())
        return pa.table({"k": table.column("k").slice(0, 1), "m": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros((width, width))
    for r in rows.select("x").mapInArrow(moments, "k int, m binary").groupBy("k").applyInArrow(add, "k int, m binary").collect():
        out[r.k] = np.frombuffer(r.m)
    return np.linalg.eigh((out + out.T) / 2)[1][:, ::-1]


def _blocks(rows: DataFrame, width: int, size: int, windows: int = 0) -> DataFrame:
    """(n, ids, labels, xs, low, high): `rows` (id, label, x, and with windows low, high) in blocks of up to `size` rows."""

    def block(parts: list[tuple]) -> pa.RecordBatch:
        ids, *rest = (np.concatenate(p) for p in zip(*parts, strict=True))
        return pa.RecordBatch.from_arrays([pa.array([len(ids)], pa.int32()), *[pa.array([c.tobytes()], pa.binary()) for c in (ids, *rest)]], names=["n", "ids", "labels", "xs", "low", "high"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        n = 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                b = batch.slice(at, size - n)
                at, n = at + b.num_rows, n + b.num_rows
                ids, labels = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("id", "label"))
                low, high = (_matrix64(b.column(c), windows) for c in ("low", "high")) if windows else [np.zeros((len(ids), 0), np.int64)] * 2
                held.append((ids, labels, _matrix(b.column("x"), width).astype(np.int32), low, high))
                if n == size:
                    yield block(held)
                    held, n = [], 0
        if n:
            yield block(held)

    return rows.mapInArrow(pack, "n int, ids binary, labels binary, xs binary, low binary, high binary")


def _matrix64(lists: pa.ListArray, width: int) -> np.ndarray:
    """Windows' bounds; missing ones never match."""
    out = np.full((len(lists), width), _HIGH, np.int64)
    for i, x in enumerate(lists.to_pylist()):
        out[i, : len(x)] = x
    return out


class _Block:
    """A block as arrays, with the components turned and the norms of what is behind each step."""

    def __init__(self, n: int, ids: bytes, labels: bytes, xs: bytes, low: bytes, high: bytes, axes: np.ndarray, cuts: Sequence[int]):
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        self.x = np.frombuffer(xs, np.int32).reshape(n, len(axes)).astype(np.int64)
        self.turned = self.x @ axes
        self.norm = np.sqrt((self.x.astype(float) ** 2).sum(1))
        self.behind = [np.sqrt((self.turned[:, c:] ** 2).sum(1)) for c in cuts]
        self.low, self.high = (np.frombuffer(v, np.int64).reshape(n, -1) for v in (low, high))


class _Lists:
    """The best `k` rows of each window of each anchor of a block so far: scores falling, ids rising."""

    def __init__(self, block: _Block, windows: int, k: int):
        self.block, self.k = block, k
        self.score = np.full((len(block.ids), windows, k), _LOW, np.int64)
        self.id = np.full((len(block.ids), windows, k), _HIGH, np.int64)

    def least(self) -> np.ndarray:
        """Of each anchor and window, the score under which no row comes in any more."""
        return np.maximum(self.block.low, self.score[:, :, -1])

    def add(self, a: np.ndarray, j: int, score: np.ndarray, ids: np.ndarray) -> None:
        """Rows for window j: anchors' numbers, scores, ids."""
        if not len(a):
            return
        who = np.unique(a)
        old_a, old = np.repeat(who, self.k), (self.score[who, j].ravel(), self.id[who, j].ravel())
        a, score, ids = np.concatenate([a, old_a]), np.concatenate([score, old[0]]), np.concatenate([ids, old[1]])
        by = np.lexsort((ids, -score, a))
        a, score, ids = a[by], score[by], ids[by]
        place = np.arange(len(a)) - np.searchsorted(a, a)
        keep = place < self.k
        self.score[a[keep], j, place[keep]], self.id[a[keep], j, place[keep]] = score[keep], ids[keep]

    def rows(self) -> pa.RecordBatch | None:
        a, j, place = np.nonzero(self.score > _LOW)
        return pa.RecordBatch.from_arrays([pa.array(self.block.ids[a]), pa.array(j.astype(np.int32)), pa.array(self.id[a, j, place]), pa.array(self.score[a, j, place])], names=["anchor_id", "window", "id", "score"])


def _scan(anchors: _Block, rows: _Block, lists: _Lists, cuts: Sequence[int], same: bool) -> None:
    """Puts what `rows` have for `anchors` into `lists`, a slice of rows at a time, so that lists fill early."""
    for start in range(0, len(rows.ids), SLICE):
        columns = np.arange(start, min(start + SLICE, len(rows.ids)))
        alive = ((anchors.labels[:, None] == rows.labels[None, columns]) == same) & (anchors.ids[:, None] != rows.ids[None, columns])
        part, from_ = np.zeros(alive.shape), 0
        for step, to in enumerate(cuts):
            part = part + anchors.turned[:, from_:to] @ rows.turned[columns, from_:to].T
            from_ = to
            alive = alive & _hopeful(anchors, rows, lists, step, columns, part)
            keep = alive.any(0)
            part, alive, columns = part[:, keep], alive[:, keep], columns[keep]
            if not len(columns):
                break
        a, c = np.nonzero(alive)
        score = np.einsum("ij,ij->i", anchors.x[a], rows.x[columns[c]])  # whole numbers
        for j in range(anchors.high.shape[1]):
            inside = (score >= lists.least()[a, j]) & (score <= anchors.high[a, j])
            lists.add(a[inside], j, score[inside], rows.ids[columns[c[inside]]])


def _hopeful(anchors: _Block, rows: _Block, lists: _Lists, step: int, columns: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Pairs whose score may still lie in some window of the anchor, and above the last row of its list."""
    more = anchors.behind[step][:, None] * rows.behind[step][None, columns] + SLACK * anchors.norm[:, None] * rows.norm[None, columns]
    upper, lower = part + more, part - more
    least, out = lists.least(), np.zeros(part.shape, bool)
    for j in range(least.shape[1]):
        out |= (upper >= least[:, j, None]) & (lower <= anchors.high[:, j, None])
    return out


@contextlib.contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of few rows, each of which is a pair of blocks, for what is run inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(PAIRS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


_CELLS = ("n", "ids", "labels", "xs", "low", "high")


def _ranked(found: DataFrame, k: int, by: Sequence[str]) -> DataFrame:
    """The first k of each group of `by`, best first, with their rank; a task's list of them has k rows at most."""
    rank = F.row_number().over(W.partitionBy(*by).orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def _groups(blocks: DataFrame, most: int) -> list[tuple[int, int]]:
    """The first and last key of each group of `blocks`, in order of their keys, of `most` rows or of one block."""
    out: list[tuple[int, int]] = []
    n = 0
    for r in blocks.select("k", "n").orderBy("k").collect():  # a row for ANCHORS anchors
        n += r.n
        if out and n <= most:
            out[-1] = (out[-1][0], r.k)
        else:
            out.append((r.k, r.k))
            n = r.n
    return out or [(0, 0)]


def search(anchors: DataFrame, blocks: DataFrame, axes: np.ndarray, windows: int, k: int, same: bool) -> DataFrame:
    """(anchor_id, window, id, score, rank): the best k rows of each window of each anchor.

    anchors: (id, label, x, low, high), low and high arrays of up to `windows` bounds of the score, both included.
    blocks: rows as _blocks packs them. same: rows of the anchor's label, or of others.
    """
    spark, width = blocks.sparkSession, len(axes)
    cuts = sorted({max(1, round(width * s)) for s in STEPS})
    # Each task gives lists of its own: some tasks a core, not more.
    tasks = min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(16, 2 * spark.sparkContext.defaultParallelism))
    asked = common.cut(_blocks(anchors, width, ANCHORS, windows).withColumn("k", F.monotonically_increasing_id()))
    a = asked.select(*[F.col(c).alias(f"a_{c}") for c in ("k", *_CELLS)])
    r = blocks.select(*[F.col(c).alias(f"r_{c}") for c in ("k", *_CELLS)]).repartition(tasks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, _Lists] = {}
        rows, at = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                cell = lambda side, batch=batch, i=i: [batch.column(f"{side}_{c}")[i].as_py() for c in _CELLS]
                key, row_key = batch.column("a_k")[i].as_py(), batch.column("r_k")[i].as_py()
                if key not in kept:
                    kept[key] = _Lists(_Block(*cell("a"), axes, cuts), windows, k)
                if at != row_key:
                    rows, at = _Block(*cell("r"), axes, cuts), row_key
                _scan(kept[key].block, rows, kept[key], cuts, same)
        for x in kept.values():
            yield x.rows()

    out = []
    for first, last in _groups(asked, min(GROUP, GROUP_BYTES // (4 * width + 16 * windows + 16))):
        with _small_batches(spark):
            lists = common.cut(r.crossJoin(F.broadcast(a.filter(F.col("a_k").between(first, last)))).mapInArrow(run, "anchor_id bigint, window int, id bigint, score bigint"))
        out.append(common.cut(_ranked(lists, k, ["anchor_id", "window"])))
        common.discard(lists)
    return functools.reduce(DataFrame.union, out)


def mine(embeddings: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of rows (vec_id, embedding, label)."""
    rows = common.cut(whole_rows(embeddings))
    width = int(rows.agg(F.coalesce(F.max(F.size("x")), F.lit(0))).first()[0])
    if not width:
        width = 1  # only empty vectors, or none
    axes = rotation(rows, width)
    blocks = common.cut(_blocks(rows, width, ROWS).withColumn("k", F.monotonically_increasing_id()))
    anchors = common.cut(rows.filter(F.col("id") % QUERY_STEP == 0).groupBy("id").agg(F.min(F.struct("label", "x")).alias("r")).select("id", "r.label", "r.x"))
    open_ = anchors.select("*", F.array(F.lit(_LOW + 1)).alias("low"), F.array(F.lit(_HIGH)).alias("high"))
    first = search(open_, blocks, axes, 1, positives, True)
    best = common.cut(first.select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), (F.col("rank") - 1).alias("window")))
    # 30 p <= 100 n <= 90 p: n from 0.3 p rounded up to 0.9 p rounded down, in decimals.
    low, high = (F.expr(f"cast({f}(positive_score * {x}BD) AS bigint)") for f, x in (("ceil", 0.3), ("floor", 0.9)))
    bounds = best.groupBy(F.col("anchor_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("window", low.alias("low"), high.alias("high")))).alias("b"))
    asked = anchors.join(bounds, "id").select("id", "label", "x", F.col("b.low").alias("low"), F.col("b.high").alias("high"))
    found = search(asked, blocks, axes, positives, negatives, False)
    return found.join(best, ["anchor_id", "window"]).select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(common.table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


ORACLE_SQL = f"""
WITH w AS (SELECT vec_id AS id, CASE WHEN vec_id % {SHIFT_STEP} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
    list_transform(embedding, lambda v: floor({SCALE} * CAST(v AS DOUBLE))) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
s AS (SELECT a.id AS anchor_id, a.label = r.label AS same, r.id, CAST(list_inner_product(a.x, r.x) AS BIGINT) AS score FROM w a JOIN w r ON a.id <> r.id WHERE a.id % {QUERY_STEP} = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES})
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INT) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) <= {NEGATIVES}"""

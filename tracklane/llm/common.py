"""What the corpus operators share: reading tables, cutting lineage, splitting words in Arrow batches."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklane.sources.scratch import at_end

#: A word is a run of anything but these six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
#: Bytes of text that one step of an Arrow task handles at once; a longer single text is one step.
SLICE_BYTES = 4_000_000

_own_dirs: dict[str, str] = {}
#: Of each running query, innermost last, the tables that it has written so far.
_written: list[list[str]] = []


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Table `name`; with `columns`, only those (the scan reads no others)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, or in local mode without one a temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="tracklane-")
    return _own_dirs[app]


#: Lets shuffle files go when their query ends, not when the driver's JVM comes to collect what named them.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _write(df: DataFrame, path: str) -> None:
    """`df` written; what was shuffled for that goes at once, since from here on the table is read."""
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLES_GO, None)
    conf.set(SHUFFLES_GO, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(SHUFFLES_GO) if before is None else conf.set(SHUFFLES_GO, before)


def cut(df: DataFrame) -> DataFrame:
    """`df` written once to the shared folder and read back: recomputation after a lost executor starts here.

    The table goes at the latest when the session's JVM ends, the shuffle files of its writing when it is written.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    if _written:
        _written[-1].append(path)
    at_end(spark, path)
    _write(df, path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, paths: Iterable[str]) -> None:
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)  # noqa: SLF001


def tidy(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """`query`, after which only those of the tables that it has cut are left that its result still reads."""

    @functools.wraps(query)
    def run(*args, **kwargs) -> DataFrame:
        _written.append([])
        try:
            out = query(*args, **kwargs)
        except BaseException:
            mine = _written.pop()
            if mine and (spark := SparkSession.getActiveSession()):
                _remove(spark, mine)
            raise
        mine = _written.pop()
        read = {f.rpartition("/")[0].rpartition("/")[2] for f in out.inputFiles()} if mine else set()
        _remove(out.sparkSession, [p for p in mine if p.rpartition("/")[2] not in read])
        if _written:
            _written[-1] += [p for p in mine if p.rpartition("/")[2] in read]
        return out

    return run


def discard(df: DataFrame) -> None:
    """Remove the files of a table made by `cut` that no later plan reads, before its query ends."""
    folders = {f.rpartition("/")[0] for f in df.inputFiles()}
    names = {f.rpartition("/")[2] for f in folders}
    if len(names) == 1 and (name := names.pop()).startswith("cut-"):
        _remove(df.sparkSession, folders)
        for paths in _written:
            paths[:] = [p for p in paths if not p.endswith(name)]


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once a row."""
    return F.transform(F.array(value), body)[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges of `batch` whose texts have about `limit` bytes; a single longer text stays whole."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // limit
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
        yield batch.slice(a, b - a)


def split_words(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in one array, and the offsets at which each text's words begin (null: no word)."""
    texts = pc.fill_null(texts, "")
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    words, at = lists.flatten(), np.asarray(lists.offsets, dtype=np.int64)
    at = at - at[0]
    full = pc.greater(pc.binary_length(words), 0)
    if pc.sum(full).as_py() != len(words):
        before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
        words, at = words.filter(full), before[at]
    return words, at


def encoded(words: pa.Array) -> tuple[list, np.ndarray]:
    """The distinct words, and each word's number among them."""
    coded = words.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)


def sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of `values` in each range at[i]:at[i+1]; 0 for an empty range."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[at[1:]] - total[at[:-1]]


def row_key(id_: Column, text: Column) -> Column:
    """What rows of equal id and text share: decisions are joined back by it (null and empty differ)."""
    return F.md5(F.concat(F.coalesce(id_.cast("string"), F.lit("\0")), F.lit("\x1f"), F.coalesce(text, F.lit("\0"))))

"""Tables that a plan writes on its way: in the cluster's shared folder, removed when the session's JVM ends.

Paths are removed by the file system's own hook, which Spark does not offer in Python: this uses the driver's JVM, so it
needs a classic session, not a remote one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A path for a new folder that driver and executors share; in local mode without a shared folder, in a temporary one of the application."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = tempfile.mkdtemp(prefix="tracklane-")
            at_end(spark, _own[app])
        return f"{_own[app]}/{name}-{uuid.uuid4().hex}"
    path = f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    at_end(spark, path)
    return path


def at_end(spark: SparkSession, path: str) -> None:
    """Remove `path` when the JVM ends, if it is still there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)  # noqa: SLF001


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written once and read back: what follows sees one run of its plan, and recomputation starts here."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

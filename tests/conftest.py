"""One local session for all tests; Python workers find the repository whatever the working folder."""

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
DATA = "/root/testdata"
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    conf = {
        "spark.sql.shuffle.partitions": "4", "spark.default.parallelism": "4", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.sql.python.filterPushdown.enabled": "true", "spark.driver.memory": "4g",
        "spark.local.dir": tempfile.mkdtemp(prefix="spark-"), "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="spark-"),
    }
    s = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def _plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.fixture(scope="session")
def same_as_sql():
    """Compares a query with its SQL over the tables of a folder, whatever the order of rows."""
    import duckdb

    def compare(df, sql: str, sf_dir: str) -> None:
        con = duckdb.connect()
        for f in sorted(os.listdir(sf_dir)):
            con.execute(f"CREATE VIEW {f.partition('.')[0]} AS SELECT * FROM '{sf_dir}/{f}'")
        got = con.execute(sql)
        names, rows = [x[0] for x in got.description], got.fetchall()
        assert sorted(names) == sorted(df.columns)
        order = sorted(names)
        a = sorted((tuple(_plain(r[c]) for c in order) for r in df.collect()), key=repr)
        b = sorted((tuple(_plain(dict(zip(names, r, strict=True))[c]) for c in order) for r in rows), key=repr)
        assert a == b

    return compare

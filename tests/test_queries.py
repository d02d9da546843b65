"""Every query of the library's own against its SQL, and the driver's contract."""

import subprocess
import sys

import pytest
from conftest import DATA, ROOT

from tracklane import plans


@pytest.mark.parametrize("name", plans.QUERIES)
def test_equals_sql(spark, same_as_sql, name):
    same_as_sql(plans.QUERIES[name](spark, f"{DATA}/sf0.001"), plans.ORACLES[name], f"{DATA}/sf0.001")


def test_entry_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_imports_without_a_session_and_without_the_optional_parts():
    code = "import sys; sys.modules['tracklane.llm'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    assert said.stdout.split() == [str(len(plans.QUERIES)), str(len(plans.ORACLES))]

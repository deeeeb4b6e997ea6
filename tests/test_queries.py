"""Every catalog query gives the rows of its SQL."""

import os

import pytest
from compare import same

from polycat import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, name):
    assert same(spark, queries.QUERIES[name], queries.SQL[name], SF) is None


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["id", "name", "pos"]
    assert set(queries.QUERIES) <= set(e.queries()) and set(queries.SQL) <= set(e.oracle_sql())


def test_works_without_corpus_operators(tmp_path):
    """Without the corpus folders the entry still imports and has the other queries."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(os.path.join(root, "polycat"), tmp_path / "polycat", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert out.stdout.split() == [str(len(queries.QUERIES))] * 2, out.stderr[-500:]

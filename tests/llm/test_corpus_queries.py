"""Corpus queries against their SQL, and the pipeline's stages against what they must keep."""

import os

import pytest
from compare import same

from polycat.llm import queries
from polycat.llm.common import table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query(spark, name):
    assert same(spark, queries.queries()[name], queries.oracle_sql()[name], SF) is None


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(queries.oracle_sql())))
def test_rows(spark, name):
    n = queries.queries()[name](spark, SF).count()
    docs = table(spark, SF, "documents").count()
    assert n > docs if name.startswith("op11_") else n == (500 if name.startswith("op1_") else docs)


def test_pipeline(spark):
    import corpus_pipeline as p

    docs = table(spark, SF, "documents")
    kept = [docs]
    for name, stage in p.STAGES:
        out = stage(spark, kept[-1], SF)
        if name != "token_shards":
            assert out.columns == docs.columns
            out = out.persist()
        kept.append(out)
    n = [x.count() for x in kept]
    assert n[0] > n[1] > n[2] > n[3] > 0 and n[5] == n[4]
    assert p.run(spark, SF).count() == n[5]
    for x in kept[1:-1]:
        x.unpersist()

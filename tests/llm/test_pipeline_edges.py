"""The whole pipeline on tables without rows, without values and with clashing names."""

import os

import pytest
from test_small_tables import DOCS, clashing, docs, empty

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def through(spark, df):
    import corpus_pipeline as p

    counts, columns = [df.count()], df.columns
    for name, stage in p.STAGES:
        df = stage(spark, df, SF)
        if name != p.STAGES[-1][0]:
            assert df.columns == columns
        counts.append(df.count())
    return counts, df


def test_empty(spark):
    assert through(spark, clashing(empty(spark)))[0] == [0] * 6


def test_nulls_and_repeats(spark):
    nothing = spark.createDataFrame([(None, None, None, None, None)] * 4, DOCS)
    counts, out = through(spark, clashing(docs(spark).unionByName(docs(spark)).unionByName(nothing)))
    assert counts[:4] == [24, 24, 16, 16]  # each of six texts once, the ten rows without words all
    assert counts[5] == counts[4] and {x.n_tokens for x in out.collect() if x.doc_id is None} <= {1, 2, 3, 4}

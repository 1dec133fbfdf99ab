"""Hard negatives by shelves of leaves: what is merged stays in proportion to the anchors, and shelves of any size give the same rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_negatives import SCHEMA, brute, clustered

from fanflow.llm import negatives


def test_shelves_hold_all_leaves():
    first, many = negatives.shelves(np.array([3, 0, 4, 25, 1, 9, 2]), 10)
    assert first.tolist() == [0, 0, 0, 1, 4, 4, 5] and many.tolist() == [1, 0, 1, 3, 1, 1, 1]
    assert [x.tolist() for x in negatives.shelves(np.zeros(1, np.int64), 1)] == [[0], [0]]


@pytest.mark.parametrize(("shelves", "kept"), [(2, 1_000_000), (40, 50)])
def test_any_shelves_match_brute_force_with_few_candidates(spark, monkeypatch, shelves, kept):
    for name, value in {"LEAF": 12, "SPLITS": 4, "BLOCK": 8, "SHELVES": shelves, "KEPT": kept, "ANCHORS": 7}.items():
        monkeypatch.setattr(negatives, name, value)
    made, scan = [], negatives.Search.scan
    monkeypatch.setattr(negatives.Search, "scan", lambda self, visits: made.append(scan(self, visits)) or made[-1])
    rows = clustered(random.Random(8), 240)
    df = spark.createDataFrame(rows, SCHEMA)
    got = negatives.mine(df, df.filter(F.col("vec_id") % 10 == 0)).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(set(got)) > 20 and set(got) == brute(rows, lambda k: k % 10 == 0)
    if shelves == 2:  # in 32 anchors, 5 windows, 3 rows and 3 shelves or so; by leaves there were several times as many
        assert made[-1].count() <= 32 * 5 * 3 * 4
        assert made[-1].groupBy("anchor", "positive").count().agg(F.max("count")).first()[0] <= 3 * 4

"""Hard-negative mining against brute force."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from fanflow.llm import negatives
from fanflow.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def brute(rows, anchors, positives=5, negatives_=3):
    """The contract's rows for distinct (id, vector, label) rows."""
    ok = lambda r: r[0] is not None and r[2] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])
    held = [(k, [math.floor(256 * x) for x in v], label) for k, v, label in {(r[0], tuple(r[1]), r[2]) for r in rows if ok(r)}]
    out = set()
    for a, v, label in held:
        if not anchors(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), k, other) for k, w, other in held if k != a)
        for p, k, _ in [s for s in scored if s[2] == label][:positives]:
            fit = [s for s in scored if s[2] != label and 50 * -p <= 100 * -s[0] <= 95 * -p][:negatives_]
            out |= {(a, k, n + 1, s[1], -p, -s[0]) for n, s in enumerate(fit)}
    return out


def mined(spark, rows, every):
    df = spark.createDataFrame(rows, SCHEMA)
    got = negatives.mine(df, df.filter(F.col("vec_id") % every == 0))
    return [tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()]


def clustered(r, n, d=6):
    centres = [[r.gauss(0, 1) for _ in range(d)] for _ in range(5)]
    rows = [(k, [x + r.gauss(0, 0.3) for x in centres[k % 5]], r.choice((k % 5, r.randrange(10)))) for k in range(n)]
    return [*rows, *((n + k, rows[7][1], 3) for k in range(n // 3))]  # a third is one vector


def test_small_leaves_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(negatives, "LEAF", 20)
    monkeypatch.setattr(negatives, "SPLITS", 4)
    monkeypatch.setattr(negatives, "BLOCK", 16)
    rows = clustered(random.Random(1), 240)
    got = mined(spark, rows, 10)
    assert len(got) == len(set(got)) > 20 and set(got) == brute(rows, lambda k: k % 10 == 0)


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, list(map(float, r.embedding)), (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    out = QUERIES["op12_hard_negatives"](spark, sf)
    assert dict(out.dtypes)["rank"] == "int" and dict(out.dtypes)["negative_score"] == "bigint"
    got = [tuple(r) for r in out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()]
    assert got and len(got) == len(set(got)) and set(got) == brute(rows, lambda k: k % 50 == 0)


def test_ranges_leave_leaves_out_and_lose_none():
    r = np.random.default_rng(2)
    x = np.concatenate([r.normal(c, 0.2, (400, 5)) * 256 for c in range(8)]).round()
    tree = negatives.Tree(x, 100_000, float(np.sqrt((x**2).sum(1).max())))
    lifted = tree.lifted(x)
    tree.low = [np.full((len(n.points),) * 2, np.inf) for n in tree.nodes]
    tree.high = [np.full((len(n.points),) * 2, -np.inf) for n in tree.nodes]
    for node, _, d, nearest in tree.descend(lifted):
        for k in np.unique(nearest):
            tree.low[node][:, k], tree.high[node][:, k] = d[nearest == k].min(0), d[nearest == k].max(0)
    leaf, anchors = tree.leaf_of(lifted), x[::100]
    scores = anchors @ x.T
    most = np.sort(scores, 1)[:, -40]
    least = np.sort(scores, 1)[:, -60]
    row, at = tree.visited(np.hstack([anchors, np.zeros((len(anchors), 1))]), *tree.annulus(anchors, least, most))
    seen = set(zip(row.tolist(), at.tolist(), strict=True))
    for k, (lo, hi) in enumerate(zip(least, most, strict=True)):
        assert {(k, int(v)) for v in leaf[(scores[k] >= lo) & (scores[k] <= hi)]} <= seen
    assert len(seen) < 0.8 * len(anchors) * tree.leaves


def test_odd_rows(spark):
    rows = [(0, [1.0, 1.0], 1), (0, [1.0, 1.0], 1), (1, [1.0, 0.9], 1), (2, [0.9, 0.5], 2), (3, [0.8], 2), (4, None, 2), (5, [1.0, None], 2), (6, [float("nan"), 1.0], 2), (7, [1.0, 1.0], None), (None, [1.0, 1.0], 2), (8, [], 2), (9, [-1.0, -1.0], 1)]
    assert sorted(mined(spark, rows, 10)) == sorted(brute(rows, lambda k: k % 10 == 0)) != []
    assert mined(spark, [], 10) == []
    big = [(0, [8e6, 8e6], 1), (1, [8e6, 8e6 - 1], 1), (2, [4e6, 5e6], 2), (3, [0.0, 0.0], 1)]  # beyond what doubles hold
    assert sorted(mined(spark, big, 10)) == sorted(brute(big, lambda k: k % 10 == 0)) != []
    assert mined(spark, [(0, [1e12], 1), (1, [1e12], 1), (2, [1e12], 2), (3, [5e6], 2)], 10) == []  # all scores of 1e12 are the greatest number
    clash = spark.createDataFrame(clustered(random.Random(3), 60), SCHEMA).withColumns({c: F.lit("x") for c in ("id", "leaf", "block", "windows", "anchor", "score", "top")})
    assert negatives.mine(clash, clash.filter("vec_id % 10 = 0")).count() == len(brute(clustered(random.Random(3), 60), lambda k: k % 10 == 0))

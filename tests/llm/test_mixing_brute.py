"""Mixing by brute force: targets by water filling, every step of the flight, the landing and whole small sources."""

import random
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import none, odd

from fanflow.llm import mixing


def filled(sizes, weights=(5, 2, 1), most=3):
    """Targets of {source: size}: shares of the rest are cut at their limits until none is above."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, free, rest = {}, set(names), float(sum(sizes.values()))
    while free:
        share = sum(weight[s] for s in free)
        over = {s for s in free if rest * weight[s] / share > most * sizes[s]}
        if not over:
            return target | {s: rest * weight[s] / share for s in free}
        target |= {s: float(most * sizes[s]) for s in over}
        rest -= sum(most * sizes[s] for s in over)
        free -= over
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets_of_many_sources_match_water_filling(spark, seed):
    r = random.Random(seed)
    few = (1, 2, 3, 60)[seed]
    sizes = {f"s{k}é" if k % 7 else f"S{k}": r.choice((0, 1, few, r.randrange(1, 10**r.randrange(1, 7)))) for k in range((1, 3, 40, 500)[seed])}
    if seed % 2:
        sizes[None] = 17
    rows = [(s, part) for s, n in sizes.items() for part in (n // 2, n - n // 2)]
    found = mixing.targets(spark.createDataFrame(rows, "source string, size bigint").repartition(5)).collect()
    want = filled(sizes)
    assert {x.source: (x.n, x.source_size) for x in found} == {s: (2, n) for s, n in sizes.items()}
    assert all(x.target == pytest.approx(want[x.source], rel=1e-9, abs=1e-6) for x in found)


def test_equal_sources_have_targets_that_add_up(spark):
    rows = [(f"s{k:02d}", 10) for k in range(30)]  # many ties of limit over weight
    found = {x.source: x.target for x in mixing.targets(spark.createDataFrame(rows, "source string, size bigint")).collect()}
    assert found == pytest.approx(filled({s: n for s, n in rows})) and sum(found.values()) == pytest.approx(300)


def test_no_window_over_all_sources(spark, monkeypatch):
    """Ranges are dealt, and every window over sources is one within a range."""
    kept = []
    whole = mixing.written
    monkeypatch.setattr(mixing, "written", lambda df, tag: kept.append((tag, df._jdf.queryExecution().optimizedPlan().toString())) or whole(df, tag))
    mixing.targets(spark.range(50).select(F.col("id").cast("string").alias("source"), F.col("id").alias("size")))
    windows = [line for _, plan in kept for line in plan.splitlines() if "Window [" in line]
    assert any("RepartitionByExpression" in plan for _, plan in kept)
    assert windows and all("[range" in w or "all_" in w for w in windows)


@pytest.mark.parametrize("kind", ["spread", "equal", "heavy"])
def test_every_step_of_the_flight_keeps_both_balances(kind):
    r = random.Random(kind)
    for p in (0.05, 0.5, 0.93):
        units = [(p, float({"spread": r.randrange(1, 400), "equal": 7, "heavy": r.choice((1, 2, 90_000))}[kind]), k, r.getrandbits(64)) for k in range(300)]
        flight, done = mixing.Flight(), []
        for n, u in enumerate(units, 1):
            done += flight.push(*u)
            taken = {k: s for s, k in done}
            between = {x[2]: x[0] for x in flight.pool}
            assert len(flight.pool) <= 2 and set(taken) | set(between) == set(range(n)) and not set(taken) & set(between)
            assert set(taken.values()) <= {0, 1} and all(0 < q < 1 for q in between.values())
            now = taken | between
            assert sum(now.values()) == pytest.approx(p * n, abs=1e-5)
            assert sum(now[k] * units[k][1] for k in range(n)) == pytest.approx(sum(p * u[1] for u in units[:n]), rel=1e-7, abs=1e-3)


def test_the_flight_keeps_inclusion_probabilities():
    """Over many draws, each unit is taken about so often as its probability says (units left between count by what they have)."""
    r = random.Random(1)
    sizes, total = [r.randrange(1, 50) for _ in range(12)], np.zeros(12)
    for _ in range(4000):
        flight, done = mixing.Flight(), []
        for k, s in enumerate(sizes):
            done += flight.push(0.3, float(s), k, r.getrandbits(64))
        for s, k in [*done, *((x[0], x[2]) for x in flight.pool)]:
            total[k] += s
    assert np.abs(total / 4000 - 0.3).max() < 0.03


def best(units):
    """Least distance of the size of any subset to what the probabilities expect, and then of its number."""
    size, count = sum(p * s for p, s in units), sum(p for p, _ in units)
    ways = [(abs(sum(s for (_, s), k in zip(units, way, strict=True) if k) - size), abs(sum(way) - count)) for way in product((0, 1), repeat=len(units))]
    near = min(w[0] for w in ways)
    return near, min(c for w, c in ways if w <= near + 0.5)


def test_landing_is_the_best_subset():
    r = random.Random(2)
    for _ in range(60):
        units = [(r.random(), float(r.choice((1, 5, r.randrange(1, 900))))) for _ in range(r.randrange(0, 11))]
        landed = mixing.land([(p, s, k, 0) for k, (p, s) in enumerate(units)])
        assert sorted(k for _, k in landed) == list(range(len(units)))
        way = {k: t for t, k in landed}
        off = abs(sum(way[k] * s for k, (_, s) in enumerate(units)) - sum(p * s for p, s in units))
        near, count = best(units)
        assert off <= near + 0.5 + 1e-9 and abs(sum(way.values()) - sum(p for p, _ in units)) == pytest.approx(count)


def test_small_sources_are_mixed_as_well_as_can_be(spark):
    """Sources of so few documents that all of them land: whole repeats, and the subset that brute force finds no better than."""
    r = random.Random(3)
    docs = [(k, f"s{k % 9}" if k % 10 else None, r.choice((0, 1, 4, r.randrange(2, 200)))) for k in range(90)]
    sizes = {}
    for _, s, n in docs:
        sizes[s] = sizes.get(s, 0) + n
    want = filled(sizes)
    df = spark.createDataFrame([(k, " ".join(["w"] * n), s) for k, s, n in docs], "doc_id bigint, text string, source string")
    found = {x.id: x for x in mixing.mix(df).collect()}
    assert {k: (x["size"], x.source, x.source_size) for k, x in found.items()} == {k: (n, s, sizes[s]) for k, s, n in docs}
    for s in sizes:
        ratio = want[s] / sizes[s]
        whole = int(ratio + 1e-9)
        units = [(ratio - whole, n) for _, x, n in docs if x == s and n] if ratio - whole > 1e-9 else []
        assert all(x.taken in (whole * x["size"], (whole + 1) * x["size"]) for x in found.values() if x.source == s)
        off = abs(sum(x.taken for x in found.values() if x.source == s) - want[s])
        assert off <= best(units)[0] + 0.5 + 1e-6


def test_names_of_sources_bound_what_is_sent(spark, monkeypatch):
    df = spark.createDataFrame([(k, "w " * k, f"s{k % 4}" if k % 5 else None) for k in range(60)], "doc_id bigint, text string, source string")
    rows = sorted(map(tuple, mixing.mix(df).collect()), key=str)
    monkeypatch.setattr(mixing, "SMALL_NAMES", 1)
    assert sorted(map(tuple, mixing.mix(df).collect()), key=str) == rows


def test_targets_of_odd_and_empty_tables(spark):
    assert mixing.targets(none(spark).select("source", F.lit(1).cast("long").alias("size"))).collect() == []
    found = {x.source: x for x in mixing.targets(odd(spark).select("source", F.lit(0).cast("long").alias("size"))).collect()}
    assert {s: (x.n, x.source_size, x.target) for s, x in found.items()} == {None: (2, 0, 0.0), "s": (4, 0, 0.0), "t": (3, 0, 0.0)}

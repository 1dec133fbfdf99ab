"""Reply depths with circles, against brute force."""

import random

from fanflow.llm import quotes


def brute(up):
    """message -> depth; of each circle the least message is its first."""
    up = dict(up)
    for start in sorted(up):
        way, at = [], start
        while at is not None and at not in way:
            way.append(at)
            at = up[at]
        if at is not None:
            up[min(way[way.index(at) :])] = None
    depth = {}

    def of(m):
        if m not in depth:
            depth[m] = 0 if up[m] is None else 1 + of(up[m])
        return depth[m]

    return {m: of(m) for m in up}


def depths(spark, up):
    rows = [(*m, None if u is None else u) for m, u in up.items()]
    df = spark.createDataFrame(rows, "conv int, turn int, up struct<conv:int,turn:int>")
    return {(r.conv, r.turn): r.depth for r in quotes.depths(df).collect()}


def test_a_reply_into_a_circle_comes_after_it(spark):
    up = {(2, 0): (3, 0), (3, 0): (2, 0), (1, 0): (2, 0), (4, 0): (1, 0), (0, 0): (4, 0)}
    assert depths(spark, up) == brute(up) == {(2, 0): 0, (3, 0): 1, (1, 0): 1, (4, 0): 2, (0, 0): 3}


def test_random_reply_graphs(spark):
    for seed in range(3):
        r = random.Random(seed)
        up = {(k, 0): r.choice([None, (r.randrange(60), 0), (r.randrange(60), 0), (r.randrange(60), 0)]) for k in range(60)}
        tail = {(100 + k, 0): (100 + (k + 1) % 40, 0) if k != 39 else (100 + 20, 0) for k in range(40)}  # ids grow towards a long circle
        rows = up | tail | {(200 + k, 0): (200 + k - 1, 0) if k else (119, 0) for k in range(30)}
        got = depths(spark, rows)
        assert got == brute(rows)
        first = [m for m, d in got.items() if d == 0]
        assert all(got[m] > got[rows[m]] for m in rows if rows[m] is not None and m not in first)


def test_turns_that_are_no_numbers(spark):
    turns = spark.createDataFrame([("a", "x", "user", "hello there my friend"), ("a", "y", "user", "> hello there my friend\nindeed"), ("a", "7", "user", "seven"), ("a", "8", "user", "eight")], "conv_id string, turn string, role string, text string")
    got = {r.turn: (r.reply_turn, r.depth) for r in quotes.conversations(turns).collect()}
    assert got["8"] == ("7", 1) and got["7"] == (None, 0) and got["x"][0] is None and len(got) == 4

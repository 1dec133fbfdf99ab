"""The n-gram Jaccard join against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from test_operators import none, odd, words

from fanflow.llm import ngrams, sets, simhash


def brute(rows, likeness=0.9, size=3):
    """doc_id -> (n, component) of (doc_id, text) rows with distinct ids."""
    sets, root = {}, {}
    for key, text in rows:
        w = words(text)
        sets[key] = {" ".join(w[k : k + size]) for k in range(len(w) - size + 1)} or ({" ".join(w)} if w else set())
        root[key] = key
    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= round(100 * likeness) * (len(sets[a]) + len(sets[b]) - both):
                lo, hi = sorted((root[a], root[b]))
                root = {k: lo if r == hi else r for k, r in root.items()}
    return {k: (len(sets[k]), root[k]) for k in keys}


def found(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    return {r.doc_id: (r.n, r.component) for r in ngrams.jaccard_join(df, **more).collect()}


def corpus(r, n):
    """Texts with copies, near copies in chains, a passage that many share, and short ones."""
    vocabulary = [f"w{k}" for k in range(400)]
    passage = [r.choice(vocabulary) for _ in range(40)]
    texts = [[r.choice(vocabulary) for _ in range(r.choice((1, 2, 3, 5, 30, 90)))] for _ in range(n // 3)]
    while len(texts) < n:
        base = list(r.choice(texts))
        kind = r.random()
        if kind < 0.25:
            base = base + passage
        for _ in range(r.choice((0, 0, 1, 1, 2, 3)) if kind > 0.1 else 0):
            base[r.randrange(len(base))] = r.choice(vocabulary)
        texts.append(base)
    return [(k, " ".join(t)) for k, t in enumerate(texts)]


def test_join_matches_brute_force(spark):
    for seed in (1, 2):
        rows = corpus(random.Random(seed), 260)
        assert found(spark, rows) == brute(rows)


def test_crowded_groups_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(sets, "FEW", 2)
    rows = corpus(random.Random(3), 260)
    assert found(spark, rows) == brute(rows)
    r = random.Random(4)  # copies in long chains: the first is unlike the last, and the groups are large
    base, rows = [f"w{r.randrange(900)}" for _ in range(120)], []
    for k in range(150):
        base[r.randrange(len(base))] = f"w{r.randrange(900)}"
        rows.append((k, " ".join(base)))
    assert found(spark, rows) == brute(rows)


def test_documents_of_shared_lines_make_few_pairs(spark, monkeypatch):
    """Texts of 30 out of 60 lines, no two alike: pairs that are verified grow no faster than the texts."""
    seen = []
    whole = sets._verified
    monkeypatch.setattr(sets, "_verified", lambda pairs, *a: seen.append(pairs.count()) or whole(pairs, *a))
    r = random.Random(5)
    lines = [" ".join(f"l{k}x{r.randrange(50)}" for _ in range(8)) for k in range(60)]
    for n in (200, 400):
        rows = [(k, " ".join(r.sample(lines, 30))) for k in range(n)]
        assert {c for _, c in found(spark, rows).values()} == set(range(n))
    assert max(seen) <= 40


def test_similar_documents_of_shared_lines_make_few_pairs(spark, monkeypatch):
    """The same at five words and likeness 0.8, where whole sets are cut into quarters; no group of a part is large."""
    seen, large = [], []
    whole, dealt = sets._verified, sets._dealt
    monkeypatch.setattr(sets, "_verified", lambda pairs, *a: seen.append(pairs.count()) or whole(pairs, *a))
    monkeypatch.setattr(sets, "_dealt", lambda rooted: large.append(rooted.count()) or dealt(rooted))
    r = random.Random(8)
    lines = [" ".join(f"l{k}x{r.randrange(50)}" for _ in range(8)) for k in range(60)]
    for n in (200, 400):
        rows = [(k, " ".join(r.sample(lines, 30))) for k in range(n)]
        out = simhash.similar_documents(spark.createDataFrame(rows, "doc_id bigint, text string"))
        assert {x.component for x in out.collect()} == set(range(n))
    assert max(seen) <= 40 and sum(large) == 0


@pytest.mark.parametrize(("likeness", "each", "more"), [(0.9, 0.3, 8), (0.8, 1.4, 16)])
def test_any_two_alike_sets_share_a_part(spark, likeness, each, more):
    r = np.random.default_rng(6)
    rows = []
    for k, n in enumerate((1, 2, 9, 10, 11, 19, 20, 40, 100, 333, 1000)):
        base = r.integers(0, 2**62, n)
        swaps = int(n * (1 - likeness) / (1 + likeness) + 1e-9)  # as many as this likeness bears
        near = np.concatenate([base[swaps:], r.integers(0, 2**62, swaps)])
        drop = base[: max(1, int(np.ceil(likeness * n - 1e-9)))]
        rows += [(3 * k, sorted(base.tolist())), (3 * k + 1, sorted(near.tolist())), (3 * k + 2, sorted(drop.tolist()))]
    keys = Counter()
    of = {}
    for x in sets.parts(spark.createDataFrame(rows, "fp bigint, hashes array<bigint>"), likeness).collect():
        of.setdefault(x.fp, set()).add(x.k)
        keys[x.k] += 1
    for k in range(0, len(rows), 3):
        assert of[k] & of[k + 1] and of[k] & of[k + 2]
    assert all(len(of[k]) <= each * len(h) + more for k, h in rows)


def test_odd_rows(spark):
    out = ngrams.jaccard_join(odd(spark)).collect()
    assert len(out) == 9
    assert [(x.n, x.component) for x in out if x.doc_id == 4] == [(6, 4)] * 2
    assert {x.doc_id: (x.n, x.component) for x in out if x.doc_id in (1, 2, 3, 6, 7, 8)} == {1: (0, 1), 2: (0, 2), 3: (0, 3), 6: (1, 6), 7: (1, 7), 8: (1, 8)}
    assert [(x.n, x.component) for x in out if x.doc_id is None] == [(3, None)]
    assert ngrams.jaccard_join(none(spark)).collect() == []

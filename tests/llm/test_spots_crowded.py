"""SpotSigs' join where signatures are common to many texts, against brute force."""

import random

from fanflow.llm import spotsigs


def brute(spark, rows, least=0.8):
    df = spark.createDataFrame(rows, "doc_id int, text string")
    sets = {r.doc_id: set(r.signatures) for r in spotsigs.fingerprints(df).collect()}
    root = {k: k for k in sets}
    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both, all_ = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if all_ == 0 or both >= least * all_ - 1e-9:
                lo, hi = sorted((root[a], root[b]))
                root = {k: lo if r == hi else r for k, r in root.items()}
    return root


def found(spark, rows):
    return {r.doc_id: r.component for r in spotsigs.similar(spark.createDataFrame(rows, "doc_id int, text string")).collect()}


def line(r, k):
    return " ".join(f"the {r.choice('bcdfg')}{k}x{j} q{k}y{j}" for j in range(4))


def test_crowded_signatures_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "FEW", 2)
    r = random.Random(1)
    lines = [line(r, k) for k in range(14)]
    rows = [(k, " ".join(r.sample(lines, r.choice((1, 2, 3, 11, 12, 13))))) for k in range(90)]
    base = [line(r, 100 + k) for k in range(12)]
    for k in range(90, 130):  # a long chain: neighbours are alike, its ends are not
        base[r.randrange(12)] = line(r, 100 + k)
        rows.append((k, " ".join(base)))
    rows += [(130, "the cat"), (131, "the cat"), (132, ""), (133, None)]
    assert found(spark, rows) == brute(spark, rows)


def test_texts_of_shared_lines_verify_few_pairs(spark, monkeypatch):
    """Texts of 30 out of 60 lines, no two alike: pairs that reach the check of whole sets grow no faster than the texts."""
    seen = []
    whole = spotsigs._verified
    monkeypatch.setattr(spotsigs, "_verified", lambda pairs, *a: seen.append(pairs.count()) or whole(pairs, *a))
    r = random.Random(2)
    lines = [line(r, k) for k in range(60)]
    for n in (150, 300):
        rows = [(k, " ".join(r.sample(lines, 30))) for k in range(n)]
        assert found(spark, rows) == {k: k for k in range(n)}
    assert max(seen) <= 30

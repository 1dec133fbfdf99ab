"""The pipeline's near-duplicate step: SimHash links by pigeonhole blocks first, exact links between what these leave apart."""

import itertools
import random

import numpy as np
import pyarrow as pa
from test_operators import SF, words

import corpus_pipeline
from fanflow.llm import sets, simhash


def hashes(texts):
    """The five-word shingle hashes of each text, as a set."""
    out = []
    for _, h, cut, _ in sets._sets(5)(iter([pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])])):
        out += [set(h[cut[k] : cut[k + 1]].tolist()) for k in range(len(cut) - 1)]
    return out


def by_bits(held):
    """The SimHash of a set of hashes, bit by bit."""
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in held) > len(held))


def grouped(texts):
    """(smallest place that links reach, for each text; pairs that SimHash alone links)."""
    held = hashes(texts)
    marks, root, alone = [by_bits(h) for h in held], list(range(len(texts))), 0
    for a, b in itertools.combinations(range(len(texts)), 2):
        alike = len(held[a] & held[b]) >= 0.8 * len(held[a] | held[b])
        near = bool(held[a]) and bool(held[b]) and (marks[a] ^ marks[b]).bit_count() <= 2
        alone += near and not alike
        if alike or near:
            lo, hi = sorted((root[a], root[b]))
            root = [lo if v == hi else v for v in root]
    return root, alone


def texts():
    r = random.Random(6)
    out = [" ".join([*(f"{base}w{w}" for w in range(11)), f"end{k}"]) for base in range(12) for k in range(60)]  # seven of nine shingles in common: likeness 0.78
    base = [f"b{k}" for k in range(200)]
    out += [" ".join(f"c{w}" if w in edits else x for w, x in enumerate(base)) for edits in (set(r.sample(range(200), k)) for k in (0, 1, 2, 3, 90))]
    return [*out, "a b", "A  b", "a c", "", None, " "]


def test_fingerprints_of_sets_are_those_of_the_plain_way():
    r = np.random.default_rng(5)
    n = [0, 3, 1, 70_000, 0, 2, 65_536, 5, 0]
    cut = np.concatenate([[0], np.cumsum(n)])
    h = np.frombuffer(r.bytes(8 * cut[-1]), np.uint64)
    assert simhash.set_fingerprints(h, cut).tolist() == [by_bits(h[i:j].tolist()) for i, j in itertools.pairwise(cut)]
    assert len(simhash.set_fingerprints(h[:0], np.array([0]))) == 0


def test_near_documents_match_brute_force(spark, monkeypatch):
    docs = texts()
    root, alone = grouped(docs)
    assert alone > 3
    for few, pairwise in ((32, 1500), (2, 1)):
        monkeypatch.setattr(sets, "FEW", few)
        monkeypatch.setattr(simhash, "PAIRWISE", pairwise)
        found = simhash.near_documents(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"))
        assert {x.doc_id: x.component for x in found.collect()} == dict(enumerate(root))


def test_stage_goes_by_simhash_and_compares_only_what_it_leaves_apart(spark, monkeypatch):
    docs = texts()
    root, _ = grouped(docs)
    df = spark.createDataFrame([(k, t, "en", "s") for k, t in enumerate(docs)], "doc_id long, text string, lang string, source string")
    assert {r.doc_id for r in corpus_pipeline.keep_one_of_near_duplicates(spark, df, SF).collect()} == set(root)
    compared, verified = [], sets._verified
    monkeypatch.setattr(sets, "_verified", lambda pairs, *a: compared.append(pairs.count()) or verified(pairs, *a))
    long = [f"w{k}" for k in range(3000)]
    copies = [" ".join(x if w != at else "other" for w, x in enumerate(long)) for at in (None, 0, 2999)]
    assert (by_bits(hashes(copies[:1])[0]) ^ by_bits(hashes(copies[1:2])[0])).bit_count() <= 2 and len(words(copies[0])) == 3000
    rows = spark.createDataFrame(list(enumerate(copies)), "doc_id long, text string")
    assert {x.component for x in simhash.similar_documents(rows).collect()} == {x.component for x in simhash.near_documents(rows).collect()} == {0}
    assert compared[0] > compared[1]

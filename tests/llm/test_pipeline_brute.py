"""The pipeline from end to end: what each stage decides against brute force on whole tables, and the tables that a run leaves."""

import glob
import os
from collections import Counter

import pytest
from test_mixing_brute import filled
from test_operators import SF, brute_repeats, documents, words

import corpus_pipeline
from fanflow.llm import common


def shingles(text):
    w = words(text)
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())


def first_of_near_copies(docs):
    """{id: text} without documents that links of likeness 0.8 join to one of smaller id."""
    sets, root = {k: shingles(t) for k, t in docs.items()}, {k: k for k in docs}
    for a in sorted(docs):
        for b in sorted(docs):
            shared = len(sets[a] & sets[b])
            if b < a and (5 * shared >= 4 * (len(sets[a]) + len(sets[b]) - shared)):
                lo, hi = sorted((root[a], root[b]))
                root = {k: lo if r == hi else r for k, r in root.items()}
    return {k: t for k, t in docs.items() if root[k] == k}


def without_passages(docs):
    """{id: text} without characters that a repeated string of 256 bytes touches; texts of which nothing is left go."""
    cut, out = brute_marks([t.encode() for t in docs.values()], corpus_pipeline.PASSAGE_BYTES), {}
    for (k, t), gone in zip(docs.items(), cut, strict=True):
        at, left = 0, []
        for c in t:
            n = len(c.encode())
            if not any(gone[at : at + n]):
                left.append(c)
            at += n
        if left or not any(gone):
            out[k] = "".join(left)
    return out


def brute_marks(docs, length):
    seen, out = Counter(t[i : i + length] for t in docs for i in range(len(t) - length + 1)), []
    for t in docs:
        gone, upto = bytearray(len(t)), 0
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                upto = i + length
            if i < upto:
                gone[i:upto] = b"\1" * (upto - i)
        for i in range(max(0, len(t) - length + 1), upto):
            gone[i] = 1
        out.append(gone)
    return out


def holds(text, item):
    w, q = words(text), words(item)
    if not w or not q:
        return False
    if len(q) < 5:
        return any(w[k : k + len(q)] == q for k in range(len(w) - len(q) + 1))
    runs = {tuple(q[k : k + 5]) for k in range(len(q) - 4)}
    return 5 * len(runs & {tuple(w[k : k + 5]) for k in range(len(w) - 4)}) >= 4 * len(runs)


def test_marks_are_those_of_the_plain_way():
    docs = [b"abcabcabd" * 3, b"xyz", b"zzabcabq", b""]
    for length in (1, 3, 5):
        assert [sum(g) for g in brute_marks(docs, length)] == [r[1] for r in brute_repeats(docs, length)]


@pytest.fixture(scope="module")
def ran(spark, tmp_path_factory):
    """What each stage of one run gave, the rows of the mix, and the folders that the run left."""
    shared, kept = str(tmp_path_factory.mktemp("shared")), {}

    def watched(name, stage):
        def run(spark, docs, sf_dir):
            out = stage(spark, docs, sf_dir)
            kept[name] = out.collect()
            return out

        return name, run

    with pytest.MonkeyPatch.context() as m:
        m.setattr(corpus_pipeline, "STAGES", [watched(*s) for s in corpus_pipeline.STAGES])
        m.setattr(common, "shared_dir", lambda spark: shared)
        rows = corpus_pipeline.run(spark, SF).collect()
    return kept, rows, sorted(os.path.basename(f).rsplit("-", 1)[0] for f in glob.glob(f"{shared}/*"))


def test_stages_decide_as_brute_force_does(spark, ran):
    kept, rows, _ = ran
    plain = lambda name: {r.doc_id: r.text for r in kept[name]}
    all_docs = {r.doc_id: r.text for r in documents(spark).collect()}
    said = plain("language_id")
    assert said.items() <= all_docs.items() and all(any(c.isalpha() for c in t) for t in said.values())
    single = first_of_near_copies(said)
    assert plain("simhash_near_dedup") == single and len(single) < len(said)
    cut = without_passages(single)
    assert plain("suffix_array_dedup") == cut and cut != single
    assert all(r.n_chars == len(r.text) for r in kept["suffix_array_dedup"])
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {k: t for k, t in cut.items() if not any(holds(t, q) for q in items)}
    assert plain("decontaminate") == clean and len(clean) < len(cut)
    assert all(len(kept[n]) == len({r.doc_id for r in kept[n]}) for n in kept)
    source = {r.doc_id: r.source for r in kept["decontaminate"]}
    sizes = Counter()
    for k, t in clean.items():
        sizes[source[k]] += len(words(t))
    want, taken = filled(dict(sizes)), Counter()
    for r in rows:
        assert r.text == clean[r.doc_id] and r["size"] == len(words(r.text)) and 0 < r.taken == r.repeats * r["size"] <= 3 * r["size"]
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.02 * want[s] + 30 for s in sizes)


def test_a_run_leaves_only_what_its_rows_are_read_from(ran):
    left = Counter(ran[2])
    assert left["decontaminate"] == 1 and {n for n in left if not n.startswith("mix-")} == {"decontaminate"}

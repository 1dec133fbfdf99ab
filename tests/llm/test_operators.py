"""Operators against brute force, and their rows for nulls, empty texts, repeats, empty tables and clashing columns."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from conftest import same_rows
from pyspark.sql import functions as F

import corpus_pipeline
from fanflow.llm import decontaminate, hmm, language, mixing, quality, quotes, sets, simhash, spotsigs, suffixes, urls
from fanflow.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
ODD = [(1, None, None, None), (2, "", "en", "s"), (3, " \t\n", "en", None), (4, "the cat sat on the mat and slept", "en", "s"), (4, "the cat sat on the mat and slept", "en", "s"), (None, "la niña y el gato", "es", "s"), (6, "the cat", None, "t"), (7, "日本語 " * 3, "ja", "t"), (8, "word " * 30000, "en", "t")]
SCHEMA = "doc_id bigint, text string, lang string, source string"


def odd(spark):
    """Rows with every awkward value, and columns named like the operators' own."""
    df = spark.createDataFrame(ODD, SCHEMA)
    return df.withColumns({c: F.lit("x") for c in ("id", "mark", "h", "f", "fp", "key", "range", "hash", "label", "score", "size", "taken", "component", "train")})


def none(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet")


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    ours, theirs = same_rows(spark, QUERIES[name], ORACLES[name], SF)
    assert ours == theirs


def linked(fps, distance=2):
    root = list(range(len(fps)))
    for a, b in itertools.combinations(range(len(fps)), 2):
        if (fps[a] ^ fps[b]).bit_count() <= distance:
            x, y = root[a], root[b]
            root = [min(x, y) if r in (x, y) else r for r in root]
    return root


def test_simhash_matches_brute_force(spark):
    rows = {r.doc_id: r.text for r in documents(spark).collect()}
    brute = {}
    for k, text in rows.items():
        w = words(text)
        h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))] if w else []
        brute[k] = sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))
    ids = sorted(brute)
    root = linked([brute[k] for k in ids])
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op10_simhash"](spark, SF).collect()}
    assert found == {k: (f"{brute[k]:016x}", ids[root[n]]) for n, k in enumerate(ids)}


@pytest.mark.parametrize("pairwise", [1500, 1])
@pytest.mark.parametrize("distance", [1, 2])
def test_simhash_links(spark, monkeypatch, pairwise, distance):
    monkeypatch.setattr(simhash, "PAIRWISE", pairwise)
    r = random.Random(1)
    base = [r.getrandbits(64) for _ in range(12)]
    fps = sorted({b ^ sum(1 << r.randrange(64) for _ in range(r.randint(0, 3))) & 2**64 - 1 for b in base for _ in range(12)})
    signed = [x - 2**64 if x >> 63 else x for x in fps]
    edges = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp bigint"), distance)
    found = {x.a: x.root for x in simhash.components(edges).collect()}
    root = linked(fps, distance)
    groups = lambda key: sorted(map(sorted, ([x for x in signed if key(x) == k] for k in {key(x) for x in signed})))
    assert groups(lambda x: found.get(x, x)) == groups(lambda x: root[signed.index(x)])


def test_simhash_odd_rows(spark):
    found = sorted(((r.doc_id, r.fp, r.component) for r in simhash.near_duplicates(odd(spark)).collect()), key=str)
    assert len(found) == len(ODD) and {c for i, f, c in found if i in (1, 2, 3)} == {1}
    assert [c for i, _, c in found if i == 4] == [4, 4] and [c for i, _, c in found if i is None] == [None]
    assert simhash.near_duplicates(none(spark)).count() == 0


@pytest.mark.parametrize(("few", "part_rows"), [(32, 1024), (2, 4)])
def test_similar_documents_match_brute_force(spark, monkeypatch, few, part_rows):
    monkeypatch.setattr(sets, "FEW", few)
    monkeypatch.setattr(sets, "PART_ROWS", part_rows)
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    docs = []
    for _ in range(8):
        base = [word() for _ in range(300)]
        docs += [" ".join(word() if at in edits else w for at, w in enumerate(base)) for edits in (set(r.sample(range(300), k)) for k in (0, 0, 1, 2, 3, 60, 90))]
    docs += ["a b", "A  b", "a c", "", None, " "]
    shingle = lambda t: {tuple(w[i : i + min(5, len(w))]) for w in [words(t)] for i in range(max(1, len(w) - 4)) if w}
    held = [shingle(t) for t in docs]
    root = list(range(len(docs)))
    for a, b in itertools.combinations(range(len(docs)), 2):
        if held[a] == held[b] or len(held[a] & held[b]) >= 0.8 * len(held[a] | held[b]):
            x, y = root[a], root[b]
            root = [min(x, y) if v in (x, y) else v for v in root]
    found = simhash.similar_documents(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"))
    assert {x.doc_id: x.component for x in found.collect()} == dict(enumerate(root))


@pytest.mark.parametrize("few", [32, 1])
def test_similar_documents_at_just_the_likeness(spark, monkeypatch, few):
    monkeypatch.setattr(sets, "FEW", few)
    docs = []
    for k, n in itertools.product(range(40), (8, 24, 49)):  # 4, 20 and 45 shingles, and a quarter more or just over
        base = [f"{n}x{k}y{w}" for w in range(n)]
        docs += [" ".join(base), " ".join([*base, *(f"{n}z{k}z{w}" for w in range((n - 4) // 4))]), " ".join([*base, *(f"{n}v{k}v{w}" for w in range((n - 4) // 4 + 1))])]
    found = {x.doc_id: x.component for x in simhash.similar_documents(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")).collect()}
    assert found == {d: d - d % 3 if d % 3 < 2 else d for d in range(len(docs))}


def test_similar_documents_odd_rows(spark):
    found = sorted(((r.doc_id, r.component) for r in simhash.similar_documents(odd(spark)).collect()), key=str)
    assert len(found) == len(ODD) and {c for i, c in found if i in (1, 2, 3)} == {1}
    assert [c for i, c in found if i == 4] == [4, 4] and [c for i, c in found if i is None] == [None]
    assert simhash.similar_documents(none(spark)).count() == 0


@pytest.mark.parametrize("sent", [1_500_000, 0])
def test_near_duplicate_stage_odd_rows(spark, monkeypatch, sent):
    monkeypatch.setattr(corpus_pipeline, "SENT_ROWS", sent)
    long = [f"w{k}" for k in range(200)]
    more = [(4, " ".join(long), "en", "s"), (9, " ".join([*long[:-1], "other"]), "en", "s"), (None, " ".join([*long, "more"]), "en", "s"), (9, "another text", "en", "s")]
    docs = odd(spark).select("doc_id", "text", "lang", "source", "id", "key", "size")
    added = spark.createDataFrame(more, SCHEMA).withColumns({c: F.lit("x") for c in ("id", "key", "size")})
    kept = corpus_pipeline.keep_one_of_near_duplicates(spark, docs.unionByName(added), SF)
    assert kept.columns == docs.columns
    texts = {(i, t) for i, t, *_ in [*ODD, more[0], more[3]] if i not in (2, 3)}
    assert sorted(((x.doc_id, x.text) for x in kept.collect()), key=str) == sorted(texts, key=str)
    assert corpus_pipeline.keep_one_of_near_duplicates(spark, none(spark), SF).count() == 0


def test_words_are_told_apart_by_more_than_a_polynomial(spark):
    """Thue-Morse words and their complements collide under polynomials modulo 2^64."""
    word = "a"
    while len(word) < 2048:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    docs = spark.createDataFrame([(1, word, True), (2, f"{other} {word}", False)], "doc_id long, text string, learn boolean")
    assert {r.doc_id: r.n_known for r in hmm.score(docs, "learn").collect()} == {1: 2, 2: 2}
    items = spark.createDataFrame([(7, other)], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontaminate.contained(docs, items).collect()] == [(2, 7)]
    texts = [x + y for x, y in ((word[:1024], "x" * 50), (other[:1024], "y" * 50), (word[:1024], "z" * 50))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, bytes(x.kept)) for x in suffixes.without_repeats(df).collect()}
    assert [found[k] for k in range(3)] == brute_repeats([t.encode() for t in texts], 400)


def test_many_rows_without_an_id_stay_apart(spark):
    """Rows of one id are told apart by 64 bits of their text."""
    n = 100_000
    df = spark.range(n).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.sha2(F.col("id").cast("string").cast("binary"), 256), F.when(F.col("id") % 1000 == 0, F.repeat(F.lit("shared passage "), 40)).otherwise("")).alias("text"))
    found = suffixes.without_repeats(df).withColumn("left", F.length("kept")).groupBy("n_bytes", "n_spans").agg(F.count(F.lit(1)).alias("n"), F.min("left").alias("least"), F.max("left").alias("most")).collect()
    by = {r.n_bytes: r for r in found}  # some of the digests before the passage end alike, in a byte or a few
    assert len(found) == 2 and (by[64].n, by[64].n_spans, by[64].least) == (n - 100, 0, 64)
    assert (by[664].n, by[664].n_spans) == (100, 1) and 60 <= by[664].least <= by[664].most <= 64


def test_stages_with_odd_rows(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").filter("length(text) > 200").first().text
    passage = " ".join(f"word{k}" for k in range(80))
    more = [(4, f"before {item} after", "en", "s"), (20, f"one {passage}", "en", "s"), (21, f"two {passage} end", "en", "t"), (None, item, "en", "s")]
    extra = lambda df: df.withColumns({c: F.lit("x") for c in ("id", "mark", "hash", "rest", "kept", "key", "range", "label", "score", "component", "train")})
    docs = extra(spark.createDataFrame([*ODD, *more], SCHEMA))
    plain = lambda df: sorted((tuple(r) for r in df.select("doc_id", "text").collect()), key=str)
    for stage in (corpus_pipeline.identify_language, corpus_pipeline.cut_repeats, corpus_pipeline.drop_contaminated, corpus_pipeline.mix_sources):
        assert stage(spark, extra(none(spark)), SF).count() == 0
    said = corpus_pipeline.identify_language(spark, docs, SF)
    assert said.columns == docs.columns and plain(said) == sorted(((i, t) for i, t, *_ in [*ODD, *more] if i not in (1, 2, 3)), key=str)
    clean = corpus_pipeline.drop_contaminated(spark, docs, SF)
    assert clean.columns == docs.columns and plain(clean) == sorted(((i, t) for i, t, *_ in [*ODD, *more[1:3]]), key=str)
    cut = corpus_pipeline.cut_repeats(spark, clean, SF)
    assert cut.columns == docs.columns
    left = dict(plain(cut.filter("doc_id in (1, 20, 21)")))
    assert left[1] in (None, "") and len(left[20]) < 5 and len(left[21]) < 9
    mixed = corpus_pipeline.mix_sources(spark, clean, SF).collect()
    assert all(0 < r.taken <= 3 * r.size and r.repeats == r.taken // r.size for r in mixed) and sum(r.doc_id == 4 for r in mixed) <= 2
    plan = mixing.mix(clean).collect()
    assert abs(sum(r.taken for r in plan) - sum(r.taken for r in mixed)) <= max(r["size"] for r in plan)
    same = spark.createDataFrame([(5, "a b c", "en", "s")] * 40 + [(6, "d e", "en", "t")], SCHEMA)
    mixed = corpus_pipeline.mix_sources(spark, same, SF).collect()
    assert sum(r.doc_id == 5 for r in mixed) <= 40


def brute_repeats(docs, length):
    seen = Counter(t[i : i + length] for t in docs for i in range(len(t) - length + 1))
    out = []
    for t in docs:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), sum(gone), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)), kept))
    return out


@pytest.mark.parametrize("crowd", [50_000, 3])
def test_suffixes_match_brute_force(spark, monkeypatch, crowd):
    r = random.Random(crowd)
    base = ["".join(r.choice("ab é") for _ in range(r.randint(50, 400))) for _ in range(6)]
    docs = []
    for _ in range(60):
        parts = []
        for _ in range(r.randint(0, 5)):
            b = r.choice(base)
            a = r.randint(0, len(b))
            parts.append(b[a : r.randint(a, len(b))] + "xy" * r.choice([0, 0, 0, r.randint(1, 80)]))
        docs.append("".join(parts))
    whole = suffixes.repeated
    monkeypatch.setattr(suffixes, "repeated", lambda d, i, t, n: whole(d, i, t, n, gram=8, crowd=crowd))
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    found = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, bytes(x.kept)) for x in suffixes.without_repeats(df, length=40).collect()}
    assert [found[k] for k in range(60)] == brute_repeats([d.encode() for d in docs], 40)


def test_op6_matches_brute_force(spark):
    rows = sorted(documents(spark).collect(), key=lambda r: r.doc_id)
    brute = brute_repeats([r.text.encode() for r in rows], 400)
    found = {x.doc_id: tuple(x)[1:] for x in QUERIES["op6_suffix_dedup"](spark, SF).collect()}
    assert found == {r.doc_id: (*b[:3], hashlib.sha256(b[3]).hexdigest()) for r, b in zip(rows, brute, strict=True)}


def test_suffixes_odd_rows(spark):
    twice = spark.createDataFrame([(1, "a" * 500), (1, "a" * 500), (None, "b" * 300), (3, None)], "doc_id bigint, text string")
    found = sorted(((x.doc_id, x.n_bytes, x.n_removed) for x in suffixes.without_repeats(twice).collect()), key=str)
    assert found == [(1, 500, 500), (1, 500, 500), (3, 0, 0), (None, 300, 0)]
    assert suffixes.without_repeats(none(spark)).count() == 0 and suffixes.without_repeats(odd(spark)).count() == len(ODD)


def test_language(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in documents(spark, sf).collect()}
    rows = [r for r in QUERIES["op7_language_id"](spark, sf).collect() if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    assert sum(r.lang_pred == truth[r.doc_id] for r in rows) > 0.97 * len(rows)
    model = language.fit(odd(spark))
    found = [(r.doc_id, r.lang_pred, r.score) for r in language.identify(odd(spark), model).collect()]
    assert {p for i, p, _ in found if i in (1, 2, 3)} == {"und"} and dict((i, p) for i, p, _ in found)[7] == "ja"
    assert all(0 <= s <= 1 for _, _, s in found) and len(found) == len(ODD)
    assert language.fit(none(spark)) == {} and language.identify(odd(spark), {}).filter("lang_pred <> 'und'").count() == 0


def test_language_matches_brute_force(spark):
    table, at = language._symbol_table(), language._letters(1024).astype(np.int64)

    def profile(text):
        s = [0]
        for c in text or "":
            if (x := int(table[ord(c)])) or s[-1]:
                s.append(x)
        s += [0] if s[-1] else []
        grams = list(zip(s, s[1:], s[2:], strict=False))
        return sum((at[0][a] * at[1][b] * at[2][c] for a, b, c in grams), np.zeros(1024)), len(grams)

    rows = [r for r in documents(spark).collect() if len(r.text) < 1500]
    more = [(-1, "", None), (-2, None, None), (-3, "12 --", None), (-4, "éé ß日 本", "xx"), (-5, "a", "xx")]
    texts = {r.doc_id: (r.text, r.lang) for r in rows} | {k: (t, lang) for k, t, lang in more}
    sums = {}
    for text, lang in texts.values():
        v, n = profile(text)
        if lang and n:
            sums[lang] = sums.get(lang, 0) + v / n
    names = sorted(sums)
    unit = np.array([sums[k] / np.linalg.norm(sums[k]) for k in names])
    df = spark.createDataFrame([(k, t, lang) for k, (t, lang) in texts.items()], "doc_id long, text string, lang string")
    for r in language.identify(df, language.fit(df)).collect():
        v, n = profile(texts[r.doc_id][0])
        cosine = unit @ v / (np.linalg.norm(v) or 1)
        if not any(c.isalpha() for c in texts[r.doc_id][0] or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.score == pytest.approx(max(0.0, cosine.max()), abs=1e-3) and cosine[names.index(r.lang_pred)] == pytest.approx(cosine.max(), abs=1e-3)


def test_attention_matches_brute_force():
    r = np.random.default_rng(5)
    model, passages = quality.Attention(), np.array([1, 3, 2])
    x = r.normal(size=(6, quality.FEATURES))
    model.p = {k: r.normal(size=v.shape) * 0.3 for k, v in model.p.items()}
    said, at = model.forward(x, passages)["score"], 0
    sigmoid = lambda v: 1 / (1 + math.exp(-v))
    for n, score in zip(passages, said, strict=True):
        h = [[math.tanh(sum(max(-8, min(8, v)) * w for v, w in zip(row, col, strict=True)) + b) for col, b in zip(model.p["W"].T, model.p["b"], strict=True)] for row in x[at : at + n]]
        gated = [sum(w * math.tanh(float(np.dot(v, model.p["V"][:, k]))) * sigmoid(float(np.dot(v, model.p["U"][:, k]))) for k, w in enumerate(model.p["w"])) for v in h]
        weight = [math.exp(e) / sum(map(math.exp, gated)) for e in gated]
        whole = [sum(a * v[k] for a, v in zip(weight, h, strict=True)) for k in range(len(h[0]))]
        assert score == pytest.approx(sigmoid(sum(c * v for c, v in zip(model.p["c"], whole, strict=True)) + model.p["d"][0]), rel=1e-9)
        at += n


def test_language_stage_keeps_short_texts(spark):
    docs = documents(spark)
    short = ["Avec.", "A.", "Ok.", "Re.", "For " * 200, "123", "".join(map(chr, range(0x4E00, 0x4F00))), None]
    more = spark.createDataFrame([(-k, t, "en", "s") for k, t in enumerate(short, 1)], SCHEMA)
    few = documents(spark).select("doc_id", "text", F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("lang"), "source").unionByName(more.withColumn("lang", F.lit(None).cast("string")))
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, few, SF).collect()}
    assert {k for k in kept if k < 0} == {-1, -2, -3, -4, -5} and len(kept) > 0.98 * docs.count()


def test_quality(spark):
    sf = "/root/testdata/sf0.01"
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op2_quality"](spark, sf).collect() if r.held_out and r.doc_id in label]
    assert sum(r.predicted == label[r.doc_id] for r in rows) > 0.93 * len(rows)
    few = spark.createDataFrame([(4, 1), (4, 1), (8, 0), (99, 0), (None, 1), (2, None)], "doc_id bigint, quality int")
    model = quality.fit(odd(spark), few)
    for m in (model, None):
        found = quality.score(odd(spark), m).collect()
        assert len(found) == len(ODD) and all(0 <= r.score <= 1 for r in found)
    assert quality.fit(odd(spark), few.filter("quality = 1")) is None
    assert quality.score(none(spark), None).count() == 0


def test_attention_gradient():
    r = np.random.default_rng(0)
    x, passages, y = r.normal(size=(9, quality.FEATURES)), np.array([2, 4, 3]), np.array([1.0, 0, 1])
    model, weight = quality.Attention(), np.ones(3)
    loss = lambda: -float(np.mean(y * np.log(model.forward(x, passages)["score"]) + (1 - y) * np.log(1 - model.forward(x, passages)["score"])))
    for k, g in model.gradient(x, passages, y, weight).items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        model.p[k][at] += 1e-5
        up = loss()
        model.p[k][at] -= 2e-5
        down = loss()
        model.p[k][at] += 1e-5
        assert g[at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-7)


def test_mixing(spark):
    rows = QUERIES["op3_mixing"](spark, SF).collect()
    docs = {r.doc_id: r for r in documents(spark).collect()}
    size = Counter()
    for r in docs.values():
        size[r.source] += len(words(r.text))
    names = sorted(size)
    weight = {s: (5, 2, 1)[n % 3] for n, s in enumerate(names)}
    target, free, rest = {}, set(names), float(sum(size.values()))
    while True:
        level = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if level[s] > 3 * size[s]}
        if not over:
            target |= level
            break
        target |= {s: 3.0 * size[s] for s in over}
        free -= over
        rest -= sum(3.0 * size[s] for s in over)
    taken = Counter()
    for r in rows:
        assert r.size == len(words(docs[r.doc_id].text)) and r.taken <= 3 * r.size and r.source_size == size[docs[r.doc_id].source]
        assert r.target == pytest.approx(target[docs[r.doc_id].source])
        taken[docs[r.doc_id].source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 0.02 * target[s] + 30 for s in names)
    again = mixing.mix(documents(spark).repartition(7))
    assert sorted((r.id, r.taken) for r in again.collect()) == sorted((r.doc_id, r.taken) for r in rows)


def test_mixing_blocks_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 16)
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', cast(1 + id % 37 as int))").alias("text"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"))
    for r in mixing.mix(df).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect():
        assert abs(r.taken - r.target) <= 5
    found = mixing.mix(odd(spark)).collect()
    assert len(found) == len(ODD) and all(r.taken <= 3 * r.size for r in found)
    assert mixing.mix(none(spark)).count() == 0


def test_decontaminate_edges(spark):
    items = spark.createDataFrame([(1, "the cat sat on the mat and slept"), (2, "THE  cat"), (3, None), (4, " "), (5, "nothing of the kind is here at all"), (6, "la niña y el")], "item_id int, text string")
    found = sorted(((r.doc_id, r.item_id, r.shared, r.shingles) for r in decontaminate.contained(odd(spark), items).collect()), key=str)
    assert found == sorted([(4, 1, 4, 4), (4, 1, 4, 4), (4, 2, 1, 1), (4, 2, 1, 1), (6, 2, 1, 1), (None, 6, 1, 1)], key=str)
    assert decontaminate.contained(none(spark), items).count() == 0
    assert decontaminate.contained(odd(spark), items.limit(0)).count() == 0


def test_decontaminate_finds_scattered_and_edited_items(spark):
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    items, docs, want = [], [], set()
    for k in range(40):
        item = [word() for _ in range(r.randint(12, 60))]
        items.append((k, " ".join(item)))
        text = [word() for _ in range(4000)]
        cut, at = r.randint(5, len(item) - 5), r.randint(0, 1900)
        text[at : at + cut], text[at + 2000 : at + 2000 + len(item) - cut] = item[:cut], item[cut:]
        docs.append((k, " ".join(text)))
        shingle = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
        if len(shingle(item) & shingle(text)) >= 0.8 * len(shingle(item)):
            want.add((k, k))
    df, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {(x.doc_id, x.item_id) for x in decontaminate.contained(df, q).collect()} == want and len(want) > 20


def test_spotsigs_edges(spark):
    rows = spotsigs.fingerprints(odd(spark)).collect()
    assert len(rows) == len(ODD) and all(r.signatures == [] for r in rows if r.doc_id in (1, 2, 3))
    assert {tuple(r.signatures) for r in rows if r.doc_id == 4} == {("^ cat sat", "and slept", "on mat slept", "the cat sat", "the mat slept")}
    nexts = spotsigs.with_next(odd(spark).select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "doc_id", [], [])
    assert {(r.doc_id, r.next_text) for r in nexts.collect() if r.doc_id in (8, 7, None)} == {(8, "日本語 " * 3), (7, "the cat"), (None, "word " * 30000)}


@pytest.mark.parametrize("few, least", [(16, 0.8), (2, 0.8), (2, 0.5)])
def test_spotsigs_components_match_brute_force(spark, monkeypatch, few, least):
    monkeypatch.setattr(spotsigs, "FEW", few)
    r, names = random.Random(3), [f"word{n}" for n in range(60)]
    base = [r.choice([*names, "the", "of", "is"]) for _ in range(150)]
    copies = []
    for n in range(40):  # chains of edits, so that some are linked only through others
        copies.append(" ".join(base))
        for _ in range(r.choice((0, 3, 9))):
            base[r.randrange(150)] = r.choice(names)
    made = spark.createDataFrame([(5000 + n, t) for n, t in enumerate(copies)] + [(5001, copies[1]), (None, copies[2]), (None, "the lone row of no id")], "doc_id bigint, text string")
    df = documents(spark).select("doc_id", "text").unionByName(made).unionByName(odd(spark).select("doc_id", "text"))
    sets = [(x.doc_id, frozenset(x.signatures)) for x in spotsigs.fingerprints(df).collect()]
    alike = lambda x, y: x == y or len(x & y) >= least * len(x | y) - 1e-9
    root = {x: x for _, x in sets}
    for x, y in itertools.combinations(list(root), 2):
        if x and y and alike(x, y) and root[x] is not root[y]:
            gone = root[y]
            root = {k: root[x] if v is gone else v for k, v in root.items()}
    lowest = {}
    for k, x in sets:
        if k is not None:
            lowest[root[x]] = min(lowest.get(root[x], k), k)
    found = spotsigs.similar(df, least=least).collect()
    assert Counter((x.doc_id, x.component) for x in found) == Counter((k, lowest.get(root[x])) for k, x in sets)
    assert len(set(lowest.values())) < len(root)


def test_spotsigs_similar_edges(spark):
    found = spotsigs.similar(odd(spark)).collect()
    assert sorted((x.doc_id or 0, x.component or 0) for x in found) == [(0, 0), (1, 1), (2, 1), (3, 1), (4, 4), (4, 4), (6, 6), (7, 7), (8, 8)]
    assert spotsigs.similar(none(spark)).count() == 0


def test_hmm_base_and_likelihood(spark, monkeypatch):
    monkeypatch.setattr(hmm, "FREQUENT", 300)
    rows = QUERIES["op9_hmm"](spark, SF).collect()
    tokens = {r.doc_id: [*words(r.text), None] for r in documents(spark).collect()}
    c = Counter(w for k, v in tokens.items() if zlib.crc32(str(k).encode()) % 7 != 2 for w in v)
    total, types = sum(c.values()), len(c)
    for r in rows:
        v = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(v), sum(c[w] > 0 for w in v), total)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (total + types + 1)) for w in v), rel=1e-9)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_hmm_forward_is_exact_and_counts_add_up():
    r = np.random.default_rng(1)
    rows = lambda *s: (lambda x: x / x.sum(-1, keepdims=True))(r.random(s))
    model = hmm.Model(rows(hmm.STATES), rows(hmm.STATES, hmm.STATES), rows(hmm.STATES, hmm.CLASSES))
    sequences = [np.array([5, 9, 3]), np.array([0]), np.array([7, 7])]
    for s, said in zip(sequences, hmm._likelihood(model, sequences), strict=True):
        total = sum(model.start[p[0]] * model.emit[p[0], s[0]] * math.prod(model.move[p[t - 1], p[t]] * model.emit[p[t], s[t]] for t in range(1, len(s))) for p in itertools.product(range(hmm.STATES), repeat=len(s)))
        assert said == pytest.approx(math.log10(total))
    counts = hmm._expected(model, sequences)
    assert counts[: hmm.STATES].sum() == pytest.approx(3) and counts[hmm.STATES + hmm.STATES**2 :].sum() == pytest.approx(6)
    assert counts[hmm.STATES : hmm.STATES + hmm.STATES**2].sum() == pytest.approx(3)


def test_hmm_edges(spark):
    found = hmm.score(odd(spark).withColumn("learn", F.col("doc_id") > 3), "learn").collect()
    assert len(found) == len(ODD) and all(r.n_tokens == 1 for r in found if r.doc_id in (1, 2, 3)) and all(r.score < 0 for r in found)
    assert all(r.train_tokens == 0 and r.n_known == 0 for r in hmm.score(odd(spark).withColumn("learn", F.lit(False)), "learn").collect())
    assert hmm.score(none(spark).withColumn("learn", F.lit(True)), "learn").count() == 0


def test_hmm_every_round_sees_all_rows(spark, monkeypatch):
    seen, whole = [], hmm._summed
    monkeypatch.setattr(hmm, "_summed", lambda rows, of: (seen.append(rows.count()), whole(rows, of))[1])
    n = 9000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("word w"), F.col("id") % 7).alias("text"), F.lit(True).alias("learn"))
    assert hmm.score(docs, "learn").count() == n and seen == [n] * hmm.ROUNDS


def test_urls(spark):
    rows = [("HTTP://A.Example.COM/en/7x?q", "a.example.com", "/en/7x", "example.com/en/7"), ("http://b.com/en/1", "b.com", "/en/1", "com/en/"), ("x://net/de/", "net", "/de/", "net/de/"), ("http://example.net/de/8#f", "example.net", "/de/8", "example.net/de/8"), ("http://notnet/de/", "notnet", "/de/", None), ("nothing", "", "", None), (None, "", "", None), ("", "", "", None), ("http://q.org?x=/es/", "q.org", "", None), ("a://b://c/d", "b:", "//c/d", None), ("http://b.com/en/1", "b.com", "/en/1", "com/en/")]
    pages = spark.createDataFrame([(n, r[0], "<p>the cat</p>" if n % 2 else None, "x") for n, r in enumerate(rows)], "page_id int, url string, html string, host string")
    said = {r.url: (r.host, r.path, r.rule) for r in urls.judge(pages).collect()}
    assert said == {r[0]: r[1:] for r in rows}
    verdicts = dict(urls.RULES and [(rule, v) for v, rule in urls.RULES])
    assert all(r.verdict == verdicts[r.rule] for r in urls.judge(pages).collect() if r.rule)
    assert urls.judge(pages.limit(0)).count() == 0
    assert {r.verdict for r in urls.judge(pages.filter("url is null or url = ''")).collect()} == {"allow"}


def test_viterbi_matches_all_splits():
    counts = {"the": 9, "then": 3, "hen": 2, "ce": 1, "t": 1}
    total = sum(counts.values())
    cost = {w: -math.log(c / total) for w, c in counts.items()}
    price = lambda parts: sum(cost.get(p, math.log(total + 1) + math.log(10) * len(p)) for p in parts)
    for name in ("thence", "thethen", "xthe", "q"):
        splits = [[name[a:b] for a, b in itertools.pairwise((0, *cuts, len(name)))] for n in range(len(name)) for cuts in itertools.combinations(range(1, len(name)), n)]
        assert price(urls.viterbi(name, cost, total)) == pytest.approx(min(map(price, splits)))


def test_long_names_and_words(spark):
    word = "donaudampfschifffahrtsgesellschaftskapitaensmuetze"
    pages = spark.createDataFrame([(1, f"http://{word}haus.com/en/{'abcde' * 10_000}", f"<p>{word} haus {word}</p>")], "page_id int, url string, html string")
    counts = urls.page_words(pages)
    names = spark.createDataFrame([(word + "haus",), ("abcde" * 10_000,)], "name string")
    assert {r.name: r.parts for r in urls.segments(names, counts).collect()} == {word + "haus": [word, "haus"], "abcde" * 10_000: ["abcde" * 10_000]}
    assert urls.judge(pages).first().verdict == "block"


def test_naive_bayes_matches_brute_force(spark):
    found = QUERIES["op1_url_filter"](spark, SF).collect()
    html = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    c = Counter(w for h in html for w in re.split(r"[^\W\d_]+".join(["(", ")"]), re.sub("<[^>]*>", " ", h).lower())[1::2])
    total = sum(c.values())
    cost = {w: -math.log(n / total) for w, n in c.items()}

    def parts(of, text):
        for name in re.findall(r"[^\W\d_]+|\d+", text.lower()):
            yield from (f"{of}:{w}" for w in (urls.viterbi(name, cost, total) if name[0].isalpha() else [f"#{len(name)}"]))

    tokens = {r.page_id: [*parts("h", r.host), *parts("p", r.path)] for r in found}
    by = {v: Counter(t for r in found if r.rule and r.verdict == v for t in tokens[r.page_id]) for v in ("block", "allow")}
    prior = {v: sum(1 for r in found if r.rule and r.verdict == v) for v in by}
    v = len({t for x in tokens.values() for t in x})
    odds = lambda t: math.log((by["block"][t] + 1) / (by["block"].total() + v + 1)) - math.log((by["allow"][t] + 1) / (by["allow"].total() + v + 1))
    for r in found:
        assert r.score == pytest.approx(math.log((prior["block"] + 1) / (prior["allow"] + 1)) + sum(map(odds, tokens[r.page_id])), abs=1e-6)


def test_quotes(spark):
    rows = [(1, 0, "user", "Hello there.\nHow are you?"), (1, 1, "assistant", "On Monday A wrote:\n> How   are YOU?\nFine, thanks."), (1, 2, "user", "> On Monday A wrote:\n>> How are you?\n> Fine, thanks.\nGood."), (2, 0, "user", "> Good.\nWhy good?"), (3, 0, None, None), (None, 0, "user", "x"), (3, None, "user", "> nothing known"), (3, 0, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("own", F.lit(1))
    found = [tuple(r) for r in quotes.conversations(df).drop("formatted", "depth").collect()]
    assert len(found) == len(rows) and {f[3] for f in found if f[0] in (1, 2)} == {1}
    assert {(f[0], f[1], f[5], f[6], f[7], f[8], f[9]) for f in found if f[0] in (1, 2)} == {(1, 0, None, None, 0, 0, "Hello there.\nHow are you?"), (1, 1, 1, 0, 1, 1, "Fine, thanks."), (1, 2, 1, 1, 3, 2, "Good."), (2, 0, 1, 2, 1, 1, "Why good?")}
    assert quotes.conversations(df.limit(0)).count() == 0
    rows = QUERIES["op8_quotes"](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/conversations.parquet").count()


def test_quotes_of_passages_that_the_least_conversation_says_itself(spark):
    rows = [(1, 0, "user", "> Thanks.\nThanks."), (5, 3, "user", "Thanks."), (7, 2, "user", "Thanks."), (7, 4, "user", "> Thanks.\nNo."), (9, 0, "user", "> Thanks.\nYes."), (None, 1, "user", "> Thanks.")]
    found = {(r.conv_id, r.turn): (r.reply_conv, r.reply_turn, r.linked) for r in quotes.conversations(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()}
    assert found == {(1, 0): (5, 3, 1), (5, 3): (None, None, 0), (7, 2): (None, None, 0), (7, 4): (7, 2, 1), (9, 0): (1, 0, 1), (None, 1): (1, 0, 1)}


def brute_replies(rows):
    """(original, depth) of each message by dictionaries: rows (conv, turn, text), conv and turn not null and distinct."""
    read = {(c, t): quotes.parse(x) for c, t, x in rows}
    up = {}
    for (c, t), (_, passages) in read.items():
        found = []
        for n, (level, passage) in enumerate(passages):
            best = None
            for rank, h in enumerate(quotes.passage_hashes(passage)):
                said = sorted(k for k, (own, _) in read.items() if h in quotes.passage_hashes(own))
                here = [k for k in said if k[0] == c and k[1] < t]
                there = [k for k in said if k[0] != c]
                best = min([x for x in [best, (0, rank, here[0]) if here else None, (1, rank, there[0]) if there else None] if x], default=None)
            if best:
                found.append((-level, n, best[2]))
        before = [k for k in read if k[0] == c and k[1] < t]
        up[c, t] = max(found)[2] if found else max(before, default=None)
    first = set()
    for k in up:
        seen, at = [], k
        while at is not None and at not in seen:
            seen.append(at)
            at = up[at]
        if at is not None:
            first.add(min(seen[seen.index(at) :]))
    depth = {}
    for k in up:
        n, at = 0, k
        while at not in first and up[at] is not None:
            n, at = n + 1, up[at]
        depth[k] = n
    return up, depth


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_quotes_match_brute_force(spark, kind):
    r = random.Random(8)
    said = [f"This is remark {k}." for k in range(30)]
    rows = [(c, t, "\n".join([*(f"> {r.choice(said)}" for _ in range(r.choice([0, 0, 1]))), *r.sample(said, 1), *(["A common line."] if c % 2 else ["> A common line."])])) for c in range(1, 25) for t in range(0, r.randint(1, 9), r.choice([1, 2]))]
    df = spark.createDataFrame(rows, f"conv_id bigint, turn int, text string").withColumn("conv_id", F.col("conv_id").cast(kind) if kind == "bigint" else F.format_string("c%03d", "conv_id")).withColumn("role", F.lit(None).cast("string"))
    number = int if kind == "bigint" else lambda c: int(c[1:])
    up, depth = brute_replies(rows)
    found = {(number(x.conv_id), x.turn): x for x in quotes.conversations(df).collect()}
    assert {k: x.reply_conv and (number(x.reply_conv), x.reply_turn) for k, x in found.items()} == up
    assert {k: x.depth for k, x in found.items()} == depth
    for whole in {x.conversation for x in found.values()}:
        members = sorted((k for k, x in found.items() if x.conversation == whole), key=lambda k: (depth[k], k))
        assert [found[k].position for k in members] == list(range(1, len(members) + 1))
    assert all(found[k].position > found[v].position for k, v in up.items() if v is not None and depth[k])


def test_replies_in_a_circle(spark):
    rows = [(1, 0, "> b\na"), (2, 0, "> a\nb"), (3, 0, "> b\nc"), (3, 7, "d")]
    found = {(x.conv_id, x.turn): (x.depth, x.position, x.reply_conv) for x in quotes.conversations(spark.createDataFrame(rows, "conv_id long, turn int, text string").withColumn("role", F.lit("user"))).collect()}
    assert found == {(1, 0): (0, 1, 2), (2, 0): (1, 2, 1), (3, 0): (2, 3, 2), (3, 7): (3, 4, 3)}


def test_pipeline(spark):
    docs, sizes = documents(spark), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.written(stage(spark, docs, SF), "test")
        assert sorted(out.columns) == sorted(docs.columns)
        sizes.append((docs.count(), out.count()))
        docs = out
    assert all(b <= a for a, b in sizes) and sizes[-1][1] > 100
    texts = [r.text.encode() for r in docs.collect()]
    assert sum(b[1] for b in brute_repeats(texts, 400)) == 0
    assert decontaminate.contained(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert all(0 < r.taken <= 3 * r.size and r.repeats == r.taken // r.size for r in mixed)

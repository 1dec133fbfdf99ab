"""Cross-tokenizer alignment against brute force."""

import hashlib
import random
from collections import Counter
from functools import cache

import numpy as np
from test_operators import none, odd

from fanflow.llm import align

COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
TEXTS = ["Hello world, don't stop", " leading  spaces\n\tand tabs ", "naïve café — “quotes” …", "日本語のテキスト", "😀 emoji ‍ joined", "<|endoftext|> and <s> </s>", "ﬁ ligature", "a▁b", "x" * 300, "\x00 nul \x7f", "123456 7.89", "", None, "é", "é", " nbsp em", "\U0001d4d0 bold"]


@cache
def tokenizers():
    return align._both(align.TOKENIZERS)


def aligned(text):
    """Tokens of a text by both tokenizers' own files, groups and links, by loops; None without tokens."""
    if not text:
        return None
    a, b = tokenizers()
    byte_of, raw = align._byte_of(), (" " + text).encode()
    ids = [a.slow.encode(" " + text, add_special_tokens=False).ids, b.model.encode(text)]
    model = b.model
    parts = [[bytes(byte_of[c] for c in a.slow.id_to_token(i)) for i in ids[0]], [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]]]
    if any(b"".join(p) != raw for p in parts):
        return None
    ends = [np.cumsum([len(x) for x in p]).tolist() for p in parts]
    spans = [list(zip([0, *e], e, strict=False)) for e in ends]
    groups, links, at = [], [], 0
    for (s, e), i in zip(spans[0], ids[0], strict=True):
        while spans[1][at][1] <= s:
            at += 1
        k = at
        while k < len(spans[1]) and spans[1][k][0] < e:
            links.append((i, ids[1][k]))
            k += 1
    for cut in sorted(set(ends[0]) & set(ends[1])):
        before = groups[-1][2] if groups else 0
        groups.append(tuple([i for (_, e), i in zip(spans[n], ids[n], strict=True) if before < e <= cut] for n in (0, 1)) + (cut,))
    text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y, _ in groups)
    return len(ids[0]), len(ids[1]), len(groups), hashlib.sha256(text.encode()).hexdigest(), links


def brute(texts):
    each = [aligned(t) for t in texts]
    counts, most = Counter(link for x in each if x for link in x[4]), {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    return [(x[0], x[1], x[2], len(x[4]), sum(counts[k] == most[k[1]] for k in x[4]), sum(counts[k] for k in x[4]), x[3]) if x else (0, 0, 0, 0, 0, 0, "") for x in each]


def test_align_matches_brute_force(spark):
    r = random.Random(1)
    texts = [*TEXTS, *("".join(r.choice("ab cde \n'.é1ß") for _ in range(r.randrange(200))) for _ in range(60))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(3)
    want = dict(enumerate(brute(texts)))
    assert {x.doc_id: tuple(x[c] for c in COLUMNS) for x in align.align(df).collect()} == want
    rows = align.aligned(df).persist()
    table = align.token_map(rows)
    by_shuffle = align.scored(rows, table, 0).collect()
    assert {x.id: tuple(x[c] for c in COLUMNS) for x in by_shuffle} == want
    assert any(w[0] == 0 for t, w in zip(texts, want.values(), strict=True) if t) and sum(w[0] > 0 for w in want.values()) > 60


def test_fast_encoder_agrees_on_every_stable_character():
    a = tokenizers()[0]
    chars = [chr(n) for n in np.flatnonzero(a.stable).tolist()]
    assert len(chars) > 40_000
    for k in range(0, len(chars), 500):
        text = "".join(f" a{c}b1{c} {c}{c}\n" for c in chars[k : k + 500])
        assert a.fast.encode_ordinary(text) == a.slow.encode(text, add_special_tokens=False).ids


def test_pointers_reach_the_terminal_of_any_chain():
    for n in (1, 2, 3, 64, 1000):  # ends that never meet before the last
        a, b = np.append(np.arange(2, 2 * n, 2), 2 * n), np.append(np.arange(1, 2 * n, 2), 2 * n)
        marks = [np.zeros(2 * n, bool) for _ in "ab"]
        marks[0][a - 1], marks[1][b - 1] = True, True
        label_a, label_b = align.groups(a, b, *(np.cumsum(m) - m for m in marks))
        assert set(label_a) | set(label_b) == {0}


def test_odd_rows(spark):
    out = align.align(odd(spark)).collect()
    assert len(out) == 9 and [x.n_a > 0 for x in out if x.doc_id in (1, 2)] == [False, False]
    assert len({tuple(x) for x in out if x.doc_id == 4}) == 1 and sum(x.doc_id is None for x in out) == 1
    assert [x.groups_sha256 for x in out if x.doc_id == 1] == [""]
    assert align.align(none(spark)).collect() == []

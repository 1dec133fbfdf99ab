"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from fanflow.llm.common import lower_ascii, mix64, pieces, ragged, range_hashes, tokens, written

WORDS, LIKENESS, PERMUTATIONS = 5, 0.8, 32
#: Characters of benchmark text that one pass over the documents looks for.
BLOCK_CHARS = 16_000_000
_SIFT_BITS = 20


def shingles(data: np.ndarray, offsets: np.ndarray, words: int, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of so many words, A-Z lower-cased, and the number of them in each text; whole: shorter texts are one run."""
    low = lower_ascii(data)
    starts, ends, first = tokens(low, offsets)
    h = range_hashes(low, starts, ends)
    n = np.diff(first)
    if whole and len(n) == 1 and 0 < n[0] < words:
        words = int(n[0])
    runs = np.maximum(0, n - words + 1)
    text, place = ragged(runs)
    at = first[:-1][text] + place
    out = np.zeros(len(at), np.uint64)
    for k in range(words):
        out = out + h[at + k] * np.uint64(pow(0x9E3779B97F4A7C15, 2 * k + 1, 2**64) | 1)
    return mix64(out), runs


def exact_shingles(text: str | None, words: int) -> set[bytes]:
    """The distinct runs of so many words themselves, A-Z lower-cased; a text of fewer words has none."""
    low = lower_ascii(np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)).tobytes()
    split = low.replace(b"\x0b", b" ").replace(b"\x0c", b" ").split()
    return {b" ".join(split[k : k + words]) for k in range(len(split) - words + 1)}


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(5)
    return r.integers(0, 2**63, n, np.uint64), r.integers(0, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1)


class Index:
    """MinHash signatures of items, apart by words of a shingle and by size: class c holds items of 2^c to 2^(c+1)-1 shingles.

    A document is cut into runs of 2^c shingles for class c, so an item and the run that it lies in are of like size and
    share a minimum under one of the permutations almost surely, however long the document is. An item at containment
    0.8 of any spread over neighbouring runs has Jaccard likenesses with them that sum to 0.4 at least, so that all of
    32 permutations miss it less than once in 100,000 times.
    """

    def __init__(self, items: list[tuple[object, str]], words: int = WORDS, permutations: int = PERMUTATIONS):
        self.items: list[tuple[object, np.ndarray, str]] = []
        groups: dict[int, dict[int, list[int]]] = {}
        for key, text in items:
            raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
            low = tokens(raw, np.array([0, len(raw)]))
            size = min(words, len(low[0]))
            if size:
                h = np.unique(shingles(raw, np.array([0, len(raw)]), words, True)[0])
                groups.setdefault(size, {}).setdefault(int(len(h)).bit_length() - 1, []).append(len(self.items))
                self.items.append((key, h, text))
        self.xor, self.odd = _seeds(permutations)
        self.groups = {size: dict(sorted(by.items())) for size, by in groups.items()}
        self.minima = {(size, c): [self._signatures(ids, k) for k in range(permutations)] for size, by in self.groups.items() for c, ids in by.items()}

    def _signatures(self, ids: list[int], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted minima under permutation k, the item of each, and a table that sifts other values by their top bits."""
        m = np.array([((self.items[i][1] ^ self.xor[k]) * self.odd[k]).min() for i in ids], np.uint64)
        order = np.argsort(m, kind="stable")
        sift = np.zeros(2**_SIFT_BITS // 8, np.uint8)
        top = m >> np.uint64(64 - _SIFT_BITS)
        np.bitwise_or.at(sift, (top >> np.uint64(3)).astype(np.int64), (1 << (top & np.uint64(7)).astype(np.uint8)).astype(np.uint8))
        return m[order], np.array(ids)[order], sift

    def candidates(self, size: int, h: np.ndarray, runs: np.ndarray) -> set[tuple[int, int]]:
        """(text, item) pairs that share a minimum, for texts laid end to end with so many shingles each."""
        found: set[tuple[int, int]] = set()
        text, place = ragged(runs)
        levels = list(self.groups[size])
        cuts, owners = [], []
        for c in levels:
            first = np.flatnonzero(place & ((1 << c) - 1) == 0)
            cuts.append(first)
            owners.append(text[first])
        inner = [cuts[0], *(np.searchsorted(a, b) for a, b in zip(cuts, cuts[1:], strict=False))]
        for k in range(len(self.xor)):
            v = (h ^ self.xor[k]) * self.odd[k]
            for level, c in enumerate(levels):
                v = np.minimum.reduceat(v, inner[level])
                minima, ids, sift = self.minima[size, c][k]
                top = v >> np.uint64(64 - _SIFT_BITS)
                maybe = np.flatnonzero(sift[(top >> np.uint64(3)).astype(np.int64)] >> (top & np.uint64(7)).astype(np.uint8) & 1)
                lo, hi = np.searchsorted(minima, v[maybe], "left"), np.searchsorted(minima, v[maybe], "right")
                for run, a, b in zip(maybe[hi > lo], lo[hi > lo], hi[hi > lo], strict=True):
                    found.update((int(owners[level][run]), int(i)) for i in ids[a:b])
        return found


def contained(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", words: int = WORDS, likeness: float = LIKENESS) -> DataFrame:
    """(id_col, item_col, shared, shingles, containment) of each document row and item row with shared / shingles >= likeness.

    shingles is the number of an item's distinct runs of five words (words: runs of bytes other than x20 and x09-x0D,
    A-Z lower-cased), shared how many of them the whole document has. An item of fewer words is one run of all its
    words. Items and documents that are null, empty or blank match nothing; repeated rows match each on its own; item ids
    may have any type. The documents are read once for each block of BLOCK_CHARS characters of items, one block after
    another, and are not shuffled or collected. Pairs found by hashes are verified by the shingles themselves.
    """
    kinds = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, {item_col} {items.schema[item_col].dataType.simpleString()}, shared bigint, shingles bigint, containment double"
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out, blocks = None, _blocks(items, item_col, item_text, words)
    for passes, index in blocks:
        found = rows.mapInArrow(_search(index, likeness, [id_col, item_col], items.schema[item_col].dataType), kinds)
        found = written(found, "leaks") if passes > 1 else found
        out = found if out is None else out.unionByName(found)
    return out


def without_items(docs: DataFrame, items: DataFrame, text_col: str = "text", item_text: str = "text", words: int = WORDS, likeness: float = LIKENESS) -> DataFrame:
    """The rows of docs, all columns, that hold no item in the sense of contained(); each row is judged by itself, not by its id.

    Rows aren't shuffled or joined. Null and empty texts stay, and an empty table of items takes nothing.
    """
    for passes, index in _blocks(items.withColumn("_item", F.lit(0)), "_item", item_text, words):

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for b, data, offsets in pieces(batches, text_col):
                clean = np.ones(b.num_rows, bool)
                clean[[hit[0] for hit in _hits(index, likeness, b.column(text_col), data, offsets)]] = False
                yield b.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
        docs = written(docs, "leaks") if passes > 1 else docs
    return docs


def _blocks(items: DataFrame, item_col: str, item_text: str, words: int) -> Iterator[tuple[int, Index]]:
    """The number of passes, and the index of each block of about BLOCK_CHARS characters of items: the driver holds one at a time."""
    chars = items.agg(F.sum(F.char_length(item_text))).first()[0] or 0
    passes = max(1, -(-chars // BLOCK_CHARS))
    for n in range(passes):
        block = items.filter(F.col(item_text).isNotNull() & (F.pmod(F.xxhash64(F.col(item_text)), F.lit(passes)) == n)).select(item_col, item_text)
        yield passes, Index(sorted(((r[0], r[1]) for r in block.collect()), key=lambda x: (str(x[0]), x[1])), words)


def _hits(index: Index, likeness: float, texts: pa.Array, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(text, item, shared, shingles) of verified pairs: hashes first, and where they say yes the shingles themselves."""
    hits = []
    for size in index.groups:
        h, runs = shingles(data, offsets, size, False)
        if not len(h):
            continue
        to = np.cumsum(runs)
        own: dict[int, tuple[np.ndarray, set[bytes]]] = {}
        for text, item in sorted(index.candidates(size, h, runs)):
            if text not in own:
                own = {text: (np.unique(h[to[text] - runs[text] : to[text]]), set())}
            hashes, whole = own[text]
            _, wanted, item_text = index.items[item]
            place = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
            if int((hashes[place] == wanted).sum()) >= likeness * len(wanted) - 1e-9:
                if not whole:
                    whole |= exact_shingles(texts[text].as_py(), size)
                item_set = exact_shingles(item_text, size)
                shared = len(item_set & whole)
                if shared >= likeness * len(item_set) - 1e-9:
                    hits.append((text, item, shared, len(item_set)))
    return hits


def _search(index: Index, likeness: float, names: list[str], item_kind: DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = to_arrow_type(item_kind)
        for b, data, offsets in pieces(batches, "text"):
            hits = _hits(index, likeness, b.column("text"), data, offsets)
            if hits:
                text, item, shared, of = zip(*hits, strict=True)
                keys = [index.items[i][0] for i in item]
                ids = b.column("id").take(pa.array(text))
                yield pa.RecordBatch.from_arrays([ids, pa.array(keys, kind), pa.array(shared, pa.int64()), pa.array(of, pa.int64()), pa.array(np.array(shared) / np.array(of))], [*names, "shared", "shingles", "containment"])

    return run


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item: doc_id, item_id, shared, shingles, containment."""
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return contained(docs, items)


_WORDS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"
OP5_SQL = f"""
WITH i AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
iw AS (SELECT row_number() OVER () AS item, item_id, w, least(5, len(w)) AS k FROM i WHERE len(w) > 0),
s AS (SELECT DISTINCT item, item_id, k, array_to_string(w[p:p + k - 1], ' ') AS g FROM iw, unnest(range(1, len(w) - k + 2)) AS u(p)),
d AS (SELECT row_number() OVER () AS doc, doc_id, {_WORDS} AS w FROM documents),
g AS (SELECT DISTINCT doc, doc_id, k, array_to_string(w[p:p + k - 1], ' ') AS g
      FROM d, (SELECT DISTINCT k FROM iw) AS ks, unnest(range(1, len(w) - k + 2)) AS u(p) WHERE len(w) >= k),
n AS (SELECT item, count(*) AS shingles FROM s GROUP BY item)
SELECT doc_id, item_id, count(*) AS shared, any_value(shingles) AS shingles, count(*) / any_value(shingles)::DOUBLE AS containment
FROM g JOIN s USING (k, g) JOIN n USING (item) GROUP BY doc, doc_id, item, item_id HAVING count(*) >= 0.8 * any_value(shingles) - 1e-9
"""

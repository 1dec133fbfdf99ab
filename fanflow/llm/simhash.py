"""SimHash near-duplicates: fingerprints of word shingles, linked through pigeonhole blocks and verified by Hamming distance; shingle sets that these leave apart by exact likeness."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fanflow.llm.common import written
from fanflow.llm.components import components
from fanflow.llm.sets import distinct_sets, join_links, named, prefixes

#: Bits of the fingerprint, and the parts it is cut into; pairs at distance d agree on PARTS - d parts at least.
BITS, PARTS = 64, 4
#: Block groups up to this size are compared pair by pair; larger ones take the path by one-bit neighbours.
PAIRWISE = 1500


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """64-bit SimHash: a bit is set if it is set in over half the shingles' XXH64; 0 without words."""
    split = (text or "").encode().lower().split()
    if not split:
        return 0
    joined = b" ".join(split)
    if len(split) <= words:
        return xxhash.xxh64_intdigest(joined, seed)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(gaps[: len(split) - words] + 1).tolist()]
    ends = [*gaps[words - 1 :].tolist(), len(joined)]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[s:e], seed) for s, e in zip(starts, ends, strict=True)), np.uint64, len(starts))
    total = np.zeros(BITS, np.int64)
    for at in range(0, len(h), 65536):
        part = h[at : at + 65536].view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(total * 2 > len(h), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, seed: int = 42) -> DataFrame:
    """One row (id, fp: long, the fingerprint's bits) for each row of docs; null and empty texts have fp 0."""
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), words, seed) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind.simpleString()}, fp long")


def set_fingerprints(h: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """The 64-bit SimHash of each set h[cut[k] : cut[k + 1]] of shingle hashes: a bit is set if it is set in over half of them; 0 for none."""
    n = np.diff(cut)
    some = np.flatnonzero(n)
    starts, votes = cut[some], np.zeros((len(n), BITS), np.int64)
    for at in range(0, len(h), 65536):
        part = np.unpackbits(h[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        lo, hi = np.searchsorted(starts, at, "right") - 1, np.searchsorted(starts, at + len(part), "left")
        votes[some[lo:hi]] += np.add.reduceat(part, np.maximum(starts[lo:hi] - at, 0), axis=0, dtype=np.int32)
    return np.packbits(votes * 2 > n[:, None], axis=1, bitorder="little").view(np.uint64).reshape(-1)


def _linked(fps: np.ndarray, distance: int) -> np.ndarray:
    """For each fingerprint of one block group the smallest place it reaches by links within the group."""
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= distance
    label = np.arange(len(fps))
    while True:
        new = np.where(near, label[None, :], len(fps)).min(1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def links(fps: DataFrame, distance: int = 2) -> DataFrame:
    """Edges (a, b) that connect exactly the distinct fingerprints (fp: long) that chains of pairs within distance connect.

    The fingerprint is cut into PARTS parts. A pair within distance agrees on PARTS - distance of them, so each
    fingerprint goes to one block for each choice of so many parts, and only block mates are compared. A block group
    gives a spanning set of verified links, never all its pairs. Groups over PAIRWISE are passed on whole to an exact
    path that makes no pairs: every fingerprint goes to each point within half the distance, points that several
    reach link them, and that takes a fixed number of rows for each.
    """
    if distance not in (1, 2):
        raise ValueError("distance must be 1 or 2")
    width = BITS // PARTS
    part = [F.shiftrightunsigned("fp", width * k).bitwiseAND(F.lit(2**width - 1)) for k in range(PARTS)]
    keys = [F.struct(F.lit(n).alias("n"), sum((part[k] * F.lit(2 ** (width * j)) for j, k in enumerate(ks)), F.lit(0)).alias("v")) for n, ks in enumerate(combinations(range(PARTS), PARTS - distance))]
    blocks = fps.select("fp").distinct().select("fp", F.explode(F.array(*keys)).alias("k")).select("k.n", "k.v", "fp")
    sizes = blocks.groupBy("n", "v").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    mates = blocks.join(sizes, ["n", "v"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def close(fps: list[int]) -> pa.RecordBatch:
            x = np.array(fps, np.int64).view(np.uint64)
            label = _linked(x, distance)
            some = label != np.arange(len(x))
            return pa.RecordBatch.from_arrays([pa.array(x[some].view(np.int64)), pa.array(x[label[some]].view(np.int64))], ["a", "b"])

        for b in batches:
            for n, v, fp in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (n, v) != key:
                    if len(held) > 1:
                        yield close(held)
                    key, held = (n, v), []
                held.append(fp)
        if len(held) > 1:
            yield close(held)

    small = mates.filter(F.col("size") <= PAIRWISE).select("n", "v", "fp").repartition("n", "v").sortWithinPartitions("n", "v")
    edges = small.mapInArrow(compare, "a long, b long")
    one_off = F.array(F.lit(0), *(F.lit(2**k if k < 63 else -(2**63)) for k in range(BITS)))
    crowded = mates.filter(F.col("size") > PAIRWISE).select("fp").distinct()
    reach = crowded.select("fp", F.explode(one_off).alias("bit")).select("fp", F.col("fp").bitwiseXOR(F.col("bit")).alias("point"))
    if distance == 1:  # a point that is itself a fingerprint, reached from one bit away
        met = reach.join(crowded.select(F.col("fp").alias("point")), "point").select(F.col("fp").alias("a"), F.col("point").alias("b"))
    else:
        meet = reach.groupBy("point").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("c")).filter("c > 1")
        met = reach.join(meet, "point").select(F.col("fp").alias("a"), "b")
    return edges.unionByName(met.filter("a <> b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, seed: int = 42, distance: int = 2) -> DataFrame:
    """One row for each row of docs: (id_col, fp: long, component: the smallest id that links reach, itself included).

    Fingerprints within distance bits link, equal ones too; texts that are null, empty or blank have fingerprint 0
    and link like any other. Null ids keep their row and are never the smallest unless all ids of a component are
    null. Rows with equal ids stay separate rows. Other columns of docs are not read.
    """
    fps = written(fingerprints(docs, id_col, text_col, words, seed), "simhash-fp")
    distinct = written(fps.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    return named(fps, distinct, components(links(distinct, distance))).withColumnRenamed("id", id_col)


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, likeness: float = 0.8) -> DataFrame:
    """One row for each row of docs: (id_col, fp: long key of the shingle set, component: the smallest id that links reach).

    Documents whose sets of five-word shingles have a Jaccard likeness of 0.8 or more link, all of them and no others:
    candidates come from an exact prefix filter and are verified by their whole sets (see sets.join_links(); shingles and
    sets are told apart by 64-bit hashes). Texts without words link with each other only. Null ids, equal ids and other
    columns are as in near_duplicates(). docs is read up to four times.
    """
    rows = written(prefixes(docs, id_col, text_col, words, likeness), "simhash-prefixes")
    distinct = written(distinct_sets(rows), "simhash-distinct")
    roots = components(join_links(distinct, docs, text_col, words, likeness))
    return named(rows.select("id", "fp"), distinct.select("fp", "least"), roots).withColumnRenamed("id", id_col)


def set_links(distinct: DataFrame, distance: int = 2) -> DataFrame:
    """Edges (a, b) between sets of distinct (fp: key, n, mark: SimHash) whose SimHashes chains of pairs within distance bits connect.

    Sets of equal SimHash meet the one of least key; sets without shingles have no SimHash.
    """
    marked = distinct.filter("n > 0").select("fp", "mark")
    first = written(marked.groupBy("mark").agg(F.min("fp").alias("first")), "simhash-marks")
    same = marked.join(first, "mark").select(F.col("fp").alias("a"), F.col("first").alias("b")).filter("a <> b")
    near = links(first.select(F.col("mark").alias("fp")), distance)
    one, two = (first.select(F.col("mark").alias(c), F.col("first").alias(f"set_{c}")) for c in "ab")
    return same.unionByName(near.join(one, "a").join(two, "b").select(F.col("set_a").alias("a"), F.col("set_b").alias("b")))


def near_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, likeness: float = 0.8, distance: int = 2) -> DataFrame:
    """One row for each row of docs: (id_col, fp: long key of the shingle set, component: the smallest id that links reach).

    Documents link if the 64-bit SimHashes of their sets of five-word shingles differ by distance bits at most: all such pairs,
    through the pigeonhole blocks of links(). That reaches few pairs near likeness 0.8, which differ by some ten bits, so an
    exact check follows between the components that SimHash leaves: sets of a Jaccard likeness of 0.8 or more link as in
    similar_documents(), and pairs within a component are not compared again. A SimHash counts a set's shingles once each, so
    that a line repeated in a text does not outvote the rest of it. Texts without words link with each other only. Null ids,
    equal ids and other columns are as in near_duplicates(). docs is read up to four times.
    """
    rows = written(prefixes(docs, id_col, text_col, words, likeness, set_fingerprints), "simhash-prefixes")
    distinct = written(distinct_sets(rows), "simhash-distinct")
    known = written(components(set_links(distinct, distance)), "simhash-known")
    roots = components(join_links(distinct, docs, text_col, words, likeness, known))
    return named(rows.select("id", "fp"), distinct.select("fp", "least"), roots).withColumnRenamed("id", id_col)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns for all documents: doc_id, fingerprint (16 hex digits), component_id."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))

"""Sets of word n-grams and the exact links among them: rare-first prefixes, parts of whole sets, each pair verified once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fanflow.llm.common import mix64, pieces, ragged, signed, written
from fanflow.llm.components import components
from fanflow.llm.decontaminate import shingles

#: Counters (a power of 2) that tell how often n-grams occur, and how many of them one row holds.
COUNTERS, BLOCK = 2**22, 2**14
#: Ranges of hashes by which a set's n-grams are counted, for sets of any size.
RANGES = 64
#: Groups of an n-gram up to this size give their pairs; larger ones are cut by parts first.
FEW = 32
#: Parts that would have fewer n-grams than this are joined and cut into quarters.
WHOLE_PART = 6
#: Keys of sets that one broadcast may hold (about 100 MB).
SENT = 1_500_000
#: Largest set whose counts by range are exact, so that a block compares them.
COUNTED = 1_000_000
#: Sets in a block of a large group, and about as many n-grams.
PART_ROWS, PART_SHINGLES = 1024, 4_000_000


def _sets(words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]]:
    """Of batches with a text: (slice, shingle hashes by text in ascending order without repeats, offsets, key of each set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for b, data, offsets in pieces(batches, "text"):
            h, runs = shingles(data, offsets, words, False)
            text = np.repeat(np.arange(b.num_rows), runs)
            for t in np.flatnonzero(runs == 0):
                short, _ = shingles(data[offsets[t] : offsets[t + 1]], np.array([0, offsets[t + 1] - offsets[t]]), words, True)
                h, text = np.append(h, short), np.append(text, np.full(len(short), t))
            order = np.lexsort((h, text))
            h, text = h[order], text[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
            h, text = h[new], text[new]
            n = np.bincount(text, minlength=b.num_rows)
            ends = np.cumsum(n)
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(h + np.uint64(1)), dtype=np.uint64)])
            yield b, h, np.concatenate([[0], ends]), mix64(total[ends] - total[ends - n] + n.astype(np.uint64))

    return run


def frequencies(docs: DataFrame, text_col: str, words: int) -> np.ndarray:
    """How many texts hold the n-grams of each counter (an n-gram's counter is its hash modulo COUNTERS), over all texts.

    Each task adds up its own counters; blocks of them are added up by a task each, row by row, so that nothing grows with
    the corpus but the counts. Several n-grams may share a counter: that changes the order, never the links.
    """
    sets = _sets(words)

    def blocks(at: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        cut = pa.array(np.arange(len(at) + 1, dtype=np.int32) * BLOCK)
        return pa.RecordBatch.from_arrays([pa.array(at), pa.ListArray.from_arrays(cut, pa.array(n))], ["at", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None
        for _, h, _, _ in sets(batches):
            table = np.zeros(COUNTERS, np.int32) if table is None else table
            at, n = np.unique((h % np.uint64(COUNTERS)).astype(np.int64), return_counts=True)
            table[at] += n
        if table is not None:
            yield blocks(np.arange(0, COUNTERS, BLOCK), table)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for at, n in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                sums[at] = sums.get(at, 0) + n.values.to_numpy().astype(np.int64)
        for at, n in sums.items():
            yield blocks(np.array([at]), np.minimum(n, 2**31 - 1).astype(np.int32))

    found = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "at long, n array<int>").repartition("at").mapInArrow(add, "at long, n array<int>").toArrow()
    table = np.zeros(COUNTERS, np.int32)
    for at, n in zip(found.column("at").to_pylist(), found.column("n"), strict=True):
        table[at : at + BLOCK] = n.values.to_numpy()
    return table


def prefixes(docs: DataFrame, id_col: str, text_col: str, words: int, likeness: float, marks: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """One row (id, fp: long key of the n-gram set, n, keys, counts) for each row of docs: keys are the set's prefix, the rarest n-gram first.

    In any one order of all n-grams, two sets of this likeness have one of their first n - ceil(likeness * n) + 1 in common.
    counts are the set's n-grams by range of their hash. Texts of fewer words are one n-gram; texts without words have none.
    With marks, a column mark: long has what it gives for each set, from all hashes and where each set's begin among them.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    sets, held = _sets(words), docs.sparkSession.sparkContext.broadcast(frequencies(docs, text_col, words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = held.value
        for b, h, cut, fp in sets(batches):
            n = np.diff(cut)
            text, place = ragged(n)
            ordered = h[np.lexsort((h, often[(h % np.uint64(COUNTERS)).astype(np.int64)], text))]
            first = np.where(n > 0, n - np.ceil(likeness * n - 1e-9).astype(np.int64) + 1, 0)
            keys = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(first)]).astype(np.int32)), signed(ordered[place < first[text]]))
            spread = np.bincount(text * RANGES + (h >> np.uint64(58)).astype(np.int64), minlength=b.num_rows * RANGES)
            counts = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * RANGES), pa.array(np.minimum(spread, 32767).astype(np.int16)))
            more = {"mark": signed(marks(h, cut))} if marks else {}
            yield pa.RecordBatch.from_arrays([b.column("id"), signed(fp), pa.array(n), keys, counts, *more.values()], ["id", "fp", "n", "keys", "counts", *more])

    schema = f"id {kind}, fp long, n bigint, keys array<bigint>, counts array<smallint>" + (", mark long" if marks else "")
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def distinct_sets(rows: DataFrame) -> DataFrame:
    """(fp, least: smallest id, n, keys, counts, and mark if there is one) of rows of prefixes(): each set once."""
    return rows.groupBy("fp").agg(F.min("id").alias("least"), *(F.first(c).alias(c) for c in rows.columns if c not in ("id", "fp")))


def _members(found: DataFrame, wanted: DataFrame, key: str = "fp") -> DataFrame:
    return found.join(F.broadcast(wanted) if wanted.count() <= SENT else wanted, key, "left_semi")


def whole_sets(docs: DataFrame, wanted: DataFrame, text_col: str, words: int) -> DataFrame:
    """(fp, hashes: all n-grams, ascending) of the sets with a key in wanted (fp, distinct)."""
    sets = _sets(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, h, cut, fp in sets(batches):
            yield pa.RecordBatch.from_arrays([signed(fp), pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), signed(h))], ["fp", "hashes"])

    return _members(docs.select(F.col(text_col).alias("text")).mapInArrow(run, "fp long, hashes array<bigint>"), wanted).dropDuplicates(["fp"])


def _size_class(n: np.ndarray, likeness: float) -> np.ndarray:
    """Classes of sizes such that sets of this likeness are in one class or in neighbouring ones."""
    return np.floor(np.log(n) / -np.log(likeness) + 1e-9).astype(np.int64)


def parts(sets: DataFrame, likeness: float) -> DataFrame:
    """(k, fp) for sets (fp, hashes): keys of parts, one of which any two sets of this likeness have in common.

    Two such sets of size hi at most differ by d = 2 * hi * (1 - likeness) / (1 + likeness) n-grams at most. Cut by hash into
    d + 1 parts, they are equal in one part at least (pigeonhole). A set is cut for its own size class and for the next,
    so that it meets both neighbours. That makes about 0.23 keys for each n-gram at likeness 0.9, and parts of some nine n-grams, which
    unlike sets hardly ever share however common each n-gram is. Where parts would have fewer than WHOLE_PART (some four at
    likeness 0.8, so that many were empty and alike), half as many are made, one of which differs by one n-gram at most; it
    is cut into four quarters, and its keys are the sums of three of them: about 1.2 keys for each n-gram, of some six.
    """
    grouped = (1 + likeness) / (2 * (1 - likeness)) < WHOLE_PART if likeness < 1 else False

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, made = [], []
            for hashes in b.column(1):
                h = hashes.values.to_numpy().view(np.uint64)
                own = int(_size_class(np.array([max(len(h), 1)]), likeness)[0])
                made.append(0)
                for c in (own, own + 1):
                    most = np.exp((c + 1) * -np.log(likeness)) * (1 + 1e-6) + 1
                    n = int(2 * most * (1 - likeness) / (1 + likeness)) + 1
                    quarters = grouped and n > 1
                    n = 4 * ((n + 1) // 2) if quarters else n
                    part = (mix64(h + np.uint64(7)) % np.uint64(n)).astype(np.int64)
                    total = np.zeros(n, np.uint64)
                    np.add.at(total, part, mix64(h ^ np.uint64(0x9E3779B97F4A7C15)))
                    if quarters:
                        total = np.repeat(total.reshape(-1, 4).sum(1, dtype=np.uint64), 4) - total
                    out.append(mix64(total + mix64(np.arange(n, dtype=np.uint64) + np.uint64(c << 32))))
                    made[-1] += n
            if out:
                yield pa.RecordBatch.from_arrays([signed(np.concatenate(out)), pa.array(np.repeat(b.column(0).to_numpy(), made))], ["k", "fp"])

    return sets.select("fp", "hashes").mapInArrow(run, "k long, fp long")


def _alike(shared, n, m, likeness: float):
    """Whether sets of n and m shingles with so many in common have a Jaccard likeness this large."""
    return shared >= likeness * (n + m - shared) - 1e-9


def _verified(pairs: DataFrame, sets: DataFrame, likeness: float) -> DataFrame:
    """Those pairs (a, b) whose whole sets have this Jaccard likeness."""
    one, two = (sets.select(F.col("fp").alias(c), F.col("hashes").alias(f"set_{c}")) for c in "ab")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    return pairs.select("a", "b").join(one, "a").join(two, "b").filter(_alike(shared, F.size("set_a"), F.size("set_b"), likeness)).select("a", "b")


def _each_pair(groups: DataFrame) -> DataFrame:
    """(a, b) of each two of ids, a list of structs with fp in ascending order."""
    each = F.expr("flatten(transform(ids, (x, i) -> transform(slice(ids, i + 2, size(ids)), y -> struct(x as a, y as b))))")
    return groups.select(F.explode(each).alias("e")).select("e.a", "e.b")


def _likely(members: DataFrame, likeness: float) -> DataFrame:
    """(a, b, n_a, n_b), once each, of the pairs of small groups that length and positions of their common n-grams allow.

    Places count from 0 in the rarest-first order. After the last common n-gram of both prefixes as many can be shared
    as the shorter rest has; before it, those found and those of crowded groups, which give no pairs here.
    """
    few = members.filter(F.col("size") <= FEW).groupBy("k").agg(F.array_sort(F.collect_list(F.struct("fp", "n", "at", "hot"))).alias("ids"))
    e = _each_pair(few).filter(F.least("a.n", "b.n") >= F.greatest("a.n", "b.n") * likeness - 1e-9)
    both = e.groupBy(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"), F.col("a.n").alias("n_a"), F.col("b.n").alias("n_b"))
    both = both.agg(F.count(F.lit(1)).alias("c"), F.max("a.at").alias("i"), F.max("b.at").alias("j"), F.least(F.max("a.hot"), F.max("b.hot")).alias("hot"))
    most = F.col("c") + F.col("hot") + F.least(F.col("n_a") - F.col("i"), F.col("n_b") - F.col("j")) - 1
    return both.filter(_alike(F.least(most, "n_a", "n_b"), F.col("n_a"), F.col("n_b"), likeness)).select("a", "b", "n_a", "n_b")


def _suffix_filter(pairs: DataFrame, distinct: DataFrame, likeness: float) -> DataFrame:
    """Pairs (a, b, n_a, n_b) that the counts of their n-grams by range of hash allow: in each range they share the lesser count at most."""
    one, two = (distinct.select(F.col("fp").alias(c), F.col("counts").alias(f"counts_{c}")) for c in "ab")
    apart = F.aggregate(F.zip_with("counts_a", "counts_b", lambda x, y: F.abs(x.cast("int") - y.cast("int"))), F.lit(0), lambda t, x: t + x)
    most = (F.col("n_a") + F.col("n_b") - apart) / 2
    return pairs.join(one, "a").join(two, "b").filter(_alike(most, F.col("n_a"), F.col("n_b"), likeness)).select("a", "b")


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"])


def _by_cell(close: Callable[[list[tuple]], pa.RecordBatch], columns: tuple[str, ...]):
    """Rows sorted by group and pair of parts, given to close() for each pair: the columns, counts and hashes as arrays."""

    def value(c: str, x: pa.Scalar):
        return x.values.to_numpy().view(np.uint64) if c == "hashes" else x.values.to_numpy() if c == "counts" else x.as_py()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for b in batches:
            for k, i, j, *row in zip(*(b.column(c) for c in ("k", "i", "j", *columns)), strict=True):
                here = (k.as_py(), i.as_py(), j.as_py())
                if here != key:
                    if held:
                        yield close(held)
                    key, held = here, []
                held.append(tuple(map(value, columns, row)))
        if held:
            yield close(held)

    return run


class _Cell:
    """Rows of a pair of parts: who may be like whom, by sizes and counts of shingles in buckets, across components."""

    def __init__(self, held: list[tuple], likeness: float):
        self.ids, self.roots, self.n = (np.array([x[k] for x in held]) for k in (0, 1, 2))
        self.counts, self.likeness = np.stack([x[3] for x in held]).astype(np.int32), likeness

    def near(self, at: int, some: np.ndarray) -> np.ndarray:
        """Those of the rows some that can have this likeness with row at, the likeliest first."""
        some = some[_alike(np.minimum(self.n[some], self.n[at]), self.n[some], self.n[at], self.likeness)]
        most = np.minimum(self.counts[some], self.counts[at]).sum(1)
        fits = (np.maximum(self.n[some], self.n[at]) > COUNTED) | _alike(most, self.n[some], self.n[at], self.likeness)
        return some[fits][np.argsort(-(most / (self.n[some] + self.n[at]))[fits], kind="stable")]

    def apart(self) -> Iterator[int]:
        """Rows of all components but the commonest: its rows are met as the others' partners."""
        names, counts = np.unique(self.roots, return_counts=True)
        for name in names[np.argsort(counts, kind="stable")][:-1]:
            yield from np.flatnonzero(self.roots == name)


def _across(likeness: float):
    """Links (a, b) that join the components in each pair of parts, by exact likeness of whole sets."""

    def close(held: list[tuple]) -> pa.RecordBatch:
        cell, sets, found = _Cell(held, likeness), [x[4] for x in held], []
        for at in list(cell.apart()):
            x = sets[at]
            for to in cell.near(at, np.flatnonzero(cell.roots != cell.roots[at])):
                if cell.roots[to] != cell.roots[at]:
                    y = sets[to]
                    if _alike(int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum()), len(x), len(y), likeness):
                        found.append((cell.ids[at], cell.ids[to]))
                        cell.roots[cell.roots == cell.roots[at]] = cell.roots[to]
        return _edges(found)

    return _by_cell(close, ("fp", "root", "n", "counts", "hashes"))


def _dealt(rooted: DataFrame) -> DataFrame:
    """(k, i, j, fp, root) from (k, fp, n, root): each group of several components is cut into parts, and rows go to pairs of parts.

    The rows of the commonest component meet all others, but not one another: with m other rows and d of its own, about
    d * (m / PART_ROWS + 1) + m * ((m + d) / PART_ROWS + 1) rows are made, in proportion to the group while m is small.
    """
    whole = rooted.groupBy("k").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.count(F.lit(1)).alias("c"), F.bit_xor("fp").alias("x"), F.bit_xor(F.xxhash64("fp")).alias("y"), F.sum("n").alias("all")).filter("least <> most")
    apart = whole.groupBy("c", "x", "y").agg(F.min(F.struct("k", "all")).alias("one")).select("one.*", F.col("c").alias("size"))  # one of the groups with the same members
    top = rooted.groupBy("k", "root").agg(F.count(F.lit(1)).alias("c")).groupBy("k").agg(F.max(F.struct("c", "root")).alias("top"))
    groups = written(apart.join(top, "k"), "simhash-apart")
    parts = lambda rows: F.ceil(F.greatest(rows / PART_ROWS, F.col("all") * rows / F.col("size") / PART_SHINGLES))
    rest = rooted.select("k", "fp", "root").join(groups, "k").withColumn("pd", parts(F.col("top.c"))).withColumn("pm", parts(F.col("size") - F.col("top.c")))
    own, h = F.col("root") == F.col("top.root"), F.xxhash64("fp")
    part = F.when(own, F.col("pm") + F.pmod(h, "pd")).otherwise(F.pmod(h, "pm"))
    to = F.when(own, F.col("pm")).otherwise(F.col("pm") + F.col("pd")) - 1
    cells = F.transform(F.sequence(F.lit(0).cast("long"), to), lambda x: F.struct(F.least(x, "part").alias("i"), F.greatest(x, "part").alias("j")))
    return rest.withColumn("part", part).select("k", "fp", "root", F.explode(cells).alias("ij")).select("k", "ij.i", "ij.j", "fp", "root")


def _cells(dealt: DataFrame, *columns: str) -> DataFrame:
    return dealt.select("k", "i", "j", *columns).repartition("k", "i", "j").sortWithinPartitions("k", "i", "j")


def _between(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Those pairs (a, b) that components known (a, root) leave apart."""
    for c in "ab":
        pairs = pairs.join(known.select(F.col("a").alias(c), F.col("root").alias(f"root_{c}")), c, "left")
    return pairs.filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")


def join_links(distinct: DataFrame, docs: DataFrame, text_col: str, words: int, likeness: float, known: DataFrame | None = None) -> DataFrame:
    """Edges (a, b) that connect exactly the sets of distinct (fp, n, keys, counts) that chains of pairs of this likeness connect.

    With known (a, root), components found before, their sets are connected too, and pairs within one are not compared.

    Sets meet over prefix n-grams. An n-gram's group up to FEW gives its pairs, filtered by length, positions and
    ranges. Sets of larger groups meet again over the parts that parts() cuts them into: groups of a part up to FEW give their
    pairs, and of larger ones each set meets the least set of all its groups. All these pairs are verified once, by whole
    sets. Then only members of large groups that are still in several components are compared, in pairs of bounded
    blocks, each of which gives spanning links alone; rows of the commonest component never meet one another. Groups of
    unlike sets are not large (they would have to be equal in a part), so common n-grams make no pairs of all that have them.
    """
    keyed = distinct.select("fp", "n", F.posexplode("keys").alias("at", "k"))
    shared = keyed.groupBy("k").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = written(keyed.join(shared, "k"), "ngrams-members")
    crowded = written(members.filter(F.col("size") > FEW).groupBy("fp").agg(F.count(F.lit(1)).alias("hot")), "ngrams-crowded")
    counted = members.join(crowded, "fp", "left").na.fill(0, ["hot"])
    pairs = _likely(counted, likeness)
    large = None
    if not crowded.isEmpty():
        sets = written(whole_sets(docs, crowded.select("fp"), text_col, words), "ngrams-crowded-sets")
        cut = written(parts(sets, likeness), "ngrams-parts")
        sizes = cut.groupBy("k").agg(F.count(F.lit(1)).alias("size"), F.min("fp").alias("lo")).filter("size > 1")
        cut = written(cut.join(sizes, "k"), "ngrams-parts")
        facts = distinct.select("fp", "n")
        small = cut.filter(F.col("size") <= FEW).groupBy("k").agg(F.array_sort(F.collect_set("fp")).alias("ids")).select("ids").distinct()
        large = cut.filter(F.col("size") > FEW)
        star = large.groupBy("fp").agg(F.min("lo").alias("lo")).filter("lo < fp").select(F.col("lo").alias("a"), F.col("fp").alias("b"))
        met = _each_pair(small).unionByName(star).distinct()
        met = met.join(facts.select(F.col("fp").alias("a"), F.col("n").alias("n_a")), "a").join(facts.select(F.col("fp").alias("b"), F.col("n").alias("n_b")), "b")
        pairs = pairs.unionByName(met.filter(F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * likeness - 1e-9)).distinct()
    pairs = _suffix_filter(written(pairs, "ngrams-likely"), distinct, likeness)
    pairs = written(pairs if known is None else _between(pairs, known), "ngrams-pairs")
    wanted = written(pairs.select(F.col("a").alias("fp")).unionByName(pairs.select(F.col("b").alias("fp"))).distinct(), "ngrams-wanted")
    near = written(_verified(pairs, written(whole_sets(docs, wanted, text_col, words), "ngrams-sets"), likeness), "ngrams-near")
    if known is not None:
        near = near.unionByName(known.select("a", F.col("root").alias("b")).filter("a <> b"))
    if large is None or large.isEmpty():
        return near
    roots = written(components(near), "ngrams-roots").withColumnRenamed("a", "fp")
    rooted = large.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")).join(distinct.select("fp", "n"), "fp")
    dealt = _dealt(written(rooted.select("k", "fp", "n", "root"), "ngrams-rooted"))
    dealt = dealt.join(distinct.select("fp", "n", "counts"), "fp").join(sets, "fp")
    across = written(_cells(dealt, "fp", "root", "n", "counts", "hashes").mapInArrow(_across(likeness), "a long, b long"), "ngrams-across")
    return roots.select(F.col("fp").alias("a"), F.col("root").alias("b")).unionByName(across)


def named(rows: DataFrame, distinct: DataFrame, roots: DataFrame) -> DataFrame:
    """(id, fp, component) of rows (id, fp), from distinct fingerprints (fp, least id) and the components (a, root) of their links."""
    roots = written(roots, "simhash-roots").withColumnRenamed("a", "fp")
    by_root = distinct.join(roots, "fp").groupBy("root").agg(F.min("least").alias("lowest"))
    moved = roots.join(by_root, "root").select("fp", "lowest")
    named = distinct.join(moved, "fp", "left").select("fp", F.coalesce("lowest", "least").alias("component"))
    return rows.join(named, "fp").select("id", "fp", "component")

"""Hard-negative mining over a multiway hyperplane tree whose split points store distance ranges to sibling subtrees (GNAT)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fanflow.llm.common import ragged, written

#: Rows that the split points are chosen from; split points of a node; rows of a leaf that is not split; levels at most.
FIT, SPLITS, LEAF, LEVELS = 20_000, 12, 2_000, 4
#: Rows of a leaf and anchors that are compared at once; entries that are kept for such anchors before they are thinned out.
BLOCK, ANCHORS, KEPT = 4_096, 256, 1_000_000
#: Shelves that leaves are put on together, and components of all vectors of a shelf at most: larger tables have more shelves.
SHELVES, SHELF = 12, 2**22
#: Components of this size or more take no part: their squares would not be finite.
LARGEST = 1e150
#: Scores below this are exact in double precision.
EXACT = 2.0**53


def whole(vectors: list[np.ndarray], width: int) -> np.ndarray:
    """floor(256 * x) of each component as doubles, short vectors filled up with zeros."""
    out = np.zeros((len(vectors), width))
    for k, v in enumerate(vectors):
        out[k, : len(v)] = np.floor(256 * np.asarray(v, np.float64))
    return out


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of a with those of b, exact: in doubles while these hold them, else in Python's whole numbers."""
    most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1])
    return a @ b.T if most < EXACT else np.vectorize(int, otypes=[object])(a) @ np.vectorize(int, otypes=[object])(b).T


@dataclass
class Node:
    points: np.ndarray  # split points, a row each, with the lifted coordinate
    children: list[int]  # a node's number, or -1 - the number of a leaf


class Tree:
    """Split points of all nodes, and for each node the least and greatest distances from split point i to the rows below child j.

    Vectors are lifted by one coordinate to one length (norm), so that a row's score with an anchor fixes its distance:
    d^2 = |anchor|^2 + norm^2 - 2 * score. A window of scores is then an annulus around the anchor.
    """

    def __init__(self, sample: np.ndarray, rows: int, norm: float):
        self.norm, self.nodes, self.leaves = norm, [], 0
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self.margin = 1e-6 * (1 + norm)
        self._grow(self.lifted(sample), rows, 0)

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        return np.hstack([vectors, np.sqrt(np.maximum(0, self.norm**2 - (vectors**2).sum(1)))[:, None]])

    @staticmethod
    def distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0, (x**2).sum(1)[:, None] + (points**2).sum(1)[None, :] - 2 * x @ points.T))

    def _grow(self, sample: np.ndarray, rows: float, level: int) -> int:
        """The number of the node, or of the leaf as -1 - n, for so many rows of which these are a sample."""
        points = np.unique(sample, axis=0) if len(sample) <= FIT else sample
        if rows <= LEAF or level >= LEVELS or len(points) < 2 * SPLITS:
            self.leaves += 1
            return -self.leaves
        far = self.distances(points, points[:1])[:, 0]
        chosen = []
        for _ in range(SPLITS):  # each the farthest from those before
            chosen.append(int(far.argmax()))
            far = np.minimum(far, self.distances(points, points[chosen[-1:]])[:, 0])
        me = len(self.nodes)
        self.nodes.append(Node(points[chosen], []))
        nearest = self.distances(sample, points[chosen]).argmin(1)
        for k in range(SPLITS):
            part = sample[nearest == k]
            self.nodes[me].children.append(self._grow(part, rows * len(part) / len(sample), level + 1))
        return me

    def descend(self, x: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(node, rows at it, their distances to its split points, the child of each) for lifted rows x, from the root."""
        todo = [(0, np.arange(len(x)))] if self.nodes and len(x) else []
        while todo:
            node, some = todo.pop()
            d = self.distances(x[some], self.nodes[node].points)
            nearest = d.argmin(1)
            yield node, some, d, nearest
            for k, child in enumerate(self.nodes[node].children):
                if child >= 0 and (nearest == k).any():
                    todo.append((child, some[nearest == k]))

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int64)
        for node, some, _, nearest in self.descend(x):
            out[some] = np.array(self.nodes[node].children)[nearest]
        return np.maximum(0, -1 - out) if self.nodes else out

    def visited(self, x: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) pairs: the leaves that may hold rows at distances from low to high of lifted anchors x.

        A child is left out if a split point's range of distances to the child's rows and the annulus exclude each
        other by the triangle inequality, for any split point of the node, its own one too.
        """
        if not self.nodes:
            rows = np.flatnonzero(low <= high)
            return rows, np.zeros(len(rows), np.int64)
        found, todo = [], [(0, np.flatnonzero(low <= high))]
        while todo:
            node, some = todo.pop()
            d = self.distances(x[some], self.nodes[node].points)
            for k, child in enumerate(self.nodes[node].children):
                lo, hi = self.low[node][:, k], self.high[node][:, k]
                if not (lo <= hi).all():
                    continue  # no rows below
                near = np.maximum(np.maximum(d - hi, lo - d), 0).max(1)
                far = (d + hi).min(1)
                alive = some[(near <= high[some] + self.margin) & (far >= low[some] - self.margin)]
                if len(alive) and child >= 0:
                    todo.append((child, alive))
                elif len(alive):
                    found.append((alive, np.full(len(alive), -1 - child)))
        return tuple(np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))

    def annulus(self, anchors: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances that scores from least to most have from the anchors."""
        square = (anchors**2).sum(1) + self.norm**2
        return np.sqrt(np.maximum(0, square - 2 * most)), np.sqrt(np.maximum(0, square - 2 * least))


def usable(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, vector) of the rows that take part, each once."""
    kept = rows.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"), F.col(vector_col).alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < LARGEST))
    return kept.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()).filter(finite).distinct()


def _fit(rows: DataFrame, width: int) -> Tree:
    """The tree, with ranges of all rows. Split points come from FIT rows at most, those of least hash of their id."""

    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = whole([v.values.to_numpy() for v in b.column(0)], width)
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([(x**2).sum(1).max(initial=0.0)])], ["n", "most"])

    n, most = rows.select("vector").mapInArrow(norms, "n long, most double").agg(F.sum("n"), F.max("most")).first()
    sample = rows.select("vector", F.xxhash64("id").alias("h"), "id").orderBy("h", "id").limit(FIT).toArrow().column("vector")
    return Tree(whole([v.values.to_numpy() for v in sample], width), n or 0, float(np.sqrt(most or 0.0)))


def _ranges(placed: DataFrame, tree: Tree, width: int) -> None:
    """Sets tree.low and tree.high from all rows: a row for each node and pair of its children from each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = held.value
        low = [np.full((len(n.points),) * 2, np.inf) for n in t.nodes]
        high = [np.full((len(n.points),) * 2, -np.inf) for n in t.nodes]
        for b in batches:
            for node, _, d, nearest in t.descend(t.lifted(whole([v.values.to_numpy() for v in b.column(0)], width))):
                for k in np.unique(nearest):
                    low[node][:, k] = np.minimum(low[node][:, k], d[nearest == k].min(0))
                    high[node][:, k] = np.maximum(high[node][:, k], d[nearest == k].max(0))
        for node, (lo, hi) in enumerate(zip(low, high, strict=True)):
            i, j = np.nonzero(lo <= hi)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), node)), pa.array(i), pa.array(j), pa.array(lo[i, j]), pa.array(hi[i, j])], ["node", "i", "j", "lo", "hi"])

    held = placed.sparkSession.sparkContext.broadcast(tree)
    found = placed.select("vector").mapInArrow(run, "node long, i long, j long, lo double, hi double").groupBy("node", "i", "j").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()
    tree.low = [np.full((len(n.points),) * 2, np.inf) for n in tree.nodes]
    tree.high = [np.full((len(n.points),) * 2, -np.inf) for n in tree.nodes]
    for r in found:
        tree.low[r.node][r.i, r.j], tree.high[r.node][r.i, r.j] = r.lo, r.hi


def place(rows: DataFrame, tree: Tree, width: int) -> DataFrame:
    """rows with the leaf that each falls into."""
    kind = rows.schema["id"].dataType.simpleString()
    held = rows.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = held.value
        for b in batches:
            leaf = t.leaf_of(t.lifted(whole([v.values.to_numpy() for v in b.column("vector")], width)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf)], ["id", "label", "vector", "leaf"])

    return rows.select("id", "label", "vector").mapInArrow(run, f"id {kind}, label int, vector {rows.schema['vector'].dataType.simpleString()}, leaf long")


_WINDOWS = "array<struct<positive:{id},score:decimal(38,0),least:decimal(38,0),most:decimal(38,0),from:decimal(38,0)>>"


def shelves(sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """The first shelf of each leaf of so many rows, and how many it has: neighbours in the tree share a shelf of so much room, a larger leaf has several to itself."""
    first, many = np.zeros((2, len(sizes)), np.int64)
    at, used = 0, 0
    for leaf in np.flatnonzero(sizes):
        if used and used + sizes[leaf] > room:
            at, used = at + 1, 0
        first[leaf], many[leaf] = at, -(-sizes[leaf] // room)
        at, used = (at, used + sizes[leaf]) if many[leaf] == 1 else (at + many[leaf], 0)
    return first, many


def _places(group: np.ndarray) -> np.ndarray:
    """The place of each element in its group, equal numbers being side by side."""
    start = np.flatnonzero(np.concatenate([np.ones(min(1, len(group)), bool), group[1:] != group[:-1]]))
    return np.arange(len(group)) - np.repeat(start, np.diff(np.append(start, len(group))))


class Found:
    """For each anchor and window the first n rows so far, the highest scores first and then the smaller ids."""

    def __init__(self, n: int):
        self.n, self.kept = n, [np.zeros((4, 0), np.int64)]

    def add(self, *columns: np.ndarray) -> None:
        """anchor, window, score, id of more rows."""
        self.kept.append(np.stack(columns))
        if sum(k.shape[1] for k in self.kept) > KEPT:
            self.kept = [self.first()]

    def first(self) -> np.ndarray:
        found = np.concatenate(self.kept, 1)
        anchor, window, score, ids = found
        found = found[:, np.lexsort((ids, ~score, window, anchor))]
        return found[:, _places(found[0] * (found[1].max(initial=0) + 1) + found[1]) < self.n]


class Anchors:
    """Anchors that meet the rows of a shelf: their windows as arrays (anchor by window; without windows, one of all scores)."""

    def __init__(self, held: list[tuple], width: int):
        self.ids, self.labels = (np.array([a[k] for a in held], np.int64) for k in (0, 1))
        self.x, self.windows = whole([a[2] for a in held], width), [a[3] for a in held]
        self.own = all(w is None for w in self.windows)  # rows of the anchor's label are wanted
        n = max((len(w or []) for w in self.windows), default=0)
        self.low, self.high = np.full((len(held), max(1, n)), 2**63 - 1), np.full((len(held), max(1, n)), -(2**63))
        if self.own:
            self.low, self.high = self.high, self.low
        for k, ws in enumerate(self.windows):
            for at, w in enumerate(ws or []):
                low, high = int(w["from"]), int(w["most"])
                if low <= min(high, 2**63 - 1) and high >= -(2**63):
                    self.low[k, at], self.high[k, at] = max(low, -(2**63)), min(high, 2**63 - 1)
        self.leaves: dict[int, list[int]] = {}
        for k, a in enumerate(held):
            for leaf in a[4]:
                self.leaves.setdefault(leaf, []).append(k)

    def meet(self, some: np.ndarray, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, found: Found) -> None:
        """Adds the first rows of these (ids, labels, x) for the anchors at some."""
        s = inner(self.x[some], x)
        s = np.clip(s, -(2**63), 2**63 - 1).astype(np.int64) if s.dtype == object else s
        fits = (labels == self.labels[some, None]) == self.own
        fits &= ids != self.ids[some, None]
        if self.own and s.dtype != np.int64 and s.shape[1] > 4 * found.n:  # only what reaches the n-th score can be among the first
            fits &= s >= np.partition(np.where(fits, s, -np.inf), -found.n, 1)[:, -found.n, None]
        elif not self.own:
            fits &= (s >= self.low[some].min(1)[:, None]) & (s <= self.high[some].max(1)[:, None])
        row, col = np.nonzero(fits)
        score, row, ids = s[row, col].astype(np.int64), some[row], ids[col]
        order = np.lexsort((ids, ~score, row))
        score, row, ids = score[order], row[order], ids[order]
        for w in range(self.low.shape[1]):
            inside = np.flatnonzero((score >= self.low[row, w]) & (score <= self.high[row, w]))
            inside = inside[_places(row[inside]) < found.n]
            found.add(row[inside], np.full(len(inside), w), score[inside], ids[inside])


class Search:
    """Anchors and the rows of the leaves that they visit, brought together by shelf: a few leaves that are neighbours in the tree.

    Each step gives, for each anchor (and each of its windows), the first rows of each shelf, so that what is merged
    afterwards is bounded by the shelves that an anchor visits: SHELVES or so, and more only beyond SHELF. An anchor meets the
    rows of its own leaves alone there. An anchor's windows are (positive, its score, least, most, from): rows of other
    labels with scores from least to most are wanted, of which those from `from` on hold the first; without windows, rows
    of its own label are.
    """

    def __init__(self, placed: DataFrame, tree: Tree, width: int, positives: int, negatives: int):
        self.placed, self.tree, self.width, self.positives, self.negatives = placed, tree, width, positives, negatives
        self.kind = placed.schema["id"].dataType.simpleString()
        self.vector = placed.schema["vector"].dataType.simpleString()
        counts = placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("rows")).collect()  # as many rows as the tree has leaves: SPLITS ** LEVELS at most
        sizes = np.zeros(max(1, tree.leaves), np.int64)
        sizes[[r.leaf for r in counts]] = [r.rows for r in counts]
        first, many = shelves(sizes, max(1, min(SHELF // max(1, width), -(-int(sizes.sum()) // SHELVES))))
        self.held: Broadcast = placed.sparkSession.sparkContext.broadcast((tree, first, many))
        where = placed.sparkSession.createDataFrame([(r.leaf, int(first[r.leaf]), int(many[r.leaf])) for r in counts], "leaf long, first long, many long")
        self.rows = placed.join(F.broadcast(where), "leaf").withColumn("shelf", F.col("first") + F.pmod(F.xxhash64("id", "label"), "many"))

    def visits(self, anchors: DataFrame, own: bool) -> DataFrame:
        """anchors (id, label, vector, least, most: arrays of scores) with the shelves and leaves that they visit: their own leaf alone, or all that the annuli of any window meet."""
        width, held = self.width, self.held

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            t, first, many = held.value
            for b in batches:
                x = whole([v.values.to_numpy() for v in b.column("vector")], width)
                lifted = t.lifted(np.zeros((0, width))) if not len(x) else np.hstack([x, np.zeros((len(x), 1))])
                if own:
                    row, leaf = np.arange(len(x)), t.leaf_of(t.lifted(x))
                else:
                    least, most = (b.column(c).to_pylist() for c in ("least", "most"))
                    of = np.array([k for k, v in enumerate(least) for _ in v], np.int64)
                    low, high = t.annulus(x[of], *(np.array([s for v in w for s in v], np.float64) for w in (least, most)))
                    row, leaf = t.visited(lifted[of], low, high)
                    pairs = np.unique(np.stack([of[row], leaf], 1), axis=0) if len(row) else np.zeros((0, 2), np.int64)
                    row, leaf = pairs[:, 0], pairs[:, 1]
                at, place = ragged(many[leaf])
                row, leaf, shelf = row[at], leaf[at], first[leaf[at]] + place
                order = np.lexsort((leaf, shelf, row))
                row, leaf, shelf = row[order], leaf[order], shelf[order]
                start = np.flatnonzero(_places(row * (shelf.max(initial=0) + 1) + shelf) == 0)
                leaves = pa.ListArray.from_arrays(pa.array(np.append(start, len(row)).astype(np.int32)), pa.array(leaf))
                took = (b.column(c).take(pa.array(row[start])) for c in ("id", "label", "vector", "windows"))
                yield pa.RecordBatch.from_arrays([*took, pa.array(shelf[start]), leaves], ["id", "label", "vector", "windows", "shelf", "leaves"])

        windows = anchors.schema["windows"].dataType.simpleString()
        return anchors.select("id", "label", "vector", "windows", "least", "most").mapInArrow(run, f"id {self.kind}, label int, vector {self.vector}, windows {windows}, shelf long, leaves array<long>")

    def scan(self, visits: DataFrame) -> DataFrame:
        """(anchor, positive, positive_score, other, score) from each shelf that is visited; see the class."""
        width, positives, negatives = self.width, self.positives, self.negatives

        def met(rows: tuple, held: list[tuple]) -> pa.RecordBatch:
            ids, labels, leaves, x = rows
            a = Anchors(held, width)
            found = Found(positives if a.own else negatives)
            for leaf, some in a.leaves.items():
                lo, hi = np.searchsorted(leaves, leaf), np.searchsorted(leaves, leaf, "right")
                for at in range(lo, hi, BLOCK):
                    part = slice(at, min(at + BLOCK, hi))
                    a.meet(np.array(some), ids[part], labels[part], x[part], found)
            anchor, window, score, other = found.first()
            of = [None if a.own else a.windows[k][w] for k, w in zip(anchor.tolist(), window.tolist(), strict=True)]
            asked = [pa.array([w and int(w[c]) for w in of], pa.int64()) for c in ("positive", "score")]
            return pa.RecordBatch.from_arrays([pa.array(a.ids[anchor]), *asked, pa.array(other), pa.array(score)], ["anchor", "positive", "positive_score", "other", "score"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, rows, anchors = None, [], []

            def flush() -> pa.RecordBatch:
                nonlocal rows, anchors
                if isinstance(rows, list):
                    ids, labels, leaves = (np.concatenate([r[k] for r in rows] or [np.zeros(0, np.int64)]) for k in range(3))
                    order = np.argsort(leaves, kind="stable")
                    x = np.concatenate([r[3] for r in rows] or [np.zeros((0, width))])
                    rows = (ids[order], labels[order], leaves[order], x[order])
                out, anchors = met(rows, anchors), []
                return out

            for whole_batch in batches:
                shelf, asks = (whole_batch.column(c).to_numpy(zero_copy_only=False) for c in ("shelf", "asks"))
                edges = np.flatnonzero((shelf[1:] != shelf[:-1]) | (asks[1:] != asks[:-1])) + 1
                for at, to in zip([0, *edges.tolist()], [*edges.tolist(), len(shelf)], strict=True):
                    if at == to:
                        continue
                    b = whole_batch.slice(at, to - at)
                    if shelf[at] != key:
                        if anchors:
                            yield flush()
                        key, rows, anchors = shelf[at], [], []
                    if not asks[at]:
                        values = (b.column(c).to_numpy().astype(np.int64) for c in ("id", "label", "leaf"))
                        rows.append((*values, whole([v.values.to_numpy() for v in b.column("vector")], width)))
                        continue
                    for a in zip(*(b.column(c) for c in ("id", "label", "vector", "windows", "leaves")), strict=True):
                        anchors.append((a[0].as_py(), a[1].as_py(), a[2].values.to_numpy(), a[3].as_py(), a[4].as_py()))
                        if len(anchors) >= ANCHORS:
                            yield flush()
            if anchors:
                yield flush()

        windows = visits.schema["windows"].dataType.simpleString()
        empty = lambda kind: F.lit(None).cast(kind)
        rows = self.rows.select("shelf", F.lit(False).alias("asks"), "leaf", empty("array<long>").alias("leaves"), "id", "label", "vector", empty(windows).alias("windows"))
        asked = visits.select("shelf", F.lit(True).alias("asks"), empty("long").alias("leaf"), "leaves", "id", "label", "vector", "windows")
        dealt = rows.unionByName(asked).repartition("shelf").sortWithinPartitions("shelf", "asks")
        return dealt.mapInArrow(run, "anchor long, positive long, positive_score long, other long, score long")


def _first(found: DataFrame, by: list[str], n: int) -> DataFrame:
    """For each group the list of its first n (score, other), the highest scores first and the smaller ids of those: a few from each shelf."""
    rows = F.array_sort(F.collect_list(F.struct((-F.col("score").cast("decimal(38,0)")).alias("down"), F.col("other"), F.col("score"))))
    return found.groupBy(*by).agg(F.slice(rows, 1, n).alias("top"))


def mine(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for anchors, which are rows of rows.

    A score is the inner product of floor(256 * x) of two vectors. An anchor's positives are the first rows of its label, the highest
    scores first and then the smaller ids; for each, the first negatives rows of other labels with
    least * positive_score <= 100 * score <= most * positive_score. Search is exact: an anchor's own leaf gives a bound, and all leaves
    that the bound's annulus meets are searched then. Rows with a null id, label, vector or component, or one that is not
    finite (or LARGEST in size), take no part; shorter vectors count as filled up with zeros; equal rows (id, label and vector) count once, and
    rows of an anchor's own id are never its partners. Scores beyond 64 bits count as the nearest 64-bit number. An empty table gives none. Ids are whole numbers;
    other columns are left out. Split points are chosen from FIT rows at most, which bears on speed alone: every row is indexed.
    """
    clean = written(usable(rows, id_col, vector_col, label_col), "gnat-rows")
    width = clean.agg(F.max(F.size("vector"))).first()[0] or 0
    tree = _fit(clean, width)
    placed = written(place(clean, tree, width), "gnat-leaves")
    _ranges(placed, tree, width)
    search = Search(placed, tree, width, positives, negatives)
    me = written(usable(anchors, id_col, vector_col, label_col), "gnat-anchors")
    kind = placed.schema["id"].dataType.simpleString()
    windows = _WINDOWS.format(id=kind)
    none = F.lit(None).cast(windows)
    scores = F.array(F.lit(None).cast("double"))
    start = me.select("id", "label", "vector", none.alias("windows"), scores.alias("least"), scores.alias("most"))
    near = written(_first(search.scan(search.visits(start, True)), ["anchor"], positives), "gnat-near")
    floor = F.when(F.size("top") >= positives, F.nullif(F.element_at("top", F.lit(positives)).getField("score"), F.lit(-(2**63))).cast("double"))
    bound = start.join(near, start["id"] == near["anchor"], "left").select("id", "label", "vector", "windows", F.array(F.coalesce(floor, F.lit(-1e300))).alias("least"), F.array(F.lit(1e300)).alias("most"))
    top = _first(search.scan(search.visits(bound, False)), ["anchor"], positives)

    big = lambda c: F.col(c).cast("decimal(38,0)")
    one = top.select("anchor", F.explode("top").alias("p")).select("anchor", F.col("p.other").alias("positive"), F.col("p.score").alias("score"))
    low, high = F.ceil(big("score") * least / 100), F.floor(big("score") * most / 100)
    one = one.select("anchor", F.struct("positive", big("score").alias("score"), low.cast("decimal(38,0)").alias("least"), high.cast("decimal(38,0)").alias("most"), low.cast("decimal(38,0)").alias("from")).alias("w"))
    held = written(one.groupBy("anchor").agg(F.array_sort(F.collect_list("w")).cast(windows).alias("windows")), "gnat-windows")

    def asked(held: DataFrame) -> DataFrame:
        ends = [F.col(f"windows.{c}").cast("array<double>").alias(n) for n, c in (("least", "from"), ("most", "most"))]
        return me.join(held, me["id"] == held["anchor"]).select("id", "label", "vector", "windows", *ends)

    by = ["anchor", "positive", "positive_score"]
    first = written(_first(search.scan(search.visits(asked(held), True)), by, negatives), "gnat-first")
    reached = first.filter(F.size("top") >= negatives).select("anchor", F.struct("positive", F.element_at("top", F.lit(negatives)).getField("score").alias("score")).alias("r"))
    reached = reached.groupBy("anchor").agg(F.map_from_entries(F.collect_list("r")).alias("reached"))
    raised = held.join(reached, "anchor", "left").withColumn("windows", F.transform("windows", lambda w: w.withField("from", F.greatest(w["from"], F.coalesce(F.try_element_at("reached", w["positive"]).cast("decimal(38,0)"), w["from"])))).cast(windows)).drop("reached")
    found = _first(search.scan(search.visits(asked(written(raised, "gnat-windows")), False)), by, negatives)
    out = found.select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "positive_score", F.posexplode("top").alias("at", "n"))
    return out.select("anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("n.other").alias("negative_id"), "positive_score", F.col("n.score").alias("negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns for all anchors of `embeddings`."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return mine(rows, rows.filter(F.col("vec_id") % 50 == 0))


OP12_SQL = """
WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id, list_dot_product(a.q, b.q)::BIGINT AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT p.*, s.id AS negative_id, s.score AS negative_score, (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id))::INTEGER AS rank
    FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same WHERE 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""

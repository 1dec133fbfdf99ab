"""Document quality by attention-based multiple-instance learning over passages."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fanflow.llm.common import RangeHash, crc_mod, mix64, pieces, ragged, tokens, written

#: Words of a passage, hashed letter-pair features of a passage, and other features.
PASSAGE, PAIRS, SHAPES = 64, 64, 14
FEATURES = PAIRS + SHAPES
#: The training sample's bounds: documents of each label, and passages in all.
MAX_DOCS, MAX_PASSAGES = 3000, 120_000


def encode(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all passages of some texts, and the number of passages of each text (1 of zeros for an empty text)."""
    starts, ends, first = tokens(data, offsets)
    words = np.diff(first)
    passages = np.maximum(1, -(-words // PASSAGE))
    base = np.cumsum(passages) - passages
    doc, place = ragged(words)
    at = base[doc] + place // PASSAGE
    n = int(passages.sum())
    x = np.zeros((n, FEATURES), np.float32)
    if not len(starts):
        return x, passages
    count = np.maximum(1, np.bincount(at, minlength=n)).astype(np.float64)
    size = ends - starts
    mean = np.bincount(at, size, n) / count
    h = RangeHash(data)(starts, ends)
    same_doc = doc[1:] == doc[:-1]

    def share(flag: np.ndarray, by: np.ndarray = at) -> np.ndarray:
        return np.bincount(by[flag], minlength=n) / count

    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & same_doc
    again2 = np.zeros(len(h), bool)
    again2[2:] = (h[2:] == h[:-2]) & (doc[2:] == doc[:-2])
    key = mix64(h ^ mix64(at.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key)
    new = np.ones(len(key), bool)
    new[1:] = key[order][1:] != key[order][:-1]
    kinds = np.zeros(256, np.uint8)  # 1 lower case, 2 upper case, 3 digit, 4 other ASCII, 5 beyond ASCII
    kinds[33:128], kinds[128:], kinds[97:123], kinds[65:91], kinds[48:58] = 4, 5, 1, 2, 3
    kind = kinds[data]
    sums = np.zeros((6, len(data) + 1), np.int32)
    for k in (2, 3, 4, 5):
        np.cumsum(kind == k, out=sums[k, 1:])
    letters = np.maximum(1, np.bincount(at, size, n))
    parts = [np.bincount(at, sums[k][ends] - sums[k][starts], n) / letters for k in (2, 3, 4, 5)]
    tail = (sums[4][ends] - sums[4][np.maximum(starts, ends - 2)]) == 2
    shapes = [np.log1p(count), mean, np.sqrt(np.maximum(0, np.bincount(at, size.astype(np.float64) ** 2, n) / count - mean**2)), *parts, share(again), share(again2), np.bincount(at[order][new], minlength=n) / count, share(kind[ends - 1] == 4), share(tail), share(size == 1), share(kind[starts] == 2)]
    x[:, :SHAPES] = np.stack(shapes, 1)
    inside = np.zeros(len(data), bool)
    inside[:-1] = (kind[:-1] != 0) & (kind[1:] != 0)
    inside[offsets[1:][offsets[1:] > 0] - 1] = False
    pos = np.flatnonzero(inside)
    pair = mix64(data[pos].astype(np.uint64) << np.uint64(8) | data[pos + 1]) % np.uint64(PAIRS)
    owner = at[np.searchsorted(starts, pos, "right") - 1]
    bag = np.bincount(owner * PAIRS + pair.astype(np.int64), minlength=n * PAIRS).reshape(n, PAIRS)
    x[:, SHAPES:] = np.sqrt(bag / np.maximum(1, bag.sum(1, keepdims=True)))
    return x, passages


class Attention:
    """Passages are encoded by a hidden layer, weighted by gated attention within their document, and the weighted sum is scored."""

    def __init__(self, hidden: int = 24, gate: int = 12, seed: int = 7):
        r = np.random.default_rng(seed)
        self.p = {"W": r.normal(0, FEATURES**-0.5, (FEATURES, hidden)), "b": np.zeros(hidden), "V": r.normal(0, hidden**-0.5, (hidden, gate)), "U": r.normal(0, hidden**-0.5, (hidden, gate)), "w": r.normal(0, gate**-0.5, gate), "c": r.normal(0, hidden**-0.5, hidden), "d": np.zeros(1)}
        self.mean, self.scale = np.zeros(FEATURES), np.ones(FEATURES)

    def forward(self, x: np.ndarray, passages: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        first = np.cumsum(passages) - passages
        doc = np.repeat(np.arange(len(passages)), passages)
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(z @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * g) @ p["w"]
        e = np.exp(e - np.maximum.reduceat(e, first)[doc])
        a = e / np.add.reduceat(e, first)[doc]
        m = np.add.reduceat(a[:, None] * h, first, 0)
        return {"z": z, "h": h, "t": t, "g": g, "a": a, "m": m, "doc": doc, "first": first, "score": 1 / (1 + np.exp(-np.clip(m @ p["c"] + p["d"], -35, 35)))}

    def gradient(self, x: np.ndarray, passages: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        p, f = self.p, self.forward(x, passages)
        ds = (f["score"] - y) * weight / weight.sum()
        dm = ds[:, None] * p["c"]
        da = (dm[f["doc"]] * f["h"]).sum(1)
        de = f["a"] * (da - np.add.reduceat(f["a"] * da, f["first"])[f["doc"]])
        dt, dg = de[:, None] * p["w"] * f["g"] * (1 - f["t"] ** 2), de[:, None] * p["w"] * f["t"] * f["g"] * (1 - f["g"])
        dh = (f["a"][:, None] * dm[f["doc"]] + dt @ p["V"].T + dg @ p["U"].T) * (1 - f["h"] ** 2)
        return {"W": f["z"].T @ dh, "b": dh.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ dg, "w": (f["t"] * f["g"]).T @ de, "c": f["m"].T @ ds, "d": ds.sum(keepdims=True)}

    def train(self, x: np.ndarray, passages: np.ndarray, y: np.ndarray, epochs: int = 40, batch: int = 128, rate: float = 0.01, decay: float = 1e-4) -> None:
        """Adam over shuffled batches of documents; both labels weigh the same in all."""
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        share = np.array([max(1, (y == k).sum()) for k in (0, 1)], float)
        weight = (len(y) / 2 / share)[y.astype(int)]
        first, r = np.cumsum(passages) - passages, np.random.default_rng(11)
        m, v, step = {k: 0.0 for k in self.p}, {k: 0.0 for k in self.p}, 0
        for epoch in range(epochs):
            order = r.permutation(len(y))
            for at in range(0, len(y), batch):
                ids = order[at : at + batch]
                group, place = ragged(passages[ids])
                g = self.gradient(x[first[ids][group] + place], passages[ids], y[ids], weight[ids])
                step += 1
                for k, d in g.items():
                    d = d + decay * self.p[k]
                    m[k], v[k] = 0.9 * m[k] + 0.1 * d, 0.999 * v[k] + 0.001 * d * d
                    self.p[k] = self.p[k] - rate * (0.1 + 0.9 * (1 - epoch / epochs)) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)


def passage_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *carried: str) -> DataFrame:
    """(id, carried columns, passages, features: float32 bytes, row by row) of each whole text; null is empty."""
    kinds = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in carried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, data, offsets in pieces(batches, "text"):
            x, passages = encode(data, offsets)
            to = np.cumsum(passages)
            rows = [x[e - k : e].tobytes() for k, e in zip(passages, to, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("id"), *(b.column(c) for c in carried), pa.array(passages), pa.array(rows, pa.binary())], ["id", *carried, "passages", "features"])

    rows = docs.select(F.col(id_col).alias("id"), *carried, F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}{kinds}, passages bigint, features binary")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_docs: int = MAX_DOCS, max_passages: int = MAX_PASSAGES) -> Attention | None:
    """Attention model of label 1 against 0, from at most about max_docs documents of each label and max_passages passages.

    The sample is chosen by a hash of the id, so that reruns agree. Ids with several labels count by their mean
    (0.5 or more is 1); null labels and ids, and labels without a document, are left out. None if a label is missing.
    """
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("key")).agg((F.avg(label_col) >= 0.5).cast("int").alias("label"))
    counts = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return None
    draw = F.pmod(F.xxhash64(F.col("key").cast("string"), F.lit("quality")), F.lit(10**9)) / F.lit(1e9)
    rate = F.when(F.col("label") == 1, min(1.0, max_docs / counts[1])).otherwise(min(1.0, max_docs / counts[0]))
    chosen = F.broadcast(known.filter(draw < rate))
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")).join(chosen, "key")
    table = written(passage_features(rows, "key", "text", "label"), "quality-sample")
    total = table.agg(F.sum("passages")).first()[0] or 0
    if total > max_passages:
        table = table.filter(F.pmod(F.xxhash64("id", F.lit("less")), F.lit(10**9)) < int(1e9 * max_passages / total)).filter(F.col("passages") <= max_passages)
    sample = sorted(table.collect(), key=lambda r: (r.id, r.features))
    if len({r.label for r in sample}) < 2:
        return None
    x = np.concatenate([np.frombuffer(r.features, np.float32).reshape(-1, FEATURES) for r in sample]).astype(np.float64)
    model = Attention()
    model.train(x, np.array([r.passages for r in sample]), np.array([r.label for r in sample], float))
    return model


def score(docs: DataFrame, model: Attention | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score: 0 to 1, higher when label 1 is likelier) of each row's whole text; empty and null texts are one empty passage.

    Without a model every score is 0.5. Rows aren't shuffled; rows with equal texts have equal scores.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, data, offsets in pieces(batches, "text"):
            said = np.full(b.num_rows, 0.5) if model is None else model.forward(*encode(data, offsets))["score"]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(said)], ["id", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, score double").withColumnRenamed("id", id_col)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns: doc_id, held_out, score, predicted; learned from labels that aren't held out."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = fit(docs, labels.filter(crc_mod("doc_id", 3) != 1))
    return score(docs, model).select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

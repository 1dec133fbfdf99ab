"""Hidden Markov language model: latent states over word classes, exact words within a class by their smoothed counts."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fanflow.llm.common import crc_mod, lower_ascii, mix64, pieces, ragged, range_hashes, tokens, written

STATES = 8
#: Words that are a class each; other words share classes by a hash of their last bytes.
TOP, ENDINGS = 2000, 2048
CLASSES = 1 + TOP + ENDINGS
#: Most word counts that every task holds; the counts of all other words are joined.
FREQUENT = 200_000
#: Baum-Welch rounds, each over all training documents.
ROUNDS = 12
#: Words of a training window.
WINDOW = 128
#: The end of a text, as a word that no text has.
END = np.uint64(0x656E64)
#: Partial counts that one task or the driver adds up.
FAN_IN = 32


def _hashed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and class by ending of all tokens, each text's words and then its end, and the number of tokens of each text."""
    low = lower_ascii(data)
    starts, ends, first = tokens(low, offsets)
    n = np.diff(first)
    word = np.full(len(starts) + len(n), END, np.uint64)
    ending = np.zeros(len(word), np.int32)
    text, _ = ragged(n)
    at = np.arange(len(starts)) + text
    word[at] = range_hashes(low, starts, ends)
    last = np.zeros(len(starts), np.uint64)
    for k in (1, 2, 3):
        last = last << np.uint64(8) | np.where(ends - k >= starts, low[np.maximum(ends - k, 0)], 0).astype(np.uint64)
    ending[at] = mix64(last) % np.uint64(ENDINGS)
    return word, ending, n + 1


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word: 64-bit hash, ending, c) of all tokens of docs, A-Z lower-cased, with one end for each text; null texts are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def summed() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            word, ending, c = (np.concatenate(x) for x in zip(*held, strict=True))
            distinct, at, inverse = np.unique(word, return_index=True, return_inverse=True)
            return distinct, ending[at], np.bincount(inverse, c).astype(np.int64)

        def out() -> pa.RecordBatch:
            word, ending, c = summed()
            return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(ending), pa.array(c)], ["word", "ending", "c"])

        for _, data, offsets in pieces(batches, "text"):
            word, ending, _ = _hashed(data, offsets)
            held.append((word, ending, np.ones(len(word), np.int64)))
            held = [summed()] if len(held) > 3 else held
            if len(held[0][0]) > 500_000:
                yield out()
                held = []
        if held:
            yield out()

    parts = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "word bigint, ending int, c bigint")
    return parts.groupBy("word", "ending").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """What every task holds of the counts: words of high count (sorted by hash), classes, and totals."""

    words: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    tokens: int
    types: int
    class_total: np.ndarray
    class_types: np.ndarray


def vocabulary(counts: DataFrame) -> Vocabulary:
    """counts: a written word_counts() table. Bounded: FREQUENT words and a row for each class."""
    total, types = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    least = 0
    if (types or 0) > FREQUENT:
        least = counts.approxQuantile("c", [1 - FREQUENT / types], 0.001)[0]
        while counts.filter(F.col("c") > least).limit(2 * FREQUENT + 1).count() > 2 * FREQUENT:
            least = 2 * least + 1
    frequent = counts.filter(F.col("c") > least).toArrow()
    words = frequent.column("word").to_numpy().view(np.uint64)
    c, ending = frequent.column("c").to_numpy(), frequent.column("ending").to_numpy()
    order = np.argsort(words)
    words, c, ending = words[order], c[order], ending[order]
    by_count = np.lexsort((words, -c))
    top = by_count[words[by_count] != END][:TOP]
    classes = (1 + TOP + ending).astype(np.int64)
    classes[top] = 1 + np.arange(len(top))
    classes[words == END] = 0
    sums = counts.groupBy("ending").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).toArrow()
    class_total, class_types = np.zeros(CLASSES), np.zeros(CLASSES)
    at = 1 + TOP + sums.column("ending").to_numpy()
    class_total[at], class_types[at] = sums.column("c").to_numpy(), sums.column("n").to_numpy()
    single = classes < 1 + TOP
    np.subtract.at(class_total, 1 + TOP + ending[single], c[single])
    np.subtract.at(class_types, 1 + TOP + ending[single], 1)
    class_total[classes[single]], class_types[classes[single]] = c[single], 1
    return Vocabulary(words, c, classes, total or 0, types or 0, class_total, class_types)


def _coded(docs: DataFrame, v: Vocabulary, id_col: str, text_col: str, train_col: str) -> DataFrame:
    """Each text as classes, with the sums over its words of known count, and its other words for a join with the counts."""
    inside = np.log10(v.class_total + v.class_types + 1)
    scale = np.log10(v.tokens + v.types + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 36
        for b, data, offsets in pieces(batches, "text"):
            word, ending, n = _hashed(data, offsets)
            text, _ = ragged(n)
            classes = (1 + TOP + ending).astype(np.int64)
            c = np.zeros(len(word))
            if len(v.words):
                place = np.minimum(np.searchsorted(v.words, word), len(v.words) - 1)
                held = v.words[place] == word
                c[held], classes[held] = v.counts[place[held]], v.classes[place[held]]
            else:
                held = np.zeros(len(word), bool)
            classes[word == END] = 0
            shared = classes > TOP
            base = np.bincount(text, np.log10(c + 1) - scale, len(n))
            within = np.bincount(text[shared], np.log10(c[shared] + 1) - inside[classes[shared]], len(n)).astype(float)
            known = np.bincount(text[held], minlength=len(n))
            key = mix64(word[~held] ^ mix64(text[~held].astype(np.uint64) + np.uint64(1)))
            _, first, times = np.unique(key, return_index=True, return_counts=True)
            order = np.argsort(text[~held][first], kind="stable")
            other, times = word[~held][first][order], times[order]
            per = np.bincount(text[~held][first], minlength=len(n))
            cut = np.concatenate([[0], np.cumsum(per)]).astype(np.int32)
            flat = classes.astype(np.int16)
            to = np.cumsum(n)
            lists = [pa.ListArray.from_arrays(pa.array(cut), pa.array(x)) for x in (other.view(np.int64), times.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(uid + np.arange(len(n))), b.column("id"), b.column("train"), pa.array(n), pa.array(known), pa.array(base), pa.array(within), pa.array([flat[e - k : e].tobytes() for k, e in zip(n, to, strict=True)], pa.binary()), *lists],
                ["uid", "id", "train", "n", "known", "base", "within", "classes", "other", "times"],
            )
            uid += len(n)

    rows = docs.select(F.col(id_col).alias("id"), F.col(train_col).alias("train"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"uid bigint, id {docs.schema[id_col].dataType.simpleString()}, train boolean, n bigint, known bigint, base double, within double, classes binary, other array<bigint>, times array<int>")


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @staticmethod
    def first(v: Vocabulary) -> Model:
        """States that differ by chance and tend to stay: enough for Baum-Welch to pull them apart."""
        r = np.random.default_rng(3)
        emit = (v.class_total + 0.5) * np.exp(r.normal(0, 0.5, (STATES, CLASSES)))
        move = np.full((STATES, STATES), 0.2 / STATES) + np.eye(STATES) * 0.8
        return Model(np.full(STATES, 1 / STATES), move, emit / emit.sum(1, keepdims=True))

    def better(self, counts: np.ndarray, v: Vocabulary) -> Model:
        """The model of expected counts, smoothed: transitions by a little of each, emissions by the class frequencies."""
        start, move, emit = counts[:STATES], counts[STATES : STATES + STATES**2].reshape(STATES, STATES), counts[STATES + STATES**2 :].reshape(STATES, CLASSES)
        prior = (v.class_total + 0.5) / (v.class_total + 0.5).sum()
        start, move, emit = start + 0.1, move + 0.1, emit + prior * 20
        return Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))


def _expected(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """Expected counts (start, transitions, emissions, flat) of windows of the sequences, by scaled forward and backward recursion.

    Training reads texts in windows of WINDOW words. A window that continues a text starts from the states' long-run
    shares and doesn't count as a start, so the counts of its first words are approximate; scoring reads whole texts.
    """
    cut = [(s[a : a + WINDOW], a == 0) for s in sequences for a in range(0, len(s), WINDOW)]
    cut.sort(key=lambda x: -len(x[0]))
    lengths = np.array([len(x[0]) for x in cut])
    steps = int(lengths[0])
    live = [int(np.searchsorted(-lengths, -t, "left")) for t in range(steps)]  # windows longer than t
    codes = np.zeros((steps, len(cut)), np.int64)
    for k, (s, _) in enumerate(cut):
        codes[: len(s), k] = s
    fresh = np.array([x[1] for x in cut])
    stay = np.linalg.matrix_power(model.move, 64)[0]
    alpha, seen = np.zeros((steps, STATES, len(cut))), np.empty((steps, STATES, len(cut)))  # states by windows: the fast way round for small matrices
    per, forth = np.ones((steps, len(cut))), np.ascontiguousarray(model.move.T)
    for t in range(steps):
        m = live[t]
        seen[t, :, :m] = model.emit.take(codes[t, :m], 1)
        a = np.where(fresh, model.start[:, None], stay[:, None])[:, :m] if t == 0 else forth @ alpha[t - 1, :, :m]
        a *= seen[t, :, :m]
        np.divide(1, a.sum(0), out=per[t, :m])
        np.multiply(a, per[t, :m], out=alpha[t, :, :m])
    move, beta = np.zeros((STATES, STATES)), np.ones((STATES, len(cut)))
    for t in range(steps - 1, -1, -1):
        m = live[t]
        if t:
            back = seen[t, :, :m] * beta[:, :m]
            back *= per[t, :m]
            move += alpha[t - 1, :, :m] @ back.T
        alpha[t, :, :m] *= beta[:, :m]  # now the chance of each state
        if t:
            beta[:, :m] = model.move @ back
    flat = codes.ravel()
    emit = np.stack([np.bincount(flat, alpha[:, k].ravel(), CLASSES) for k in range(STATES)])
    start = alpha[0][:, fresh].sum(1)
    return np.concatenate([start, (move * model.move).ravel(), emit.ravel()])


def _summed(rows: DataFrame, of: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]]) -> np.ndarray:
    """Sum of the vectors that of() gives for each partition, added up by a tree of tasks of FAN_IN vectors each."""

    def once(f):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for x in f(batches):
                total = x if total is None else total + x
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["v"])

        return run

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for b in batches:
            for x in b.column(0):
                yield np.frombuffer(x.as_py(), np.float64)

    parts, n = rows.mapInArrow(once(of), "v binary"), rows.rdd.getNumPartitions()
    while n > FAN_IN:
        n = -(-n // FAN_IN)
        parts = parts.repartition(n).mapInArrow(once(vectors), "v binary")
    found = [np.frombuffer(r.v, np.float64) for r in parts.collect()]
    return np.sum(found, 0) if found else np.zeros(STATES + STATES**2 + STATES * CLASSES)


def train(coded: DataFrame, v: Vocabulary) -> Model:
    """Baum-Welch: each round one pass over all training rows, whose partitions give expected counts that are added up."""
    rows = coded.filter("train").select("classes")
    model = Model.first(v)
    for _ in range(ROUNDS):

        def counted(batches: Iterator[pa.RecordBatch], model: Model = model) -> Iterator[np.ndarray]:
            for b in batches:
                held, size = [], 0
                for x in b.column("classes"):
                    held.append(np.frombuffer(x.as_py(), np.int16).astype(np.int64))
                    size += len(held[-1])
                    if size > 150_000:
                        yield _expected(model, held)
                        held, size = [], 0
                if held:
                    yield _expected(model, held)

        model = model.better(_summed(rows, counted), v)
    return model


def _likelihood(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """log10 probability of each whole sequence of classes: scaled forward recursion over all of them side by side."""
    order = sorted(range(len(sequences)), key=lambda k: -len(sequences[k]))
    lengths = np.array([len(sequences[k]) for k in order])
    flat, first = np.concatenate([sequences[k] for k in order]), np.cumsum(lengths) - lengths
    out, a, forth = np.zeros(len(order)), np.repeat(model.start[:, None], len(order), 1), np.ascontiguousarray(model.move.T)
    live = np.searchsorted(-lengths, -np.arange(lengths[0]), "left")
    for t in range(int(lengths[0])):
        m = live[t]
        a = (a[:, :m] if t == 0 else forth @ a[:, :m]) * model.emit.take(flat[first[:m] + t], 1)
        s = a.sum(0)
        a /= s
        out[:m] += np.log10(s)
    back = np.empty(len(order))
    back[order] = out
    return back


def score(docs: DataFrame, train_col: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: (id_col, train, n_tokens, n_known, train_tokens, base_score, score).

    Learns from the rows where train_col holds. Word counts grow with the corpus and stay distributed: tasks hold the
    FREQUENT commonest, other words are joined by hash and summed by document. P(text) is the chance of its classes
    under the HMM, by the exact forward recursion, times that of each word within its class, (c + 1) / (class tokens +
    class types + 1). Null texts are empty: one end token. Rows with equal ids stay separate; with no training row
    every word is unknown. Words are told apart by 64-bit hashes.
    """
    counts = written(word_counts(docs.filter(train_col), text_col), "hmm-counts")
    v = vocabulary(counts)
    coded = written(_coded(docs, v, id_col, text_col, train_col), "hmm-coded")
    model = train(coded, v)
    others = coded.select("uid", F.explode(F.arrays_zip("other", "times")).alias("o")).select("uid", F.col("o.other").alias("word"), F.col("o.times").alias("times"))
    found = others.join(counts.select("word", "c"), "word").groupBy("uid").agg(F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("gain"), F.sum("times").alias("more"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            said = _likelihood(model, [np.frombuffer(x.as_py(), np.int16).astype(np.int64) for x in b.column("classes")]) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in b.schema.names if c != "classes"), pa.array(said)], [*(c for c in b.schema.names if c != "classes"), "states"])

    kind = docs.schema[id_col].dataType.simpleString()
    said = coded.drop("other", "times").mapInArrow(run, f"uid bigint, id {kind}, train boolean, n bigint, known bigint, base double, within double, states double")
    gain = F.coalesce("gain", F.lit(0.0))
    return said.join(found, "uid", "left").select(
        F.col("id").alias(id_col), "train", F.col("n").alias("n_tokens"), (F.col("known") + F.coalesce("more", F.lit(0))).cast("long").alias("n_known"),
        F.lit(v.tokens).cast("long").alias("train_tokens"), (F.col("base") + gain).alias("base_score"), (F.col("states") + F.col("within") + gain).alias("score"),
    )


def op9_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("learn", crc_mod("doc_id", 7) != 2)
    return score(docs, "learn").select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")

"""Repeated substrings by sampled suffixes: sorted externally with their common prefixes, from which all others are induced."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fanflow.llm.common import RangeHash, buffers, pieces, ragged, written

LENGTH, GRAM = 400, 64
#: Suffix tuples of one sampled string that one task induces from; more go by counts of single strings.
CROWD = 50_000
#: Suffix tuples that a step of numpy work takes (a group is never cut).
STEP = 6000
_KEY = ["id", "mark"]


def _sampled(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """The sampled positions: text, place, least and most offset of the strings that each stands for, its hash, and the hash of all their bytes.

    A string of length bytes is sampled at the gram in it of least hash, the first of several. That depends on its bytes
    alone, so equal strings are sampled at the same offset; runs of neighbouring strings share a sampled position.
    """
    none = np.zeros(0, np.int64)
    n, w = len(data), length - gram + 1
    if n < length:
        return (none,) * 6
    h = RangeHash(data, 1)
    at = np.arange(n - gram + 1)
    packed = (h(at, at + gram) & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    full = -(-len(packed) // w) * w
    blocks = np.full(full, np.uint64(2**64 - 1))
    blocks[: len(packed)] = packed
    blocks = blocks.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    least = np.minimum(back[: n - length + 1], ahead[w - 1 : w - 1 + n - length + 1])
    chosen = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    per_text = np.maximum(0, np.diff(offsets) - length + 1)
    text, place = ragged(per_text)
    start = offsets[:-1][text] + place
    if not len(start):
        return (none,) * 6
    a = chosen[start]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(a)) - 1
    lo, hi, a, text = start[first], start[last], a[first], text[first]
    raw = memoryview(data)
    context = np.fromiter((xxhash.xxh3_64_intdigest(raw[s:e]) for s, e in zip(lo.tolist(), (hi + length).tolist(), strict=True)), np.uint64, len(lo))
    return text, a - offsets[:-1][text], a - hi, a - lo, h(a, a + gram), context


def _samples(rows: DataFrame, kind: str, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, data, offsets in pieces(batches, "text"):
            text, place, least, most, h, f = _sampled(data, offsets, length, gram)
            if len(text):
                keys = [b.column(c).take(pa.array(text)) for c in _KEY]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(place), pa.array(least.astype(np.int32)), pa.array(most.astype(np.int32)), pa.array(h.view(np.int64)), pa.array(f.view(np.int64))], [*_KEY, "place", "least", "most", "h", "f"])

    return rows.mapInArrow(run, f"id {kind}, mark bigint, place bigint, least int, most int, h bigint, f bigint")


_TUPLE = "h bigint, f bigint, n bigint, least int, most int, before binary, after binary"


def _tuples(chosen: DataFrame, rows: DataFrame, length: int) -> DataFrame:
    """Suffix tuples: the bytes from each chosen position on, and those before it read backwards."""
    per_text = chosen.groupBy(*_KEY).agg(F.collect_list(F.struct("h", "f", "n", "place", "least", "most")).alias("chosen"))
    met = rows.join(per_text.select(F.col("id").alias("i"), F.col("mark").alias("m"), "chosen"), F.col("id").eqNullSafe(F.col("i")) & (F.col("mark") == F.col("m")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text, some in zip(b.column("text"), b.column("chosen"), strict=True):
                raw, some = text.as_py() or b"", some.as_py()
                out = [(c["h"], c["f"], c["n"], c["least"], c["most"], raw[c["place"] - c["most"] : c["place"]][::-1], raw[c["place"] : c["place"] + length - c["least"]]) for c in some]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], ["h", "f", "n", "least", "most", "before", "after"])

    return met.select("text", "chosen").mapInArrow(run, _TUPLE).dropDuplicates(["h", "f"])


def _padded(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = buffers(column)
    size = np.diff(offsets)
    out = np.zeros((len(size), width), np.uint8)
    row, place = ragged(size)
    out[row, place] = data
    return out, size


def induce(group: np.ndarray, least: np.ndarray, most: np.ndarray, before: pa.Array, after: pa.Array, length: int) -> np.ndarray:
    """For suffix tuples sorted by group and bytes: whether the string at each offset is that of another tuple of the group.

    The sorted suffixes and the common prefixes of neighbours are given; those one byte to the left are induced: sorted
    stably by that byte alone within what agreed so far, and the common prefix of new neighbours is the least between
    them. After k steps a run holds the tuples that agree on k bytes before the sampled position, in suffix order; a
    string that starts there is repeated if a neighbour's common prefix reaches its end.
    """
    n, width = len(group), int(most.max(initial=0)) + 1
    found = np.zeros((n, width), bool)
    right, size = _padded(after, length)
    left, _ = _padded(before, max(1, width))
    common = np.zeros(n, np.int64)
    if n > 1:
        differs = right[1:] != right[:-1]
        same = np.where(differs.any(1), differs.argmax(1), length)
        common[1:] = np.where(group[1:] == group[:-1], np.minimum(same, np.minimum(size[1:], size[:-1])), -1)
    common[0] = -1
    at, run = np.arange(n), group.copy()
    for k in range(width):
        if k:
            byte = left[at, k - 1].astype(np.int64)
            order = np.lexsort((byte, run))
            if (order[1:] < order[:-1]).any():
                p, q = order[:-1] + 1, order[1:] + 1
                bounds = np.stack([np.minimum(p, q), np.maximum(p, q)], 1).ravel()
                between = np.minimum.reduceat(np.append(common, -1), bounds)[::2]
            else:
                between = common[1:]
            byte, new_run, at = byte[order], run[order], at[order]
            joined = (new_run[1:] == new_run[:-1]) & (byte[1:] == byte[:-1])
            common = np.concatenate([[-1], np.where(joined, between, -1)])
            run = np.cumsum(np.concatenate([[True], ~joined]))
        enough = common >= length - k
        hit = enough | np.append(enough[1:], False)
        hit &= (least[at] <= k) & (k <= most[at])
        found[at[hit], k] = True
        reach = np.maximum(common, np.append(common[1:], -1))
        alive = (most[at] > k) & (reach >= length - most[at])
        if not alive.all():
            keep = np.flatnonzero(alive)
            if len(keep) < 2:
                break
            common = np.minimum.reduceat(common[: keep[-1] + 1], np.concatenate([[0], keep[:-1] + 1]))
            common[0] = -1
            at, run = at[keep], run[keep]
    return found


def _spans(found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of true places: row, first and last."""
    edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, first = np.nonzero(edge == 1)
    return row, first, np.nonzero(edge == -1)[1] - 1


_SPAN = "h bigint, f bigint, low int, high int"


def _repeated(tuples: DataFrame, length: int) -> DataFrame:
    """(h, f, low, high): offsets at which strings are repeated. Spark sorts the tuples on disk, tasks stream through them."""

    def settle(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        h, n, least, most = (t.column(c).to_numpy() for c in ("h", "n", "least", "most"))
        group = np.cumsum(np.concatenate([[0], h[1:] != h[:-1]]))
        found = induce(group, least, most, t.column("before"), t.column("after"), length)
        place = np.arange(found.shape[1])
        found |= (n > 1)[:, None] & (place >= least[:, None]) & (place <= most[:, None])
        row, low, high = _spans(found)
        return pa.RecordBatch.from_arrays([pa.array(h[row]), pa.array(t.column("f").to_numpy()[row]), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))], ["h", "f", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            while len(held) > STEP:
                h = held.column("h").to_numpy()
                cuts = np.flatnonzero(h[1:] != h[:-1]) + 1
                if not len(cuts):
                    break
                cut = int(cuts[min(np.searchsorted(cuts, STEP), len(cuts) - 1)])
                yield settle(held.slice(0, cut))
                held = held.slice(cut)
                if cut < STEP // 2:
                    break
        if held is not None and len(held):
            yield settle(held)

    return tuples.repartition("h").sortWithinPartitions("h", "after").mapInArrow(run, _SPAN)


def _counted(tuples: DataFrame, length: int) -> DataFrame:
    """The same for sampled strings with more tuples than a task should hold: every string by itself, counted by 128-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for h, f, n, least, most, before, after in zip(*(b.column(c).to_pylist() for c in ("h", "f", "n", "least", "most", "before", "after")), strict=True):
                raw = before[::-1] + after
                k = np.arange(least, most + 1)
                start = most - k
                digests = b"".join(xxhash.xxh3_128_digest(raw[s : s + length]) for s in start.tolist())
                one, two = np.frombuffer(digests, np.int64).reshape(-1, 2).T
                same = pa.array(np.full(len(k), h)), pa.array(np.full(len(k), f)), pa.array(np.full(len(k), n))
                yield pa.RecordBatch.from_arrays([*same, pa.array(k.astype(np.int32)), pa.array(one), pa.array(two)], ["h", "f", "n", "k", "one", "two"])

    each = written(tuples.mapInArrow(run, "h bigint, f bigint, n bigint, k int, one bigint, two bigint"), "suffix-crowd")
    often = each.groupBy("h", "k", "one", "two").agg(F.sum("n").alias("all")).filter("all > 1")
    return each.join(often, ["h", "k", "one", "two"]).select("h", "f", F.col("k").alias("low"), F.col("k").alias("high"))


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """(id, mark, spans: (s, e) pairs): byte ranges of each text that a string of length bytes covers which starts elsewhere too.

    id and mark (a hash of the text) tell texts apart; rows with both equal are one row here, and repeats of each other.
    Texts without a repeat have no row. Ranges of one text may overlap.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = _rows(docs, id_col, text_col)
    samples = written(_samples(rows, kind, length, gram), "suffix-samples")
    several = samples.groupBy("h").agg(F.count(F.lit(1)).alias("all"), (F.min("f") != F.max("f")).alias("mixed")).filter("all > 1").select("h", "mixed")
    met = written(samples.join(written(several, "suffix-several"), "h"), "suffix-met")  # written, so that a hot h is split in the join
    alike = met.filter("not mixed").select(*_KEY, (F.col("place") - F.col("most")).alias("s"), (F.col("place") - F.col("least") + length).alias("e"))
    one = F.min(F.struct(*_KEY, "place", "least", "most")).alias("one")
    kinds = met.filter("mixed").groupBy("h", "f").agg(F.count(F.lit(1)).alias("n"), one).select("h", "f", "n", "one.*")
    tuples = written(_tuples(kinds, rows, length), "suffix-tuples")
    crowded = tuples.groupBy("h").count().filter(F.col("count") > crowd).select("h")
    spans = _repeated(tuples.join(crowded, "h", "left_anti"), length)
    if not crowded.isEmpty():
        spans = spans.unionByName(_counted(tuples.join(crowded, "h", "left_semi"), length))
    mixed = met.filter("mixed").join(spans, ["h", "f"]).select(*_KEY, (F.col("place") - F.col("high")).alias("s"), (F.col("place") - F.col("low") + length).alias("e"))
    return alike.unionByName(mixed).groupBy(*_KEY).agg(F.collect_list(F.struct("s", "e")).alias("spans"))


def _rows(docs: DataFrame, id_col: str, text_col: str, carried: tuple[str, ...] = ()) -> DataFrame:
    rest = [F.struct(*carried).alias("rest")] if carried else []
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("mark"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"), *rest)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, carried: tuple[str, ...] = (), whole_characters: bool = False) -> DataFrame:
    """(id_col, mark, n_bytes, n_removed, n_spans, kept: binary, and rest: a struct of the carried columns) for each row of docs: its text without the bytes of repeated strings.

    A string of length bytes is repeated if it starts at another place of any text, the same one included; all its
    places lose it, and whole runs of covered bytes count as spans. Null, empty and short texts lose nothing unless
    another row repeats them whole; repeated rows are repeats of each other. kept may cut a character in two; with
    whole_characters what is left of one goes too, without being counted.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    spans = repeated(docs, id_col, text_col, length).select(F.col("id").alias("i"), F.col("mark").alias("m"), "spans")
    rows = _rows(docs, id_col, text_col, carried)
    rest = ["rest"] if carried else []
    both = rows.join(spans, F.col("id").eqNullSafe(F.col("i")) & (F.col("mark") == F.col("m")), "left").select("id", "mark", "text", "spans", *rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, removed, count = [], [], []
            for text, some in zip(b.column("text"), b.column("spans"), strict=True):
                raw, some = text.as_py() or b"", some.as_py()
                if some:
                    raw_array = np.frombuffer(raw, np.uint8)
                    depth = np.zeros(len(raw) + 1, np.int32)
                    np.add.at(depth, [x["s"] for x in some], 1)
                    np.add.at(depth, [x["e"] for x in some], -1)
                    gone = np.cumsum(depth)[:-1] > 0
                    count.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
                    removed.append(int(gone.sum()))
                    raw = raw_array[~gone].tobytes()
                else:
                    count.append(0)
                    removed.append(0)
                kept.append(raw)
            size = [len(k) + r for k, r in zip(kept, removed, strict=True)]
            if whole_characters:
                kept = [k.decode("utf-8", "ignore").encode() for k in kept]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("mark"), *(pa.array(x, pa.int64()) for x in (size, removed, count)), pa.array(kept, pa.binary()), *(b.column(c) for c in rest)], ["id", "mark", "n_bytes", "n_removed", "n_spans", "kept", *rest])

    found = both.mapInArrow(run, f"id {kind}, mark bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary" + "".join(f", rest {rows.schema[c].dataType.simpleString()}" for c in rest))
    return found.withColumnRenamed("id", id_col)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    found = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

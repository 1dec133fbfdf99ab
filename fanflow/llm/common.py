"""What the operators share: durable intermediate tables, Arrow batches as numpy buffers, token positions and hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one step of numpy work takes at once (a longer text is taken alone).
CHUNK_BYTES = 1_000_000

_own_dir: list[str] = []
#: Tables written inside settled(), by thread: runs side by side don't see each other's.
_tables: ContextVar[list[str] | None] = ContextVar("tables", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, on a local master only, a folder of this process."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith(("local[", "local*")) and spark.conf.get("spark.master", "local") != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _own_dir:
        _own_dir.append("file://" + tempfile.mkdtemp(prefix="spark-shared-"))
    return _own_dir[0]


def written(df: DataFrame, tag: str, by: str | None = None) -> DataFrame:
    """df, computed once: a Parquet table in the shared folder cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(by) if by else df.write
    if (on_the_way := _tables.get()) is not None:
        on_the_way.append(path)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(make: Callable[[], DataFrame], tag: str) -> tuple[DataFrame, Callable[[], None]]:
    """The rows of make() as a table of their own, and what deletes it. Tables that make() wrote on the way are deleted: its result no longer reads them.

    If make() fails, its tables stay for whoever looks into it.
    """
    tables: list[str] = []
    outer = _tables.set(tables)
    try:
        made = make()
        out = written(made, tag)
    finally:
        _tables.reset(outer)
    spark = made.sparkSession

    def drop(path: str) -> None:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)

    *on_the_way, path = tables
    for p in on_the_way:
        drop(p)
    return out, lambda: drop(path)


def crc_mod(col: str, n: int):
    """crc32 of the id as text, modulo n (null ids count as the empty text)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit(""))) % n


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string column and each text's offsets in them; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES, rows: int | None = None) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with about limit bytes of text, and so many rows, at most: (slice, bytes, offsets)."""
    for batch in batches:
        data, offsets = buffers(batch.column(text))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
            to = min(max(to, at + 1), at + (rows or batch.num_rows), batch.num_rows)
            yield batch.slice(at, to - at), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
            at = to


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes other than x20 and x09-x0D: start and end of each, and where each text's tokens begin among them."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = space[:-1]
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = space[1:]
    word = ~space
    starts = np.flatnonzero(word & (before | edge[:n]))
    ends = np.flatnonzero(word & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a 64-bit value over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Longest byte range that gets the multilinear hash, and the multiplier of each of its places.
SHORT = 32
_PLACES = mix64(np.arange(1, SHORT + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes by which byte ranges are told apart: multilinear up to SHORT bytes, XXH3 beyond.

    Each place has a random 64-bit multiplier of its own, so two different short ranges have equal hashes for at most one
    in 2^57 choices of the multipliers, however regular their bytes are.
    """
    lengths = ends - starts
    short = np.flatnonzero(lengths <= SHORT)
    n = lengths[short]
    group, place = ragged(n)
    sums = np.zeros(len(group) + 1, np.uint64)
    np.cumsum((data[starts[short][group] + place].astype(np.uint64) + np.uint64(1)) * _PLACES[place], out=sums[1:])
    to = np.cumsum(n)
    out = np.zeros(len(starts), np.uint64)
    out[short] = sums[to] - sums[to - n]
    for k in np.flatnonzero(lengths > SHORT):
        out[k] = xxhash.xxh3_64_intdigest(data[starts[k] : ends[k]])
    return mix64(out)


class RangeHash:
    """64-bit hashes of any byte ranges of a buffer, each in constant time (prefix sums of a polynomial with odd base).

    Regular ranges (Thue-Morse words of 1,024 bytes, say) may collide, so these hashes choose places and group strings,
    but never decide that strings are equal.
    """

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, seed: int = 0):
        table = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
        up, self.down = self._grown(seed, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(table[data] * up[: len(data)], out=self.sums[1:])

    @classmethod
    def _grown(cls, seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        if seed not in cls._powers or len(cls._powers[seed][0]) < n:
            base = (0x9E3779B97F4A7C15 + 2 * seed * 0x5851F42D) % 2**64 | 1
            made = []
            for b in (base, pow(base, -1, 2**64)):
                p = np.full(n + n // 4, b, np.uint64)
                p[0] = 1
                made.append(np.cumprod(p, dtype=np.uint64))
            cls._powers[seed] = (made[0], made[1])
        return cls._powers[seed]

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix64((self.sums[ends] - self.sums[starts]) * self.down[starts])


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def ragged(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of these lengths laid end to end: each element's group, and its place in the group."""
    group = np.repeat(np.arange(len(lengths)), lengths)
    first = np.cumsum(lengths) - lengths
    return group, np.arange(len(group)) - first[group]

"""Mixing sources to target weights by cube-method balanced sampling."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fanflow.llm.common import written

WEIGHTS = (5, 2, 1)
#: Most repeats of a source's words.
MOST = 3
#: Documents of a block of the flight phase; rows of a source table that is sent to every task, and bytes of its names.
BLOCK, SMALL_TABLE, SMALL_NAMES = 4096, 100_000, 20_000_000
#: Units of a source's last block that wait for the landing phase.
LANDING = 16
_NEAR = 1e-9


def word_count(col: str):
    """Runs of bytes other than x20 and x09-x0D; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(col), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def row_hash(id_col: str, text_col: str):
    """What tells rows with equal ids apart, unless their texts are equal too."""
    return F.xxhash64(F.col(id_col), F.xxhash64(F.col(text_col)))


def _before(rows: DataFrame, order: tuple[Column, ...], *sums: str) -> DataFrame:
    """rows with, for each of these columns, its sum over all rows before in this order (before_<column>, 0 for the first row).

    Rows, which must differ in their order, are dealt by ranges; a task sorts and adds up its own range, and only the sums of
    whole ranges, one row for each partition, are added up in one place.
    """
    dealt = written(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "mix-ranges")
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    total = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    ranges = dealt.groupBy("range").agg(*(F.sum(c).alias(f"all_{c}") for c in sums))
    ranges = ranges.select("range", *(total(f"all_{c}", earlier(Window.orderBy("range"))).alias(f"upto_{c}") for c in sums))
    own = earlier(Window.partitionBy("range").orderBy(*order))
    out = dealt.withColumns({f"before_{c}": total(c, own) for c in sums}).join(F.broadcast(ranges), "range")
    return out.withColumns({f"before_{c}": F.col(f"before_{c}") + F.col(f"upto_{c}") for c in sums}).drop("range", *(f"upto_{c}" for c in sums))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, n, source_size, target) from rows (source, size: long).

    Sources in code point order, null last, take the weights in turn and share the sum of all sizes by weight; no target
    exceeds most times its source's size, and what is over goes to the others by weight. In closed form: with sources
    by limit over weight, those before the first whose share of the rest is within its limit stay at their limits.
    Places and sums come from ranges of the table of sources, which is aggregated first: no task holds all sources,
    though each document may have its own. Sizes of 0 give targets of 0.
    """
    by_name = F.col("source").asc_nulls_last()
    total = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size")).withColumn("one", F.lit(1).cast("long"))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("before_one") % len(weights) + 1).cast("int"))
    t = _before(total, (by_name,), "one").select("source", "n", "source_size", weight.alias("w"), (F.col("source_size") * float(most)).alias("cap"))
    t = _before(t.withColumn("r", F.col("cap") / F.col("w")), (F.col("r").asc(), by_name), "cap", "w")
    t = written(t, "mix-sources")
    size, share = t.agg(F.sum("source_size"), F.sum("w")).first()
    level = (F.lit(float(size or 0)) - F.col("before_cap")) / (F.lit(share or 0.0) - F.col("before_w"))
    within = t.select("r", level.alias("level")).filter("level <= r")
    found = within.agg(F.min(F.struct("r", (-F.col("level")).alias("down"))).alias("first")).select("first.down").first().down
    target = F.col("cap") if found is None else F.least("cap", F.lit(-found) * F.col("w"))
    return t.select("source", "n", "source_size", target.alias("target"))


class Flight:
    """Moves inclusion probabilities through the null space of the constraints, three units at a time, until each is 0 or 1.

    Equal probabilities within a source make (1, size) the balancing variables. push() gives the units that it settles;
    pool holds those still between, two at most.
    """

    def __init__(self) -> None:
        self.pool: list[list] = []  # [probability, size, row, number for the draw]

    def _step(self, u: tuple[float, ...]) -> None:
        up = min((1 - p) / d if d > 0 else p / -d for (p, *_), d in zip(self.pool, u, strict=False) if d)
        down = min(p / d if d > 0 else (1 - p) / -d for (p, *_), d in zip(self.pool, u, strict=False) if d)
        draw = xxhash.xxh64_intdigest(b"".join(int(x[3] & 2**64 - 1).to_bytes(8, "little") for x in self.pool), 3) / 2**64
        by = up if draw * (up + down) < down else -down
        for x, d in zip(self.pool, u, strict=False):
            x[0] += by * d

    def settled(self) -> list[tuple]:
        done = [(round(x[0]), x[2]) for x in self.pool if not _NEAR < x[0] < 1 - _NEAR]
        self.pool = [x for x in self.pool if _NEAR < x[0] < 1 - _NEAR]
        return done

    def push(self, probability: float, size: float, row: object, number: int) -> list[tuple]:
        self.pool.append([probability, size, row, number])
        if len(self.pool) < 3:
            return self.settled()
        a, b, c = (x[1] for x in self.pool)
        u = (b - c, c - a, a - b)
        self._step(u if any(u) else (1.0, -1.0, 0.0))
        return self.settled()


def land(units: list[tuple[float, float, object, int]]) -> list[tuple]:
    """The landing problem: of all ways to take some of these few units, the one whose size is nearest to what their probabilities expect.

    Ties go to the nearest number of documents, then to the first. At most LANDING + 2 units, so 2^(LANDING + 2) ways.
    """
    size, count = np.zeros(1), np.zeros(1)
    for _, s, *_ in units:
        size, count = np.concatenate([size, size + s]), np.concatenate([count, count + 1])
    off = np.abs(size - sum(u[0] * u[1] for u in units))
    near = np.flatnonzero(off <= off.min() + 0.5)
    way = int(near[np.abs(count[near] - sum(u[0] for u in units)).argmin()])
    return [(way >> k & 1, u[2]) for k, u in enumerate(units)]


_FLOWN = "row struct<id:{kind},source:string,size:bigint,source_size:bigint,target:double,hash:bigint,whole:bigint>, p double, block bigint, taken bigint"


def _flight(rows: DataFrame, kind: str, last: bool) -> DataFrame:
    """rows (row, p, block) by source and block; taken is null for units still between."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, flight, waiting = None, Flight(), []

        def close(out: list) -> None:
            if last:
                out.extend((row, None, s) for s, row in land([*map(tuple, flight.pool), *(x[1] for x in sorted(waiting, key=lambda x: x[0]))]))
            else:
                out.extend((x[2], x[0], None) for x in flight.pool)
            flight.pool = []
            waiting.clear()

        def batch(out: list, kind: pa.DataType) -> pa.RecordBatch:
            row, p, s = ([x[k] for x in out] for k in range(3))
            taken = [None if k is None else r["size"] * (r["whole"] + k) for r, k in zip(row, s, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(row, kind), pa.array(p, pa.float64()), pa.array([0] * len(out), pa.int64()), pa.array(taken, pa.int64())], ["row", "p", "block", "taken"])

        made, seen = None, 0
        for b in batches:
            out: list[tuple] = []
            made = b.schema.field("row").type
            for row, p, block in zip(*(b.column(c).to_pylist() for c in ("row", "p", "block")), strict=True):
                if (row["source"], block) != group:
                    close(out)
                    group = (row["source"], block)
                unit = (p, float(row["size"]), row, row["hash"])
                if last:
                    seen += 1
                    unit = heapq.heappushpop(waiting, ((row["hash"], seen), unit))[1] if len(waiting) >= LANDING else heapq.heappush(waiting, ((row["hash"], seen), unit))
                if unit:
                    out.extend((r, None, s) for s, r in flight.push(*unit))
            if out:
                yield batch(out, made)
        close(out := [])
        if out:
            yield batch(out, made)

    dealt = rows.repartition(F.col("row.source"), F.col("block"))
    ordered = dealt.sortWithinPartitions(F.col("row.source"), F.col("block"), F.col("row.size").desc(), F.col("row.id"), F.col("row.hash"))
    return ordered.mapInArrow(run, _FLOWN.format(kind=kind))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, most: float = MOST, key: Column | None = None) -> DataFrame:
    """(id, hash, source, size, source_size, target, taken) for each row of docs: the words that the mix takes of it, repeats counted.

    Every document is taken whole: floor(target / source size) times, and once more for a balanced sample of its source,
    whose inclusion probability is the fraction left. The flight phase runs in blocks of a source, hot or not; the few
    units that each block leaves meet in blocks again until a source has one block, of which LANDING units wait and land
    with those left: their best subset settles what the flight could not. Draws come from a hash of id and text: reruns agree whatever the partitions. Null texts
    have size 0, which is never taken; null sources are a source of their own; repeated rows are units of their own;
    an empty table gives none. hash is row_hash(), or key if that is given: what tells rows apart that aren't alike.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), word_count(text_col).alias("size"), (row_hash(id_col, text_col) if key is None else key).alias("hash"))
    sizes = written(base, "mix-sizes")
    goal = written(targets(sizes, weights, most), "mix-targets").withColumnRenamed("source", "of")
    sources, largest, names = goal.agg(F.count(F.lit(1)), F.max("n"), F.coalesce(F.sum(F.octet_length("of")), F.lit(0))).first()
    goal = F.broadcast(goal) if sources <= SMALL_TABLE and names <= SMALL_NAMES else goal
    rows = sizes.join(goal, F.col("source").eqNullSafe(F.col("of"))).withColumn("ratio", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    rows = rows.withColumn("whole", F.floor(F.col("ratio") + _NEAR)).withColumn("p", F.greatest(F.lit(0.0), F.col("ratio") - F.col("whole")))
    unit = F.struct("id", "source", "size", "source_size", "target", "hash", "whole").alias("row")
    flies = (F.col("size") > 0) & (F.col("p") > _NEAR)
    done = [rows.filter(~flies).select("id", "hash", "source", "size", "source_size", "target", (F.col("size") * F.col("whole")).alias("taken"))]
    between = rows.filter(flies).select(unit, "p", "n")
    per_block = largest or 0
    while True:
        blocks = -(-per_block // BLOCK)
        of = F.ceil(F.col("n") / BLOCK) if "n" in between.columns else F.lit(max(1, blocks))
        flown = written(_flight(between.select("row", "p", F.pmod(F.col("row.hash"), F.greatest(F.lit(1), of)).alias("block")), kind, blocks <= 1), "mix-flight")
        done.append(flown.filter("taken is not null").select("row.id", "row.hash", "row.source", "row.size", "row.source_size", "row.target", "taken"))
        if blocks <= 1:
            break
        between, per_block = flown.filter("taken is null").select("row", "p"), 2 * blocks
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns: doc_id, size, source_size, target, taken."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")

"""Metrics as relations: histograms, quantiles and rates."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fanflow.operators import cdc

#: Upper edges of the batch size histogram.
BATCH_ROWS = (100, 500, 1_000, 5_000, 10_000, 50_000, 100_000, 500_000, 1_000_000, 5_000_000, 10_000_000)

#: Ranges into which quantiles() cuts the values.
BOUNDS = 256


def histogram(df: DataFrame, value: str, edges: tuple[int, ...] = BATCH_ROWS, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, le, count): values up to each edge, cumulative; le is +Inf for all. One scan for all labels, counted before the shuffle."""
    counts = df.groupBy(*by).agg(*(F.count_if(F.col(value) <= e).alias(f"c{n}") for n, e in enumerate(edges)), F.count(value).alias("all"))
    rows = F.array(*(F.struct(F.lit(str(e)).alias("le"), F.col(f"c{n}").alias("count")) for n, e in enumerate(edges)), F.struct(F.lit("+Inf").alias("le"), F.col("all").alias("count")))
    return counts.select(*by, F.inline(rows))


def quantiles(df: DataFrame, value: str, qs: tuple[float, ...] = (0.5, 0.95, 0.99)) -> DataFrame:
    """One row: exact quantiles, interpolated between neighbours; nulls don't count, and without values all are null.

    Approximate bounds cut the values into BOUNDS ranges whose counts go to the driver; only the ranges that hold a wanted
    rank are counted value by value, so no task holds all values.
    """
    rows = df.filter(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    bounds = sorted(set(rows.approxQuantile("v", [k / BOUNDS for k in range(1, BOUNDS)], 1 / BOUNDS / 2)))
    held = F.array(*map(F.lit, bounds)) if bounds else F.array(F.lit(0.0))
    ranged = rows.withColumn("range", F.size(F.filter(held, lambda b: b <= F.col("v"))))
    counts = {r.range: r.n for r in ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, total = {}, 0
    for k in sorted(counts):
        before[k] = total
        total += counts[k]
    ranks = {q: (math.floor(q * (total - 1)), math.ceil(q * (total - 1))) for q in qs} if total else {}
    of = lambda rank: max(k for k in before if before[k] <= rank)
    wanted = sorted({of(r) for pair in ranks.values() for r in pair})
    each = ranged.filter(F.col("range").isin(wanted)).groupBy("range", "v").agg(F.count(F.lit(1)).alias("n"))
    each = each.withColumn("to", F.sum("n").over(Window.partitionBy("range").orderBy("v")))
    at = lambda rank: F.min(F.when((F.col("range") == of(rank)) & (F.col("to") > rank - before[of(rank)]), F.col("v")))
    name = lambda q: f"p{round(q * 100)}"
    if not ranks:
        return each.agg(*(F.max(F.lit(None).cast("double")).alias(name(q)) for q in qs))
    return each.agg(*((at(lo) + (at(hi) - at(lo)) * (q * (total - 1) - lo)).alias(name(q)) for q, (lo, hi) in ranks.items()))


def histogram_quantile(buckets: DataFrame, q: float, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, quantile) from cumulative buckets (by, le: text, count): linear within the bucket that holds the rank.

    The first bucket starts at 0; a rank beyond the last finite edge gives that edge; no observations give null.
    """
    edge = F.when(F.col("le") == "+Inf", F.lit(float("inf"))).otherwise(F.col("le").cast("double"))
    order = Window.partitionBy(*by).orderBy("edge") if by else Window.partitionBy(F.lit(0)).orderBy("edge")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = buckets.withColumn("edge", edge).withColumn("low", F.coalesce(F.lag("edge").over(order), F.lit(0.0)))
    rows = rows.withColumn("under", F.coalesce(F.lag("count").over(order), F.lit(0))).withColumn("rank", q * F.last("count").over(whole))
    inside = (F.col("count") >= F.col("rank")) & (F.col("count") > F.col("under"))
    value = F.when(F.col("edge") == float("inf"), F.col("low")).otherwise(F.col("low") + (F.col("edge") - F.col("low")) * (F.col("rank") - F.col("under")) / (F.col("count") - F.col("under")))
    return rows.groupBy(*by).agg(F.min_by(F.when(inside, value), F.when(inside, F.col("edge"))).alias("quantile"))


def rates(samples: DataFrame, label: str, at: str, value: str) -> DataFrame:
    """(label, at, rate) of a counter's growth by second since the sample before; a fall is a restart from 0."""
    before = Window.partitionBy(label).orderBy(at)
    grown, seconds = F.col(value) - F.lag(value).over(before), F.col(at) - F.lag(at).over(before)
    return samples.select(label, at, (F.when(grown < 0, F.col(value)).otherwise(grown) / seconds).alias("rate")).filter("rate is not null")


def rate_by(samples: DataFrame, series: list[str], by: str, at: str, value: str) -> DataFrame:
    """(by, at, rate): the rates of all series (told apart by their labels) summed by one label."""
    labelled = samples.withColumn("_series", F.to_json(F.struct(*series)))
    label = labelled.select("_series", by).distinct()
    return rates(labelled, "_series", at, value).join(label, "_series").groupBy(by, at).agg(F.sum("rate").alias("rate"))


#: Names of a round's metrics, those of the round and those of each destination.
ROUND = ("polls_total", "cdc_read_seconds", "cdc_rows_read_total", "source_snapshot_id", "dest_write_seconds", "unrouted_rows_total", "errors_total", "cdc_batch_rows", "cdc_routing_mutations_total", "cdc_conflicts_resolved_total", "cdc_orphaned_preimages_total", "dest_upsert_matched_total")
EACH = ("dest_rows_written_total", "dest_rows_deleted_total", "dest_rows_upserted_total", "dest_upsert_matched_total", "dest_last_snapshot_id", "dest_lag_snapshots")


def relation(spark: SparkSession, numbers: dict[str, float], destinations: dict[str, dict[str, float]], pipeline: str, kind: str = "double") -> DataFrame:
    """(pipeline, metric, destination_id, value): a round's numbers, and those of its destinations, as they were observed in its own jobs.

    Names that are none of ROUND and EACH are left out, as are numbers that a round has not.
    """
    rows = [(n, None, numbers[n]) for n in ROUND if n in numbers] + [(n, d, v[n]) for d, v in destinations.items() for n in EACH if n in v]
    table = pa.table({"metric": pa.array([r[0] for r in rows], pa.string()), "destination_id": pa.array([r[1] for r in rows], pa.string()), "value": pa.array([float(r[2]) for r in rows], pa.float64())})
    return spark.createDataFrame(table).select(F.lit(pipeline).alias("pipeline"), "metric", "destination_id", F.col("value").cast(kind).alias("value"))


def sent(table: DataFrame, batch: DataFrame, keys: tuple[str, ...]) -> dict[str, dict[str, int]]:
    """By destination: rows that a resolved batch writes, deletes and upserts, and those upserts that table has. One job; a row for each destination comes back."""
    rows = cdc.apply_counts(table, batch, keys, ("destination_id",)).collect()
    return {r.destination_id: {"dest_rows_written_total": r.deleted + r.upserted, "dest_rows_deleted_total": r.deleted, "dest_rows_upserted_total": r.upserted, "dest_upsert_matched_total": r.upsert_matched} for r in rows}

"""Cursor and status relations of destinations."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATE = "destination_id string, instance_id string, last_snapshot_id bigint, last_replicated_at timestamp, rows_replicated bigint, last_error string, last_error_at timestamp, updated_at timestamp"


def _no_time() -> Column:
    return F.lit(None).cast("timestamp")


def cursors_of(destinations: DataFrame, state: DataFrame, instance: str) -> DataFrame:
    """destinations with their state of this instance; a destination without state is at snapshot 0 with no rows."""
    mine = state.filter(F.col("instance_id") == instance).drop("instance_id")
    known = destinations.select("destination_id").join(mine, "destination_id", "left")
    return known.withColumn("last_snapshot_id", F.coalesce("last_snapshot_id", F.lit(0))).withColumn("rows_replicated", F.coalesce("rows_replicated", F.lit(0)))


def group_by_cursor(cursors: DataFrame) -> DataFrame:
    return cursors.groupBy("last_snapshot_id").agg(F.sort_array(F.collect_list("destination_id")).alias("destinations"))


def behind(cursors: DataFrame, snapshot: int) -> DataFrame:
    return cursors.filter(F.col("last_snapshot_id") < snapshot)


def initialise(state: DataFrame, destinations: DataFrame, instance: str, now: Column) -> DataFrame:
    """state with a row at snapshot 0 for each destination of this instance that has none."""
    mine = state.filter(F.col("instance_id") == instance)
    new = destinations.select("destination_id").distinct().join(mine, "destination_id", "left_anti")
    null = F.lit(None)
    return state.unionByName(new.select("destination_id", F.lit(instance).alias("instance_id"), F.lit(0).cast("bigint").alias("last_snapshot_id"), _no_time().alias("last_replicated_at"), F.lit(0).cast("bigint").alias("rows_replicated"), null.cast("string").alias("last_error"), _no_time().alias("last_error_at"), now.alias("updated_at")))


def _mine(instance: str, destinations: Sequence[str]) -> Column:
    return (F.col("instance_id") == instance) & F.col("destination_id").isin(list(destinations))


def advance(state: DataFrame, instance: str, destinations: Sequence[str], snapshot: int, now: Column, rows: int | None = None) -> DataFrame:
    """Cursors moved to snapshot, errors cleared; rows is the new cumulative count, None keeps it."""
    here = _mine(instance, destinations)
    new = {"last_snapshot_id": F.lit(snapshot).cast("bigint"), "last_replicated_at": now, "last_error": F.lit(None).cast("string"), "last_error_at": _no_time(), "updated_at": now}
    if rows is not None:
        new["rows_replicated"] = F.lit(rows).cast("bigint")
    return state.withColumns({k: F.when(here, v).otherwise(F.col(k)) for k, v in new.items()})


def add_rows(state: DataFrame, instance: str, done: DataFrame) -> DataFrame:
    """state with the operations of a round (destination_id, rows: one row for each destination) added to this instance's cumulative counts."""
    ops = done.select("destination_id", F.col("rows").alias("_ops"))
    more = F.when(F.col("instance_id") == instance, F.coalesce("_ops", F.lit(0))).otherwise(0)
    return state.join(ops, "destination_id", "left").withColumn("rows_replicated", F.coalesce("rows_replicated", F.lit(0)) + more).select(*state.columns)


def record_error(state: DataFrame, instance: str, destination: str, message: str, now: Column) -> DataFrame:
    """Cursor and count stay, the error and its time are set, the replication time is cleared; no row, no effect."""
    here = _mine(instance, [destination])
    new = {"last_error": F.lit(message), "last_error_at": now, "last_replicated_at": _no_time(), "updated_at": now}
    return state.withColumns({k: F.when(here, v).otherwise(F.col(k)) for k, v in new.items()})


def status(cursors: DataFrame, current: int) -> DataFrame:
    lag = F.lit(current) - F.col("last_snapshot_id")
    said = F.when(F.col("last_error").isNotNull(), "error").when(lag > 0, "lagging").otherwise("healthy")
    return cursors.select("destination_id", F.col("last_snapshot_id").alias("snapshot"), lag.alias("lag"), "rows_replicated", said.alias("status"), "last_error")


def status_document(states: DataFrame, source_table: str, snapshot: int | None, mode: str, poll_interval: int) -> DataFrame:
    """One row (document): the source's and all destinations' status() as JSON, destinations by id, nulls written."""
    rows = F.array_sort(F.collect_list(F.struct("destination_id", *(c for c in states.columns if c != "destination_id"))))
    whole = F.struct(F.lit(source_table).alias("source_table"), F.lit(snapshot).alias("source_snapshot"), F.lit(mode).alias("mode"), F.lit(poll_interval).alias("poll_interval"), F.col("destinations"))
    return states.agg(rows.alias("destinations")).select(F.to_json(whole, {"ignoreNullFields": "false"}).alias("document"))


#: Seconds since the last poll, and since the last replication, from which on an instance is not alive, and not ready.
ALIVE, READY = 300, 600


def health(df: DataFrame, now: Column) -> DataFrame:
    """df (last_poll_at, last_replicated_at) with alive and ready. Alive: it has polled within ALIVE seconds; ready: alive, and what was ever replicated was so within READY."""
    age = lambda c: F.unix_micros(now.cast("timestamp")) / 1e6 - F.unix_micros(F.col(c).cast("timestamp")) / 1e6
    alive = F.coalesce(age("last_poll_at") < ALIVE, F.lit(False))
    return df.withColumn("alive", alive).withColumn("ready", alive & (F.col("last_replicated_at").isNull() | (age("last_replicated_at") < READY)))


def max_lag(cursors: DataFrame, current: int) -> DataFrame:
    return cursors.agg(F.max(F.lit(current) - F.coalesce("last_snapshot_id", F.lit(0))).alias("max_lag"))


def partition_of(destination: str, total: int) -> int:
    return int(hashlib.sha256(destination.encode()).hexdigest(), 16) % total


def partition_column(name: str, total: int) -> Column:
    """The same as a column: hex digits of SHA-256 reduced modulo total."""
    digits = F.split(F.sha2(F.col(name).cast("binary"), 256), "")
    return F.aggregate(digits, F.lit(0).cast("bigint"), lambda acc, d: F.when(d == "", acc).otherwise((acc * 16 + F.conv(d, 16, 10).cast("bigint")) % total))


def assigned(destinations: Sequence[str], mode: str = "all", include: Sequence[str] = (), total: int = 1, ordinal: int = 0) -> list[str]:
    """This instance's destinations: all, those listed (in list order, unknown ones left out), or those of its hash part."""
    if mode == "all":
        return list(destinations)
    if mode == "explicit":
        return [d for d in include if d in set(destinations)]
    if mode == "hash":
        return [d for d in destinations if partition_of(d, total) == ordinal]
    raise ValueError(f"unknown partition mode {mode}")

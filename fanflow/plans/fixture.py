"""A change log derived from the `events` table, so that every query's work grows with it."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("click", "view", "purchase", "signup", "error")
#: Destinations by routing value; `error` has none.
DESTINATIONS = {k: f"d_{k}" for k in KINDS[:4]}
END = 9


def script() -> list[tuple[int, int, str, int, int, int]]:
    """(class of event_id % 20, snapshot, change type, routing shift, added to value, added to rowid)."""
    rows = [(c, 1 + c % 4, "insert", 0, 0, 0) for c in (*range(17), 19)] + [(17, 8, "insert", 0, 0, 0), (18, 6, "insert", 0, 0, 0)]
    #: class, snapshot, shift and sum before, shift and sum after
    updates = [(8, 5, 0, 0, 0, 100), (9, 5, 0, 0, 0, 100), (10, 5, 0, 0, 0, 100), (10, 7, 0, 100, 0, 200), (11, 6, 0, 0, 1, 100), (12, 6, 0, 0, 1, 100), (12, 7, 1, 100, 0, 200), (14, 5, 0, 0, 0, 100), (18, 9, 0, 0, 0, 100), (19, 5, 0, 0, 1, 100)]
    for c, at, s0, a0, s1, a1 in updates:
        rows += [(c, at, "update_preimage", s0, a0, 0), (c, at, "update_postimage", s1, a1, 0)]
    rows += [(13, 8, "delete", 0, 0, 0), (14, 8, "delete", 0, 100, 0), (15, 8, "delete", 0, 0, 0), (15, 9, "insert", 0, 1000, 10_000_000)]
    return [*rows, (16, 6, "update_preimage", 0, 0, 0), (17, 9, "delete", 0, 0, 0), (19, 9, "delete", 1, 100, 0)]


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, company (routing), val, change_type, snapshot_id, rowid."""
    kinds = [("cls", pa.int32()), ("snapshot_id", pa.int64()), ("change_type", pa.string()), ("shift", pa.int32()), ("added", pa.int32()), ("moved", pa.int64())]
    steps = spark.createDataFrame(pa.table({name: pa.array(values, kind) for (name, kind), values in zip(kinds, zip(*script(), strict=True), strict=True)}))
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type", "value")
    both = events.join(F.broadcast(steps), F.col("event_id") % 20 == F.col("cls"))
    kinds = F.array(*map(F.lit, KINDS))
    place = F.array_position(kinds, F.col("event_type")) - 1 + F.col("shift")
    company = F.when(F.col("event_id") % 50 != 7, F.element_at(kinds, (place % len(KINDS) + 1).cast("int")))
    return both.select("event_id", company.alias("company"), (F.col("value") + F.col("added")).alias("val"), "change_type", "snapshot_id", (F.col("event_id") + F.col("moved")).alias("rowid"))


_SCRIPT = ", ".join(map(str, script()))
_KINDS = "[" + ", ".join(f"'{k}'" for k in KINDS) + "]"
LOG_SQL = f"""script(cls, snapshot_id, change_type, shift, added, moved) AS (VALUES {_SCRIPT}),
log AS (SELECT event_id, CASE WHEN event_id % 50 <> 7 THEN ({_KINDS})[(list_position({_KINDS}, event_type) - 1 + shift) % 5 + 1] END AS company,
    value + added AS val, change_type, snapshot_id::BIGINT AS snapshot_id, event_id + moved AS rid FROM events JOIN script ON event_id % 20 = cls)"""

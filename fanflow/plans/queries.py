"""Registered queries of the change-data-capture engine and the SQL that gives the same rows.

Queries call the operators; the SQL is written apart from them, with joins and groups where they use windows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fanflow.functions import metrics
from fanflow.operators import cdc, cursors, routing
from fanflow.plans import replicate
from fanflow.plans.fixture import DESTINATIONS, END, KINDS, LOG_SQL, change_log
from fanflow.sources.config import Config, Destination
from fanflow.sources.lake import LakeTable, shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_IN = "('click', 'view', 'purchase', 'signup')"
_KEYS = ("event_id",)


def _query(sql: str | None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _out(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("rowid", "rid")


def _routed(spark: SparkSession, sf_dir: str, start: int = 0) -> DataFrame:
    log = cdc.in_range(change_log(spark, sf_dir), start, END)
    return routing.route(log, "company", DESTINATIONS).withColumn("cursor", F.lit(start))


def _resolved(spark: SparkSession, sf_dir: str, start: int = 0, pairing: str = "compatible") -> DataFrame:
    return replicate.resolve(_routed(spark, sf_dir, start), "company", _KEYS, pairing).drop("cursor")


def _at(spark: SparkSession, sf_dir: str, snapshot: int) -> DataFrame:
    """The destinations as they should be at a snapshot."""
    return routing.route(cdc.as_of(change_log(spark, sf_dir), snapshot), "company", DESTINATIONS).drop("rowid")


def _applied(spark: SparkSession, sf_dir: str, start: int = 0, pairing: str = "compatible") -> DataFrame:
    return cdc.apply_changes(_at(spark, sf_dir, start), _resolved(spark, sf_dir, start, pairing), _KEYS, ("destination_id",))


def _with(*more: str) -> str:
    return "WITH " + ",\n".join([LOG_SQL, *more]) + "\n"


def _phases(start: int = 0, hardened: bool = False) -> list[str]:
    """Window after the routing filter, phase 1 (p1) and phase 2 (p2) by joins with grouped tables."""
    older = " OR p.last_snap < w.snapshot_id" if hardened else ""
    return [
        f"win AS (SELECT *, 'd_' || company AS destination_id FROM log WHERE snapshot_id > {start} AND snapshot_id <= {END} AND company IN {_IN})",
        "posts AS (SELECT rid, arg_max(company, snapshot_id) AS last, max(snapshot_id) AS last_snap FROM win WHERE change_type = 'update_postimage' GROUP BY rid)",
        f"p1 AS (SELECT w.* REPLACE (CASE WHEN change_type = 'update_preimage' THEN 'delete' ELSE change_type END AS change_type) FROM win w LEFT JOIN posts p USING (rid) WHERE change_type <> 'update_preimage' OR p.rid IS NULL OR p.last <> w.company{older})",
        "fl AS (SELECT destination_id, rid, bool_or(change_type = 'insert') AS i, bool_or(change_type = 'delete') AS d, bool_or(change_type = 'update_postimage') AS p FROM p1 GROUP BY ALL)",
        "p2 AS (SELECT p1.* FROM p1 JOIN fl USING (destination_id, rid) WHERE NOT ((change_type = 'insert' AND (d OR p)) OR (change_type = 'delete' AND i) OR (change_type = 'update_postimage' AND d)))",
    ]


def _state(name: str, snapshot: int) -> str:
    return f"""{name} AS (SELECT event_id, company, val, 'd_' || company AS destination_id FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY snapshot_id DESC, change_type IN ('insert', 'update_postimage') DESC) AS n
    FROM log WHERE snapshot_id <= {snapshot}) WHERE n = 1 AND change_type IN ('insert', 'update_postimage') AND company IN {_IN})"""


def _apply(start: int = 0, hardened: bool = False) -> list[str]:
    return [
        *_phases(start, hardened), _state("prev", start),
        "ups AS (SELECT event_id, company, val, destination_id FROM p2 WHERE change_type IN ('insert', 'update_postimage') QUALIFY row_number() OVER (PARTITION BY destination_id, event_id ORDER BY snapshot_id DESC, rid DESC) = 1)",
        "applied AS (SELECT * FROM prev WHERE NOT EXISTS (FROM p2 WHERE p2.destination_id = prev.destination_id AND p2.event_id = prev.event_id) UNION ALL SELECT * FROM ups)",
    ]


_ALL = "event_id, company, val, change_type, snapshot_id, rid"


@_query(_with() + f"SELECT {_ALL} FROM log WHERE snapshot_id > 4 AND snapshot_id <= 9")
def cdc_changes_range(spark, sf_dir):
    return _out(cdc.in_range(change_log(spark, sf_dir), 4, END))


@_query(_with() + f"SELECT {_ALL} FROM log WHERE snapshot_id > 2 AND snapshot_id <= 9 AND change_type = 'insert'")
def cdc_insertions_range(spark, sf_dir):
    return _out(cdc.insertions(change_log(spark, sf_dir), 2, END))


@_query(_with() + "SELECT max(snapshot_id) AS current_snapshot FROM log")
def current_snapshot(spark, sf_dir):
    return change_log(spark, sf_dir).agg(F.max("snapshot_id").alias("current_snapshot"))


@_query(_with() + "SELECT snapshot_id, change_type, count(*) AS changes FROM log GROUP BY ALL")
def snapshot_change_counts(spark, sf_dir):
    return change_log(spark, sf_dir).groupBy("snapshot_id", "change_type").agg(F.count(F.lit(1)).alias("changes"))


@_query(_with(_state("s", 6)) + "SELECT event_id, company, val, destination_id FROM s")
def scan_as_of(spark, sf_dir):
    return _at(spark, sf_dir, 6)


@_query(_with() + "SELECT event_id, company, val FROM log WHERE snapshot_id <= 5")
def strip_meta(spark, sf_dir):
    return cdc.strip_meta(cdc.in_range(change_log(spark, sf_dir), 0, 5))


@_query(_with() + f"SELECT {_ALL} FROM log WHERE company IN ('view', 'signup')")
def filter_routing_values(spark, sf_dir):
    log = change_log(spark, sf_dir)
    return _out(log.filter(routing.value_filter(log, "company", ["view", "signup"])))


@_query(_with() + "SELECT snapshot_id, false AS kept, count(*) AS rows FROM log GROUP BY ALL")
def filter_routing_empty(spark, sf_dir):
    """Without routing values no row is kept: all rows of every snapshot, by what the filter says."""
    log = change_log(spark, sf_dir)
    return log.groupBy("snapshot_id", routing.value_filter(log, "company", []).alias("kept")).agg(F.count(F.lit(1)).alias("rows"))


@_query(_with() + f"SELECT {_ALL} FROM log WHERE company = 'view' OR company IS NULL")
def delete_predicate_single(spark, sf_dir):
    """The predicate form of a delete filter over one column: IN and IS NULL."""
    return _out(change_log(spark, sf_dir).filter(cdc.delete_predicate([{"company": "view"}, {"company": None}], ("company",))))


@_query(_with() + f"SELECT {_ALL} FROM log WHERE (company = 'click' AND snapshot_id = 5) OR (company IS NULL AND snapshot_id = 3)")
def delete_predicate_composite(spark, sf_dir):
    keys = [{"company": "click", "snapshot_id": 5}, {"company": None, "snapshot_id": 3}]
    return _out(change_log(spark, sf_dir).filter(cdc.delete_predicate(keys, ("company", "snapshot_id"))))


@_query(_with(*_phases()) + f"SELECT {_ALL.replace('company', 'company AS user_domain')}, destination_id FROM p2")
def route_special_column(spark, sf_dir):
    """Routing, keys and both phases by a column whose name has signs that SQL would read."""
    odd = "user@domain.`x`"
    routed = routing.route(change_log(spark, sf_dir).withColumnRenamed("company", odd), odd, DESTINATIONS).withColumn("cursor", F.lit(0))
    done = replicate.resolve(routed, odd, _KEYS).drop("cursor")
    return _out(done.select(*(cdc.col(c).alias("user_domain" if c == odd else c) for c in done.columns)))


@_query(_with(*_phases()) + "SELECT destination_id, count(*) FILTER (change_type = 'delete') AS deletes, count(*) FILTER (change_type IN ('insert', 'update_postimage')) AS upserts FROM p2 GROUP BY ALL")
def change_type_split(spark, sf_dir):
    batch = _resolved(spark, sf_dir)
    parts = cdc.deletes(batch).select("destination_id", F.lit(1).alias("d"), F.lit(0).alias("u")).unionByName(cdc.upserts(batch).select("destination_id", F.lit(0).alias("d"), F.lit(1).alias("u")))
    return parts.groupBy("destination_id").agg(F.sum("d").alias("deletes"), F.sum("u").alias("upserts"))


@_query(_with(*_phases()) + f"SELECT {_ALL}, destination_id FROM p1")
def preimage_resolve(spark, sf_dir):
    return _out(cdc.resolve_preimages(_routed(spark, sf_dir), "company", _KEYS, ("cursor",)).drop("cursor"))


@_query(_with(*_phases(4, True)) + f"SELECT {_ALL}, destination_id FROM p1")
def preimage_resolve_hardened(spark, sf_dir):
    return _out(cdc.resolve_preimages(_routed(spark, sf_dir, 4), "company", _KEYS, ("cursor",), True).drop("cursor"))


@_query(_with(*_phases()) + "SELECT count(*) FILTER (p.rid IS NULL) AS orphans, count(*) FILTER (p.last <> w.company) AS mutations, count(*) FILTER (p.last = w.company) AS dropped FROM win w LEFT JOIN posts p USING (rid) WHERE change_type = 'update_preimage'")
def preimage_metrics(spark, sf_dir):
    return cdc.preimage_counts(_routed(spark, sf_dir), "company", ("cursor",))


@_query(_with(*_phases()) + f"SELECT {_ALL}, destination_id FROM win")
def route_split(spark, sf_dir):
    return _out(_routed(spark, sf_dir).drop("cursor"))


@_query(_with() + f"SELECT CASE WHEN company IN {_IN} THEN 'd_' || company END AS destination_id, count(*) AS rows FROM log GROUP BY ALL")
def route_counts(spark, sf_dir):
    return routing.route_counts(change_log(spark, sf_dir), "company", DESTINATIONS)


@_query("SELECT c_custkey, c_nationkey, 'n' || c_nationkey AS destination_id FROM customer WHERE c_nationkey IN (3, 7, 11)")
def route_integer_column(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_nationkey")
    return routing.route(rows, "c_nationkey", {"3": "n3", " 7 ": "n7", "11": "n11"})


@_query("SELECT l_orderkey, l_linenumber, l_discount, CASE WHEN l_discount = 0.05 THEN 'five' ELSE 'seven' END AS destination_id FROM lineitem WHERE l_discount IN (0.05::DOUBLE, 0.07::DOUBLE)")
def route_float_column(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_discount")
    return routing.route(rows, "l_discount", {"0.05": "five", "0.07": "seven"})


@_query(_with() + f"SELECT company IS NULL AS is_null, count(*) AS rows FROM log WHERE company IS NULL OR company NOT IN {_IN} GROUP BY ALL")
def route_null_unrouted(spark, sf_dir):
    left = routing.route(change_log(spark, sf_dir), "company", DESTINATIONS, True).filter("destination_id IS NULL")
    return left.groupBy(F.col("company").isNull().alias("is_null")).agg(F.count(F.lit(1)).alias("rows"))


@_query(_with(*_phases()) + f"SELECT {_ALL}, destination_id FROM p2")
def conflict_resolve(spark, sf_dir):
    return _out(_resolved(spark, sf_dir))


@_query(_with(*_phases()) + "SELECT count(*) FILTER (i AND (d OR p)) AS conflicts FROM fl")
def conflict_metrics(spark, sf_dir):
    first = cdc.resolve_preimages(_routed(spark, sf_dir), "company", _KEYS, ("cursor",))
    return cdc.conflict_counts(first, ("destination_id",))


@_query(_with(*_apply()) + "SELECT * FROM ups")
def upsert_candidates_lww(spark, sf_dir):
    return cdc.strip_meta(cdc.last_write_wins(_resolved(spark, sf_dir), _KEYS, ("destination_id",)))


@_query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def delete_keys_single(spark, sf_dir):
    orders, lines = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("orders", "lineitem"))
    gone = lines.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return cdc.without_keys(orders.select("o_orderkey", "o_custkey", "o_orderstatus"), gone, ["o_orderkey"])


@_query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l WHERE NOT EXISTS (FROM lineitem d WHERE d.l_quantity > 25 AND d.l_orderkey = l.l_orderkey AND d.l_linenumber = l.l_linenumber)")
def delete_keys_composite(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    keys = ["l_orderkey", "l_linenumber"]
    return cdc.without_keys(lines.select(*keys, "l_partkey"), lines.filter("l_quantity > 25").select(*keys), keys)


@_query(_with(_state("s", 4)) + ", k AS (SELECT DISTINCT company, event_id % 3 AS third FROM log WHERE company IS NULL OR company = 'view')\nSELECT event_id, company, val FROM (SELECT event_id, company, val FROM log WHERE snapshot_id <= 4) t WHERE NOT EXISTS (FROM k WHERE k.company IS NOT DISTINCT FROM t.company AND k.third = t.event_id % 3)")
def delete_keys_nullsafe(spark, sf_dir):
    log = change_log(spark, sf_dir)
    third = (F.col("event_id") % 3).alias("third")
    table = cdc.strip_meta(cdc.in_range(log, 0, 4)).select("event_id", "company", "val", third)
    return cdc.without_keys(table, log.filter("company IS NULL OR company = 'view'").select("company", third), ["company", "third"]).drop("third")


@_query(_with(*_apply()) + "SELECT * FROM applied")
def apply_full(spark, sf_dir):
    return _applied(spark, sf_dir)


@_query(_with(*_apply(4)) + "SELECT * FROM applied")
def apply_from_cursor_4(spark, sf_dir):
    return _applied(spark, sf_dir, 4)


@_query(_with(*_apply(6, True)) + "SELECT * FROM applied")
def apply_from_cursor_6_hardened(spark, sf_dir):
    return _applied(spark, sf_dir, 6, "hardened")


@_query(_with(_state("s", END)) + "SELECT * FROM s")
def apply_empty_change_set(spark, sf_dir):
    """A round of destinations that have caught up: no changes, and the tables stay as they are."""
    return _applied(spark, sf_dir, END)


@_query(_with(*_apply(4)) + """, kept AS (SELECT * FROM prev WHERE NOT EXISTS (FROM p2 WHERE p2.change_type = 'delete' AND p2.destination_id = prev.destination_id AND p2.event_id = prev.event_id)),
m AS (SELECT destination_id, count(*) AS upsert_matched FROM ups JOIN kept USING (destination_id, event_id) GROUP BY ALL)
SELECT destination_id, count(*) FILTER (change_type = 'delete') AS deleted, count(*) FILTER (change_type <> 'delete') AS upserted, coalesce(any_value(upsert_matched), 0) AS upsert_matched FROM p2 LEFT JOIN m USING (destination_id) GROUP BY destination_id""")
def apply_counts(spark, sf_dir):
    return cdc.apply_counts(_at(spark, sf_dir, 4), _resolved(spark, sf_dir, 4), _KEYS, ("destination_id",))


@_query(_with(*_phases(4), _state("prev", 4)) + "SELECT * FROM prev WHERE NOT EXISTS (FROM p2 WHERE change_type = 'delete' AND p2.destination_id = prev.destination_id AND p2.event_id = prev.event_id)")
def apply_delete_only(spark, sf_dir):
    return cdc.apply_changes(_at(spark, sf_dir, 4), cdc.deletes(_resolved(spark, sf_dir, 4)), _KEYS, ("destination_id",))


@_query(_with() + f"SELECT event_id, company, val, 'd_' || company AS destination_id FROM log WHERE change_type = 'insert' AND company IN {_IN}")
def append_only_round_trip(spark, sf_dir):
    return cdc.strip_meta(routing.route(cdc.insertions(change_log(spark, sf_dir), 0, END), "company", DESTINATIONS))


@_query(_with(_state("s", 5)) + "SELECT * FROM s WHERE destination_id IN ('d_click', 'd_signup')")
def seed_scan(spark, sf_dir):
    new = {v: DESTINATIONS[v] for v in ("click", "signup")}
    return routing.route(cdc.as_of(change_log(spark, sf_dir), 5), "company", new).drop("rowid")


def _difference(a: DataFrame, b: DataFrame) -> DataFrame:
    b = b.select(*a.columns)
    over, under = a.exceptAll(b).agg(F.count(F.lit(1)).alias("over")), b.exceptAll(a).agg(F.count(F.lit(1)).alias("under"))
    return over.crossJoin(under)


def _difference_sql(a: str, b: str) -> str:
    return f"SELECT (SELECT count(*) FROM (SELECT * FROM {a} EXCEPT ALL SELECT * FROM {b})) AS over, (SELECT count(*) FROM (SELECT * FROM {b} EXCEPT ALL SELECT * FROM {a})) AS under"


@_query(_with(*_apply(5, True), _state("s", 9)) + _difference_sql("applied", "s"))
def seed_then_replay_equals_scan(spark, sf_dir):
    return _difference(_applied(spark, sf_dir, 5, "hardened"), _at(spark, sf_dir, END))


@_query(_with(*_apply(), _state("s", 9)) + _difference_sql("applied", "s"))
def eventual_consistency_diff(spark, sf_dir):
    return _difference(_applied(spark, sf_dir), _at(spark, sf_dir, END))


@_query(_with(*_apply(4)) + "SELECT count(*) AS rows, count(*) FILTER (destination_id <> 'd_' || company) AS misplaced FROM applied")
def partition_correctness_diff(spark, sf_dir):
    rows = _applied(spark, sf_dir, 4)
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("destination_id") != F.concat(F.lit("d_"), "company")).alias("misplaced"))


def _cursor_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State rows by event type: as many rows replicated as events, snapshot by the type; `signup` has none."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").filter("event_type <> 'signup'")
    counts = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    place = F.array_position(F.array(*map(F.lit, KINDS)), F.col("event_type"))
    null, t0 = F.lit(None), F.lit("2024-01-01 00:00:00").cast("timestamp")
    return counts.select(
        F.concat(F.lit("d_"), "event_type").alias("destination_id"), F.lit("me").alias("instance_id"), F.when(place == 5, 9).when(place == 2, 9).otherwise(4).cast("bigint").alias("last_snapshot_id"), t0.alias("last_replicated_at"), F.col("n").alias("rows_replicated"),
        F.when(place == 3, "boom").alias("last_error"), null.cast("timestamp").alias("last_error_at"), t0.alias("updated_at"),
    )


_CURSOR_SQL = "WITH st AS (SELECT 'd_' || event_type AS destination_id, CASE WHEN event_type IN ('error', 'view') THEN 9 ELSE 4 END::BIGINT AS last_snapshot_id, count(*) AS rows_replicated, CASE WHEN event_type = 'purchase' THEN 'boom' END AS last_error FROM events WHERE event_type <> 'signup' GROUP BY event_type),\nal AS (SELECT DISTINCT 'd_' || event_type AS destination_id FROM events),\nc AS (SELECT destination_id, coalesce(last_snapshot_id, 0) AS last_snapshot_id, coalesce(rows_replicated, 0) AS rows_replicated, last_error FROM al LEFT JOIN st USING (destination_id))\n"


def _cursors(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.concat(F.lit("d_"), "event_type").alias("destination_id")).distinct()
    return cursors.cursors_of(every, _cursor_table(spark, sf_dir), "me")


@_query(_CURSOR_SQL + "SELECT last_snapshot_id, string_agg(destination_id, ',' ORDER BY destination_id) AS destinations FROM c GROUP BY ALL")
def group_by_cursor(spark, sf_dir):
    return cursors.group_by_cursor(_cursors(spark, sf_dir)).withColumn("destinations", F.array_join("destinations", ","))


@_query(_CURSOR_SQL + "SELECT destination_id, last_snapshot_id FROM c WHERE last_snapshot_id < 9")
def caught_up_skip(spark, sf_dir):
    return cursors.behind(_cursors(spark, sf_dir), END).select("destination_id", "last_snapshot_id")


_STARTS = {"d_click": 0, "d_view": 4, "d_purchase": 4, "d_signup": 6}


@_query(_with(
    "starts(destination_id, cursor) AS (VALUES ('d_click', 0), ('d_view', 4), ('d_purchase', 4), ('d_signup', 6))",
    f"win AS (SELECT l.*, destination_id, cursor FROM log l JOIN starts ON destination_id = 'd_' || company WHERE snapshot_id > cursor AND snapshot_id <= {END})",
    "posts AS (SELECT cursor, rid, arg_max(company, snapshot_id) AS last FROM win WHERE change_type = 'update_postimage' GROUP BY cursor, rid)",
    "p1 AS (SELECT w.* REPLACE (CASE WHEN change_type = 'update_preimage' THEN 'delete' ELSE change_type END AS change_type) FROM win w LEFT JOIN posts p USING (cursor, rid) WHERE change_type <> 'update_preimage' OR p.rid IS NULL OR p.last <> w.company)",
    *_phases()[3:],
) + f"SELECT {_ALL}, destination_id FROM p2")
def multi_cursor_single_scan(spark, sf_dir):
    starts = spark.createDataFrame(pa.table({"destination_id": list(_STARTS), "last_snapshot_id": list(_STARTS.values())}))
    log = cdc.in_range(change_log(spark, sf_dir), min(_STARTS.values()), END)
    return _out(replicate.resolve(replicate.window_for(log, "company", DESTINATIONS, starts), "company", _KEYS).drop("cursor"))


@_query(_with() + "SELECT DISTINCT 'd_' || event_type AS destination_id FROM events WHERE event_type NOT IN (SELECT company FROM log WHERE company IS NOT NULL AND change_type = 'insert' AND snapshot_id > 8 AND company IN ('click', 'view'))")
def no_data_destinations(spark, sf_dir):
    every = _cursors(spark, sf_dir).select("destination_id")
    some = {v: DESTINATIONS[v] for v in ("click", "view")}
    return every.join(routing.route(cdc.insertions(change_log(spark, sf_dir), 8, END), "company", some), "destination_id", "left_anti")


_NOW = "2024-02-01 00:00:00"


def _brief(state: DataFrame) -> DataFrame:
    return state.select("destination_id", "last_snapshot_id", "rows_replicated", "last_error", (F.col("updated_at") == F.lit(_NOW).cast("timestamp")).alias("touched"))


@_query(_CURSOR_SQL + "SELECT *, destination_id = 'd_signup' AS touched FROM c")
def cursor_init(spark, sf_dir):
    return _brief(cursors.initialise(_cursor_table(spark, sf_dir), _cursors(spark, sf_dir).select("destination_id"), "me", F.lit(_NOW).cast("timestamp")))


@_query(_CURSOR_SQL + "SELECT destination_id, CASE WHEN t THEN 9 ELSE last_snapshot_id END AS last_snapshot_id, rows_replicated, CASE WHEN NOT t THEN last_error END AS last_error, t AS touched FROM (SELECT *, destination_id IN ('d_click', 'd_purchase') AS t FROM st)")
def cursor_advance(spark, sf_dir):
    return _brief(cursors.advance(_cursor_table(spark, sf_dir), "me", ["d_click", "d_purchase"], 9, F.lit(_NOW).cast("timestamp")))


@_query(_with(*_phases(4)) + ", st AS (SELECT 'd_' || event_type AS destination_id, count(*) AS n FROM events WHERE event_type <> 'signup' GROUP BY event_type), d AS (SELECT destination_id, count(*) AS ops FROM p2 GROUP BY ALL)\nSELECT destination_id, n + coalesce(ops, 0) AS rows_replicated FROM st LEFT JOIN d USING (destination_id)")
def rows_replicated_totals(spark, sf_dir):
    """Each destination's cumulative count after a round: what it was and the operations of the round."""
    done = _resolved(spark, sf_dir, 4).groupBy("destination_id").agg(F.count(F.lit(1)).alias("rows"))
    return cursors.add_rows(_cursor_table(spark, sf_dir), "me", done).filter("instance_id = 'me'").select("destination_id", "rows_replicated")


@_query(_CURSOR_SQL + "SELECT destination_id, last_snapshot_id, rows_replicated, CASE WHEN destination_id = 'd_view' THEN 'down' ELSE last_error END AS last_error, destination_id = 'd_view' AS touched FROM st")
def cursor_record_error(spark, sf_dir):
    return _brief(cursors.record_error(_cursor_table(spark, sf_dir), "me", "d_view", "down", F.lit(_NOW).cast("timestamp")))


@_query(_CURSOR_SQL + "SELECT destination_id, last_snapshot_id AS snapshot, 9 - last_snapshot_id AS lag, rows_replicated, CASE WHEN last_error IS NOT NULL THEN 'error' WHEN last_snapshot_id < 9 THEN 'lagging' ELSE 'healthy' END AS status, last_error FROM c")
def destination_status(spark, sf_dir):
    return cursors.status(_cursors(spark, sf_dir), END)


@_query(_CURSOR_SQL + "SELECT max(9 - last_snapshot_id) AS max_lag FROM c")
def max_lag(spark, sf_dir):
    return cursors.max_lag(_cursors(spark, sf_dir), END)


@_query("SELECT c_custkey, list_reduce(list_prepend(0::BIGINT, list_transform(string_split(sha256(c_name), ''), lambda d: (strpos('0123456789abcdef', d) - 1)::BIGINT)), lambda a, x: (a * 16 + x) % 7) AS part FROM customer")
def hash_partition_assignment(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", cursors.partition_column("c_name", 7).alias("part"))


@_query(_with() + "SELECT 'd_' || company AS destination_id, count(*) AS rows FROM log WHERE company IN ('signup', 'view') GROUP BY ALL")
def explicit_partition_assignment(spark, sf_dir):
    mine = set(cursors.assigned(list(DESTINATIONS.values()), "explicit", ["d_signup", "d_nobody", "d_view"]))
    return routing.route(change_log(spark, sf_dir), "company", {k: v for k, v in DESTINATIONS.items() if v in mine}).groupBy("destination_id").agg(F.count(F.lit(1)).alias("rows"))


_BATCHES = "b AS (SELECT company, snapshot_id, count(*) AS n FROM log WHERE company IS NOT NULL GROUP BY ALL)"


def _batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_log(spark, sf_dir).filter("company IS NOT NULL").groupBy("company", "snapshot_id").agg(F.count(F.lit(1)).alias("n"))


@_query(_with(_BATCHES) + ", e AS (SELECT unnest([" + ", ".join(map(str, metrics.BATCH_ROWS)) + "])::BIGINT AS le)\nSELECT le::VARCHAR AS le, (SELECT count(*) FROM b WHERE n <= le) AS count FROM e UNION ALL SELECT '+Inf', (SELECT count(*) FROM b)")
def batch_rows_histogram(spark, sf_dir):
    return metrics.histogram(_batches(spark, sf_dir), "n")


@_query("SELECT quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.95) AS p95, quantile_cont(value, 0.99) AS p99 FROM events")
def read_latency_quantiles(spark, sf_dir):
    return metrics.quantiles(spark.read.parquet(f"{sf_dir}/events.parquet"), "value")


@_query(_with(_BATCHES) + "SELECT * FROM (SELECT company, snapshot_id, (CASE WHEN n < lag(n) OVER w THEN n ELSE n - lag(n) OVER w END)::DOUBLE / (snapshot_id - lag(snapshot_id) OVER w) AS rate FROM b WINDOW w AS (PARTITION BY company ORDER BY snapshot_id)) WHERE rate IS NOT NULL")
def rate_by_destination(spark, sf_dir):
    return metrics.rates(_batches(spark, sf_dir), "company", "snapshot_id", "n")


@_query(_with(_BATCHES) + ", e AS (SELECT unnest([" + ", ".join(map(str, metrics.BATCH_ROWS)) + "])::DOUBLE AS le UNION ALL SELECT 'inf'::DOUBLE), h AS (SELECT company, le, count(*) FILTER (n <= le) AS c FROM b, e GROUP BY ALL),\nw AS (SELECT *, coalesce(lag(le) OVER o, 0) AS low, coalesce(lag(c) OVER o, 0) AS under, 0.95 * max(c) OVER (PARTITION BY company) AS rank FROM h WINDOW o AS (PARTITION BY company ORDER BY le))\nSELECT company, arg_min(CASE WHEN le = 'inf'::DOUBLE THEN low ELSE low + (le - low) * (rank - under) / (c - under) END, le) AS quantile FROM w WHERE c >= rank AND c > under GROUP BY company")
def batch_rows_quantile_from_buckets(spark, sf_dir):
    return metrics.histogram_quantile(metrics.histogram(_batches(spark, sf_dir), "n", by=("company",)), 0.95, ("company",))


@_query(_with() + ", s AS (SELECT change_type, company, snapshot_id, count(*) AS n FROM log WHERE company IS NOT NULL GROUP BY ALL),\nr AS (SELECT company, snapshot_id, (CASE WHEN n < lag(n) OVER w THEN n ELSE n - lag(n) OVER w END)::DOUBLE / (snapshot_id - lag(snapshot_id) OVER w) AS rate FROM s WINDOW w AS (PARTITION BY change_type, company ORDER BY snapshot_id))\nSELECT company, snapshot_id, sum(rate) AS rate FROM r WHERE rate IS NOT NULL GROUP BY ALL")
def rate_summed_by_label(spark, sf_dir):
    counts = change_log(spark, sf_dir).filter("company IS NOT NULL").groupBy("change_type", "company", "snapshot_id").agg(F.count(F.lit(1)).alias("n"))
    return metrics.rate_by(counts, ["change_type", "company"], "company", "snapshot_id", "n")


@_query(_with(*_apply(4)) + """, kept AS (SELECT * FROM prev WHERE NOT EXISTS (FROM p2 WHERE p2.change_type = 'delete' AND p2.destination_id = prev.destination_id AND p2.event_id = prev.event_id)),
m AS (SELECT destination_id, count(*) AS matched FROM ups JOIN kept USING (destination_id, event_id) GROUP BY ALL),
d AS (SELECT destination_id, count(*) FILTER (change_type = 'delete') AS del, count(*) FILTER (change_type <> 'delete') AS up FROM p2 GROUP BY ALL),
pre AS (SELECT count(*) FILTER (p.rid IS NULL) AS orphans, count(*) FILTER (p.last <> w.company) AS mutations FROM win w LEFT JOIN posts p USING (rid) WHERE change_type = 'update_preimage')
SELECT 'events-me' AS pipeline, metric, destination_id, value::BIGINT AS value FROM (
SELECT 'cdc_rows_read_total' AS metric, NULL::VARCHAR AS destination_id, (SELECT count(*) FROM log WHERE snapshot_id > 4) AS value
UNION ALL SELECT 'unrouted_rows_total', NULL, (SELECT count(*) FROM log WHERE snapshot_id > 4 AND (company IS NULL OR company NOT IN """ + _IN + """))
UNION ALL SELECT 'cdc_routing_mutations_total', NULL, mutations FROM pre UNION ALL SELECT 'cdc_orphaned_preimages_total', NULL, orphans FROM pre
UNION ALL SELECT 'cdc_conflicts_resolved_total', NULL, count(*) FILTER (i AND (d OR p)) FROM fl
UNION ALL SELECT 'dest_rows_written_total', destination_id, del + up FROM d UNION ALL SELECT 'dest_rows_deleted_total', destination_id, del FROM d
UNION ALL SELECT 'dest_rows_upserted_total', destination_id, up FROM d UNION ALL SELECT 'dest_upsert_matched_total', destination_id, coalesce(matched, 0) FROM d LEFT JOIN m USING (destination_id))""")
def round_metrics(spark, sf_dir):
    """One scan of the changes: the numbers are observed as the rows pass."""
    seen, first, second = Observation(), Observation(), Observation()
    starts = spark.createDataFrame(pa.table({"destination_id": list(DESTINATIONS.values()), "last_snapshot_id": pa.array([4] * len(DESTINATIONS), pa.int64())}))
    batch = replicate.window_for(cdc.in_range(change_log(spark, sf_dir), 4, END), "company", DESTINATIONS, starts, seen)
    batch = replicate.resolve(batch, "company", _KEYS, "compatible", first, second).drop("cursor").persist()
    try:
        each = metrics.sent(_at(spark, sf_dir, 4), batch, _KEYS)
    finally:
        batch.unpersist()
    return metrics.relation(spark, seen.get | first.get | second.get, each, "events-me", "bigint")


@_query(_CURSOR_SQL + "SELECT to_json(struct_pack(source_table := 'events', source_snapshot := 9, mode := 'cdc', poll_interval := 5, destinations := list(struct_pack(destination_id := destination_id, snapshot := last_snapshot_id, lag := 9 - last_snapshot_id, rows_replicated := rows_replicated, status := CASE WHEN last_error IS NOT NULL THEN 'error' WHEN last_snapshot_id < 9 THEN 'lagging' ELSE 'healthy' END, last_error := last_error) ORDER BY destination_id)))::VARCHAR AS document FROM c")
def status_json(spark, sf_dir):
    return cursors.status_document(cursors.status(_cursors(spark, sf_dir), END), "events", END, "cdc", 5)


def _lake(spark: SparkSession, sf_dir: str, last: int = END) -> tuple[Config, LakeTable]:
    """The change log committed snapshot by snapshot as a versioned table, with destinations beside it."""
    root = f"{shared_folder(spark)}/lake-{uuid.uuid4().hex}"
    log = change_log(spark, sf_dir)
    source = LakeTable.create(spark, f"{root}/source", cdc.strip_meta(log).schema)
    for n in range(1, last + 1):
        source.commit_changes(cdc.in_range(log, n - 1, n))
    return Config(f"{root}/source", "company", tuple(Destination(d, v, f"{root}/{d}") for v, d in DESTINATIONS.items()), _KEYS, "cdc_replay", pairing="hardened"), source


def _held(spark: SparkSession, cfg: Config) -> DataFrame:
    tables = {d.id: LakeTable.load(spark, d.path) for d in cfg.destinations}
    return replicate.held_rows(spark, {f: k for k, t in tables.items() for f in t.folders(t.manifest())}, next(iter(tables.values())).schema)


@_query(_with(_state("s", 6)) + "SELECT event_id, company, val, destination_id FROM s")
def scan_as_of_from_base(spark, sf_dir):
    """The rows at snapshot 6 from what was materialised of snapshot 4 and the changes after it."""
    source = _lake(spark, sf_dir)[1]
    source.materialise(4)
    return routing.route(source.scan(6), "company", DESTINATIONS)


_HEALTH = "SELECT event_type, max(ts) AS last_poll_at, max(ts) FILTER (value > 50) AS last_replicated_at FROM events GROUP BY ALL"


@_query(f"WITH h AS ({_HEALTH}), n AS (SELECT max(ts) AS now FROM events) SELECT event_type, coalesce(epoch(now) - epoch(last_poll_at) < 300, false) AS alive, coalesce(epoch(now) - epoch(last_poll_at) < 300, false) AND (last_replicated_at IS NULL OR epoch(now) - epoch(last_replicated_at) < 600) AS ready FROM h, n")
def health_by_age(spark, sf_dir):
    """Liveness and readiness of each kind's writer at the time of the last event: events are its polls, those over 50 its replications."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_type", "ts", "value")
    last = events.groupBy("event_type").agg(F.max("ts").alias("last_poll_at"), F.max(F.when(F.col("value") > 50, F.col("ts"))).alias("last_replicated_at"))
    now = last.agg(F.max("last_poll_at").alias("now"))
    return cursors.health(last.crossJoin(F.broadcast(now)), F.col("now")).select("event_type", "alive", "ready")


@_query(_with("k AS (SELECT snapshot_id, count(*) AS rows, count(*) FILTER (change_type IN ('delete', 'update_preimage')) AS delete_rows FROM log GROUP BY 1)") + "SELECT *, true AS in_files FROM k")
def snapshot_file_stats(spark, sf_dir):
    """Rows and deletes in the change files of each snapshot; how many files and bytes they are is the writer's choice, so only that there are some is told."""
    found = _lake(spark, sf_dir)[1].file_stats()
    return found.select("snapshot_id", "rows", "delete_rows", ((F.col("files") > 0) & (F.col("bytes") > F.col("files"))).alias("in_files"))


@_query(_with(_state("s", 9)) + "SELECT * FROM s")
def poll_cycle(spark, sf_dir):
    """Rounds at snapshots 4 and 9 over versioned tables on disk; the destinations then."""
    cfg, source = _lake(spark, sf_dir, 4)
    replicate.run_once(spark, cfg)
    log = change_log(spark, sf_dir)
    for n in range(5, END + 1):
        source.commit_changes(cdc.in_range(log, n - 1, n))
    replicate.run_once(spark, cfg)
    return _held(spark, cfg)


@_query(_with(_state("s", 9)) + "SELECT event_id, company, val, destination_id FROM s")
def stream_pairing(spark, sf_dir):
    """A stream of the change log, a few files in each batch, paired by state into a log of resolved changes; that log's rows then."""
    from fanflow.streaming.pairing import log_resolved

    source = _lake(spark, sf_dir)[1]
    out = LakeTable.create(spark, f"{source.path}-resolved", source.schema)
    schema = source.log().schema
    changes = spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).parquet(f"{source.path}/log")
    log_resolved(changes, "company", _KEYS, out, f"{shared_folder(spark)}/pairing-{uuid.uuid4().hex}").awaitTermination()
    return routing.route(out.scan(), "company", DESTINATIONS)


@_query(_with(_state("s", 9)) + "SELECT * FROM s")
def poll_cycle_stream(spark, sf_dir):
    from fanflow.streaming.trigger import replicate as stream

    cfg, _ = _lake(spark, sf_dir)
    stream(spark, cfg, f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}").awaitTermination()
    return _held(spark, cfg)

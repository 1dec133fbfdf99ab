"""One replication round over all destinations: a single scan from the oldest cursor, phases 1 to 3, one write, one commit by destination."""

from __future__ import annotations

import hashlib
import logging
import math
import re
import time
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession, types as T
from pyspark.sql import functions as F

from fanflow.functions import metrics
from fanflow.operators import cdc, cursors, routing
from fanflow.sources.config import Config, Destination
from fanflow.sources.lake import LakeTable, fs_has_data

#: Manifests that are read or swapped at once.
MANIFEST_THREADS = 16
#: Rows for which a destination gets a bucket; with more than twice as many in each, its buckets are doubled.
BUCKET_ROWS = 1_000_000
#: Folders that an append-only destination has before small ones are merged.
FOLDERS = 8
#: Writes of subsets that a round tries while it looks for destinations that make the common write fail.
ISOLATED = 64
log = logging.getLogger(__name__)


@dataclass
class Round:
    """What a round did: by destination, and its own numbers (rows read, seconds of its parts, ...)."""

    destinations: dict[str, dict] = field(default_factory=dict)
    numbers: dict[str, float] = field(default_factory=dict)


def window_for(changes: DataFrame, field: str, values: dict[str, str], starts: DataFrame, seen: Observation | None = None) -> DataFrame:
    """Routed changes after each destination's cursor, with cursor: destinations of one cursor see one another's rows alone.

    starts (destination_id, last_snapshot_id) is a row for each destination and goes to every task up to SMALL_MAP rows.
    seen observes the rows read and those without a destination as they pass.
    """
    starts = starts.select("destination_id", F.col("last_snapshot_id").alias("cursor"))
    starts = F.broadcast(starts) if len(values) <= routing.SMALL_MAP else starts
    routed = routing.route(changes, field, values, seen is not None)
    if seen is not None:
        routed = routed.observe(seen, F.count(F.lit(1)).alias("cdc_rows_read_total"), F.count_if(F.col("destination_id").isNull()).alias("unrouted_rows_total")).filter("destination_id is not null")
    return routed.join(starts, "destination_id").filter("snapshot_id > cursor")


def resolve(changes: DataFrame, field: str, keys: tuple[str, ...], pairing: str = "compatible", first: Observation | None = None, second: Observation | None = None) -> DataFrame:
    """Phases 1 and 2 of what window_for() gives: one exchange by rowid and one sort, which both windows use.

    A destination has one cursor, so phase 2 may cluster by both, in the order that phase 1 begins. first and second
    observe the counts of their phases as the rows pass.
    """
    dealt = changes.repartition("rowid").sortWithinPartitions("rowid", "cursor", "destination_id")
    paired = cdc.resolve_preimages(dealt, field, keys, ("cursor",), pairing == "hardened", first)
    return cdc.resolve_conflicts(paired, ("cursor", "destination_id"), second)


def with_retry(operation: Callable[[], object], attempts: int = 3, wait: Callable[[float], None] = time.sleep) -> object:
    for n in range(attempts):
        try:
            return operation()
        except Exception:
            if n + 1 == attempts:
                raise
            wait(2.0**n)


def isolated(keys: list[str], work: Callable[[list[str]], dict], suspect: Callable[[str, str], bool], wait: Callable[[float], None]) -> tuple[dict, dict[str, Exception]]:
    """work(keys) -> a result for each key; where it fails, the keys that make it fail are found and the others done without them.

    Keys that the error names (suspect(key, message)) are set apart at once; else the set is halved, so that one bad key
    costs attempts by the logarithm of the keys, and none cost one. A key by itself is tried again before it counts as failed. Beyond
    ISOLATED attempts what is left fails as it is: with all keys failing, that bounds the jobs.
    """
    done: dict = {}
    failed: dict[str, Exception] = {}
    todo, left = [list(keys)] if keys else [], ISOLATED
    while todo:
        some = todo.pop()
        try:
            left -= 1
            done |= work(some) if len(some) > 1 else with_retry(lambda s=some: work(s), wait=wait)
        except Exception as e:
            if len(some) == 1 or left <= 0:
                log.exception("destinations %s failed", some[:5])
                failed |= dict.fromkeys(some, e)
                continue
            named = [k for k in some if suspect(k, str(e))]
            rest = [k for k in some if k not in set(named)]
            if not named or not rest:
                named, rest = some[: len(some) // 2], some[len(some) // 2 :]
            todo += [rest, named]
    return done, failed


Tables = dict[str, tuple[Destination, LakeTable]]


def _tables(spark: SparkSession, cfg: Config, source: LakeTable) -> Tables:
    mine = set(cursors.assigned([d.id for d in cfg.destinations], cfg.mode, cfg.include, cfg.total, cfg.ordinal))
    with ThreadPoolExecutor(MANIFEST_THREADS) as pool:
        made = pool.map(lambda d: LakeTable.create(spark, d.path, source.schema), wanted := [d for d in cfg.destinations if d.id in mine])
        return {d.id: (d, t) for d, t in zip(wanted, made, strict=True)}


def _each(tables: Tables, f: Callable[[str, LakeTable], object], wait: Callable[[float], None]) -> dict[str, object]:
    """f for each destination (small files only), some at once; gives its result, or the error after all attempts."""

    def one(key: str) -> object:
        try:
            return with_retry(lambda: f(key, tables[key][1]), wait=wait)
        except Exception as e:
            log.exception("destination %s failed", key)
            return e

    with ThreadPoolExecutor(MANIFEST_THREADS) as pool:
        return dict(zip(tables, pool.map(one, tables), strict=True))


def _cursor(manifest: dict) -> int:
    return manifest["cursor"].get("snapshot", 0)


def _now() -> str:
    return datetime.now(UTC).isoformat(timespec="seconds")


def buckets_for(rows: int) -> int:
    """Buckets of a destination of so many rows: a power of 2."""
    return 2 ** max(0, math.ceil(math.log2(max(1, rows) / BUCKET_ROWS)))


def bucket_of(folder: str) -> int:
    """The bucket that a written folder holds, -1 if it holds rows of any."""
    found = re.search(r"/bucket=(\d+)/?$", folder)
    return int(found[1]) if found else -1


def _slot(key: str) -> str:
    return hashlib.sha256(key.encode()).hexdigest()[:16]


def _write(spark: SparkSession, cfg: Config, rows: DataFrame, schema: T.StructType, buckets: dict[str, int], keys: Sequence[str]) -> dict[str, dict[str, int]]:
    """One job writes rows (with destination_id) of all destinations, a folder for each and each of its buckets: destination -> folder -> rows.

    Rows are dealt by destination and bucket and rebalanced: large ones are split among tasks, small ones share a task,
    so that a destination's bucket has about as many files as its size asks for, however many tasks there are.
    """
    at = f"{cfg.source_path}-rounds/{uuid.uuid4().hex}"
    counts = spark.createDataFrame(pa.table({"destination_id": list(buckets), "_buckets": pa.array(list(buckets.values()), pa.int64())}))
    rows = rows.join(F.broadcast(counts) if len(buckets) <= routing.SMALL_MAP else counts, "destination_id")
    bucket = F.pmod(F.xxhash64(*map(cdc.col, keys)), F.col("_buckets")) if keys else F.lit(0).cast("bigint")
    slot = F.substring(F.sha2(F.col("destination_id").cast("binary"), 256), 1, 16)
    out = rows.select(*map(cdc.col, schema.names), slot.alias("slot"), bucket.alias("bucket"))
    out.hint("rebalance", "slot", "bucket").write.partitionBy("slot", "bucket").parquet(at)
    if not fs_has_data(at):
        return {}
    parts = T.StructType([T.StructField("slot", T.StringType()), T.StructField("bucket", T.LongType())])
    found: dict[str, dict[str, int]] = {}
    ids = {_slot(k): k for k in buckets}
    for r in spark.read.schema(parts).parquet(at).groupBy("slot", "bucket").count().collect():
        found.setdefault(ids[r.slot], {})[f"{at}/slot={r.slot}/bucket={r.bucket}"] = r["count"]
    return found


def _place(folder: str) -> str:
    return "/".join(folder.rstrip("/").split("/")[-3:])


def held_rows(spark: SparkSession, folders: dict[str, str], schema: T.StructType) -> DataFrame:
    """Rows of these folders (folder -> destination) with destination_id, in one scan: a row's folder tells whose it is."""
    if not folders:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("destination_id", T.StringType())]))
    of = pa.table({"_folder": [_place(f) for f in folders], "destination_id": list(folders.values())})
    rows = spark.read.schema(schema).parquet(*folders).withColumn("_folder", F.regexp_extract(F.col("_metadata.file_path"), "([^/]+/[^/]+/[^/]+)/[^/]+$", 1))
    of = spark.createDataFrame(of)
    return rows.join(F.broadcast(of) if len(folders) <= routing.SMALL_MAP else of, "_folder").drop("_folder")


def _commit(table: LakeTable, kept: dict[str, int], new: dict[str, int], buckets: int, cursor: dict) -> None:
    """The destination's new version: the folders that stay and the new ones, with their rows, and its cursor."""
    held = kept | new
    table.set_folders(list(held), cursor, {"buckets": buckets, "held": held})


def seed(spark: SparkSession, cfg: Config, wait: Callable[[float], None] = time.sleep) -> dict[str, int]:
    """New destinations (cursor 0) get the source's rows at one pinned snapshot, by one write; gives the rows of each. An error ends it."""
    source = LakeTable.load(spark, cfg.source_path)
    snapshot = source.current_snapshot()
    if snapshot is None:
        return {}
    new = {k: v for k, v in _tables(spark, cfg, source).items() if _cursor(v[1].manifest()) == 0}
    values, _ = routing.typed_values(source.scan(snapshot), cfg.routing_field, {d.routing_value: d.id for d, _ in new.values()})
    new = {k: v for k, v in new.items() if k in set(values.values())}
    if not new:
        return {}
    rows = routing.route(source.scan(snapshot), cfg.routing_field, values).persist()
    try:
        many = {r.destination_id: r["count"] for r in rows.groupBy("destination_id").count().collect()}
        written = _write(spark, cfg, rows, source.schema, {k: buckets_for(many.get(k, 0)) for k in new}, cfg.key_columns)
    finally:
        rows.unpersist()
    counts = {k: sum(written.get(k, {}).values()) for k in new}
    done = lambda key, table: _commit(table, {}, written.get(key, {}), buckets_for(many.get(key, 0)), {"snapshot": snapshot, "rows": counts[key], "error": None, "replicated_at": _now()})
    for result in _each(new, done, wait).values():
        if isinstance(result, Exception):
            raise result
    return counts


def _merged(held: dict[str, int], rows: int) -> list[str]:
    """Folders to write anew with so many new rows, none below FOLDERS: the latest, as long as each has no more rows than all that follow.

    So the folders that stay halve in size at least from one to the next, and a row is written anew by the logarithm of
    the rows at most.
    """
    out: list[str] = []
    if len(held) < FOLDERS:
        return out
    for folder, n in reversed(held.items()):
        if n > rows:
            break
        out.append(folder)
        rows += n
    return out


@dataclass
class _Plan:
    """What a round does to a destination: buckets from now on, folders to read and replace, folders that stay."""

    buckets: int
    replaced: list[str]
    kept: dict[str, int]


def _plan(manifest: dict, table: LakeTable, touched: dict[int, int], upserted: int, keyed: bool) -> _Plan:
    """touched: rows of the batch by bucket (of as many buckets as the manifest has). Only their folders are replaced, unless the buckets are doubled."""
    held = {f: manifest.get("held", {}).get(f, 0) for f in table.folders(manifest)}
    if not keyed:
        replaced = _merged(held, sum(touched.values()))
        return _Plan(1, replaced, {f: n for f, n in held.items() if f not in replaced})
    buckets = manifest.get("buckets") or 1
    if sum(held.values()) + upserted > 2 * BUCKET_ROWS * buckets:
        return _Plan(buckets_for(sum(held.values()) + upserted), list(held), {})
    replaced = [f for f in held if bucket_of(f) in touched or bucket_of(f) < 0]
    return _Plan(buckets, replaced, {f: n for f, n in held.items() if f not in replaced})


def run_once(spark: SparkSession, cfg: Config, wait: Callable[[float], None] = time.sleep) -> dict[str, dict]:
    """One round; gives what happened to each destination (see run_round())."""
    return run_round(spark, cfg, wait).destinations


def run_round(spark: SparkSession, cfg: Config, wait: Callable[[float], None] = time.sleep) -> Round:
    """One round. A destination whose routing value, data or manifest is at fault keeps its cursor and gets its error; the others go on.

    The number of jobs doesn't depend on the number of destinations: one scan of changes from the oldest cursor, one scan
    of the touched buckets of changed destinations, one write. If that fails, isolated() finds the destinations at fault.
    Then each destination's manifest is swapped for one with the new folders and the new cursor, by a few threads;
    destinations without changes get the cursor alone. Buckets that no change touches are neither read nor written;
    append-only rounds write new rows, and now and then small folders anew. Numbers of the round are observed in these same jobs.
    """
    began, out = time.time(), Round()
    source = LakeTable.load(spark, cfg.source_path)
    current = source.current_snapshot()
    if current is None:
        return out
    if cfg.seed_mode == "scan":
        seed(spark, cfg, wait)
    tables = _tables(spark, cfg, source)
    manifests = {k: t.manifest() for k, (_, t) in tables.items()}
    late = {k: v for k, v in tables.items() if _cursor(manifests[k]) < current}
    if not late:
        return out
    schema, keyed = source.schema, bool(cfg.key_columns)
    start = min(_cursor(manifests[k]) for k in late)
    changes = source.changes(start, current)
    values, bad = routing.typed_values(changes, cfg.routing_field, {d.routing_value: d.id for d, _ in late.values()})
    failed: dict[str, Exception] = {k: routing.RoutingError(f"{v!r} is no value of {cfg.routing_field}") for v, k in bad.items()}
    good = [k for k in late if k not in failed]
    starts = spark.createDataFrame(pa.table({"destination_id": pa.array(good, pa.string()), "last_snapshot_id": pa.array([_cursor(manifests[k]) for k in good], pa.int64()), "_buckets": pa.array([manifests[k].get("buckets") or 1 for k in good], pa.int64())}))
    starts = F.broadcast(starts) if len(good) <= routing.SMALL_MAP else starts
    seen, first, second = Observation(), Observation(), Observation()
    if not keyed:
        changes = changes.filter(F.col("change_type") == cdc.INSERT)
    batch = window_for(changes, cfg.routing_field, values, starts, seen)
    if keyed:
        batch = resolve(batch, cfg.routing_field, cfg.key_columns, cfg.pairing, first, second)
    batch = batch.drop("cursor").persist()
    try:
        bucket = F.pmod(F.xxhash64(*map(cdc.col, cfg.key_columns)), F.col("_buckets")) if keyed else F.lit(0).cast("bigint")
        many: dict[str, dict[int, int]] = {}
        deleted = dict.fromkeys(good, 0)
        for r in batch.join(starts.select("destination_id", "_buckets"), "destination_id").groupBy("destination_id", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("change_type") == cdc.DELETE).alias("d")).collect():
            many.setdefault(r.destination_id, {})[r.bucket] = r.n
            deleted[r.destination_id] += r.d
        rows = {k: sum(v.values()) for k, v in many.items()}
        if many:  # else stages without rows, and what they observe, may be left out of the plan
            out.numbers |= seen.get | (first.get | second.get if keyed else {})
        else:
            lone = changes.join(routing.routing_map(changes, cfg.routing_field, values), cdc.col(cfg.routing_field) == F.col("_value"), "left_anti")
            out.numbers |= {"cdc_rows_read_total": changes.count(), "unrouted_rows_total": lone.count()}
        out.numbers["cdc_read_seconds"] = time.time() - began
        plans = {k: _plan(manifests[k], late[k][1], many[k], rows[k] - deleted[k], keyed) for k in many}
        sent = cdc.strip_meta(batch)
        matched = [0]

        def work(some: list[str]) -> dict[str, dict[str, int]]:
            mine = batch if len(some) == len(plans) else batch.filter(F.col("destination_id").isin(some))
            old = held_rows(spark, {f: k for k in some for f in plans[k].replaced}, schema)
            hit = Observation() if keyed and any(plans[k].replaced for k in some) else None
            if keyed:
                new = cdc.apply_changes(old, mine, cfg.key_columns, ("destination_id",), hit)
            else:
                new = old.unionByName((sent if mine is batch else cdc.strip_meta(mine)).select(*old.columns))
            made = _write(spark, cfg, new, schema, {k: plans[k].buckets for k in some}, cfg.key_columns)
            matched[0] += hit.get["upsert_matched"] if hit is not None and made else 0  # nothing written, nothing upserted
            return {k: made.get(k, {}) for k in some}

        suspect = lambda key, message: late[key][0].path in message or any(_place(f) in message for f in plans[key].replaced)
        written, broken = isolated(list(plans), work, suspect, wait)
        failed |= broken
    finally:
        batch.unpersist()
    out.numbers |= {"dest_upsert_matched_total": matched[0], "dest_write_seconds": time.time() - began - out.numbers["cdc_read_seconds"]}

    def commit(key: str, table: LakeTable) -> dict:
        if key in failed:
            raise failed[key]
        done = {"snapshot": current, "rows": manifests[key]["cursor"].get("rows", 0) + rows.get(key, 0), "error": None, "error_at": None, "replicated_at": _now()}
        if not rows.get(key):
            table.set_cursor({"snapshot": current, "error": None, "error_at": None})
        else:
            _commit(table, plans[key].kept, written[key], plans[key].buckets, done)
        return {"rows": rows.get(key, 0), "deleted": deleted[key], "rewritten": sum(written.get(key, {}).values()), "seconds": time.time() - began, "snapshot": current, "error": None}

    results = _each({k: late[k] for k in good if k not in failed}, commit, wait) | failed
    for key in late:
        result = results[key]
        if isinstance(result, Exception):
            result = {"rows": 0, "deleted": 0, "rewritten": 0, "seconds": time.time() - began, "snapshot": _cursor(manifests[key]), "error": str(result)}
            try:
                late[key][1].set_cursor({"error": result["error"], "error_at": _now(), "replicated_at": None})
            except Exception:  # the store of a lost destination may be lost too: the others' results stand
                log.exception("error of destination %s can't be recorded", key)
        out.destinations[key] = result
    out.numbers |= {
        "polls_total": 1, "cycle_seconds": time.time() - began, "routing_errors_total": len(bad), "errors_total": sum(v["error"] is not None for v in out.destinations.values()),
        "source_snapshot_id": current, "snapshots_read": current - start, "max_lag_snapshots": max(current - v["snapshot"] for v in out.destinations.values()), "cdc_batch_rows": sum(rows.values()),
    }
    return out


def round_metrics(spark: SparkSession, cfg: Config, done: Round) -> DataFrame:
    """(pipeline, metric, destination_id, value) of a round that was run: no further scan."""
    current = done.numbers.get("source_snapshot_id", 0)
    each = {k: {"dest_rows_written_total": v["rows"], "dest_rows_deleted_total": v["deleted"], "dest_rows_upserted_total": v["rows"] - v["deleted"], "dest_last_snapshot_id": v["snapshot"], "dest_lag_snapshots": current - v["snapshot"]} for k, v in done.destinations.items()}
    return metrics.relation(spark, done.numbers, each, cfg.pipeline)


def status(spark: SparkSession, cfg: Config) -> DataFrame:
    """(destination_id, snapshot, lag, rows_replicated, status, last_error, last_replicated_at, last_error_at) from the manifests."""
    source = LakeTable.load(spark, cfg.source_path)
    held = [(k, t.manifest()["cursor"]) for k, (_, t) in _tables(spark, cfg, source).items()]
    rows = [(k, c.get("snapshot", 0), c.get("rows", 0), c.get("error"), c.get("replicated_at"), c.get("error_at")) for k, c in held]
    frame = spark.createDataFrame(rows, "destination_id string, last_snapshot_id bigint, rows_replicated bigint, last_error string, last_replicated_at string, last_error_at string")
    times = frame.select("destination_id", F.to_timestamp("last_replicated_at").alias("last_replicated_at"), F.to_timestamp("last_error_at").alias("last_error_at"))
    return cursors.status(frame, source.current_snapshot() or 0).join(times, "destination_id")

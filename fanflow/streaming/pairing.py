"""Pairing of changes across micro-batches: a table holds what is downstream of each row, so that a move is seen whenever its halves come."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window, types as T
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fanflow.operators import cdc
from fanflow.plans.replicate import _merged
from fanflow.sources.lake import LakeTable

_AT = T.StructType([T.StructField("snapshot_id", T.LongType()), T.StructField("live", T.BooleanType())])


def _place(field: str, keys: Sequence[str]) -> list[str]:
    return list(dict.fromkeys([field, *keys]))


def _state(spark: SparkSession, folders: Sequence[str], place: T.StructType) -> DataFrame:
    """Rows of these folders: rowid, the change that was last passed on (at) and where the row is since (place), once or more for a rowid, the latest counts."""
    full = T.StructType([T.StructField("rowid", T.LongType()), T.StructField("at", _AT), T.StructField("place", place)])
    return spark.read.schema(full).parquet(*folders) if folders else spark.createDataFrame([], full)


def _deleted(folder: str) -> None:
    store, at = fs.FileSystem.from_uri(folder) if ":/" in folder else (fs.LocalFileSystem(), folder)
    store.delete_dir(at)


def paired(changes: DataFrame, state: DataFrame, field: str, keys: Sequence[str]) -> DataFrame:
    """The last change of each rowid in a batch, if it is later than the state's: rowid, at, place, row, and where the row was before.

    State by rowid is the routing value and key of the row that was last passed on (place), and which change made it so.
    place and row are null where the change (delete, preimage) leaves no row. A batch's changes of a row are combined before
    the shuffle, and meet the state of the same rows in one window by rowid; a semi join finds that state, so a small batch
    costs a scan of the state and no shuffle of it.
    """
    live = F.coalesce(F.lower("change_type").isin(cdc.INSERT, cdc.POST), F.lit(False))
    user = F.struct(*(cdc.col(c) for c in changes.columns if c not in cdc.META))
    each = changes.filter("snapshot_id IS NOT NULL").select(F.col("rowid").cast("long").alias("rowid"), F.struct(F.col("snapshot_id").cast("long").alias("snapshot_id"), live.alias("live")).alias("at"), F.when(live, user).alias("row"))
    last = each.groupBy("rowid").agg(F.max_by("row", "at").alias("row"), F.max("at").alias("at"))
    place = F.struct(*(F.col("row").getField(c).alias(c) for c in _place(field, keys)))
    now = last.select("rowid", "at", F.when(F.col("row").isNotNull(), place).alias("place"), "row", F.lit(True).alias("new"))
    ids = each.select(F.col("rowid").alias("id")).distinct()
    met = state.join(ids, F.col("rowid").eqNullSafe(F.col("id")), "left_semi")
    both = met.withColumns({"row": F.lit(None).cast(now.schema["row"].dataType), "new": F.lit(False)}).unionByName(now)
    was = F.lag(F.struct("at", "place")).over(Window.partitionBy("rowid").orderBy("new", "at"))
    return both.withColumn("was", was).filter("new AND (was IS NULL OR at > was.at)").select("rowid", "at", "place", "row", F.col("was.place").alias("before"))


def resolved(pairs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """These columns, change_type and rowid of paired(): deletes from where a row was, then what it is now.

    A change that leaves a row (insert, postimage) is passed on, after a delete of the old one if routing value or key differ;
    else the old one is deleted. A preimage whose postimage comes in a later batch is a delete until then. Changes that are no
    later than the state's, such as a preimage after its postimage, are left out; so the number of a deleted row's last change
    stays in the state. Rows of deletes have routing value and key alone.
    """
    full, held = pairs.schema["row"].dataType, pairs.schema["before"].dataType.names
    gone = F.struct(*((F.col("before").getField(c) if c in held else F.lit(None).cast(full[c].dataType)).alias(c) for c in columns), F.lit(cdc.DELETE).alias("change_type"))
    kind = F.when(F.col("before").isNull(), cdc.INSERT).otherwise(cdc.POST)
    come = F.struct(*(F.col("row").getField(c).alias(c) for c in columns), kind.alias("change_type"))
    moved = F.col("before").isNotNull() & ~F.col("before").eqNullSafe(F.col("place"))
    out = pairs.select("rowid", F.explode(F.array_compact(F.array(F.when(moved, gone), F.when(F.col("place").isNotNull(), come)))).alias("change"))
    return out.select("change.*", "rowid")


def log_resolved(changes: DataFrame, field: str, keys: Sequence[str], out: LakeTable, checkpoint: str) -> StreamingQuery:
    """Starts the stream that commits each batch's resolved changes as a snapshot of out, a table with a change log.

    The batch's number and the folders of the state are committed with its data, so a batch that is run again after a failure
    finds the state as it was before, and is not committed twice. The state grows by a folder a batch; small ones are merged.
    Moves give a delete and a row of one rowid in a batch; the log keeps both, and its scans the later state.
    """
    cdc.require_columns(changes, [field, *keys, *cdc.META])
    place = T.StructType([changes.schema[c] for c in _place(field, keys)])

    def batch(rows: DataFrame, number: int) -> None:
        cursor = out.manifest()["cursor"]
        if cursor.get("batch", -1) >= number:
            return
        if "batch" in cursor and "state" not in cursor:
            raise ValueError(f"{out.path} was written by a stream that kept its state in the checkpoint: start with a new table and checkpoint")
        spark, state, this = rows.sparkSession, cursor.get("state", {}), uuid.uuid4().hex
        found = paired(rows, _state(spark, list(state), place), field, keys)
        found.write.parquet(f"{out.path}/pairs-{this}")
        pairs = spark.read.schema(found.schema).parquet(f"{out.path}/pairs-{this}")
        new = pairs.count()
        replaced = _merged(state, new)
        latest = pairs.select("rowid", "at", "place")
        if replaced:
            latest = latest.unionByName(_state(spark, replaced, place)).groupBy("rowid").agg(F.max_by("place", "at").alias("place"), F.max("at").alias("at"))
        latest.write.parquet(f"{out.path}/state-{this}")
        kept = {f: n for f, n in state.items() if f not in replaced} | {f"{out.path}/state-{this}": new + sum(state[f] for f in replaced)}
        out.commit_changes(resolved(pairs, out.schema.names), {"batch": number, "state": kept})
        for folder in [f"{out.path}/pairs-{this}", *replaced]:
            _deleted(folder)

    return changes.writeStream.foreachBatch(batch).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

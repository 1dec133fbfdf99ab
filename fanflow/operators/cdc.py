"""Change sets as DataFrames: pairing, conflict resolution, last-write-wins and apply.

A change set has the user's columns and change_type, snapshot_id and rowid. Nothing here collects or loops over rows:
phases 1 and 2 are windows by rowid, apply is a null-safe anti join by key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

META = ("change_type", "snapshot_id", "rowid")
INSERT, DELETE, PRE, POST = "insert", "delete", "update_preimage", "update_postimage"


class RoutingError(ValueError):
    """A routing or key column, or a routing value, does not fit the data."""


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise RoutingError(f"no column {missing} among {df.columns}")


def reject_reserved(columns: Sequence[str]) -> None:
    clash = sorted(set(columns) & set(META))
    if clash:
        raise RoutingError(f"columns {clash} are reserved for change metadata")


def col(name: str) -> Column:
    """A column by its exact name, dots and other signs included."""
    return F.col("`" + name.replace("`", "``") + "`")


def strip_meta(df: DataFrame) -> DataFrame:
    """Without the metadata columns; those that are missing are no error."""
    return df.drop(*META)


def normalise(df: DataFrame) -> DataFrame:
    return df.withColumn("change_type", F.lower("change_type"))


def in_range(log: DataFrame, start: int, end: int) -> DataFrame:
    """Changes after snapshot start up to end; on a log partitioned by snapshot_id only those partitions are read."""
    return log.filter((F.col("snapshot_id") > start) & (F.col("snapshot_id") <= end))


def insertions(log: DataFrame, start: int, end: int) -> DataFrame:
    return in_range(log, start, end).filter(F.col("change_type") == INSERT)


def as_of(log: DataFrame, snapshot: int) -> DataFrame:
    """User rows (with rowid) alive at a snapshot: the last event of each rowid, if it left a row."""
    last = Window.partitionBy("rowid").orderBy(F.col("snapshot_id").desc(), F.col("change_type").isin(INSERT, POST).desc())
    ranked = log.filter(F.col("snapshot_id") <= snapshot).withColumn("_last", F.row_number().over(last))
    return ranked.filter((F.col("_last") == 1) & F.col("change_type").isin(INSERT, POST)).drop("_last", "change_type", "snapshot_id")


def as_of_base(base: DataFrame, tail: DataFrame) -> DataFrame:
    """User rows (with rowid) after base (user columns and rowid, at one snapshot) and the changes tail after it: rows that tail touches are as their last event left them."""
    last = tail.groupBy("rowid").agg(F.max_by(F.struct(*map(col, base.columns), F.col("change_type").isin(INSERT, POST).alias("_live")), F.struct("snapshot_id", F.col("change_type").isin(INSERT, POST).alias("live"))).alias("_last"))
    kept = base.join(last.select(F.col("rowid").alias("_rowid")), F.col("rowid") == F.col("_rowid"), "left_anti")
    return kept.unionByName(last.select("_last.*").filter("_live").drop("_live"))


def _paired(batch: DataFrame, routing: str, group: Sequence[str]) -> DataFrame:
    """With _post: struct of the routing value and snapshot of the rowid's last postimage, null without one."""
    per_row = Window.partitionBy("rowid", *group)
    post = F.when(F.col("change_type") == POST, F.struct(F.col("snapshot_id").alias("at"), col(routing).alias("to")))
    return batch.withColumn("_post", F.max_by(post, F.when(F.col("change_type") == POST, F.col("snapshot_id"))).over(per_row))


def _orphan(hardened: bool) -> Column:
    lone = F.col("_post").isNull()
    return lone | (F.col("_post.at") < F.col("snapshot_id")) if hardened else lone


def resolve_preimages(batch: DataFrame, routing: str, keys: Sequence[str] = (), group: Sequence[str] = (), hardened: bool = False, seen: Observation | None = None) -> DataFrame:
    """Phase 1: preimages whose row left its destination become deletes, the others go. seen observes how many were alone or moved.

    A preimage stays as a delete if its rowid has no postimage, or the last one has another routing value (null equals
    null). hardened also takes a preimage as alone if the last visible postimage is older than it.
    """
    require_columns(batch, [routing, *keys])
    moved = ~F.col("_post.to").eqNullSafe(col(routing))
    pre = F.col("change_type") == PRE
    paired = _paired(batch, routing, group)
    if seen is not None:
        alone = _orphan(hardened)
        paired = paired.observe(seen, F.count_if(pre & alone).alias("cdc_orphaned_preimages_total"), F.count_if(pre & ~alone & moved).alias("cdc_routing_mutations_total"))
    kept = paired.filter(~pre | _orphan(hardened) | moved)
    return kept.withColumn("change_type", F.when(pre, DELETE).otherwise(F.col("change_type"))).drop("_post")


def preimage_counts(batch: DataFrame, routing: str, group: Sequence[str] = (), hardened: bool = False) -> DataFrame:
    """One row: orphans, mutations and drops among the preimages."""
    pairs = _paired(batch, routing, group).filter(F.col("change_type") == PRE)
    same = F.col("_post.to").eqNullSafe(col(routing))
    alone = _orphan(hardened)
    return pairs.agg(F.count_if(alone).alias("orphans"), F.count_if(~alone & ~same).alias("mutations"), F.count_if(~alone & same).alias("dropped"))


def _flags(batch: DataFrame, by: Sequence[str]) -> DataFrame:
    per_row = Window.partitionBy("rowid", *by)
    return batch.select("*", *(F.max(F.col("change_type") == kind).over(per_row).alias(name) for name, kind in (("_i", INSERT), ("_d", DELETE), ("_p", POST))))


def resolve_conflicts(batch: DataFrame, by: Sequence[str] = (), seen: Observation | None = None) -> DataFrame:
    """Phase 2 by destination and rowid: insert and delete cancel, a delete beats postimages, a postimage beats inserts. seen observes the conflicts."""
    ct = F.col("change_type")
    gone = ((ct == INSERT) & (F.col("_d") | F.col("_p"))) | ((ct == DELETE) & F.col("_i")) | ((ct == POST) & F.col("_d"))
    flags = _flags(batch, by)
    if seen is not None:  # each rowid once, by equal shares of its inserts
        share = 1 / F.sum(F.when(ct == INSERT, 1)).over(Window.partitionBy("rowid", *by))
        flags = flags.withColumn("_share", F.when((ct == INSERT) & (F.col("_d") | F.col("_p")), share)).observe(seen, F.coalesce(F.round(F.sum("_share")).cast("bigint"), F.lit(0)).alias("cdc_conflicts_resolved_total"))
    return flags.filter(~gone).drop("_i", "_d", "_p", "_share")


def conflict_counts(batch: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row: conflicts, the rowids of a destination with an insert and a delete or postimage."""
    flags = batch.groupBy(*by, "rowid").agg(*(F.max(F.col("change_type") == k).alias(n) for n, k in (("_i", INSERT), ("_d", DELETE), ("_p", POST))))
    return flags.agg(F.count_if(F.col("_i") & (F.col("_d") | F.col("_p"))).alias("conflicts"))


def upserts(batch: DataFrame) -> DataFrame:
    return batch.filter(F.col("change_type").isin(INSERT, POST))


def deletes(batch: DataFrame) -> DataFrame:
    return batch.filter(F.col("change_type") == DELETE)


def last_write_wins(batch: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Of the upserts of one key the one of the highest snapshot, then rowid: found in each task before the shuffle, so that a hot key brings few rows to one."""
    rows = upserts(batch)
    last = rows.groupBy(*map(col, [*by, *keys])).agg(F.max_by(F.struct(*map(col, rows.columns)), F.struct("snapshot_id", "rowid")).alias("_last"))
    return last.select("_last.*")


def without_keys(table: DataFrame, keys_of: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of table whose key is not in keys_of; nulls match nulls."""
    require_columns(table, keys)
    other = keys_of.select(*(col(k).alias(f"_k{n}") for n, k in enumerate(keys))).distinct()
    return table.join(other, reduce(lambda a, b: a & b, (col(k).eqNullSafe(F.col(f"_k{n}")) for n, k in enumerate(keys))), "left_anti")


def with_keys(table: DataFrame, keys_of: DataFrame, keys: Sequence[str]) -> DataFrame:
    other = keys_of.select(*(col(k).alias(f"_k{n}") for n, k in enumerate(keys))).distinct()
    return table.join(other, reduce(lambda a, b: a & b, (col(k).eqNullSafe(F.col(f"_k{n}")) for n, k in enumerate(keys))), "left_semi")


def delete_predicate(rows: list[dict], keys: Sequence[str]) -> Column:
    """The predicate that finds the given keys (a few, known on the driver): IN and IS NULL for one column, else null-safe equalities."""
    if not rows:
        return F.lit(False)
    if len(keys) == 1:
        values = [r[keys[0]] for r in rows]
        some = [v for v in values if v is not None]
        found = col(keys[0]).isin(some) if some else F.lit(False)
        return found | col(keys[0]).isNull() if len(some) < len(values) else found
    return reduce(lambda a, b: a | b, (reduce(lambda a, b: a & b, (col(k).eqNullSafe(F.lit(r[k])) for k in keys)) for r in rows))


def apply_changes(table: DataFrame, batch: DataFrame, keys: Sequence[str], by: Sequence[str] = (), seen: Observation | None = None) -> DataFrame:
    """Phase 3: the table after the deletes and then the upserts of a resolved batch. Deletes never touch the batch's upserts.

    seen observes the table's rows that upserts replace (and no delete takes away).
    """
    require_columns(batch, keys)
    new = strip_meta(last_write_wins(batch, keys, by))
    if seen is not None:
        names = [*by, *keys]
        kinds = batch.groupBy(*(col(k).alias(f"_k{n}") for n, k in enumerate(names))).agg(F.max(F.col("change_type") == DELETE).alias("_gone"))
        met = table.join(kinds, reduce(lambda a, b: a & b, (col(k).eqNullSafe(F.col(f"_k{n}")) for n, k in enumerate(names))), "left")
        met = met.observe(seen, F.count_if(~F.col("_gone")).alias("upsert_matched")).filter("_gone is null")
        return met.select(*map(col, table.columns)).unionByName(new.select(*map(col, table.columns)))
    touched = batch.select(*(col(k) for k in [*by, *keys]))
    return without_keys(table, touched, [*by, *keys]).unionByName(new.select(*table.columns))


def apply_counts(table: DataFrame, batch: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """deleted and upserted: rows sent; upsert_matched: keys upserted that the table has after the deletes. By destination if given."""
    sent = batch.groupBy(*by).agg(F.count_if(F.col("change_type") == DELETE).alias("deleted"), F.count_if(F.col("change_type").isin(INSERT, POST)).alias("upserted"))
    kept = without_keys(table, deletes(batch), [*by, *keys])
    matched = with_keys(kept, upserts(batch), [*by, *keys]).groupBy(*by).agg(F.count(F.lit(1)).alias("upsert_matched"))
    joined = sent.join(matched, list(by), "left") if by else sent.crossJoin(F.broadcast(matched))
    return joined.withColumn("upsert_matched", F.coalesce("upsert_matched", F.lit(0)))

"""A versioned table: Parquet change files by snapshot and base files by version, tied together by one manifest that is swapped whole."""

from __future__ import annotations

import json
import tempfile
import uuid
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from fanflow.operators import cdc


_own: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, spark.checkpoint.dir; on a local master only, one of this process where that is unset."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at and not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not at and not _own:
        _own.append("file://" + tempfile.mkdtemp(prefix="spark-lake-"))
    return (at or _own[0]).rstrip("/")


def read_manifest(path: str) -> dict | None:
    """The manifest of the table at a path or URI; None without a table."""
    store, at = fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)
    name = f"{at}/manifest.json"
    if store.get_file_info(name).type == fs.FileType.NotFound:
        return None
    with store.open_input_stream(name) as f:
        return json.loads(f.read())


def fs_has_data(path: str) -> bool:
    """Whether a written folder holds a Parquet file."""
    store, at = fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)
    return any(f.path.endswith(".parquet") for f in store.get_file_info(fs.FileSelector(at, allow_not_found=True, recursive=True)))


@dataclass(frozen=True)
class LakeTable:
    """Tables live in folders of a store that renames files; data files are read and written by Spark alone.

    A commit writes new files first and then replaces the manifest in one step, so readers see all of it or nothing. The
    manifest may carry a cursor, which makes data and cursor one commit.
    """

    spark: SparkSession
    path: str

    def manifest(self) -> dict:
        return read_manifest(self.path)

    def _commit(self, manifest: dict) -> None:
        store, at = fs.FileSystem.from_uri(self.path) if ":/" in self.path else (fs.LocalFileSystem(), self.path)
        store.create_dir(at)
        new = f"{at}/manifest-{uuid.uuid4().hex}"
        with store.open_output_stream(new) as f:
            f.write(json.dumps(manifest).encode())
        store.move(new, f"{at}/manifest.json")

    @classmethod
    def create(cls, spark: SparkSession, path: str, schema: T.StructType) -> LakeTable:
        """The table at path, made with this schema if there is none."""
        table = cls(spark, path)
        if read_manifest(path) is None:
            cdc.reject_reserved(schema.names)
            table._commit({"schema": schema.json(), "snapshot": None, "base": None, "logs": [], "cursor": {}})
        return table

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LakeTable:
        table = cls(spark, path)
        if read_manifest(path) is None:
            raise FileNotFoundError(f"no table at {path}")
        return table

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.manifest()["schema"]))

    def current_snapshot(self) -> int | None:
        return self.manifest()["snapshot"]

    def log(self) -> DataFrame:
        """All changes; filters on snapshot_id prune the folders that are read."""
        full = T.StructType([*self.schema.fields, T.StructField("change_type", T.StringType()), T.StructField("rowid", T.LongType()), T.StructField("snapshot_id", T.LongType())])
        if not self.manifest()["logs"]:
            return self.spark.createDataFrame([], full)
        return self.spark.read.schema(full).parquet(f"{self.path}/log")

    def changes(self, start: int, end: int) -> DataFrame:
        return cdc.in_range(self.log(), start, min(end, self.current_snapshot() or 0))

    def insertions(self, start: int, end: int) -> DataFrame:
        return self.changes(start, end).filter(F.col("change_type") == cdc.INSERT)

    def commit_changes(self, changes: DataFrame, cursor: dict | None = None) -> int:
        """One snapshot of changes (user columns, change_type, rowid), and the cursor with it."""
        m = self.manifest()
        snapshot = (m["snapshot"] or 0) + 1
        cdc.normalise(changes).select(*self.schema.names, "change_type", "rowid").write.mode("overwrite").parquet(f"{self.path}/log/snapshot_id={snapshot}")
        self._commit(m | {"snapshot": snapshot, "logs": [*m["logs"], snapshot], "cursor": m["cursor"] | (cursor or {})})
        return snapshot

    def scan(self, snapshot: int | None = None) -> DataFrame:
        """Rows at a snapshot of the log, or of the current base version."""
        m = self.manifest()
        if m["logs"]:
            at = snapshot if snapshot is not None else m["snapshot"]
            return self._rows_at(m, at).select(*map(cdc.col, self.schema.names))
        return self.spark.read.schema(self.schema).parquet(*self.folders(m)) if self.folders(m) else self.spark.createDataFrame([], self.schema)

    def _rows_at(self, m: dict, at: int) -> DataFrame:
        """Rows with rowid at a snapshot: from the nearest materialised one at or before it, if any, and the changes since."""
        base = max((int(n) for n in m.get("bases", {}) if int(n) <= at), default=None)
        if base is None:
            return cdc.as_of(self.log(), at)
        rows = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("rowid", T.LongType())])).parquet(m["bases"][str(base)])
        return cdc.as_of_base(rows, cdc.in_range(self.log(), base, at)) if base < at else rows

    def materialise(self, snapshot: int | None = None) -> None:
        """Writes the rows at a snapshot of the log (the current one by default); scans of it and later ones begin there and read only the changes since."""
        m = self.manifest()
        at = snapshot if snapshot is not None else m["snapshot"]
        if not m["logs"] or at is None or str(at) in m.get("bases", {}):
            return
        path = f"{self.path}/base-{at}-{uuid.uuid4().hex}"
        self._rows_at(m, at).write.parquet(path)
        self._commit(self.manifest() | {"bases": m.get("bases", {}) | {str(at): path}})

    def folders(self, manifest: dict) -> list[str]:
        """Folders of the data files that this manifest holds."""
        return list(manifest["base"] or [])

    def set_folders(self, folders: list[str], cursor: dict | None = None, layout: dict | None = None) -> None:
        """A new version of these folders, written before, with the cursor and how the rows lie in them. Tables with a change log are refused: scans read the log."""
        m = self.manifest()
        if m["logs"]:
            raise ValueError(f"{self.path} has a change log: commit changes instead")
        self._commit(m | {"base": folders, "snapshot": (m["snapshot"] or 0) + 1, "cursor": m["cursor"] | (cursor or {}), "buckets": None, "held": {}} | (layout or {}))

    def _written(self, rows: DataFrame) -> str:
        if self.manifest()["logs"]:
            raise ValueError(f"{self.path} has a change log: commit changes instead")
        at = f"{self.path}/base-{uuid.uuid4().hex}"
        rows.select(*self.schema.names).write.parquet(at)
        return at

    def replace(self, rows: DataFrame, cursor: dict | None = None) -> None:
        """A new version with these rows alone, and the cursor with it."""
        self.set_folders([self._written(rows)], cursor)

    def append(self, rows: DataFrame, cursor: dict | None = None) -> None:
        """A new version with these rows added in files of their own; nothing is rewritten."""
        self.set_folders([*self.folders(self.manifest()), self._written(rows)], cursor)

    def delete(self, predicate) -> None:
        self.replace(self.scan().filter(~F.coalesce(predicate, F.lit(False))))

    def upsert(self, rows: DataFrame, keys: list[str]) -> int:
        """Rows replaced or added by key (nulls equal); gives the number of rows that were replaced."""
        old = self.scan()
        matched = cdc.with_keys(old, rows, keys).count()
        self.replace(cdc.without_keys(old, rows, keys).unionByName(rows.select(*self.schema.names)))
        return matched

    def set_cursor(self, cursor: dict) -> None:
        m = self.manifest()
        self._commit(m | {"cursor": m["cursor"] | cursor})

    def files(self, snapshot: int | None = None) -> DataFrame:
        """One row: file count, data bytes and delete bytes of what a scan at this snapshot (the current one by default) reads.

        Deletes are rows of the log, or are gone from the base: no files hold deletes alone, so their bytes are zero.
        """
        m = self.manifest()
        at = [f"{self.path}/log/snapshot_id={n}" for n in m["logs"] if snapshot is None or n <= snapshot] or self.folders(m)
        if not at:
            return self.spark.createDataFrame([(0, 0, 0)], "files bigint, bytes bigint, delete_bytes bigint")
        listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(at).select("path", "length")
        return listed.agg(F.count("path").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.lit(0).cast("bigint").alias("delete_bytes"))

    def file_stats(self, start: int = 0, end: int | None = None) -> DataFrame:
        """(snapshot_id, files, bytes, rows, delete_rows) of the change files of each snapshot after start up to end (the current one by default).

        Each file is described by its own rows, so the listing is that of the scan and only the folders of these snapshots
        are read. delete_rows are deletes and preimages. Snapshots without rows have no row.
        """
        log = self.log()
        if not self.manifest()["logs"]:
            return log.select("snapshot_id", *(F.lit(0).cast("bigint").alias(c) for c in ("files", "bytes", "rows", "delete_rows"))).limit(0)
        rows = cdc.in_range(log.select("snapshot_id", "change_type", "_metadata.file_path", "_metadata.file_size"), start, self.current_snapshot() if end is None else end)
        gone = F.count_if(F.col("change_type").isin(cdc.DELETE, cdc.PRE))
        each = rows.groupBy("snapshot_id", "file_path").agg(F.max("file_size").alias("size"), F.count(F.lit(1)).alias("n"), gone.alias("gone"))
        return each.groupBy("snapshot_id").agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"), F.sum("n").alias("rows"), F.sum("gone").alias("delete_rows"))

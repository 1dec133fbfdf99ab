"""Structured Streaming as a trigger: a source whose offset is the table's snapshot; each batch runs one replication round."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from fanflow.plans.replicate import run_once
from fanflow.sources.config import Config
from fanflow.sources.lake import read_manifest


class SnapshotSource(DataSource):
    """Stream of snapshot ids of the table at option path. Data is read inside the batch, by the native Parquet reader."""

    @classmethod
    def name(cls) -> str:
        return "snapshots"

    def schema(self) -> str:
        return "snapshot_id bigint"

    def streamReader(self, schema):  # noqa: N802
        return _Reader(self.options["path"])


class _Reader(DataSourceStreamReader):
    def __init__(self, path: str):
        self.path = path

    def initialOffset(self) -> dict:  # noqa: N802
        return {"snapshot": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"snapshot": (read_manifest(self.path) or {}).get("snapshot") or 0}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [InputPartition((start["snapshot"], end["snapshot"]))]

    def read(self, partition: InputPartition):
        first, last = partition.value
        yield from ((n,) for n in range(first + 1, last + 1))


def replicate(spark: SparkSession, cfg: Config, checkpoint: str, continuous: bool = False) -> StreamingQuery:
    """Starts the stream: what is there now, or a round every poll interval. Cursors in the manifests decide what is read."""
    spark.dataSource.register(SnapshotSource)

    def batch(snapshots: DataFrame, _: int) -> None:
        run_once(snapshots.sparkSession, cfg)

    writer = spark.readStream.format("snapshots").option("path", cfg.source_path).load().writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=f"{cfg.poll_seconds} seconds") if continuous else writer.trigger(availableNow=True)).start()

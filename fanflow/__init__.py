"""Snapshot-driven change-data-capture fan-out as Spark DataFrame plans."""

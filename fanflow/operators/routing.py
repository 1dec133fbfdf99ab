"""Routing of rows to destinations by the value of one column: one join with the routing map for all destinations."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fanflow.operators.cdc import RoutingError, col, require_columns

#: Largest routing map that is sent to every task; larger ones are joined by shuffle.
SMALL_MAP = 200_000


def _typed(df: DataFrame, field: str, values: dict[str, str]) -> DataFrame:
    """(text, destination_id, _value): values cast once to the routing column's type, null where that can't be. A local relation, whose filters need no job."""
    require_columns(df, [field])
    kind = df.schema[field].dataType
    if kind.typeName() in ("array", "map", "struct", "variant"):
        raise RoutingError(f"{field} is of type {kind.simpleString()}, which has no routing values")
    table = pa.table({"text": pa.array([str(v) for v in values], pa.string()), "destination_id": pa.array(list(values.values()), pa.string())})
    return df.sparkSession.createDataFrame(table).withColumn("_value", F.col("text").try_cast(kind))


def typed_values(df: DataFrame, field: str, values: dict[str, str]) -> tuple[dict[str, str], dict[str, str]]:
    """values (value -> destination) that the routing column can have, and those that it can't."""
    bad = {r.text for r in _typed(df, field, values).filter(F.col("_value").isNull()).collect()}
    return {v: d for v, d in values.items() if v not in bad}, {v: d for v, d in values.items() if v in bad}


def routing_map(df: DataFrame, field: str, values: dict[str, str]) -> DataFrame:
    """(_value, destination_id) with values cast once to the routing column's type; a value that has none is an error."""
    made = _typed(df, field, values)
    bad = [r.text for r in made.filter(F.col("_value").isNull()).limit(5).collect()]
    if bad:
        raise RoutingError(f"{bad} are no values of {field}: {df.schema[field].dataType.simpleString()}")
    return made.select("_value", "destination_id")


def value_filter(df: DataFrame, field: str, values: list[str]) -> Column:
    """field IN values, typed; false without values."""
    require_columns(df, [field])
    if not values:
        return F.lit(False)
    kind = df.schema[field].dataType
    return col(field).isin([r[0] for r in routing_map(df, field, {v: v for v in values}).select("_value").collect()]) if kind.typeName() != "string" else col(field).isin(values)


def route(df: DataFrame, field: str, values: dict[str, str], keep_unrouted: bool = False) -> DataFrame:
    """df with destination_id; rows of null or unknown values go, or stay with a null destination_id."""
    table = routing_map(df, field, values)
    table = F.broadcast(table) if len(values) <= SMALL_MAP else table
    return df.join(table, col(field) == F.col("_value"), "left" if keep_unrouted else "inner").drop("_value")


def route_counts(df: DataFrame, field: str, values: dict[str, str]) -> DataFrame:
    """(destination_id, rows): destinations with rows, and null for unrouted rows."""
    return route(df, field, values, True).groupBy("destination_id").agg(F.count(F.lit(1)).alias("rows"))

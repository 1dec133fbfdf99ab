import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.sql.session.timeZone": "UTC", "spark.ui.showConsoleProgress": "false"}
    session = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def same_rows(spark, query, sql, sf_dir):
    """Rows of a query and of its SQL in DuckDB, sorted and rounded."""
    import duckdb

    db = duckdb.connect()
    for name in os.listdir(sf_dir):
        db.sql(f"create view {name.removesuffix('.parquet')} as select * from '{sf_dir}/{name}'")
    df, other = query(spark, sf_dir), db.sql(sql)
    columns = sorted(df.columns)
    assert columns == sorted(other.columns)
    clean = lambda v: round(v, 9) if isinstance(v, float) else v
    ours = sorted(repr([clean(r[c]) for c in columns]) for r in df.collect())
    theirs = sorted(repr([clean(v) for v in r]) for r in other.select(*(duckdb.ColumnExpression(c) for c in columns)).fetchall())
    return ours, theirs

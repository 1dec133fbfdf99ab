import pytest
from conftest import same_rows
from pyspark.sql import functions as F

from fanflow.functions import metrics
from fanflow.operators import cdc, cursors, routing
from fanflow.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = "company string, value bigint, change_type string, snapshot_id bigint, rowid bigint"


def batch(spark, *rows):
    return spark.createDataFrame([(company, value, kind, n + 1, rowid) for n, (kind, rowid, company, value) in enumerate(rows)], COLUMNS)


def kinds(df):
    return sorted((r.change_type.removeprefix("update_"), r.rowid, r.company) for r in df.collect())


PRE, POST = "update_preimage", "update_postimage"


@pytest.mark.parametrize(
    ("rows", "left"),
    [
        ([(PRE, 100, "acme", 1), (POST, 100, "acme", 2)], [("postimage", 100, "acme")]),
        ([(PRE, 100, "acme", 1), (POST, 100, "beta", 2)], [("delete", 100, "acme"), ("postimage", 100, "beta")]),
        ([(PRE, 100, "acme", 1), ("insert", 200, "beta", 2)], [("delete", 100, "acme"), ("insert", 200, "beta")]),
        ([(PRE, 100, "", 1), (POST, 100, "", 2)], [("postimage", 100, "")]),
        ([(PRE, 100, None, 1), (POST, 100, None, 2)], [("postimage", 100, None)]),
        ([(PRE, 100, None, 1), (POST, 100, "a", 2)], [("delete", 100, None), ("postimage", 100, "a")]),
        ([("insert", 1, "a", 1)], [("insert", 1, "a")]),
    ],
)
def test_preimages(spark, rows, left):
    key = lambda x: (x[0], x[1], x[2] or "")
    found = [(r.change_type.removeprefix("update_"), r.rowid, r.company) for r in cdc.resolve_preimages(batch(spark, *rows), "company", ["value"]).collect()]
    assert sorted(found, key=key) == sorted(left, key=key)


@pytest.mark.parametrize(
    ("rows", "left", "conflicts"),
    [
        ([("insert", 100), ("delete", 100)], [], 1),
        ([(POST, 100), ("delete", 100)], [("delete", 100, "a")], 0),
        ([("insert", 100), (POST, 100), ("delete", 100)], [], 1),
        ([("insert", 100), ("insert", 100)], [("insert", 100, "a")] * 2, 0),
        ([("insert", 100), ("delete", 200)], [("delete", 200, "a"), ("insert", 100, "a")], 0),
        ([("insert", 100), ("delete", 100), ("insert", 300)], [("insert", 300, "a")], 1),
        ([("insert", 100), (POST, 100)], [("postimage", 100, "a")], 1),
        ([(POST, 100), (POST, 200), (POST, 300)], [("postimage", 100, "a"), ("postimage", 200, "a"), ("postimage", 300, "a")], 0),
    ],
)
def test_conflicts(spark, rows, left, conflicts):
    df = batch(spark, *((k, r, "a", 1) for k, r in rows))
    assert kinds(cdc.resolve_conflicts(df)) == left
    assert cdc.conflict_counts(df).first().conflicts == conflicts


def test_apply_delete_then_upsert_last_write_wins_and_null_keys(spark):
    table = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "company string, value bigint")
    changes = batch(spark, ("delete", 1, "a", 1), ("insert", 9, "a", 5), (POST, 9, "a", 6), ("delete", 3, None, 3))
    assert sorted(map(tuple, cdc.apply_changes(table, changes, ["company"]).collect())) == [("a", 6), ("b", 2)]
    counts = cdc.apply_counts(table, changes, ["company"]).first()
    assert (counts.deleted, counts.upserted, counts.upsert_matched) == (2, 2, 0)


def test_delete_predicate(spark):
    df = spark.createDataFrame([(1, "x"), (None, "y"), (3, None)], "a int, b string")
    left = lambda rows, keys: sorted(str(tuple(r)) for r in df.filter(cdc.delete_predicate(rows, keys)).collect())
    assert left([{"a": 1}, {"a": None}], ["a"]) == ["(1, 'x')", "(None, 'y')"]
    assert left([{"a": None}], ["a"]) == ["(None, 'y')"]
    assert left([{"a": 3, "b": None}, {"a": 1, "b": "z"}], ["a", "b"]) == ["(3, None)"]
    assert left([], ["a"]) == []


def test_errors(spark):
    df = batch(spark, ("insert", 1, "a", 1))
    with pytest.raises(cdc.RoutingError):
        cdc.resolve_preimages(df, "company", ["missing"])
    with pytest.raises(cdc.RoutingError):
        routing.route(df, "value", {"seven": "d"})
    with pytest.raises(cdc.RoutingError):
        cdc.reject_reserved(["rowid", "x"])
    odd = df.withColumnRenamed("company", "user@domain")
    assert routing.route(odd, "user@domain", {"a": "d"}).first().destination_id == "d"


def test_quantiles(spark):
    df = spark.createDataFrame([(float(v),) for v in (5, 1, 4, 1, 3)] + [(None,)], "v double")
    assert tuple(metrics.quantiles(df, "v", (0.0, 0.5, 0.9, 1.0)).first()) == (1.0, 3.0, pytest.approx(4.6), 5.0)
    assert tuple(metrics.quantiles(df.filter("v > 9"), "v").first()) == (None, None, None)
    buckets = metrics.histogram(df, "v", (2, 4))
    assert metrics.histogram_quantile(buckets, 0.5).first().quantile == 2.5
    assert metrics.histogram_quantile(buckets, 0.95).first().quantile == 4.0
    assert metrics.histogram_quantile(metrics.histogram(df.limit(0), "v", (2, 4)), 0.5).first().quantile is None


def test_counts_add_up_by_instance(spark):
    row = lambda d, i, n: (d, i, 1, None, n, None, None, None)
    state = spark.createDataFrame([row("a", "me", 5), row("b", "me", None), row("c", "me", 7), row("a", "other", 2)], cursors.STATE)
    done = spark.createDataFrame([("a", 3), ("b", 4), ("z", 9)], "destination_id string, rows bigint")
    found = {(r.destination_id, r.instance_id): r.rows_replicated for r in cursors.add_rows(state, "me", done).collect()}
    assert found == {("a", "me"): 8, ("b", "me"): 4, ("c", "me"): 7, ("a", "other"): 2}


def test_assignment(spark):
    ids = [f"d{n}" for n in range(50)]
    parts = [cursors.assigned(ids, "hash", total=3, ordinal=k) for k in range(3)]
    assert sorted(sum(parts, [])) == sorted(ids)
    assert cursors.assigned(ids, "explicit", ["d9", "nobody", "d1"]) == ["d9", "d1"]
    rows = spark.createDataFrame([(d,) for d in ids], "d string").select("d", cursors.partition_column("d", 3).alias("p")).collect()
    assert all(r.p == cursors.partition_of(r.d, 3) for r in rows)


def test_plan_has_no_nested_loop_and_one_exchange_for_both_phases(spark):
    for name in ("conflict_resolve", "multi_cursor_single_scan"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        assert plan.count("Exchange hashpartitioning") == 1


def test_both_phases_share_one_sort(spark):
    plan = QUERIES["multi_cursor_single_scan"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count(" Sort [") == 1 and plan.count(" Window [") == 2


def test_a_routing_map_needs_no_job(spark):
    df = batch(spark, ("insert", 1, "a", 1))
    tracker, group = spark.sparkContext.statusTracker(), "routing-map"
    spark.sparkContext.setJobGroup(group, "")
    routing.route(df, "value", {"1": "d"})
    assert not tracker.getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    ours, theirs = same_rows(spark, QUERIES[name], ORACLES[name], SF)
    assert ours == theirs

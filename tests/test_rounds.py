"""Rounds that go wrong for some destinations, and what rounds write."""

import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F
from test_replicate import SCHEMA, commit, held, made

from fanflow.functions import metrics
from fanflow.operators import cdc, cursors
from fanflow.operators.routing import RoutingError
from fanflow.plans import replicate
from fanflow.sources import config
from fanflow.sources.lake import LakeTable


def many(spark, tmp_path, n, **more):
    source = LakeTable.create(spark, f"{tmp_path}/source", spark.createDataFrame([], SCHEMA).schema)
    raw = {"source": {"path": source.path}, "routing": {"field": "company", "key_columns": ["event_id"], "seed_mode": "cdc_replay"} | more, "destinations": [{"id": f"d{k}", "routing_value": f"c{k}", "path": f"{tmp_path}/d{k}"} for k in range(n)]}
    return source, config.parse(raw)


def jobs(spark, name, run):
    spark.sparkContext.setJobGroup(name, "")
    out = run()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_a_destination_that_lost_its_data_fails_alone(spark, tmp_path):
    source, cfg = made(spark, tmp_path, seed_mode="cdc_replay")
    commit(spark, source, (1, "a", 10, "insert", 1), (3, "b", 30, "insert", 3))
    replicate.run_once(spark, cfg)
    for folder in LakeTable.load(spark, f"{tmp_path}/da").manifest()["base"]:
        shutil.rmtree(folder)
    commit(spark, source, (1, "a", 11, "update_postimage", 1), (3, "b", 33, "update_postimage", 3))
    said = replicate.run_once(spark, cfg, wait=lambda s: None)
    assert said["da"]["error"] and said["db"] | {"seconds": 0} == {"rows": 1, "deleted": 0, "rewritten": 1, "seconds": 0, "snapshot": 2, "error": None}
    states = {r.destination_id: r for r in replicate.status(spark, cfg).collect()}
    assert (states["da"].snapshot, states["da"].lag, states["da"].status, states["da"].last_error_at is None) == (1, 1, "error", False)
    assert (states["db"].snapshot, states["db"].lag, states["db"].status) == (2, 0, "healthy")
    assert sorted(map(tuple, LakeTable.load(spark, f"{tmp_path}/db").scan().collect())) == [(3, "b", 33)]


def test_unreadable_data_is_found_by_halving(spark, tmp_path, monkeypatch):
    source, cfg = many(spark, tmp_path, 16)
    commit(spark, source, *((k, f"c{k}", k, "insert", k) for k in range(16)))
    replicate.run_once(spark, cfg)
    commit(spark, source, *((k, f"c{k}", k + 100, "update_postimage", k) for k in range(16)))
    for file in (f for folder in LakeTable.load(spark, f"{tmp_path}/d5").manifest()["base"] for f in glob.glob(f"{folder}/*.parquet")):
        os.remove(f"{os.path.dirname(file)}/.{os.path.basename(file)}.crc")
        with open(file, "wb") as f:
            f.write(b"no parquet")
    tries = []
    whole = replicate._write
    monkeypatch.setattr(replicate, "_write", lambda *a: tries.append(len(a[4])) or whole(*a))
    said = replicate.run_once(spark, cfg, wait=lambda s: None)
    assert {k for k, v in said.items() if v["error"]} == {"d5"} and len(tries) <= 2 * 4 + 4
    assert all(rows == [(int(k[1:]), f"c{k[1:]}", int(k[1:]) + 100)] for k, rows in held(spark, config.parse({"source": {"path": source.path}, "routing": {"field": "company"}, "destinations": [{"id": d.id, "routing_value": d.routing_value, "path": d.path} for d in cfg.destinations if d.id != "d5"]})).items())


def test_isolated():
    def work(keys):
        if bad & set(keys):
            raise OSError("disk" if hidden else f"no folder {min(bad & set(keys))}!")
        tried.append(keys)
        return {k: k for k in keys}

    keys = [f"k{n:03}" for n in range(100)]
    for bad, hidden in ((set(), True), ({"k007"}, False), ({"k007", "k070", "k099"}, True), (set(keys), True)):
        tried = []
        done, failed = replicate.isolated(keys, work, lambda k, message: k in message, lambda s: None)
        assert set(failed) == bad and set(done) == set(keys) - bad and len(tried) <= 1 + len(bad) * 8


def test_a_value_that_is_none_of_the_column_fails_its_destination_alone(spark, tmp_path):
    source = LakeTable.create(spark, f"{tmp_path}/source", spark.createDataFrame([], "event_id int, company int").schema)
    raw = {"source": {"path": source.path}, "routing": {"field": "company", "key_columns": ["event_id"]}, "destinations": [{"id": f"d{v}", "routing_value": v, "path": f"{tmp_path}/d{v}"} for v in ("1", "x")]}
    source.commit_changes(spark.createDataFrame([(1, 1, "insert", 1), (2, 2, "insert", 2)], "event_id int, company int, change_type string, rowid bigint"))
    for more in ({}, {"seed_mode": "cdc_replay"}):
        round_ = replicate.run_round(spark, config.parse(raw | {"routing": raw["routing"] | more}))
        assert "no value of company" in round_.destinations["dx"]["error"] and round_.numbers["routing_errors_total"] == 1
    assert {r.destination_id: r.status for r in replicate.status(spark, config.parse(raw)).collect()} == {"d1": "healthy", "dx": "error"}
    with pytest.raises(RoutingError):
        replicate.routing.route(source.scan(), "company", {"x": "dx"})


def test_one_changed_row_rewrites_one_bucket(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(replicate, "BUCKET_ROWS", 100)
    source, cfg = made(spark, tmp_path, seed_mode="scan")
    rows = spark.range(3000).selectExpr("cast(id as int) event_id", "if(id < 2900, 'a', 'b') company", "1 value", "'insert' change_type", "id rowid")
    source.commit_changes(rows)
    assert replicate.run_once(spark, cfg) == {}  # seeded
    before = LakeTable.load(spark, f"{tmp_path}/da").manifest()
    assert before["buckets"] == 32 and len(before["base"]) == 32 and sum(before["held"].values()) == 2900
    commit(spark, source, (5, "a", 1, "update_preimage", 5), (5, "a", 2, "update_postimage", 5))
    said, _ = jobs(spark, "one-row", lambda: replicate.run_once(spark, cfg))
    after = LakeTable.load(spark, f"{tmp_path}/da").manifest()
    assert 0 < said["da"]["rewritten"] < 200 and len(set(after["base"]) - set(before["base"])) == 1 and len(after["base"]) == 32
    assert {r.event_id: r.value for r in LakeTable.load(spark, f"{tmp_path}/da").scan().collect()} == {k: 2 if k == 5 else 1 for k in range(2900)}
    source.commit_changes(spark.range(10_000, 18_000).selectExpr("cast(id as int) event_id", "'a' company", "3 value", "'insert' change_type", "id rowid"))
    replicate.run_once(spark, cfg)
    grown = LakeTable.load(spark, f"{tmp_path}/da")
    assert grown.manifest()["buckets"] == 128 and grown.scan().count() == 10_900
    commit(spark, source, *((k, "b", 1, "delete", k) for k in range(2900, 3000)))
    replicate.run_once(spark, cfg)
    assert LakeTable.load(spark, f"{tmp_path}/db").scan().count() == 0 and LakeTable.load(spark, f"{tmp_path}/db").manifest()["base"] == []


def test_files_follow_rows_not_tasks(spark, tmp_path):
    n = 300
    source, cfg = many(spark, tmp_path, n)
    rows = spark.range(0, 20 * n, 1, 16).selectExpr("cast(id as int) event_id", f"concat('c', id % {n}) company", "1 value", "'insert' change_type", "id rowid")
    source.commit_changes(rows)
    spark.conf.set("spark.sql.shuffle.partitions", 64)
    try:
        replicate.run_once(spark, cfg)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    files = glob.glob(f"{source.path}-rounds/*/*/*/*.parquet")
    assert n <= len(files) <= 1.1 * n


def test_append_rounds_keep_few_folders(spark, tmp_path):
    source, cfg = many(spark, tmp_path, 1, key_columns=[])
    for k in range(12):
        commit(spark, source, (k, "c0", k, "insert", k))
        replicate.run_once(spark, cfg)
    table = LakeTable.load(spark, f"{tmp_path}/d0")
    assert len(table.manifest()["base"]) <= replicate.FOLDERS and sorted(r.event_id for r in table.scan().collect()) == list(range(12))
    sizes, written = {}, 0
    for k in range(1000):
        gone = replicate._merged(sizes, 1)
        new = 1 + sum(sizes.pop(f) for f in gone)
        written += new
        sizes[f"f{k}"] = new
    assert len(sizes) <= replicate.FOLDERS + 11 and written <= 11 * 1000 and sum(sizes.values()) == 1000


def test_numbers_of_a_round(spark, tmp_path):
    source, cfg = made(spark, tmp_path, seed_mode="cdc_replay")
    commit(spark, source, (1, "a", 10, "insert", 1), (2, "a", 20, "insert", 2), (3, "b", 30, "insert", 3), (4, "z", 40, "insert", 4))
    first = replicate.run_round(spark, cfg).numbers
    assert (first["cdc_rows_read_total"], first["unrouted_rows_total"], first["dest_upsert_matched_total"], first["max_lag_snapshots"]) == (4, 1, 0, 0)
    commit(spark, source, (1, "a", 10, "update_preimage", 1), (1, "b", 10, "update_postimage", 1), (2, "a", 20, "update_preimage", 2), (3, "b", 30, "update_preimage", 3), (3, "b", 31, "update_postimage", 3), (5, "a", 1, "insert", 5), (5, "a", 1, "delete", 5))
    said = replicate.run_round(spark, cfg)
    names = ("cdc_rows_read_total", "cdc_orphaned_preimages_total", "cdc_routing_mutations_total", "cdc_conflicts_resolved_total", "dest_upsert_matched_total", "routing_errors_total", "snapshots_read")
    assert [said.numbers[k] for k in names] == [7, 1, 1, 1, 1, 0, 1] and said.numbers["cycle_seconds"] > 0
    assert held(spark, cfg) == {"da": [], "db": [(1, "b", 10), (3, "b", 31)]}
    rows = {(r.metric, r.destination_id): r.value for r in replicate.round_metrics(spark, cfg, said).collect()}
    assert rows["dest_rows_written_total", "db"] == 2 and rows["dest_lag_snapshots", "da"] == 0 and rows["source_snapshot_id", None] == 2
    assert {m for m, _ in rows} == {*metrics.ROUND, *metrics.EACH}
    commit(spark, source, (9, "z", 1, "insert", 9))
    none = replicate.run_round(spark, cfg)
    assert none.numbers["unrouted_rows_total"] == none.numbers["cdc_rows_read_total"] == 1 and none.destinations["da"]["rows"] == 0


def test_key_columns_are_a_list(tmp_path):
    good = {"source": {"path": "s"}, "routing": {"field": "f"}, "destinations": [{"id": "a", "routing_value": 1, "path": "p"}]}
    for bad in ("event_id", [1], [""], {"a": 1}):
        with pytest.raises(config.ConfigError):
            config.parse(good | {"routing": {"field": "f", "key_columns": bad}})
    assert config.parse(good | {"routing": {"field": "f", "key_columns": ["a", "b"]}}).key_columns == ("a", "b")


def plan(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[-1]


def test_scans_begin_at_the_nearest_base(spark, tmp_path):
    source, _ = made(spark, tmp_path)
    commit(spark, source, (1, "a", 10, "insert", 1), (2, "a", 20, "insert", 2), (3, "b", 30, "insert", 3))
    commit(spark, source, (1, "a", 10, "update_preimage", 1), (1, "b", 11, "update_postimage", 1), (2, "a", 20, "delete", 2))
    commit(spark, source, (2, "a", 22, "insert", 2), (3, "b", 30, "delete", 3), (4, "a", 4, "insert", 4), (4, "a", 4, "delete", 4))
    before = {n: sorted(map(tuple, source.scan(n).collect())) for n in (1, 2, 3)}
    source.materialise(2)
    source.materialise(2)
    assert {n: sorted(map(tuple, source.scan(n).collect())) for n in (1, 2, 3)} == before
    assert "snapshot_id#" in plan(source.scan(3)) and "(snapshot_id" in plan(source.scan(3)).split("PartitionFilters")[-1]
    files = {f.split("/log/")[-1].split("/")[0] for f in source.scan(3).inputFiles() if "/log/" in f}
    assert {"snapshot_id=3"} <= files and not [f for f in source.scan(2).inputFiles() if "/log/" in f]
    assert "> 2)" in plan(source.scan(3))


def test_last_write_wins_without_a_window(spark):
    batch = spark.createDataFrame([(1, "a", 1, "insert", 1, 1), (1, "b", 2, "insert", 1, 2), (1, "c", 3, "delete", 9, 3), (None, "d", 4, "update_postimage", 2, 4)], "k int, v string, n int, change_type string, snapshot_id bigint, rowid bigint")
    out = cdc.last_write_wins(batch, ["k"])
    assert "Window" not in plan(out) and plan(out).count("Exchange") == 1
    assert out.columns == batch.columns and sorted(r.v for r in out.collect()) == ["b", "d"]


def test_health_by_age(spark):
    rows = [(1, None, None), (2, 900.0, None), (3, 900.0, 500.0), (4, 900.0, 300.0), (5, 600.0, 600.0)]
    df = spark.createDataFrame(rows, "id int, p double, r double").select("id", *(F.expr(f"timestamp_seconds({c})").alias(n) for c, n in (("p", "last_poll_at"), ("r", "last_replicated_at"))))
    got = {r.id: (r.alive, r.ready) for r in cursors.health(df, F.expr("timestamp_seconds(1000)")).collect()}
    assert got == {1: (False, False), 2: (True, True), 3: (True, True), 4: (True, False), 5: (False, False)}


def test_file_stats_match_the_files_on_disk(spark, tmp_path):
    """Files, bytes and rows of each snapshot, from the scan's own metadata, against a listing of the folders."""
    import pyarrow.parquet as pq

    table = LakeTable.create(spark, f"{tmp_path}/t", spark.createDataFrame([], "k long, v string").schema)
    assert table.file_stats().collect() == []
    kinds = ("insert", "delete", "update_preimage", "update_postimage")
    for n in range(1, 4):
        rows = [(k, "x" * k, kinds[k % 4 if n > 1 else 0], k) for k in range(20 * n)]
        table.commit_changes(spark.createDataFrame(rows, "k long, v string, change_type string, rowid long").repartition(n + 1))
    found = {x.snapshot_id: x for x in table.file_stats().collect()}
    assert set(found) == {1, 2, 3}
    for n, x in found.items():
        files = [f for f in (tmp_path / f"t/log/snapshot_id={n}").glob("*.parquet") if pq.read_metadata(f).num_rows]
        assert (x.files, x.bytes, x.rows) == (len(files), sum(f.stat().st_size for f in files), 20 * n)
        assert x.files == n + 1 and x.delete_rows == (0 if n == 1 else 10 * n)
    assert {x.snapshot_id for x in table.file_stats(1, 2).collect()} == {2}
    assert "PartitionFilters: [isnotnull(snapshot_id" in table.file_stats(1, 2)._jdf.queryExecution().executedPlan().toString()

import os
import random

import pytest

from fanflow.operators import cdc
from fanflow.plans import replicate
from fanflow.sources import config
from fanflow.sources.lake import LakeTable

SCHEMA = "event_id int, company string, value int"


def made(spark, tmp_path, **more):
    source = LakeTable.create(spark, f"{tmp_path}/source", spark.createDataFrame([], SCHEMA).schema)
    raw = {"source": {"path": f"{tmp_path}/source"}, "routing": {"field": "company", "key_columns": ["event_id"]} | more, "destinations": [{"id": f"d{c}", "routing_value": c, "path": f"{tmp_path}/d{c}"} for c in "ab"]}
    return source, config.parse(raw)


def commit(spark, source, *rows):
    source.commit_changes(spark.createDataFrame(list(rows), f"{SCHEMA}, change_type string, rowid bigint"))


def held(spark, cfg):
    return {d.id: sorted(map(tuple, LakeTable.load(spark, d.path).scan().collect())) for d in cfg.destinations}


def test_seed_then_changes(spark, tmp_path):
    source, cfg = made(spark, tmp_path)
    assert replicate.run_once(spark, cfg) == {}
    commit(spark, source, (1, "a", 10, "INSERT", 1), (2, "a", 20, "insert", 2), (3, "b", 30, "insert", 3), (4, "c", 40, "insert", 4))
    replicate.run_once(spark, cfg)
    assert held(spark, cfg) == {"da": [(1, "a", 10), (2, "a", 20)], "db": [(3, "b", 30)]}
    commit(spark, source, (1, "a", 10, "update_preimage", 1), (1, "a", 99, "update_postimage", 1), (2, "a", 20, "delete", 2))
    said = replicate.run_once(spark, cfg)
    assert held(spark, cfg) == {"da": [(1, "a", 99)], "db": [(3, "b", 30)]}
    assert said["da"]["deleted"] == 1 and said["db"]["rows"] == 0
    assert {(r.destination_id, r.lag, r.status) for r in replicate.status(spark, cfg).collect()} == {("da", 0, "healthy"), ("db", 0, "healthy")}
    assert source.files().first().files >= 2
    assert [tuple(r) for r in source.scan(1).orderBy("event_id").collect()][0] == (1, "a", 10)


def test_a_failed_destination_keeps_its_cursor(spark, tmp_path, monkeypatch):
    source, cfg = made(spark, tmp_path, seed_mode="cdc_replay")
    commit(spark, source, (1, "a", 10, "insert", 1), (3, "b", 30, "insert", 3))
    whole = LakeTable.set_folders
    monkeypatch.setattr(LakeTable, "set_folders", lambda self, *a: (_ for _ in ()).throw(OSError("full")) if self.path.endswith("da") else whole(self, *a))
    said = replicate.run_once(spark, cfg, wait=lambda s: None)
    assert said["da"]["error"] == "full" and said["db"]["error"] is None
    assert {r.destination_id: r.status for r in replicate.status(spark, cfg).collect()} == {"da": "error", "db": "healthy"}
    monkeypatch.setattr(LakeTable, "set_folders", whole)
    replicate.run_once(spark, cfg)
    assert held(spark, cfg) == {"da": [(1, "a", 10)], "db": [(3, "b", 30)]}


def test_many_destinations_take_as_many_jobs_as_two(spark, tmp_path):
    jobs = []
    for n in (2, 60):
        source, cfg = made(spark, tmp_path / str(n), seed_mode="cdc_replay")
        raw = {"source": {"path": source.path}, "routing": {"field": "company", "key_columns": ["event_id"], "seed_mode": "cdc_replay"}, "destinations": [{"id": f"d{k}", "routing_value": f"c{k}", "path": f"{tmp_path}/{n}/d{k}"} for k in range(n)]}
        cfg = config.parse(raw)
        commit(spark, source, *((k, f"c{k % n}", k, "insert", k) for k in range(120)))
        replicate.run_once(spark, cfg)
        commit(spark, source, *((k, f"c{k % n}", k, "delete", k) for k in range(60)))
        spark.sparkContext.setJobGroup(f"round-{n}", "")
        said = replicate.run_once(spark, cfg)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"round-{n}")))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert sum(v["deleted"] for v in said.values()) == 60
        assert sum(len(v) for v in held(spark, cfg).values()) == 60
    assert jobs[1] <= jobs[0] + 4  # many folders are listed by jobs of their own


def test_appended_rows_are_new_files_and_logged_tables_refuse_writes(spark, tmp_path):
    source, cfg = made(spark, tmp_path, seed_mode="cdc_replay", key_columns=[])
    commit(spark, source, (1, "a", 10, "insert", 1))
    replicate.run_once(spark, cfg)
    first = LakeTable.load(spark, f"{tmp_path}/da").manifest()["base"]
    commit(spark, source, (2, "a", 20, "insert", 2), (1, "a", 10, "delete", 1))
    replicate.run_once(spark, cfg)
    assert LakeTable.load(spark, f"{tmp_path}/da").manifest()["base"][:1] == first and held(spark, cfg)["da"] == [(1, "a", 10), (2, "a", 20)]
    with pytest.raises(ValueError, match="change log"):
        source.append(spark.createDataFrame([(9, "a", 9)], SCHEMA))


def test_random_histories_converge(spark, tmp_path):
    """Hardened replay from any cursor gives the source's rows, whatever the operations."""
    r = random.Random(4)
    source, cfg = made(spark, tmp_path, seed_mode="cdc_replay", pairing="hardened")
    live, free = {}, 1
    for step in range(3):
        rows = []
        for _ in range(25):
            kind = r.choice(["insert", "update", "delete"])
            if kind == "insert" or not live:
                live[free] = (free, r.choice("abc"), r.randint(0, 9))
                rows.append((*live[free], "insert", free))
                free += 1
            else:
                key = r.choice(sorted(live))
                if any(x[-1] == key for x in rows):
                    continue
                rows.append((*live[key], "update_preimage" if kind == "update" else "delete", key))
                if kind == "update":
                    live[key] = (key, r.choice("abc"), r.randint(0, 9))
                    rows.append((*live[key], "update_postimage", key))
                else:
                    del live[key]
        commit(spark, source, *rows)
        if step != 1:
            replicate.run_once(spark, cfg)
    assert held(spark, cfg) == {f"d{c}": sorted(v for v in live.values() if v[1] == c) for c in "ab"}


def test_table_operations(spark, tmp_path):
    t = LakeTable.create(spark, f"{tmp_path}/t", spark.createDataFrame([], SCHEMA).schema)
    rows = lambda *x: spark.createDataFrame(list(x), SCHEMA)
    t.append(rows((1, "a", 1), (2, "b", 2), (3, None, 3)))
    assert t.upsert(rows((2, "b", 5), (4, "d", 4)), ["event_id"]) == 1
    t.delete(cdc.delete_predicate([{"company": None}, {"company": "a"}], ["company"]))
    assert sorted(map(tuple, t.scan().collect())) == [(2, "b", 5), (4, "d", 4)]
    with pytest.raises(FileNotFoundError):
        LakeTable.load(spark, f"{tmp_path}/none")


def test_config_errors():
    good = {"source": {"path": "s"}, "routing": {"field": "f"}, "destinations": [{"id": "a", "routing_value": 1, "path": "p"}]}
    assert config.parse(good).destinations[0].routing_value == "1"
    os.environ["FANFLOW_TEST_KEY"] = "secret"
    props = {"defaults": {"properties": {"key_env": "FANFLOW_TEST_KEY", "a": "1"}}, "destinations": [{"id": "a", "routing_value": 1, "path": "p", "properties": {"a": "2"}}]}
    assert config.parse(good | props).destinations[0].properties == {"key": "secret", "a": "2"}
    for bad in ({"defaults": {"properties": {"k_env": "NO_SUCH_VARIABLE"}}}, {"defaults": {"properties": {"k": 5}}}, {"defaults": {"properties": ["k"]}}, {"destinations": []}, {"destinations": good["destinations"] * 2}, {"poll": {"interval_seconds": True}}, {"source": {}}, {"source": {"path_env": "NO_SUCH_VARIABLE"}}, {"instance": {"partition": {"mode": "some"}}}):
        with pytest.raises(config.ConfigError):
            config.parse(good | bad)

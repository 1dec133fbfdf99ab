"""The state of the pairing stream: large batches, many batches, batches that fail half-way, odd rows."""

import os
import random

import pytest
from test_pairing import put, resolved, tables
from test_replicate import SCHEMA

from fanflow.plans.replicate import FOLDERS
from fanflow.sources.lake import LakeTable
from fanflow.streaming.pairing import log_resolved


def test_a_batch_of_many_rows_is_no_call_for_each(spark, tmp_path):
    source, out = tables(spark, tmp_path)
    n = 300_000
    source.commit_changes(spark.range(n).selectExpr("cast(id as int) as event_id", "'a' as company", "1 as value", "'insert' as change_type", "id as rowid").coalesce(1))
    source.commit_changes(spark.range(0, n, 3).selectExpr("cast(id as int) as event_id", "'b' as company", "2 as value", "'update_postimage' as change_type", "id as rowid").coalesce(1))
    changes = spark.readStream.schema(source.log().schema).option("maxFilesPerTrigger", 1).parquet(f"{source.path}/log")
    query = log_resolved(changes, "company", ["event_id"], out, f"{tmp_path}/checkpoint")
    try:
        assert query.awaitTermination(120)
    finally:
        query.stop()
    assert {(r.company, r.n) for r in out.scan().groupBy("company").count().withColumnRenamed("count", "n").collect()} == {("a", n - n // 3), ("b", n // 3)}
    assert out.log().filter("change_type = 'delete' AND company = 'a' AND value IS NULL").count() == n // 3


def model(state, rows, snapshot):
    """The resolved changes of a batch, and the state after it, row by row."""
    last, out = {}, []
    for event_id, company, val, kind, rowid in rows:
        live = kind in ("insert", "update_postimage")
        if (snapshot, live) > last.get(rowid, state.get(rowid, (-1, False, None)))[:2]:
            last[rowid] = (snapshot, live, (company, event_id) if live else None, val)
    for rowid, (s, live, place, val) in last.items():
        was = state.get(rowid, (-1, False, None))[2]
        if was is not None and was != place:
            out.append((was[1], was[0], None, "delete", rowid))
        if live:
            out.append((place[1], place[0], val, "insert" if was is None else "update_postimage", rowid))
        state[rowid] = (s, live, place)
    return out


def histories():
    """Batches of changes; rowids are far apart, negative or null, updates come whole, halved or without their row."""
    r = random.Random(3)
    ids = [None, -1, 0, 1, 255, 256, 2**40, 2**62, 2**62 + 1, -(2**63)]
    for step in range(FOLDERS + 3):
        rows = []
        for rowid in r.sample(ids, 3 if step < FOLDERS else 9):
            row = lambda: (r.randint(1, 3), r.choice(["a", "b", None]), r.choice([None, 5]))
            for kind in r.choice([["insert"], ["delete"], ["update_preimage"], ["update_postimage"], ["update_preimage", "update_postimage"], ["UPDATE_POSTIMAGE"]]):
                rows.append((*row(), kind.lower(), rowid))
        r.shuffle(rows)
        yield rows


def of(out, snapshot):
    return sorted((tuple(x)[:5] for x in out.log().select("event_id", "company", "value", "change_type", "rowid", "snapshot_id").filter(f"snapshot_id = {snapshot}").collect()), key=repr)


def test_many_batches_equal_a_model_and_leave_few_folders(spark, tmp_path):
    source, out = tables(spark, tmp_path)
    state, expected = {}, []
    for n, rows in enumerate(histories(), 1):
        source.commit_changes(spark.createDataFrame(rows, f"{SCHEMA}, change_type string, rowid bigint").coalesce(1))
        expected.append(sorted(model(state, rows, n), key=repr))
    resolved(spark, source, out, tmp_path)
    assert [of(out, n + 1) for n in range(len(expected))] == expected
    held = out.manifest()["cursor"]["state"]
    assert len(held) <= FOLDERS and sorted(map(os.path.basename, held)) == sorted(x for x in os.listdir(out.path) if x.startswith(("state-", "pairs-")))


def test_a_batch_that_fails_before_its_commit_is_run_again_from_the_state_before_it(spark, tmp_path, monkeypatch):
    source, out = tables(spark, tmp_path)
    put(spark, source, (1, "a", 10, "insert", 1))
    resolved(spark, source, out, tmp_path)
    put(spark, source, (1, "b", 11, "update_postimage", 1))

    def fails(*_):
        raise OSError("no commit")

    with monkeypatch.context() as m:
        m.setattr(LakeTable, "commit_changes", fails)
        with pytest.raises(Exception, match="no commit"):
            resolved(spark, source, out, tmp_path)
    assert out.current_snapshot() == 1
    resolved(spark, source, out, tmp_path)
    assert of(out, 2) == sorted([(1, "a", None, "delete", 1), (1, "b", 11, "update_postimage", 1)], key=repr)


def test_a_table_whose_state_is_elsewhere_is_refused(spark, tmp_path):
    source, out = tables(spark, tmp_path)
    put(spark, source, (1, "a", 10, "insert", 1))
    out.set_cursor({"batch": -1})
    with pytest.raises(Exception, match="kept its state in the checkpoint"):
        resolved(spark, source, out, tmp_path)

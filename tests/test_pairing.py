"""Changes paired across micro-batches by keyed state."""

import random

from test_replicate import SCHEMA, commit

from fanflow.sources.lake import LakeTable
from fanflow.streaming.pairing import log_resolved


def resolved(spark, source, out, tmp_path):
    changes = spark.readStream.schema(source.log().schema).option("maxFilesPerTrigger", 1).parquet(f"{source.path}/log")
    log_resolved(changes, "company", ["event_id"], out, f"{tmp_path}/checkpoint").awaitTermination()


def tables(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    return LakeTable.create(spark, f"{tmp_path}/source", schema), LakeTable.create(spark, f"{tmp_path}/out", schema)


def put(spark, source, *rows):
    commit(spark, source, *rows) if len(rows) > 1 else source.commit_changes(spark.createDataFrame(list(rows), f"{SCHEMA}, change_type string, rowid bigint").coalesce(1))


def test_halves_of_different_batches_pair(spark, tmp_path):
    source, out = tables(spark, tmp_path)
    put(spark, source, (1, "a", 10, "insert", 1))
    put(spark, source, (1, "a", 10, "update_preimage", 1))
    put(spark, source, (1, "b", 11, "update_postimage", 1))
    resolved(spark, source, out, tmp_path)
    assert [tuple(r)[:4] for r in out.log().orderBy("snapshot_id").collect()] == [(1, "a", 10, "insert"), (1, "a", None, "delete"), (1, "b", 11, "insert")]
    put(spark, source, (1, "c", 12, "update_postimage", 1))  # after a restart, without its preimage
    put(spark, source, (1, "c", 12, "delete", 1))
    resolved(spark, source, out, tmp_path)
    assert sorted((tuple(r)[:4] for r in out.log().filter("snapshot_id > 3").collect()), key=repr) == [(1, "b", None, "delete"), (1, "c", 12, "update_postimage"), (1, "c", None, "delete")]
    assert out.scan().collect() == [] and out.manifest()["cursor"]["batch"] == out.current_snapshot() - 1
    resolved(spark, source, out, tmp_path)  # nothing new
    assert out.current_snapshot() == 5


def test_random_histories_end_as_the_source(spark, tmp_path):
    r = random.Random(7)
    source, out = tables(spark, tmp_path)
    live, free = {}, 1
    for step in range(4):
        rows = []
        for _ in range(12):
            kind = r.choice(["insert", "update", "delete"])
            if kind == "insert" or not live:
                live[free] = (free, r.choice(["a", "b", None]), r.choice([None, 5, 2**31 - 1]))
                rows.append((*live[free], "insert", free))
                free += 1
            else:
                key = r.choice(sorted(live))
                if any(x[-1] == key for x in rows):
                    continue
                rows.append((*live[key], "update_preimage" if kind == "update" else "delete", key))
                if kind == "update":
                    live[key] = (key, r.choice("ab"), r.randint(0, 9))
                    rows.append((*live[key], "update_postimage", key))
                else:
                    del live[key]
        r.shuffle(rows)
        commit(spark, source, *rows)
        if step % 2:
            resolved(spark, source, out, tmp_path)
            by = lambda x: repr(x)
            assert sorted(map(tuple, out.scan().collect()), key=by) == sorted(live.values(), key=by)

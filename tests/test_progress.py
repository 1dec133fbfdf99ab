import time

from pyspark.sql import functions as F
from test_replicate import commit, held, made

from fanflow.streaming.progress import Progress
from fanflow.streaming.trigger import replicate


def test_progress_of_a_stream(spark, tmp_path):
    source, cfg = made(spark, tmp_path, seed_mode="cdc_replay")
    commit(spark, source, (1, "a", 10, "insert", 1))
    commit(spark, source, (3, "b", 30, "insert", 3))
    progress = Progress()
    spark.streams.addListener(progress)
    try:
        query = replicate(spark, cfg, f"{tmp_path}/checkpoint", True)
        until = time.time() + 60
        while time.time() < until and not [r for r in progress.relation(spark).collect() if r.batches]:
            time.sleep(0.5)
        here = progress.health(spark).filter(F.col("query") == str(query.runId)).first()
        assert (here.batches, here.alive, here.ready, here.ended) == (1, True, True, False)
        assert here.longest_batch_seconds >= here.last_batch_seconds > 0
        later = lambda seconds: progress.health(spark, F.lit(here.last_poll_at).cast("timestamp") + F.make_dt_interval(secs=F.lit(seconds))).filter(F.col("query") == str(query.runId)).first()
        assert later(10_000).alive is False
        query.stop()
        while time.time() < until and not progress.relation(spark).filter(F.col("query") == str(query.runId)).first().ended:
            time.sleep(0.2)
        assert [(r.alive, r.ready, r.ended) for r in progress.health(spark).filter(F.col("query") == str(query.runId)).collect()] == [(False, False, True)]
    finally:
        spark.streams.removeListener(progress)
    assert held(spark, cfg) == {"da": [(1, "a", 10)], "db": [(3, "b", 30)]}

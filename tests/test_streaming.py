"""Streams over files, run until what is there is done."""

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from tallyspark.operators import limiter, tables
from tallyspark.plans.adapters import adapter
from tallyspark.streaming import jobs

SUPPRESSION = "suppression_id string, voter_id long, action string, reason string, requested_by string, supersedes string, requested_at timestamp"


def drained(writer):
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert q.exception() is None


def test_ledger_arrival(spark, tmp_path):
    rows = [(f"s{i}", i, "suppress", "r", "b", None, dt.datetime(2024, 1, 1)) for i in range(4)]
    for part in (rows[:3], rows[1:]):
        spark.createDataFrame(part, SUPPRESSION).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        arrivals = spark.readStream.schema(SUPPRESSION).json(f"{tmp_path}/in")
        drained(jobs.append_ledger(arrivals, f"{tmp_path}/ledger", f"{tmp_path}/cp"))
    store = tables.Store(spark, f"{tmp_path}/ledger")
    assert sorted(r.suppression_id for r in store.read("voter.suppressions").collect()) == ["s0", "s1", "s2", "s3"]
    # All files once more under a new checkpoint: nothing is added.
    version = store.version
    drained(jobs.append_ledger(spark.readStream.schema(SUPPRESSION).json(f"{tmp_path}/in"), f"{tmp_path}/ledger", f"{tmp_path}/cp2"))
    assert store.read("voter.suppressions").count() == 4 and store.version == version


def test_feed_upsert(spark, tmp_path):
    schema = "video_id string, video_url string, load_seq int"
    for seq in (1, 2):
        spark.createDataFrame([("a", f"u{seq}", seq), (f"b{seq}", "w", seq)], schema).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        drained(jobs.upsert_videos(spark.readStream.schema(schema).json(f"{tmp_path}/in"), f"{tmp_path}/t", f"{tmp_path}/cp"))
    store = tables.Store(spark, f"{tmp_path}/t")
    got = {r.video_id: r.video_url for r in store.read("seb.videos").collect()}
    assert got == {"a": "u2", "b1": "w", "b2": "w"} and store.version == 1
    # A new checkpoint counts from 0 again; the table goes on from its last set.
    spark.createDataFrame([("c", "n", 3)], schema).coalesce(1).write.json(f"{tmp_path}/more")
    drained(jobs.upsert_videos(spark.readStream.schema(schema).json(f"{tmp_path}/more"), f"{tmp_path}/t", f"{tmp_path}/cp2"))
    assert store.version == 2
    assert {r.video_id for r in store.read("seb.videos").collect()} == {"a", "b1", "b2", "c"}
    # The same files once more: nothing is written.
    drained(jobs.upsert_videos(spark.readStream.schema(schema).json(f"{tmp_path}/more"), f"{tmp_path}/t", f"{tmp_path}/cp3"))
    assert store.version == 2


def test_request_counts_and_limiter(spark, sf, tmp_path):
    requests = adapter(spark, sf, "requests").withColumn("ts", F.col("ts").cast("timestamp"))
    requests.repartition(1).write.parquet(f"{tmp_path}/in")
    stream = lambda: spark.readStream.schema(requests.schema).parquet(f"{tmp_path}/in")
    drained(jobs.request_counts(stream(), late="10000 days").writeStream.outputMode("update").format("memory").queryName("counts"))
    got = {r.hour: (r.requests, r.refused) for r in spark.table("counts").collect()}
    assert got == {r.hour: (r.requests, r.refused) for r in limiter.request_rollup(requests).collect()}
    drained(jobs.limited_stream(stream(), 172800.0, 3).writeStream.outputMode("append").format("memory").queryName("limited"))
    want = {(r.event_id, r.allowed) for r in limiter.limited(requests, window=172800.0, most=3).collect()}
    assert {(r.event_id, r.allowed) for r in spark.table("limited").collect()} == want and {a for _, a in want} == {True, False}


def test_state_ends_with_the_window(spark, tmp_path):
    """Callers whose window has passed leave the state; what they ask later begins anew."""
    def add(*rows):
        spark.createDataFrame(rows, "event_id long, ip string, ts timestamp").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def run():
        stream = spark.readStream.schema("event_id long, ip string, ts timestamp").parquet(f"{tmp_path}/in")
        q = jobs.limited_stream(stream, 60.0, 2, "1 second").writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
        q.awaitTermination(180)
        assert q.exception() is None
        return [p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators]

    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    add(*((i, f"ip{i % 20}", at(i / 10)) for i in range(100)))
    many = run()
    add((1000, "other", at(500)))
    few = run()
    assert max(many) >= 20 and few[-1] < 5
    add((1001, "ip0", at(501)), (1002, "other", at(502)), (1003, "other", at(503)))
    run()
    got = {r.event_id: (r.allowed, r.retry_after) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert len(got) == 104 and [sum(got[i][0] for i in range(k, 100, 20)) for k in range(20)] == [2] * 20
    assert got[1001] == (True, 0) and got[1002] == (True, 0) and got[1003] == (False, 57)


def test_frames_of_a_caller_are_folded_one_by_one():
    class Cell:
        def __init__(self):
            self.value, self.timers = None, []

        def getValueState(self, name, schema):
            return self

        exists = lambda self: self.value is not None
        get = lambda self: self.value
        update = lambda self, v: setattr(self, "value", v)
        listTimers = lambda self: iter(self.timers)
        deleteTimer = lambda self, t: self.timers.remove(t)
        registerTimer = lambda self, t: self.timers.append(t)

    cell, fold, alive = Cell(), jobs.Limiter(10.0, 3), []
    fold.init(cell)

    def frames():
        for n in range(50):
            alive.append(n)
            yield pd.DataFrame({"event_id": range(n * 4, n * 4 + 4), "t": [n * 4.0 + k for k in (3, 2, 1, 0)]})

    allowed = {}
    for n, out in enumerate(fold.handleInputRows(("ip",), frames(), None)):
        assert len(alive) == n + 1  # no frame is read ahead
        allowed.update(zip(out.event_id, out.allowed, strict=True))
    times = np.arange(200.0)
    want, _, start, count = limiter.decide(times, None, 0, 10.0, 3)
    by_time = {4 * (int(t) // 4) + 3 - int(t) % 4: bool(w) for t, w in zip(times, want, strict=True)}
    assert allowed == by_time and cell.value == (start, count) and cell.timers == [int((start + 10) * 1000)]

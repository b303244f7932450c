"""Streams: request counts, ledger arrival, feed upsert, the limiter with state."""

from __future__ import annotations

import math
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from ..operators import limiter, tables
from ..plans import jobs as plans

LATE = "10 minutes"


def request_counts(requests: DataFrame, width: str = "1 hour", late: str = LATE) -> DataFrame:
    """Requests and refusals by window; rows later than ``late`` are dropped."""
    return (
        requests.withWatermark("ts", late)
        .groupBy(F.window("ts", width))
        .agg(F.count("*").alias("requests"), F.count_if(F.col("status") == 429).alias("refused"))
        .select(F.col("window.start").alias("hour"), "requests", "refused")
    )


def append_ledger(arrivals: DataFrame, folder: str, checkpoint: str, buckets: int = tables.BUCKETS):
    """Log requests in the store in ``folder`` as they arrive; bad batches are refused whole.

    A batch reads only the ledger's buckets of its own ids.  One that runs
    again finds its ids logged and adds nothing.
    """

    def each(batch: DataFrame, _: int) -> None:
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        with tables.Store(batch.sparkSession, folder, buckets).change() as change:
            plans.log_suppressions(change, batch, now, once=False)

    return arrivals.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)


def upsert_videos(arrivals: DataFrame, folder: str, checkpoint: str, buckets: int = tables.BUCKETS):
    """Merge each batch into the videos of the store in ``folder``.

    Only the buckets that a changed row falls into are written anew, and a
    batch that runs again changes nothing, whatever the checkpoint counts from.
    """

    def each(batch: DataFrame, _: int) -> None:
        with tables.Store(batch.sparkSession, folder, buckets).change() as change:
            change.upsert("seb.videos", batch, "video_id", "load_seq")

    return arrivals.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)


class Limiter(StatefulProcessor):
    """One window start and count for each caller, until that window has passed.

    A caller's frames are folded one by one, so a caller with any number of
    requests in a batch needs memory for one frame.  A timer at the end of the
    window ends the state: whatever comes later begins a window of its own.
    """

    def __init__(self, window: float, most: int):
        self.window_s, self.most = window, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("window", "start double, count long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        start, count = self.state.get() if self.state.exists() else (None, 0)
        before = start
        for frame in rows:
            frame = frame.sort_values(["t", "event_id"], kind="stable")
            allowed, wait, start, count = limiter.decide(frame["t"].to_numpy(), start, count, self.window_s, self.most)
            yield pd.DataFrame({"event_id": frame["event_id"], "ip": key[0], "allowed": allowed, "retry_after": wait})
        self.state.update((start, count))
        if start != before:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(math.ceil((start + self.window_s) * 1000))

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter([])

    def close(self) -> None:
        pass


#: The state store that timers need.
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def limited_stream(requests: DataFrame, window: float = limiter.WINDOW_S, most: int = limiter.MOST, late: str = LATE) -> DataFrame:
    """The limiter with state for callers whose window is open.

    In a frame (a batch of a caller, or a part of a large one) requests are
    taken in order of time; across frames and batches in order of arrival.  As
    in ``request_counts``, requests later than ``late`` are dropped.  Sets the
    session's state store to the one that keeps timers.
    """
    requests.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    at = F.col("ts").cast("timestamp")
    rows = requests.withColumn("ts", at).withWatermark("ts", late).select("event_id", "ip", "ts", (F.unix_micros("ts") / 1e6).alias("t"))
    return rows.groupBy("ip").transformWithStateInPandas(Limiter(window, most), "event_id long, ip string, allowed boolean, retry_after long", "append", "EventTime")

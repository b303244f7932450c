"""Requests: day-salted callers, rollups, and a fixed-window limiter per caller."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW_S, MOST = 60.0, 100


def decide(times: np.ndarray, start: float | None, count: int, window: float, most: int) -> tuple[np.ndarray, np.ndarray, float | None, int]:
    """allowed, seconds to wait, and the state after requests in order of time.

    A window starts at the caller's first request after the last one ended.
    """
    allowed, wait = np.zeros(len(times), bool), np.zeros(len(times), np.int64)
    i = 0
    while i < len(times):
        if start is None or times[i] - start >= window:
            start, count = float(times[i]), 0
        j = int(np.searchsorted(times, start + window, side="left"))
        ok = max(0, min(most - count, j - i))
        allowed[i : i + ok] = True
        wait[i + ok : j] = np.maximum(1, (window - (times[i + ok : j] - start)).astype(np.int64))
        count, i = count + ok, j
    return allowed, wait, start, count


def limited(requests: DataFrame, key: str = "ip", window: float = WINDOW_S, most: int = MOST) -> DataFrame:
    """event_id, caller, allowed, retry_after of each request.

    A caller's requests are folded in order of time, batch by batch: only the
    window and its count go from one batch to the next, so a caller's history
    needn't fit in memory.
    """
    schema = f"event_id long, {key} string, allowed boolean, retry_after long"

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        caller, start, count = None, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            times = batch.column("t").to_numpy(zero_copy_only=False)
            runs = pc.run_end_encode(batch.column(key))
            parts, at = [], 0
            for who, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist(), strict=True):
                if who != caller:
                    caller, start, count = who, None, 0
                allowed, wait, start, count = decide(times[at:end], start, count, window, most)
                parts.append((allowed, wait))
                at = end
            allowed, wait = (pa.array(np.concatenate(p)) for p in zip(*parts, strict=True))
            yield pa.record_batch([batch.column("event_id"), batch.column(key), allowed, wait], names=["event_id", key, "allowed", "retry_after"])

    rows = requests.select(F.col("event_id").cast("long"), F.col(key).cast("string"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("t"))
    return rows.repartition(key).sortWithinPartitions(key, "t", "event_id").mapInArrow(fold, schema)


def request_rollup(requests: DataFrame) -> DataFrame:
    """By hour: requests, refusals, their callers, server errors."""
    refused = F.col("status") == 429
    return requests.groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(
        F.count("*").alias("requests"),
        F.count_if(refused).alias("refused"),
        F.count_distinct(F.when(refused, F.col("ip"))).alias("refused_callers"),
        F.count_if(F.col("status") >= 500).alias("server_errors"),
    )

"""Keyed merge and unambiguous gap fill."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ledger import latest


def merge(existing: DataFrame, incoming: DataFrame, key: str, order: str, tie: str | None = None) -> DataFrame:
    """Incoming rows replace those of equal key; within a batch the later wins."""
    last = latest(incoming, [key], order, tie or order).select(incoming.columns)
    return existing.join(last.select(key), key, "left_anti").select(existing.columns).unionByName(last)


def fill_video_urls(meetings: DataFrame, videos: DataFrame) -> DataFrame:
    """Meetings without a video take the only one of their day, if there is just one."""
    only = videos.filter("meeting_id IS NULL AND published_date IS NOT NULL").groupBy(F.col("published_date").alias("day"))
    only = only.agg(F.min("video_url").alias("one"), F.max("video_url").alias("other")).filter("one = other").select("day", "one")
    return meetings.join(only, F.col("meeting_date") == F.col("day"), "left").withColumn("video_url", F.coalesce("video_url", "one")).select(meetings.columns)

"""Bounded reads: filters, pages, details, audit trails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from . import contracts

DEFAULT_LIMIT, MOST = 50, 500


def where(df: DataFrame, **equal) -> DataFrame:
    """Filters that are set; the others leave no trace in the plan."""
    for name, value in equal.items():
        if value is not None:
            df = df.filter(F.col(name) == value)
    return df


def page(df: DataFrame, order: list[Column], limit: int = DEFAULT_LIMIT, offset: int = 0) -> DataFrame:
    if not 1 <= limit <= MOST or offset < 0:
        raise ValueError(f"limit 1..{MOST} and offset from 0, not {limit} and {offset}")
    return df.orderBy(*order).offset(offset).limit(limit)


def projected(df: DataFrame, endpoint: str) -> DataFrame:
    """Just the columns that an endpoint shows, in its order; a table that lacks one raises."""
    columns = schemas.PROJECTIONS[endpoint]
    lacking = [c for c in columns if c not in df.columns]
    if lacking:
        raise contracts.ContractError(f"{endpoint} shows {', '.join(lacking)}, which the table lacks")
    return df.select(*columns)


def meeting_videos(videos: DataFrame, meeting_id: int) -> DataFrame:
    """The videos of one meeting as an endpoint shows them: by date, those without a date last."""
    return projected(where(videos, meeting_id=meeting_id).orderBy(F.asc_nulls_last("published_date"), "video_id"), "meeting_videos")


def overlap_page(df: DataFrame, county: str | None = None, year: int | None = None, limit: int = DEFAULT_LIMIT, offset: int = 0) -> DataFrame:
    if year is not None and not 2000 <= year <= 2100 or county is not None and len(county) > 64:
        raise ValueError("year 2000..2100, county of 64 characters at most")
    order = [F.desc("year"), F.desc("quarter"), F.asc_nulls_last("county"), F.asc_nulls_last("compliance_status"), F.asc_nulls_last("voter_status")]
    return page(where(df, county=county, year=year), order, limit, offset)


def meetings_page(df: DataFrame, limit: int = DEFAULT_LIMIT, offset: int = 0) -> DataFrame:
    return page(df, [F.desc("meeting_date"), F.desc("meeting_id")], limit, offset)


def county_page(df: DataFrame, limit: int = DEFAULT_LIMIT, offset: int = 0) -> DataFrame:
    return page(df, [F.asc_nulls_last("county"), F.asc_nulls_last("status")], limit, offset)


def meeting_detail(meetings: DataFrame, videos: DataFrame) -> DataFrame:
    """Meetings with their videos, by date, those without a date last."""
    own = videos.filter("meeting_id IS NOT NULL").groupBy("meeting_id").agg(F.collect_list(F.struct(F.coalesce("published_date", F.lit("9999-12-31").cast("date")).alias("day"), "video_id", "video_url")).alias("v"))
    listed = F.transform(F.sort_array("v"), lambda v: v["video_id"])
    return meetings.join(own, "meeting_id", "left").withColumn("videos", F.coalesce(F.array_join(listed, ","), F.lit(""))).drop("v")


def audit_trail(ledger: DataFrame, meeting_id: int) -> DataFrame:
    return where(ledger, meeting_id=meeting_id).orderBy("corrected_at", "correction_id")

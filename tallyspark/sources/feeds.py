"""Atom feeds, sheets, ledgers and request logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import dates, text
from ..operators import entries
from ..operators.files import Files

ENTRY = "`yt:videoId` string, title string, link struct<_href string>, published timestamp, `media:group` struct<`media:description` string>"
WATCH = "https://www.youtube.com/watch?v="


def feed_rows(entries: DataFrame) -> DataFrame:
    """Entries of a feed as they are read; a missing required element is a violation."""
    c = F.col
    id_, title = F.nullif(c("`yt:videoId`"), F.lit("")), F.nullif(F.trim(c("title")), F.lit(""))
    return entries.select(
        id_.alias("video_id"),
        title.alias("title"),
        F.coalesce(c("link._href"), F.concat(F.lit(WATCH), id_)).alias("video_url"),
        c("published").alias("published_at"),
        F.nullif(F.trim(c("`media:group`.`media:description`")), F.lit("")).alias("description"),
        dates.title_date(title).alias("meeting_date"),
        F.array_compact(F.array(F.when(id_.isNull(), F.lit("video_id")), F.when(title.isNull(), F.lit("title")), F.when(c("published").isNull(), F.lit("published")))).alias("violations"),
    )


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    entries = spark.read.format("xml").option("rowTag", "entry").option("mode", "FAILFAST").schema(ENTRY).load(path)
    return feed_rows(entries)


def video_rows(feed: DataFrame) -> DataFrame:
    """Rows of the videos table: no meeting yet, dated by title, else by upload."""
    day = F.coalesce(F.col("meeting_date"), F.to_date("published_at"))
    return feed.select("video_id", F.lit(None).cast("long").alias("meeting_id"), "video_url", "title", day.alias("published_date"), "description")


def compliance(x: Column) -> Column:
    return F.coalesce(text.blank_to_null(x), F.lit("Unreviewed"))


def meeting_sheet(rows: DataFrame) -> DataFrame:
    """A sheet with ``<c>_text`` and ``<c>_href`` for link cells; rows without a number go."""
    c = F.col
    return rows.filter(text.blank_to_null(c("number")).isNotNull()).select(
        text.whole_number(c("number"), "bigint").alias("meeting_id"),
        dates.loose_date(c("date")).alias("meeting_date"),
        text.day_name(c("day")).alias("day_of_week"),
        text.blank_to_null(c("type")).alias("meeting_type"),
        *(F.trim(F.coalesce(c(raw), F.lit(""))).alias(name) for raw, name in (("format", "meeting_format"), ("chair", "chair"), ("members", "members_present"), ("quorum", "quorum_met"))),
        *(F.nullif(c(raw), F.lit("")).alias(name) for raw, name in (("agenda", "agenda_summary"), ("decisions", "key_decisions"))),
        text.link(c("video_href"), c("video_text")).alias("video_url"),
        text.link(c("source_href"), c("source_text")).alias("source_url"),
        compliance(c("compliance")).alias("compliance_status"),
        *(F.nullif(c(raw), F.lit("")).alias(name) for raw, name in (("notes", "compliance_notes"), ("controversies", "controversies"))),
        text.blank_to_null(c("hours")).try_cast("double").alias("hours_logged"),
    )


def controversy_sheet(rows: DataFrame) -> DataFrame:
    c = F.col
    return rows.filter(text.blank_to_null(c("number")).isNotNull()).select(
        text.whole_number(c("number"), "bigint").alias("controversy_id"),
        F.trim(c("title")).alias("title"),
        dates.loose_date(c("first_seen")).alias("first_seen_date"),
        F.trim(F.coalesce(F.nullif(c("status"), F.lit("")), F.lit("Active"))).alias("status"),
        c("description"),
        c("latest_action"),
        text.link(c("source_href"), c("source_text")).alias("primary_source"),
    )


def source_sheet(rows: DataFrame) -> DataFrame:
    c = F.col
    return rows.filter(text.blank_to_null(c("number")).isNotNull()).select(
        text.whole_number(c("number"), "bigint").alias("source_id"),
        F.trim(c("name")).alias("name"),
        F.trim(F.coalesce(F.nullif(c("type"), F.lit("")), F.lit("Other"))).alias("source_type"),
        F.coalesce(text.link(c("url_href"), c("url_text")), F.lit("")).alias("url"),
        c("notes"),
    )


def workbook_rows(meetings: DataFrame, columns: list[str]) -> DataFrame:
    """Every value as text in a fixed order; nothing is an empty text."""
    return meetings.select(*(F.coalesce(F.col(x).cast("string"), F.lit("")).alias(x) for x in columns))


def read_ledger(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines of a folder with their file and load_seq, the order of files by name and of lines in them; no folder, no rows.

    Lines are numbered split by split (see ``entries.read_lines``), so no task
    needs a whole file.
    """
    if not Files(spark, path).exists(path):
        return spark.createDataFrame([], f"{schema}, source_file string, load_seq string")
    rows = entries.read_lines(spark, path).select(F.from_json("value", schema).alias("row"), "source_file", "load_seq")
    return rows.select("row.*", "source_file", "load_seq")


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.REQUEST).json(path)

"""Derived views: public rows, rollups, small cells, the quarter by county overlap."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .ledger import active_suppressions

SMALL_CELL = 25


def public_voters(voters: DataFrame, suppressions: DataFrame) -> DataFrame:
    return voters.join(active_suppressions(suppressions).select("voter_id"), "voter_id", "left_anti")


def county_summary(public: DataFrame, approximate: bool = False) -> DataFrame:
    zips = F.approx_count_distinct("residence_zip5") if approximate else F.count_distinct("residence_zip5")
    return (
        public.filter("county IS NOT NULL")
        .groupBy("county", "status")
        .agg(F.count("*").alias("voter_count"), zips.alias("distinct_zip5_count"), F.min("birth_year").alias("earliest_birth_year"), F.max("birth_year").alias("latest_birth_year"))
    )


def suppress_small(df: DataFrame, keys: list[str], least: int = SMALL_CELL) -> DataFrame:
    """Counts by cell; a small count is hidden, its row stays."""
    n = F.col("n")
    return df.groupBy(*keys).agg(F.count("*").alias("n")).select(*keys, F.when(n >= least, n).alias("voter_count"), (n < least).alias("suppressed_for_size"))


def precinct_summary(public: DataFrame) -> DataFrame:
    return suppress_small(public.filter("precinct IS NOT NULL"), ["county", "precinct", "status"])


def contested(x: Column) -> Column:
    return x.isNotNull() & ~F.trim(x).isin("", "None")


def meeting_quarter(meetings: DataFrame) -> DataFrame:
    day = F.col("meeting_date")
    return meetings.groupBy(F.year(day).alias("year"), F.quarter(day).alias("quarter"), "compliance_status").agg(
        F.count("*").alias("meeting_count"),
        F.count_if(F.col("quorum_met") == "Yes").alias("quorum_met_count"),
        F.count_if(contested(F.col("controversies"))).alias("controversy_meeting_count"),
    )


OVERLAP = "year quarter county voter_status voter_count distinct_zip5_count compliance_status meeting_count quorum_met_count controversy_meeting_count".split()


def overlap(meetings: DataFrame, voters: DataFrame, suppressions: DataFrame) -> DataFrame:
    """Every quarter rollup beside every county rollup: two small aggregates.

    Both sides are aggregated first; the county side has a row for each county
    and status only, whatever the number of people.
    """
    people = county_summary(public_voters(voters, suppressions)).select("county", F.col("status").alias("voter_status"), "voter_count", "distinct_zip5_count")
    return meeting_quarter(meetings).crossJoin(people).select(*OVERLAP)


#: Views that read those of several pipelines.
ACROSS = "analytics."


def register(spark: SparkSession, builders: dict[str, Callable[[], DataFrame]]) -> list[str]:
    """Temporary views in order of name, those across pipelines last; dots become underscores.

    Registering again replaces them.  Returns the names in their order.
    """
    order = sorted(builders, key=lambda name: (name.startswith(ACROSS), name))
    for name in order:
        builders[name]().createOrReplaceTempView(name.replace(".", "_"))
    return order

"""Contracts: which headers may be read, which rows are good, what may be published."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas


class ContractError(ValueError):
    """A source or a publication breaks its contract."""


def header(name: str) -> str:
    """``Ward city-council`` as ``ward_city_council``."""
    return re.sub(r"\s+", "_", name.lower().replace("-", " ").strip())


def refuse(columns: Iterable[str], names: Iterable[str], kind: str) -> None:
    found = sorted({header(c) for c in columns} & set(names))
    if found:
        raise ContractError(f"{kind} columns: {', '.join(found)}")


def check_headers(columns: list[str], licensed: bool = False) -> None:
    """Refuse confidential, then licensed headers.  No job runs."""
    if not columns:
        raise ContractError("no header")
    refuse(columns, schemas.CONFIDENTIAL, "confidential")
    if licensed:
        refuse(columns, schemas.LICENSED, "licensed")


def mapped(df: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """Only mapped columns under their field names; a field without one is null."""
    by_header = {header(c): c for c in df.columns}
    return df.select(*((F.col(f"`{by_header[h]}`") if h in by_header else F.lit(None).cast("string")).alias(f) for h, f in fields.items()))


def violations(rules: Mapping[str, Column]) -> Column:
    """The names of the rules a row breaks; a rule that is null isn't broken."""
    return F.array_compact(F.array(*(F.when(bad, F.lit(name)) for name, bad in rules.items())))


def checked(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    return df.withColumn("violations", violations(rules))


def split_valid(df: DataFrame, rules: Mapping[str, Column], strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad ones with their violations; strict: any bad row raises."""
    rows = checked(df, rules)
    good, bad = rows.filter(F.size("violations") == 0).drop("violations"), rows.filter(F.size("violations") > 0)
    if strict and (first := bad.limit(1).collect()):
        raise ContractError(f"row breaks {', '.join(first[0].violations)}: {first[0].asDict()}")
    return good, bad


def voter_rules() -> dict[str, Column]:
    c = F.col
    return {
        "voter_id": c("voter_id").isNull(),
        "first_name": c("first_name").isNull(),
        "last_name": c("last_name").isNull(),
        "birth_year": ~c("birth_year").between(1900, 2100),
        "zip5": ~c("residence_zip5").rlike(r"^\d{5}$"),
        "status": F.coalesce(~c("status").isin(*schemas.VOTER_STATUSES), F.lit(True)),
    }


def meeting_rules() -> dict[str, Column]:
    c = F.col
    return {
        "meeting_id": c("meeting_id").isNull(),
        "meeting_date": c("meeting_date").isNull(),
        "meeting_type": F.coalesce(~c("meeting_type").isin(*schemas.MEETING_TYPES), F.lit(True)),
        "compliance_status": F.coalesce(~c("compliance_status").isin(*schemas.COMPLIANCE), F.lit(True)),
        "hours_logged": ~c("hours_logged").between(0, 24),
        "video_url": ~c("video_url").rlike("^https?://"),
    }


def sheet_rules() -> dict[str, Column]:
    """``meeting_rules`` and those of a row that comes from a sheet."""
    c = F.col
    required = ("day_of_week", "meeting_format", "chair", "members_present", "quorum_met")
    return meeting_rules() | {name: c(name).isNull() for name in required} | {"day_of_week_length": F.length("day_of_week") > 3, "source_url": ~c("source_url").rlike("^https?://")}


def given_as(rules: dict[str, Column], raw: str, parsed: str) -> dict[str, Column]:
    """The rules, and one that refuses a given value that could not be read as its type."""
    given = F.nullif(F.trim(F.col(raw).cast("string")), F.lit(""))
    return rules | {parsed: given.isNotNull() & F.col(parsed).isNull()}


def table_rules(table: str, columns: Iterable[str]) -> dict[str, Column]:
    """What a stored table must satisfy whoever wrote it: a second layer under the row rules.

    A table that isn't known raises.  Of the required columns those that are
    there are checked, as a source may hold only some.
    """
    if table not in schemas.REQUIRED:
        raise ContractError(f"no table is called {table}")
    c = F.col
    checks = {
        "seb.meetings": {"hours_logged": ~c("hours_logged").between(0, 24)},
        "seb.meeting_corrections": {"target_column": ~c("target_column").isin(*schemas.OVERRIDABLE)},
        "voter.voters": {"birth_year": ~c("birth_year").between(1900, 2100), "residence_zip5": F.length("residence_zip5") != 5},
        "voter.suppressions": {"action": ~c("action").isin(*schemas.ACTIONS)},
    }.get(table, {})
    names = {"residence_zip5": "zip5"}
    there = set(columns)
    rules = {column: c(column).isNull() for column in schemas.REQUIRED[table] if column in there}
    for column, bad in checks.items():
        if column in there:
            rules[column] = rules[column] | F.coalesce(bad, F.lit(False)) if column in rules else bad
    return {names.get(k, k): v for k, v in rules.items()}


def check_table(df: DataFrame, table: str, key: str) -> DataFrame:
    """Rows of a stored table that break its rules, with ``violations``; a key that is null or repeats is one."""
    refuse(df.columns, schemas.CONFIDENTIAL, "confidential")
    rows = checked(df, {"key": F.col(key).isNull(), **table_rules(table, df.columns)})
    twice = repeated(df.filter(F.col(key).isNotNull()), key).select(key, F.lit(True).alias("_twice"))
    rows = rows.join(twice, key, "left").withColumn("violations", F.concat("violations", F.when(F.col("_twice"), F.array(F.lit("repeated"))).otherwise(F.array().cast("array<string>")))).drop("_twice")
    return rows.filter(F.size("violations") > 0)


def correction_rules() -> dict[str, Column]:
    c = F.col
    blank = lambda x: F.coalesce(F.trim(x) == "", F.lit(True))
    return {
        "id": blank(c("correction_id")),
        "meeting_id": c("meeting_id").isNull(),
        "column": F.coalesce(~c("target_column").isin(*schemas.OVERRIDABLE), F.lit(True)),
        "reason": blank(c("reason")),
        "corrected_by": blank(c("corrected_by")),
    }


def suppression_rules() -> dict[str, Column]:
    c = F.col
    blank = lambda x: F.coalesce(F.trim(x) == "", F.lit(True))
    return {
        "id": blank(c("suppression_id")),
        "voter_id": c("voter_id").isNull(),
        "action": F.coalesce(~c("action").isin(*schemas.ACTIONS), F.lit(True)),
        "reason": blank(c("reason")),
        "requested_by": blank(c("requested_by")),
        "supersedes": (c("action") == "unsuppress") & c("supersedes").isNull(),
    }


def repeated(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their number."""
    return df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def any_repeated(df: DataFrame, key: str) -> bool:
    """Whether a key occurs more than once: hashes are sent first, keys only if two hashes are equal."""
    hashes = df.groupBy(F.xxhash64(key).alias("h")).agg(F.count("*").alias("n")).filter("n > 1")
    return bool(hashes.limit(1).collect()) and bool(repeated(df, key).limit(1).collect())


def publishable(name: str) -> str:
    if name not in schemas.PUBLIC:
        raise ContractError(f"{name} is {'never published' if name in schemas.DENIED else 'not on the list'}")
    return name


def no_personal_columns(df: DataFrame) -> DataFrame:
    refuse(df.columns, schemas.PERSONAL, "per-person")
    return df

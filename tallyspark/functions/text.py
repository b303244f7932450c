"""Text columns: white space, title case, numbers, codes, hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(x: Column) -> Column:
    """Trimmed of spaces; nothing left is null."""
    return F.nullif(F.trim(x), F.lit(""))


def squeeze(x: Column) -> Column:
    """Runs of any white space become one space; nothing left is null."""
    return blank_to_null(F.regexp_replace(x, r"(?U)\s+", " "))


def title_case(x: Column) -> Column:
    """Every run of letters starts with a capital: stand-in, o'brien, 3rd."""
    runs = F.regexp_extract_all(x, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 1 << 20)))), "")


def whole_number(x: Column, kind: str = "int") -> Column:
    """The number in a text; null for blank or anything else."""
    return blank_to_null(x).try_cast(kind)


def not_a(x: Column, parsed: Column) -> Column:
    """True where something was given that could not be parsed."""
    return blank_to_null(x).isNotNull() & parsed.isNull()


def zip5(x: Column) -> Column:
    """Left-padded with zeros to five; longer values stay, for a rule to refuse."""
    t = blank_to_null(x)
    return F.when(F.length(t) < 5, F.lpad(t, 5, "0")).otherwise(t)


def looked_up(x: Column, values: dict[str, str]) -> Column:
    """The value of a small fixed table; null for an unknown key."""
    pairs = [F.lit(v) for item in values.items() for v in item]
    return F.element_at(F.create_map(*pairs), x)


def vendor_id(x: Column) -> Column:
    """Digits, or TS and digits in any case."""
    return F.nullif(F.regexp_extract(F.trim(x), r"^(?i:TS)?(\d+)$", 1), F.lit("")).try_cast("bigint")


def day_salted_hash(ip: Column, ts: Column, base: str) -> Column:
    """16 hex digits that name an address for one day only."""
    salted = F.concat(F.lit(f"{base}:"), F.date_format(ts, "yyyy-MM-dd"), F.lit("|"), ip)
    return F.left(F.sha2(salted, 256), F.lit(16))


def link(href: Column, text: Column) -> Column:
    """The link behind a cell, or its text where that is a web address itself."""
    return F.coalesce(F.nullif(href, F.lit("")), F.when(F.trim(text).rlike("^https?://"), F.trim(text)))


def day_name(x: Column) -> Column:
    return F.left(F.trim(F.coalesce(x, F.lit(""))), F.lit(3))

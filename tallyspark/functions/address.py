"""Street addresses: one line from parts, and parts from one line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import looked_up, squeeze, title_case

# Street suffixes and their canonical forms.
SUFFIXES = {
    "ST": "St",
    "STREET": "St",
    "AVE": "Ave",
    "AVENUE": "Ave",
    "BLVD": "Blvd",
    "BOULEVARD": "Blvd",
    "RD": "Rd",
    "ROAD": "Rd",
    "DR": "Dr",
    "DRIVE": "Dr",
    "LN": "Ln",
    "LANE": "Ln",
    "WAY": "Way",
    "CT": "Ct",
    "COURT": "Ct",
    "CIR": "Cir",
    "CIRCLE": "Cir",
    "PKWY": "Pkwy",
    "PARKWAY": "Pkwy",
    "PL": "Pl",
    "PLACE": "Pl",
    "TER": "Ter",
    "TERRACE": "Ter",
    "HWY": "Hwy",
    "HIGHWAY": "Hwy",
}
STATE = "GA"


def city(x: Column) -> Column:
    return title_case(squeeze(x))


def street_suffix(x: Column) -> Column:
    """The canonical suffix; an unknown one in title case."""
    key = F.regexp_replace(F.upper(squeeze(x)), r"\.+$", "")
    return F.coalesce(looked_up(key, SUFFIXES), title_case(F.nullif(key, F.lit(""))))


def street_with_suffix(name: Column, suffix: Column) -> Column:
    return F.nullif(F.concat_ws(" ", name, suffix), F.lit(""))


def split_first_line(line: Column) -> tuple[Column, Column]:
    """House number and street of a vendor's address line."""
    t = F.nullif(F.trim(line), F.lit(""))
    house = F.nullif(F.regexp_extract(t, r"^(\d+)\s+(.+)$", 1), F.lit(""))
    return house, F.when(house.isNotNull(), F.regexp_extract(t, r"^(\d+)\s+(.+)$", 2)).otherwise(t)


def house_without_street(house: Column, street: Column) -> Column:
    return house.isNotNull() & street.isNull()


def compose(house: Column, street: Column, suffix: Column, apartment: Column, city_: Column, zip_: Column) -> Column:
    """``<house> <street> <suffix>, <apartment>, <city>, GA <zip>`` of what is there."""
    first = F.nullif(F.concat_ws(" ", squeeze(house), squeeze(street), street_suffix(suffix)), F.lit(""))
    end = F.when(squeeze(zip_).isNotNull(), F.concat(F.lit(f"{STATE} "), squeeze(zip_)))
    return F.concat_ws(", ", first, squeeze(apartment), city(city_), end)


def split(df: DataFrame, line: str) -> DataFrame:
    """``df`` with a column ``parts``: the struct that ``compose`` would make ``line`` of.

    Step by step, so that each part is worked out once.
    """
    last = lambda x: F.try_element_at(x, F.lit(-1))
    but_last = lambda x: F.slice(x, F.lit(1), F.greatest(F.size(x) - 1, F.lit(0)))
    c = F.col
    rows = df.withColumn("_s", F.filter(F.transform(F.split(c(line), ","), lambda s: F.trim(s)), lambda s: s != ""))
    rows = rows.withColumn("_zip", F.nullif(F.regexp_extract(F.coalesce(last(c("_s")), F.lit("")), rf"^{STATE} (\S+)$", 1), F.lit("")))
    rows = rows.withColumn("_s", F.when(c("_zip").isNotNull(), but_last(c("_s"))).otherwise(c("_s")))
    is_city = (F.size("_s") > 0) & ~last(c("_s")).rlike(r"\d") & ((F.size("_s") > 1) | c("_zip").isNotNull())
    rows = rows.withColumn("_city", F.when(is_city, last(c("_s"))))
    rows = rows.withColumn("_s", F.when(c("_city").isNotNull(), but_last(c("_s"))).otherwise(c("_s")))
    rows = rows.withColumns({"_apartment": F.when(F.size("_s") >= 2, last(c("_s"))), "_w": F.filter(F.split(F.coalesce(F.try_element_at("_s", F.lit(1)), F.lit("")), r"\s+"), lambda w: w != "")})
    rows = rows.withColumn("_house", F.when(F.try_element_at("_w", F.lit(1)).rlike(r"^\d+$"), F.try_element_at("_w", F.lit(1))))
    rows = rows.withColumn("_w", F.when(c("_house").isNotNull(), F.slice("_w", F.lit(2), F.greatest(F.size("_w") - 1, F.lit(0)))).otherwise(c("_w")))
    rows = rows.withColumn("_suffix", looked_up(F.upper(F.regexp_replace(F.coalesce(last(c("_w")), F.lit("")), r"\.+$", "")), SUFFIXES))
    rows = rows.withColumn("_w", F.when(c("_suffix").isNotNull(), but_last(c("_w"))).otherwise(c("_w")))
    parts = {"house_number": c("_house"), "street_name": F.nullif(F.array_join("_w", " "), F.lit("")), "street_suffix": c("_suffix"), "apartment": c("_apartment"), "city": c("_city"), "zip5": c("_zip")}
    return rows.withColumn("parts", F.struct(*(v.alias(k) for k, v in parts.items()))).select(*df.columns, "parts")

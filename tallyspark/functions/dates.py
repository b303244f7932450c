"""Date columns in the shapes that sources use."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_to_null, looked_up

# Month names that titles use, longest first.
MONTHS = "January February March April May June July August September October November December Sept Jan Feb Mar Apr Jun Jul Aug Sep Oct Nov Dec".split()
LONG_TITLE = rf"(?i)({'|'.join(MONTHS)})\s+(\d{{1,2}}),?\s+(\d{{4}})"
SHORT_TITLE = r"\b(\d{2})\.(\d{2})\.(\d{2})\b"
# The first three letters of a month's name and its number.
MONTH_NUMBERS = {
    "jan": "1",
    "feb": "2",
    "mar": "3",
    "apr": "4",
    "may": "5",
    "jun": "6",
    "jul": "7",
    "aug": "8",
    "sep": "9",
    "oct": "10",
    "nov": "11",
    "dec": "12",
}
FILE_DATES = {"yyyyMMdd": r"^\d{8}$", "M/d/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}$", "yyyy-MM-dd": r"^\d{4}-\d{1,2}-\d{1,2}$"}


def first_of(*dates: Column) -> Column:
    return reduce(lambda a, b: F.coalesce(a, b), dates)


def file_date(x: Column) -> Column:
    """``20240131``, ``1/31/2024`` or ``2024-01-31``; else null."""
    t = blank_to_null(x)
    loose = {"yyyy-MM-dd": "yyyy-M-d"}
    return first_of(*(F.when(t.rlike(shape), F.try_to_date(t, loose.get(form, form))) for form, shape in FILE_DATES.items()))


def title_date(title: Column) -> Column:
    """The first date of a title that is one: month name, else MM.DD.YY."""

    def of(pattern: str, month, day: int, year) -> Column:
        part = lambda k: F.regexp_extract(title, pattern, k)
        return F.try_to_date(F.concat_ws("-", year(part), month(part), part(day)), "yyyy-M-d")

    def number(part) -> Column:
        return looked_up(F.lower(F.left(part(1), F.lit(3))), MONTH_NUMBERS)

    long = F.when(title.rlike(LONG_TITLE), of(LONG_TITLE, number, 2, lambda part: part(3)))
    short = F.when(title.rlike(SHORT_TITLE), of(SHORT_TITLE, lambda part: part(1).cast("string"), 2, lambda part: F.concat(F.lit("20"), part(3))))
    return F.coalesce(long, short)


def loose_date(x: Column) -> Column:
    """A day, or a month that stands for its first day; else null."""
    t = F.trim(x)
    day = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(t, "yyyy-MM-dd"))
    month = F.when(t.rlike(r"^\d{4}-\d{2}$"), F.try_to_date(F.concat(t, F.lit("-01")), "yyyy-MM-dd"))
    return F.coalesce(day, month)


ISO_TIME = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?$"


def iso_time(x: Column) -> Column:
    """An ISO day or time, with an offset or without; else null."""
    t = F.regexp_replace(F.regexp_replace(F.trim(x), ",", "."), r"([+-]\d{2})(\d{2})$", "$1:$2")
    # A day ends in such digits too.
    day = F.trim(x).rlike(r"^\d{4}-\d{2}-\d{2}$")
    return F.when(F.trim(x).rlike(ISO_TIME), F.when(day, F.trim(x)).otherwise(t).try_cast("timestamp"))

"""Registry and vendor CSV files: all-string scan, header contract, typed rows."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import address, dates, text
from ..operators import contracts

CORRUPT = "_corrupt"


def headers(spark: SparkSession, path: str) -> dict[str, tuple[str, ...]]:
    """The header of each file of a file, folder or pattern; one line a file is read."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(conf)
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    left, found = list(fs.globStatus(where) or ()), {}
    while left:
        entry = left.pop()
        at = entry.getPath()
        if at.getName().startswith(("_", ".")):
            continue
        if entry.isDirectory():
            left += fs.listStatus(at)
            continue
        stream, codec = fs.open(at), codecs.getCodec(at)
        try:
            lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
            found[at.toString()] = tuple(next(csv.reader([(lines.readLine() or "").removeprefix("\ufeff")]), ()))
        finally:
            stream.close()
    return found


def read_csv(spark: SparkSession, path: str, licensed: bool = False) -> DataFrame:
    """All columns as strings under the names of their own file's header, and the ragged lines.

    The header of every file is checked first, so a refused column in any of
    them stops the job before a row is read.  Files of different headers are
    read apart and put together by name; a column that a file lacks is null in
    its rows.  Parsing all columns keeps ragged lines apart whatever is
    selected later.
    """
    files: dict[tuple[str, ...], list[str]] = {}
    for name, columns in sorted(headers(spark, path).items()):
        contracts.check_headers(list(columns), licensed)
        files.setdefault(columns, []).append(name)
    contracts.check_headers([c for columns in files for c in columns], licensed)
    parts = []
    for columns, names in files.items():
        # Of columns of one name the last counts.
        last = {contracts.header(c): f"c{i}" for i, c in enumerate(columns)}
        schema = T.StructType([*(T.StructField(f"c{i}", T.StringType()) for i in range(len(columns))), T.StructField(CORRUPT, T.StringType())])
        rows = spark.read.schema(schema).option("header", True).option("escape", '"').option("columnPruning", False).option("columnNameOfCorruptRecord", CORRUPT).csv(names)
        parts.append(rows.select(*(F.col(c).alias(h) for h, c in last.items()), CORRUPT))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _strings(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    rows = contracts.mapped(df, {**fields, CORRUPT: CORRUPT} if CORRUPT in df.columns else fields)
    return rows.select(*(text.blank_to_null(F.col(c)).alias(c) for c in rows.columns))


def _as_voters(rows: DataFrame, columns: dict[str, Column], bad: dict[str, Column]) -> DataFrame:
    """Typed voter rows with ``violations``: of coercion, of the model, of the line."""
    given = {**{c: F.lit(None).cast("string") for c in schemas.VOTER_COLUMNS}, **columns}
    line = {"ragged": F.col(CORRUPT).isNotNull()} if CORRUPT in rows.columns else {}
    typed = rows.withColumn("_coerced", contracts.violations({**bad, **line})).select(*(given[c].alias(c) for c in schemas.VOTER_COLUMNS), "_coerced")
    return contracts.checked(typed, contracts.voter_rules()).withColumn("violations", F.concat("_coerced", "violations")).drop("_coerced")


def registry_rows(df: DataFrame) -> DataFrame:
    rows = _strings(df, schemas.REGISTRY_FIELDS)
    c = F.col
    status = F.when(c("status_code").isNull(), "Active").otherwise(text.looked_up(c("status_code"), schemas.STATUS_CODES))
    voter_id, year = text.whole_number(c("voter_id"), "bigint"), text.whole_number(c("birth_year"))
    registered, voted = dates.file_date(c("registration_date")), dates.file_date(c("last_voted_date"))
    same = {k: c(k) for k in ("first_name", "middle_name", "last_name", "name_suffix", "residence_house_number", "residence_apartment", "residence_city", "race", "gender", "precinct")}
    columns = same | {
        "voter_id": voter_id,
        "birth_year": year,
        "residence_zip5": text.zip5(c("residence_zip5")),
        "residence_street_name": address.street_with_suffix(c("residence_street_name"), c("street_suffix")),
        "registration_date": registered,
        "last_voted_date": voted,
        "status": status,
        "county": text.looked_up(c("county_code"), schemas.COUNTY_CODES),
    }
    bad = {
        "voter_id_number": text.not_a(c("voter_id"), voter_id),
        "birth_year_number": text.not_a(c("birth_year"), year),
        "registration_date": text.not_a(c("registration_date"), registered),
        "last_voted_date": text.not_a(c("last_voted_date"), voted),
        "status_code": c("status_code").isNotNull() & status.isNull(),
    }
    return _as_voters(rows, columns, bad)


def vendor_rows(df: DataFrame) -> DataFrame:
    rows = _strings(df, schemas.VENDOR_FIELDS)
    c = F.col
    status = F.when(c("status_label").isNull(), "Active").otherwise(text.looked_up(F.upper(c("status_label")), schemas.STATUS_LABELS))
    voter_id = text.vendor_id(c("vendor_id"))
    house, street = address.split_first_line(c("address_line"))
    columns = {k: c(k) for k in ("first_name", "middle_name", "last_name", "residence_apartment", "residence_city", "precinct")} | {
        "voter_id": voter_id,
        "birth_year": F.lit(None).cast("int"),
        "residence_house_number": house,
        "residence_street_name": street,
        "residence_zip5": text.zip5(c("residence_zip5")),
        "status": status,
        "county": text.title_case(c("county")),
        "registration_date": F.lit(None).cast("date"),
        "last_voted_date": F.lit(None).cast("date"),
    }
    return _as_voters(rows, columns, {"vendor_id": c("vendor_id").isNotNull() & voter_id.isNull(), "status_label": c("status_label").isNotNull() & status.isNull()})


def load(spark: SparkSession, path: str, vendor: bool = False, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Good voter rows and quarantined ones of a file or folder."""
    df = read_csv(spark, path, licensed=vendor)
    rows = vendor_rows(df) if vendor else registry_rows(df)
    good, bad = rows.filter(F.size("violations") == 0).drop("violations"), rows.filter(F.size("violations") > 0)
    if strict and (first := bad.limit(1).collect()):
        raise contracts.ContractError(f"row breaks {', '.join(first[0].violations)}: {first[0].asDict()}")
    return good, bad

"""Ledger files entry by entry: JSON as people wrote it, typed, with every rule an entry breaks.

An entry is kept as read (a variant) until its rules are checked, as a number
in quotes or a flag in place of an id would pass once it is cast.  The first
entry of an id, by file name and place, keeps the id; each later one is named
with the place of the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import dates
from . import contracts

CORRECTION_KEYS = ("id", "meeting_id", "column", "reason", "corrected_by")
SUPPRESSION_KEYS = ("id", "voter_id", "action", "reason", "requested_by")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """value, source_file and load_seq of every line below ``path`` that isn't blank, in the order of files and lines.

    A line's number is that of its split's first line plus its place: splits
    are counted first, so no task needs a whole file.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    # A task reads blocks of a file in order; its rows of one block lie behind one another.
    first = lines.groupBy("source_file", "block").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    later = first.select("source_file", F.col("block").alias("before"), F.col("n").alias("n_before"))
    starts = first.join(later, "source_file").filter("before <= block").groupBy("source_file", "block", "first").agg(F.sum(F.when(F.col("before") < F.col("block"), F.col("n_before")).otherwise(0)).alias("start"))
    # One row a block.
    placed = lines.join(F.broadcast(starts), ["source_file", "block"]).withColumn("line", F.col("start") + F.col("row") - F.col("first"))
    return placed.filter(F.trim("value") != "").select("value", "source_file", F.concat("source_file", F.lit("#"), F.lpad((F.col("line") + 1).cast("string"), 10, "0")).alias("load_seq"))


def _parsed(lines: DataFrame) -> DataFrame:
    return lines.withColumn("entry", F.try_parse_json("value"))


def _kind(path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get("entry", f"$.{path}", "variant"))


def _text(path: str) -> Column:
    return F.trim(F.try_variant_get("entry", f"$.{path}", "string"))


def _absent(path: str) -> Column:
    """The key is missing or null."""
    return F.coalesce(_kind(path), F.lit("VOID")) == "VOID"


def _given(rules: dict[str, Column]) -> Column:
    return contracts.violations(rules)


def with_repeats(rows: DataFrame, key: str) -> DataFrame:
    """Adds to ``violations`` what ids repeat, and where the first of each stands in ``first_place``.

    ``repeated_in_file`` if the file has an earlier entry of the id, else
    ``repeated_across_files``.  Ids are summed up by file before they meet, and
    only those with a second entry go on, so an id of any number of entries is
    a few rows.
    """
    place = F.struct("source_file", "load_seq")
    by_file = rows.filter(F.col(key) != "").groupBy(key, "source_file").agg(F.count("*").alias("n"), F.min("load_seq").alias("first_in_file"))
    firsts = by_file.groupBy(key).agg(F.sum("n").alias("n"), F.min(F.struct("source_file", F.col("first_in_file").alias("load_seq"))).alias("first")).filter("n > 1").drop("n")
    marked = rows.join(by_file.drop("n").join(firsts, key), [key, "source_file"], "left")
    later = F.col("first").isNotNull() & (place > F.col("first"))
    fault = F.when(later & (F.col("load_seq") > F.col("first_in_file")), "repeated_in_file").when(later, "repeated_across_files")
    return marked.select(*rows.columns, F.when(later, F.col("first.load_seq")).alias("first_place"), fault.alias("_fault")).withColumn("violations", F.array_compact(F.concat("violations", F.array("_fault")))).drop("_fault")


def correction_entries(lines: DataFrame) -> DataFrame:
    """Corrections as rows, ``violations`` and ``first_place``; ``lines`` has value, source_file and load_seq."""
    rows = _parsed(lines)
    whole = F.try_variant_get("entry", "$.meeting_id", "bigint")
    said = _text("corrected_at")
    rules = {"not_a_mapping": ~F.coalesce(F.schema_of_variant("entry").startswith("OBJECT"), F.lit(False))}
    mapping = ~rules["not_a_mapping"]
    rules |= {f"missing_{k}": mapping & _absent(k) for k in CORRECTION_KEYS}
    rules |= {
        "id": _text("id") == "",
        "meeting_id": ~_absent("meeting_id") & whole.isNull(),
        "column": ~_text("column").isin(*schemas.OVERRIDABLE),
        "reason": _text("reason") == "",
        "corrected_by": _text("corrected_by") == "",
        "corrected_at": ~_absent("corrected_at") & ((_kind("corrected_at") != "STRING") | dates.iso_time(said).isNull()),
    }
    out = rows.select(
        F.coalesce(_text("id"), F.lit("")).alias("correction_id"),
        whole.alias("meeting_id"),
        _text("column").alias("target_column"),
        F.try_variant_get("entry", "$.new_value", "string").alias("corrected_value"),
        _text("reason").alias("reason"),
        _text("evidence_url").alias("evidence_url"),
        _text("corrected_by").alias("corrected_by"),
        dates.iso_time(said).alias("corrected_at"),
        "source_file",
        "load_seq",
        _given(rules).alias("violations"),
    )
    return with_repeats(out, "correction_id")


def suppression_entries(lines: DataFrame) -> DataFrame:
    """Suppressions as rows, ``violations`` and ``first_place``; a voter_id must be a whole number, not one in quotes."""
    rows = _parsed(lines)
    said = _text("requested_at")
    rules = {"not_a_mapping": ~F.coalesce(F.schema_of_variant("entry").startswith("OBJECT"), F.lit(False))}
    mapping = ~rules["not_a_mapping"]
    rules |= {f"missing_{k}": mapping & _absent(k) for k in SUPPRESSION_KEYS}
    rules |= {
        "id": _text("id") == "",
        "voter_id": ~_absent("voter_id") & (_kind("voter_id") != "BIGINT"),
        "action": ~_text("action").isin(*schemas.ACTIONS),
        "reason": _text("reason") == "",
        "requested_by": _text("requested_by") == "",
        "supersedes": (_text("action") == "unsuppress") & (F.coalesce(_text("supersedes"), F.lit("")) == ""),
        "requested_at": ~_absent("requested_at") & ((_kind("requested_at") != "STRING") | dates.iso_time(said).isNull()),
    }
    out = rows.select(
        F.coalesce(_text("id"), F.lit("")).alias("suppression_id"),
        F.when(_kind("voter_id") == "BIGINT", F.try_variant_get("entry", "$.voter_id", "bigint")).alias("voter_id"),
        _text("action").alias("action"),
        _text("reason").alias("reason"),
        _text("requested_by").alias("requested_by"),
        F.nullif(_text("supersedes"), F.lit("")).alias("supersedes"),
        dates.iso_time(said).alias("requested_at"),
        "source_file",
        "load_seq",
        _given(rules).alias("violations"),
    )
    return with_repeats(out, "suppression_id")


def strict(entries: DataFrame, key: str) -> DataFrame:
    """The entries as they go into a ledger; the first broken one in order of entry raises with all it breaks."""
    worst = entries.filter(F.size("violations") > 0).orderBy("source_file", "load_seq").limit(1).collect()
    if worst:
        r = worst[0]
        first = f", first at {r.first_place}" if r.first_place else ""
        raise contracts.ContractError(f"{r.load_seq}: entry {r[key]!r} breaks {', '.join(r.violations)}{first}")
    return entries.drop("violations", "first_place")

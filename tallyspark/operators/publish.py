"""Bulk export of allow-listed relations with a manifest; freshness of tables."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping
from datetime import datetime

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import EXPORTED
from .contracts import no_personal_columns, publishable


#: Rows of a part file at most: far below the 2 GB that the digests of ``manifest`` can read.
PART_ROWS = 2_000_000


def export(relations: Mapping[str, DataFrame], folder: str, part_rows: int = PART_ROWS) -> None:
    """CSV with header and Parquet of each exported relation, in part files of at most ``part_rows`` rows."""
    for name in EXPORTED:
        publishable(name)
    for name, stem in EXPORTED.items():
        df = relations[name] if name == "seb.meetings" else no_personal_columns(relations[name])
        df.write.mode("overwrite").option("maxRecordsPerFile", part_rows).option("header", True).csv(f"{folder}/{stem}.csv")
        df.write.mode("overwrite").option("maxRecordsPerFile", part_rows).parquet(f"{folder}/{stem}.parquet")


#: Bytes of a file that is read at once; larger ones are read in pieces.
WHOLE = 512 << 20
PIECE = 8 << 20


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for path in batch.column("path").to_pylist():
            source, name = FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
            digest = hashlib.sha256()
            with source.open_input_stream(name) as stream:
                while piece := stream.read(PIECE):
                    digest.update(piece)
            found.append(digest.hexdigest())
        yield pa.record_batch([batch.column("path"), batch.column("length"), pa.array(found, pa.string())], names=["path", "length", "sha256"])


def file_digests(spark: SparkSession, folder: str, whole: int = WHOLE) -> DataFrame:
    """path, length, sha256 of every part file below ``folder``, of any size.

    Files of up to ``whole`` bytes are read by Spark; larger ones by the tasks,
    piece by piece, from a store that Arrow opens too (local, HDFS, S3, GCS).
    Files without bytes are left out, as Spark lists none.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(folder)
    small = files.filter(F.col("length") <= whole).select("path", "length", F.sha2("content", 256).alias("sha256"))
    large = files.filter(F.col("length") > whole).select("path", "length")
    return small.unionByName(large.mapInArrow(_digests, "path string, length long, sha256 string"))


def manifest(spark: SparkSession, folder: str, generated_at: datetime | None = None, built_at: datetime | None = None, whole: int = WHOLE) -> DataFrame:
    """filename, bytes, sha256 of every part file below ``folder``, when the manifest and the tables were made."""
    name = F.regexp_extract("path", r"([^/]+/[^/]+)$", 1).alias("filename")
    return file_digests(spark, folder, whole).select(name, F.col("length").alias("bytes"), "sha256", F.coalesce(F.lit(generated_at).cast("timestamp"), F.current_timestamp()).alias("generated_at"), F.lit(built_at).cast("timestamp").alias("built_at"))


def freshness(spark: SparkSession, path: str) -> DataFrame:
    """When the newest file of a table was written; a missing table raises."""
    return spark.read.parquet(path).agg(F.max("_metadata.file_modification_time").alias("built_at"))

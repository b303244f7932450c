"""Helpers that several operators use: tables, the shared folder, Arrow text."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that ``frequent`` samples, and how often it must meet a value.
SAMPLE, OFTEN = 1_000_000, 32

_own_folder: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the session has none and all tasks run on this machine (tests), a
    temporary folder is used, which goes when the driver ends; on a cluster the
    setting must be there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="tallyspark-"))
        atexit.register(shutil.rmtree, _own_folder[0], ignore_errors=True)
    return f"file://{_own_folder[0]}"


#: The stored tables of each ``scratch`` around; every thread has its own.
_scratch: ContextVar[tuple[list[DataFrame], ...]] = ContextVar("scratch", default=())


#: Tables outside every ``scratch``: results may read them as long as the driver runs.
_left: list[DataFrame] = []


@atexit.register
def _clear() -> None:
    for df in _left:
        # A session that has ended can delete nothing any more.
        with suppress(Exception):
            discard(df)


def _held(out: DataFrame, keep: bool = False) -> DataFrame:
    around = _scratch.get()
    around = around[: len(around) - keep]
    (around[-1] if around else _left).append(out)
    return out


def stored(df: DataFrame, name: str, codec: str = "zstd", keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it again.

    Cuts the lineage: a lost executor costs only the tasks it ran, and what is
    read twice is computed once.  Inside ``scratch`` the table goes at its end,
    or with ``keep`` at the end of the one around it; without one, when the
    driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return _held(out, keep)


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """Like ``stored``, but dealt into buckets by ``key``: joins on it send only the other side.

    ``key`` should be unique, as a bucket isn't split.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    unique = f"{name}-{uuid.uuid4().hex}"
    path, table_name = f"{shared_folder(spark)}/{unique}", unique.replace("-", "_")
    dealt = df.repartition(n, key).write.bucketBy(n, key).format("parquet")
    dealt.option("compression", "zstd").option("path", path).saveAsTable(table_name)
    out = spark.table(table_name)
    out.stored_at, out.stored_table = path, table_name
    return _held(out)


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for df in tables:
        if hasattr(df, "stored_table"):
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {df.stored_table}")
        jvm = df.sparkSession.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(df.stored_at)
        where.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch() -> Iterator[None]:
    """Tables stored inside are deleted at the end, but for those to keep."""
    inside: list[DataFrame] = []
    before = _scratch.set((*_scratch.get(), inside))
    try:
        yield
    finally:
        _scratch.reset(before)
        discard(*inside)


def frequent(rows: DataFrame, column: str, n: int) -> DataFrame:
    """Values of ``column`` that hold more than a small share of the ``n`` rows.

    Those are values that a sample of about ``SAMPLE`` rows holds ``OFTEN``
    times or more, so at most ``SAMPLE / OFTEN`` values whatever the input, few
    enough to broadcast.  Any other value has few rows for one task, but for
    the chances of the sample.  The answer only ever says by which of two ways
    that give the same rows a value goes.
    """
    share = SAMPLE / max(n, 1)
    seen = rows.select(column) if share >= 1 else rows.select(column).filter(F.rand(7) < share)
    return F.broadcast(stored(seen.groupBy(column).agg(F.count("*").alias("n")).filter(F.col("n") >= OFTEN).select(column), "frequent"))


def clean_columns(df: DataFrame, *wanted: str) -> DataFrame:
    """Only the columns an operator needs; extra columns cannot clash then."""
    return df.select(*(F.col(f"`{c}`") for c in wanted))


def text_buffer(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n + 1 offsets of an Arrow string column; null is empty."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    if text.null_count:
        text = pc.fill_null(text, "" if pa.types.is_string(text.type) else b"")
    n = len(text)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = text.buffers()
    offsets = np.frombuffer(offs, np.int32)[text.offset : text.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, most: int):
    """Row ranges of a batch with about ``most`` bytes of text each.

    A text is never cut; one longer than ``most`` is a range of its own.
    """
    _, offsets = text_buffer(batch.column(column))
    start, n = 0, batch.num_rows
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1
        stop = min(n, max(stop, start + 1))
        yield batch.slice(start, stop - start)
        start = stop


def worker_setup() -> None:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    os.environ.setdefault("OMP_NUM_THREADS", "1")

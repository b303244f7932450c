"""How five quality filters act on each other: what each order of them removes.

Documents become rows of a sparse document-term matrix in CSR shards whose
columns are numbered by one dictionary of all words.  The sum of a row is a
document's number of words and its stored entries are its distinct words; these
decide filters A and B.  C and D are read off the text, E compares SHA-256
digests.  A document is then a set of failed filters; what any order of the
filters does follows from how many documents have each set.

Words are ``[^\\x20\\x09-\\x0D]+`` with case.  A null text is empty.  A null
language and an empty one are the part ''.  A row without a doc_id is neither
smaller nor larger than another: it never fails E and makes none fail it.
Repeated rows count each, and equal ids are not smaller than each other.  A
document's labels are those of all label rows with its id together.  An empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import clean_columns, scratch, slices, stored, text_buffer
from .terms import one_list, sparse_rows
from .words import SPACE

#: Bytes of text in a shard; a longer text is a shard of its own.
SHARD_BYTES = 8 << 20
#: Rows of distinct words of shards that a task numbers at once.
HELD_ROWS = 1_000_000
FILTERS = "ABCDE"
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#$%&*|")] = True

MARKS = "doc_id array<long>, lang array<string>, digest array<binary>, points array<long>, capitals array<long>, symbol array<boolean>"
SHARD = f"shard long, {MARKS}, words array<string>, indptr binary, indices binary, counts binary"
MATRIX = f"shard long, {MARKS}, indptr binary, indices binary, counts binary"
NUMBERS = {"part": "int", "shard": "long", "places": "binary", "ids": "binary", "words": "array<string>"}
FLAGS = "doc_id long, part string, digest binary, n_words long, n_distinct long, failed int"


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards whose columns are numbered by the words of the shard alone."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for part in slices(batch, "text", SHARD_BYTES):
            data, offsets = text_buffer(part.column("text"))
            rows = sparse_rows(data, offsets, SPACE)
            raw, at = memoryview(data), offsets.tolist()
            digests = [hashlib.sha256(raw[a:b]).digest() for a, b in zip(at, at[1:], strict=False)]
            marks = [part.column("doc_id"), part.column("lang"), pa.array(digests, pa.binary()), pa.array(_sums((data & 0xC0) != 0x80, offsets)), pa.array(_sums((data >= 65) & (data <= 90), offsets)), pa.array(_sums(SYMBOLS[data], offsets) > 0)]
            csr = [pa.array([x.astype(np.int64 if x is rows.indptr else np.int32).tobytes()], pa.binary()) for x in (rows.indptr, rows.indices, rows.counts)]
            columns = [pa.array([number], pa.int64()), *map(one_list, marks), one_list(rows.words.cast(pa.string())), *csr]
            yield pa.record_batch(columns, names=[c.split()[0] for c in SHARD.split(", ")])
            number += 1


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the words of a partition and packs the numbers by shard; the words themselves come last.

    Only the words that differ are held; what a shard has is packed away
    whenever ``HELD_ROWS`` rows have come.
    """
    part, known, held, rows = TaskContext.get().partitionId(), pa.array([], pa.string()), [], 0

    def packed(table: pa.Table) -> Iterator[pa.RecordBatch]:
        nonlocal known
        word = table.column("word").combine_chunks()
        fresh = word.unique() if not len(known) else word.filter(pc.is_in(word, value_set=known, skip_nulls=True).fill_null(False).to_numpy(zero_copy_only=False) ^ True).unique()
        known = pa.concat_arrays([known, fresh])
        number = pc.index_in(word, value_set=known).to_numpy().astype(np.int32)
        shard, place = table.column("shard").to_numpy(), table.column("place").to_numpy()
        order = np.lexsort((place, shard))
        shard, place, number = shard[order], place[order], number[order]
        first = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
        cut = lambda x: [x[a:b].tobytes() for a, b in zip(first, np.r_[first[1:], len(shard)], strict=True)]
        n = len(first)
        columns = [pa.array(np.full(n, part), pa.int32()), pa.array(shard[first]), pa.array(cut(place.astype(np.int32)), pa.binary()), pa.array(cut(number), pa.binary()), pa.nulls(n, pa.list_(pa.string()))]
        for i in range(0, n, 64):
            yield pa.record_batch([c.slice(i, 64) for c in columns], names=list(NUMBERS))

    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= HELD_ROWS:
            yield from packed(pa.Table.from_batches(held))
            held, rows = [], 0
    if rows:
        yield from packed(pa.Table.from_batches(held))
    if len(known):
        yield pa.record_batch([pa.array([part], pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), one_list(known)], names=list(NUMBERS))


def _renumbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            local = np.frombuffer(row.column("indices")[0].as_buffer(), np.int32)
            where = np.zeros(int(local.max(initial=-1)) + 1, np.int64)
            for packed in row.column("numbers").flatten():
                at, number = (np.frombuffer(packed[c].as_buffer(), np.int32) for c in ("places", "ids"))
                where[at] = packed["before"].as_py() + number.astype(np.int64)
            columns = [row.column(c) if c != "indices" else pa.array([where[local].tobytes()], pa.binary()) for c in row.schema.names if c != "numbers"]
            yield pa.record_batch(columns, names=[c for c in row.schema.names if c != "numbers"])


def document_term_matrix(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """CSR shards, and the dictionary (word, id) that names their columns.

    A shard has its documents' marks in order, ``indptr`` (int64), ``indices``
    (int64 ids of words) and ``counts`` (int32).  The distinct words of each
    shard are dealt by word; a partition numbers its own, and the sums of the
    partitions before it make the numbers global, from 0 without gaps.  They
    are written once, so a lost task can't give a word another number.
    """
    shards = stored(clean_columns(docs, "doc_id", "lang", "text").mapInArrow(_shards, SHARD), "audit-shards")
    words = shards.select("shard", F.posexplode("words").alias("place", "word"))
    numbers = stored(words.repartition("word").mapInArrow(_numbered, ", ".join(f"{k} {v}" for k, v in NUMBERS.items())), "audit-numbers")
    # One row for each partition.
    totals = numbers.filter("shard IS NULL").select("part", F.size("words").cast("long").alias("n"))
    before = F.broadcast(totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before")))
    known = numbers.filter("shard IS NULL").join(before, "part").select(F.posexplode("words").alias("place", "word"), "before").select("word", (F.col("before") + F.col("place")).alias("id"))
    of_shard = numbers.filter("shard IS NOT NULL").join(before, "part").groupBy("shard").agg(F.collect_list(F.struct("before", "places", "ids")).alias("numbers"))
    # A shard of texts without words has no numbers.
    return shards.drop("words").join(of_shard, "shard", "left").mapInArrow(_renumbered, MATRIX), known


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            indptr = np.frombuffer(row.column("indptr")[0].as_buffer(), np.int64)
            counts = np.frombuffer(row.column("counts")[0].as_buffer(), np.int32).astype(np.int64)
            sums = np.zeros(len(counts) + 1, np.int64)
            np.cumsum(counts, out=sums[1:])
            n_words, n_distinct = sums[indptr[1:]] - sums[indptr[:-1]], np.diff(indptr)
            marks = {c.split()[0]: row.column(c.split()[0]).flatten() for c in MARKS.split(", ")}
            points, capitals, symbol = (marks[c].to_numpy(zero_copy_only=False) for c in ("points", "capitals", "symbol"))
            fails = (n_words < 200, 100 * n_distinct < 50 * n_words, 100 * capitals > 3 * points, symbol)
            failed = sum(f.astype(np.int32) << k for k, f in enumerate(fails))
            columns = [marks["doc_id"], marks["lang"].fill_null(""), marks["digest"], pa.array(n_words), pa.array(n_distinct), pa.array(failed, pa.int32())]
            yield pa.record_batch(columns, names=[c.split()[0] for c in FLAGS.split(", ")])


def flags(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest of the text, words, distinct words, and the filters A to D it fails as bits 0 to 3."""
    return document_term_matrix(docs)[0].mapInArrow(_judged, FLAGS)


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, failed (bits 0 to 4 for A to E), good, toxic, n: how many documents have each.

    Copies of a text are summed up by part and labels before they meet, so a
    group of any number of copies is a few rows.
    """
    same = flags(docs).groupBy("doc_id", "part", "failed", "digest").agg(F.count("*").alias("n"))
    known = clean_columns(labels, "doc_id", "quality", "toxic").groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    rows = same.join(known, "doc_id", "left").select(*same.columns, *(F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")))
    of_text = rows.groupBy("digest", "part", "failed", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("without_id"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("least"),
    )
    # A few rows for each text: its parts and labels.
    first = F.min("least.doc_id").over(Window.partitionBy("digest"))
    stay = F.col("without_id") + F.when(F.col("least.doc_id") == first, F.col("least.n")).otherwise(0)
    both = of_text.withColumn("stay", stay).select("part", "failed", "good", "toxic", F.explode(F.array(F.struct(F.lit(0).alias("bit"), F.col("stay").alias("n")), F.struct(F.lit(16).alias("bit"), (F.col("n") - F.col("stay")).alias("n")))).alias("e"))
    return both.groupBy("part", F.col("failed").bitwiseOR(F.col("e.bit")).alias("failed"), "good", "toxic").agg(F.sum("e.n").alias("n"))


def interactions(counts: DataFrame) -> DataFrame:
    """What every order of the filters does at every step in every part.

    ``counts`` has few rows a part (sets of failed filters by labels).  A step
    depends only on its filter and on which filters came before, so 80 pairs
    are summed up and shared out to the 600 steps of the 120 orders.
    """
    spark, k = counts.sparkSession, len(FILTERS)
    pairs = [(before, f) for before in range(1 << k) for f in range(k) if not before >> f & 1]
    steps = [("".join(FILTERS[f] for f in order), i + 1, sum(1 << f for f in order[:i]), order[i]) for order in itertools.permutations(range(k)) for i in range(k)]
    orders = lambda before: math.factorial(before.bit_count()) * math.factorial(k - 1 - before.bit_count())
    pair = F.explode(F.array(*(F.struct(F.lit(b).alias("before"), F.lit(f).alias("filter"), F.lit(1 << f).alias("bit"), F.lit(orders(b)).cast("long").alias("orders")) for b, f in pairs)))
    rows = counts.withColumn("pair", pair).select("*", "pair.*")
    fails, earlier = F.col("failed").bitwiseAND(F.col("bit")) != 0, F.col("failed").bitwiseAND(F.col("before")) != 0
    total = lambda when, name: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0)).alias(name)
    sums = rows.groupBy("part", "before", "filter", "orders").agg(
        total(~fails & ~earlier, "kept"),
        total(fails & ~earlier, "removed"),
        total(fails & earlier, "redundant"),
        total(F.col("failed") == F.col("bit"), "unique_fails"),
        total(fails & ~earlier & F.col("good"), "good_lost"),
        total(fails & ~earlier & F.col("toxic"), "toxic_lost"),
    )
    shapley = F.sum(F.col("removed") * F.col("orders")).over(Window.partitionBy("part", "filter")).alias("shapley")
    plan = spark.createDataFrame(steps, "filter_order string, step int, before int, filter int")
    return sums.select("*", shapley).join(F.broadcast(plan), ["before", "filter"]).select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``interactions`` for the five filters over ``docs``."""
    with scratch():
        counts = stored(failures(docs, labels), "audit-failures", keep=True)
    return interactions(counts)

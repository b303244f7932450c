"""Ranked lexical search over a length-stratified index.

A document's normaliser m depends on its length alone.  The documents of a
segment are ordered by m, and those of equal m are a stratum; the postings of a
term are ordered by stratum and, in it, by tf, so a run of postings shares m
and tf and its impact is computed once.  A term's last run in a stratum bounds
what the term gives there; an item's bounds order the strata, and those below
the 20th score found so far are never read.

Terms are the maximal runs of anything but ASCII characters that are no letters
or digits, with A-Z lower-cased.  A document without terms, or whose text is
null, is in no stratum.  An item without terms has no rows.  Rows of documents
that repeat are ranked each; items that repeat an id are answered each.  Equal
scores go by doc_id, null last.  Empty tables give no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import clean_columns, scratch, slices, stored, text_buffer
from .terms import one_list, ranges, sparse_rows
from .words import word_spans

#: Documents returned for each item.
TOP = 20
#: Bytes of text in a segment; a longer text is a segment of its own.
SEGMENT_BYTES = 4 << 20
#: Bytes of the items that one pass over the index answers; a longer item is a pass of its own.
ITEM_BYTES = 4 << 20
#: What a term is, as bytes of UTF-8 and as a pattern.
SEPARATORS = np.ones(256, bool)
SEPARATORS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERM = re.compile(TERM.encode())

INDEX = "segment long, doc_id array<long>, terms array<string>, df array<int>, strata binary, run_ptr binary, run_stratum binary, run_tf binary, run_len binary, postings binary"
FOUND = "item int, doc_id long, score long"


def narrow(x: np.ndarray) -> bytes:
    """Numbers from 0 up in the least width that holds them, the width first."""
    kind = np.min_scalar_type(int(x.max(initial=0)))
    return bytes([kind.itemsize]) + x.astype(kind).tobytes()


def wide(raw: pa.Scalar) -> np.ndarray:
    data = raw.as_buffer()
    return np.frombuffer(data, f"u{np.frombuffer(data, np.uint8, 1)[0]}", offset=1)


class Sizes(NamedTuple):
    """Documents with a term, and all their terms."""

    documents: int
    terms: int


def sizes(docs: DataFrame) -> Sizes:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = terms = 0
        for batch in batches:
            for part in slices(batch, "text", SEGMENT_BYTES):
                n = np.diff(word_spans(*text_buffer(part.column("text")), SEPARATORS)[2])
                documents, terms = documents + int((n > 0).sum()), terms + int(n.sum())
        yield pa.record_batch([pa.array([documents], pa.int64()), pa.array([terms], pa.int64())], names=["documents", "terms"])

    row = clean_columns(docs, "text").mapInArrow(count, "documents long, terms long").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in Sizes._fields)).first()
    return Sizes(row.documents, row.terms)


def normaliser(n: np.ndarray, size: Sizes) -> np.ndarray:
    """m of documents of n terms."""
    if 25 * size.documents * int(n.max(initial=0)) < 1 << 62:
        return 75 + 25 * n * size.documents // size.terms
    return np.array([75 + 25 * int(x) * size.documents // size.terms for x in n], np.int64)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def weight(size: Sizes, df: int) -> int:
    return math.floor(1000 * math.log((2 * size.documents + 2) / (2 * df + 1)))


def build_index(docs: DataFrame, size: Sizes) -> DataFrame:
    """Segments: document ids by ordinal, terms with df, and the runs and postings of each term.

    Runs of a term lie between two entries of ``run_ptr`` by rising m, then tf;
    ``postings`` holds the document ordinals of all runs in that order.
    """

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "text", SEGMENT_BYTES):
                rows = sparse_rows(*text_buffer(part.column("text")), SEPARATORS, lower=True)
                row = np.repeat(np.arange(part.num_rows), np.diff(rows.indptr))
                n = np.bincount(row, rows.counts, part.num_rows).astype(np.int64)
                m = normaliser(n, size)
                by_length = np.argsort(m, kind="stable")
                by_length = by_length[n[by_length] > 0]
                if not len(by_length):
                    continue
                ordinal = np.zeros(part.num_rows, np.int64)
                ordinal[by_length] = np.arange(len(by_length))
                strata, stratum = np.unique(m[by_length], return_inverse=True)
                term, tf, doc = rows.indices.astype(np.int32), rows.counts.astype(np.int32), ordinal[row].astype(np.int32)
                # Documents stand in order of m, so theirs is that of the strata.
                order = np.lexsort((doc, tf, stratum[doc], term))
                term, tf, doc = term[order], tf[order], doc[order]
                at = stratum[doc]
                new = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (tf[1:] != tf[:-1]) | (at[1:] != at[:-1])])
                run_ptr = np.searchsorted(term[new], np.arange(len(rows.words) + 1))
                df = np.bincount(term, minlength=len(rows.words))
                parts = (strata, run_ptr, at[new], tf[new], np.diff(np.r_[new, len(term)]), doc)
                columns = [pa.array([number], pa.int64()), *map(one_list, (part.column("doc_id").take(pa.array(by_length)), rows.words.cast(pa.string()), pa.array(df, pa.int32()))), *(pa.array([narrow(x)], pa.binary()) for x in parts)]
                yield pa.record_batch(columns, names=[c.split()[0] for c in INDEX.split(", ")])
                number += 1

    return stored(clean_columns(docs, "doc_id", "text").mapInArrow(segments, INDEX), "lexical-index")


class Best:
    """The best documents of an item so far, by score, then id, null last."""

    def __init__(self, most: int):
        self.most = most
        self.score, self.doc, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def least(self) -> int:
        """No score below this can be among the best."""
        return int(self.score[-1]) if len(self.score) == self.most else 1

    def add(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        score, doc, null = np.r_[self.score, score], np.r_[self.doc, doc], np.r_[self.null, null]
        keep = np.lexsort((doc, null, -score))[: self.most]
        self.score, self.doc, self.null = score[keep], doc[keep], null[keep]


class Segment:
    def __init__(self, row: pa.RecordBatch, wanted: pa.Array):
        of = lambda c: wide(row.column(c)[0])
        ids = row.column("doc_id").flatten()
        self.null, self.doc = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
        strata, tf = of("strata").astype(np.int64), of("run_tf").astype(np.int64)
        self.ptr, self.length, self.postings = of("run_ptr").astype(np.int64), of("run_len"), of("postings")
        self.strata, self.stratum = len(strata), of("run_stratum")
        #: The term of the segment for each wanted one, or -1.
        self.place = pc.index_in(wanted, value_set=row.column("terms").flatten()).fill_null(-1).to_numpy().astype(np.int64)
        self.impact = impact(tf, strata[self.stratum])
        self.start = np.cumsum(self.length, dtype=np.int64) - self.length
        # The last run of a term in a stratum has its greatest tf there.
        self.last = np.ones(len(tf), bool)
        self.last[:-1] = self.stratum[1:] != self.stratum[:-1]
        self.last[self.ptr[1:-1][self.ptr[1:-1] > 0] - 1] = True

    def search(self, terms: np.ndarray, weights: np.ndarray, best: Best) -> int:
        """Bring the documents of this segment into ``best``; the number of strata read."""
        there = self.place[terms]
        here = (there >= 0) & (weights > 0)
        term, w = there[here], weights[here]
        lengths = self.ptr[term + 1] - self.ptr[term]
        runs = ranges(self.ptr[term], lengths)
        gives = np.repeat(w, lengths) * self.impact[runs]
        stratum, last = self.stratum[runs], self.last[runs]
        bound = np.zeros(self.strata, np.int64)
        np.add.at(bound, stratum[last], gives[last])
        order = np.argsort(-bound, kind="stable")
        at, step, read = 0, 1, 0
        while at < len(order) and bound[order[at]] >= best.least:
            chosen = np.zeros(self.strata, bool)
            chosen[order[at : at + step]] = True
            chosen &= bound >= best.least
            use = np.flatnonzero(chosen[stratum])
            length = self.length[runs[use]].astype(np.int64)
            docs = self.postings[ranges(self.start[runs[use]], length)]
            score = np.zeros(len(self.doc), np.int64)
            np.add.at(score, docs, np.repeat(gives[use], length))
            found = np.flatnonzero(score >= best.least)
            best.add(score[found], self.doc[found], self.null[found])
            read += int(chosen.sum())
            at, step = at + step, step * 2
        return read


def _terms(text: str | None) -> Counter:
    lower = (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256)))
    return Counter(t.decode() for t in _TERM.findall(lower))


def _blocks(items: DataFrame) -> Iterator[list[tuple[object, str | None]]]:
    """The items in blocks of bounded bytes, partition by partition."""
    block, held = [], 0
    for row in items.toLocalIterator():
        if block and held + len(row.text or "") > ITEM_BYTES:
            yield block
            block, held = [], 0
        block.append((row.item_id, row.text))
        held += len(row.text or "")
    if block:
        yield block


def _frequencies(index: DataFrame, wanted: list[str]) -> dict[str, int]:
    """df over all segments of the wanted terms, which are those of one block."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, df = pa.array(wanted, pa.string()), np.zeros(len(wanted), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                at = pc.index_in(names, value_set=batch.column("terms").slice(i, 1).flatten())
                here = at.is_valid().to_numpy(zero_copy_only=False)
                df[here] += batch.column("df").slice(i, 1).flatten().to_numpy()[at.drop_null().to_numpy()]
        at = np.flatnonzero(df)
        yield pa.record_batch([pa.array(at, pa.int32()), pa.array(df[at])], names=["term", "df"])

    rows = index.select("terms", "df").mapInArrow(look, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
    return {wanted[r.term]: r.df for r in rows}


def _found(index: DataFrame, wanted: list[str], queries: list[tuple[np.ndarray, np.ndarray]], top: int) -> DataFrame:
    """The best documents of each task for each query, with the threshold passed on from segment to segment."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, best = pa.array(wanted, pa.string()), [Best(top) for _ in queries]
        for batch in batches:
            for i in range(batch.num_rows):
                segment = Segment(batch.slice(i, 1), names)
                for (terms, weights), b in zip(queries, best, strict=True):
                    segment.search(terms, weights, b)
        for item, b in enumerate(best):
            yield pa.record_batch([pa.array(np.full(len(b.doc), item), pa.int32()), pa.array(b.doc, pa.int64(), mask=b.null), pa.array(b.score)], names=["item", "doc_id", "score"])

    return index.mapInArrow(look, FOUND)


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score of the best ``top`` documents with a score above 0 of each item."""
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    schema = f"item_id {kind}, rank int, doc_id long, score long"
    out = []
    with scratch():
        size = sizes(docs)
        index = build_index(docs, size) if size.documents else None
        for block in _blocks(clean_columns(items, "item_id", "text")) if size.documents else ():
            asked = [_terms(text) for _, text in block]
            wanted = sorted(set().union(*asked))
            df, place = _frequencies(index, wanted), {t: i for i, t in enumerate(wanted)}
            queries = [(np.array([place[t] for t in q], np.int64), np.array([weight(size, df[t]) * r if t in df else 0 for t, r in q.items()], np.int64)) for q in asked]
            best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
            ranked = _found(index, wanted, queries, top).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
            # The ids of one block.
            ids = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], f"item int, item_id {kind}")
            out.append(stored(ranked.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score"), "lexical-found", keep=True))
    if not out:
        return spark.createDataFrame([], schema)
    return out[0].sparkSession.read.schema(schema).parquet(*(x.stored_at for x in out))

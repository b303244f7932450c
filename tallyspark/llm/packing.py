"""Packing: concatenate all documents and cut at fixed windows.

Two passes.  The first tokenizes every document and keeps its ids, with a
running count inside its partition; the token totals of the partitions, summed
up in order, give each partition its global offset.  The second pass cuts what
is now one long stream at every multiple of the window and writes a record of
each piece.  Only the last window can be short.

Null text counts as empty: the document is its closing id alone.  Repeated
rows are packed once each.  An empty table gives no pieces.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import clean_columns, slices, stored, worker_setup

WINDOW = 4096
END_ID = 2
#: Words in each of the two generations that a worker remembers.
REMEMBERED = 500_000
#: Letters and closing marks.  Lower-case letters of this kind are unchanged by
#: the tokenizer's normalizer and never cut by it.
PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-įĲ-ňŊ-ɏ]+)([.,;:!?]*)").fullmatch
BROADCAST_PARTS = 1_000_000
#: Separators for Python's split() that are no white space for the tokenizer.
ODD_SPACE = re.compile("[\x1c-\x1f]")

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded_to long"

_encoders: dict[str, WordEncoder] = {}


class Words(dict):
    """Packed ids of the words seen so far; a new word is worked out on demand.

    A word of plain letters and closing marks is put together from its
    lower-case letters and its marks, between which the tokenizer cuts too.
    Lower-case letters are what its normalizer and its splitting leave as they
    are, so they go straight to its BPE model.  Two generations: words in use
    move to the younger one when the older one goes.
    """

    def __init__(self, tokenizer, pack):
        from tokenizers.pre_tokenizers import ByteLevel

        self.older: dict[str, bytes] = {}
        self.pack, self.tokenizer, self.model = pack, tokenizer, tokenizer.model
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x250) if chr(c).isalpha()}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            plain = PLAIN(word)
            if plain is None:
                ids = self.pack(self.tokenizer.encode(word, add_special_tokens=False).ids)
            elif plain[2] or word != word.lower():
                ids = self[plain[1].lower()] + (self[plain[2]] if plain[2] else b"")
            else:
                ids = self.pack([t.id for t in self.model.tokenize(word if word.isascii() else word.translate(self.bytes))])
        self[word] = ids
        return ids

    def turn(self) -> None:
        if len(self) > REMEMBERED:
            self.older = dict(self)
            self.clear()


class WordEncoder:
    """Ids of whole texts, through a memory of the ids of words.

    The tokenizer drops white space and never joins what it separates, so the
    ids of a text are those of its words in order.
    """

    def __init__(self, path: str):
        worker_setup()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        narrow = self.tokenizer.get_vocab_size() <= 1 << 16
        self.dtype = np.dtype("<u2" if narrow else "<u4")
        self.kind = "H" if narrow else "I"
        self.words = Words(self.tokenizer, self.packed)

    def packed(self, ids: list[int]) -> bytes:
        return array(self.kind, ids).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        self.words.turn()
        known = self.words.__getitem__
        return [b"".join(map(known, t.split())) if not ODD_SPACE.search(t) else self.packed(self.tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def tokenized(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, ids (packed), n, and where the document starts in its partition."""
    schema = pa.schema([("part", pa.int32()), ("base", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, base = encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        end = enc.packed([END_ID])
        for batch in batches:
            for rows in slices(batch, "text", 2 << 20):
                ids = [x + end for x in enc.encode([t or "" for t in rows.column("text").to_pylist()])]
                n = np.array([len(x) for x in ids], np.int64) // enc.dtype.itemsize
                bases = base + np.cumsum(n) - n
                base += int(n.sum())
                yield pa.record_batch([pa.array(np.full(len(n), part, np.int32)), pa.array(bases), rows.column("doc_id").cast(pa.int64()), pa.array(n), pa.array(ids, pa.binary())], schema=schema)

    return clean_columns(docs, "doc_id", "text").mapInArrow(run, "part int, base long, doc_id long, n long, ids binary")


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW) -> DataFrame:
    """One row per piece of a document (see ``PIECES``).

    ``padded_to`` is the length the piece's sequence is filled up to: the
    window, or its own length where that is a power of two.
    """
    spark = docs.sparkSession
    ids = stored(tokenized(docs, tokenizer_path), "packing-ids")
    # One row per partition of the input, whatever the number of documents.
    totals = ids.groupBy("part").agg(F.max(F.col("base") + F.col("n")).alias("total")).collect()
    totals.sort(key=lambda r: r.part)
    ends = np.cumsum([r.total for r in totals], dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    offsets = spark.createDataFrame([(r.part, int(e) - r.total) for r, e in zip(totals, ends, strict=True)], "part int, part_offset long")
    width = encoder(tokenizer_path).dtype.itemsize
    last = total % window
    tail = last if last & (last - 1) == 0 and last else window
    schema = pa.schema([(c.split()[0], pa.int64()) for c in PIECES.split(", ")])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, n, first, packed = (batch.column(i) for i in range(4))
            n, first = n.to_numpy(), first.to_numpy()
            seq, seq_end = first // window, (first + n - 1) // window
            count = seq_end - seq + 1
            row = np.repeat(np.arange(len(n)), count)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            sequence = seq[row] + nth
            start = np.maximum(sequence * window, first[row]) - first[row]
            length = np.minimum((sequence + 1) * window, first[row] + n[row]) - first[row] - start
            crcs, k = np.empty(len(row), np.int64), 0
            for i, data in enumerate(packed):
                ids = np.frombuffer(data.as_buffer(), f"<u{width}").astype("<u4")
                for _ in range(count[i]):
                    crcs[k] = zlib.crc32(ids[start[k] : start[k] + length[k]].tobytes())
                    k += 1
            offset = first[row] + start - sequence * window
            padded = np.where(sequence == total // window, tail, window)
            columns = [pa.array(doc.to_numpy(zero_copy_only=False)[row]) if not doc.null_count else doc.take(pa.array(row)), *map(pa.array, (start, length, crcs, n[row], sequence, offset, padded))]
            yield pa.record_batch(columns, schema=schema)

    # Twelve bytes for each partition of the input.
    placed = ids.join(F.broadcast(offsets) if len(totals) <= BROADCAST_PARTS else offsets, "part").select("doc_id", "n", (F.col("part_offset") + F.col("base")).alias("first"), "ids")
    return placed.mapInArrow(cut, PIECES)

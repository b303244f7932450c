"""Suffix-array deduplication: remove every byte of a repeated string of ``length`` bytes.

Sorting every suffix of the corpus would move each byte hundreds of times.
The array here is sparse.  With 400 bytes: each 400-byte string has one anchor,
the place of the least hash among its 128-byte substrings, which depends on the
string alone.  So equal strings have equal anchors at equal distances, and
suffixes at anchors are all that have to be sorted; about one byte in 140 is
one.  Other lengths have anchors in proportion (see ``anchor_width``).

1. Every anchor gives the hash of its 128 bytes and of its context: all the
   400-byte strings that it is the anchor of.  Anchors whose 128 bytes occur
   once are done.  Contexts that occur as a whole elsewhere are removed whole.
2. One context of each kind goes on.  Sampled splitters range-partition them by
   the leading tokens of the suffix at the anchor, so suffixes that start alike
   meet in one bucket and no run of them crosses a boundary.  A bucket sorts
   its suffixes by multikey quicksort on 8-byte tokens; within a run of equal
   128 bytes, the 400-byte strings at the same distance from the anchor are
   compared.
3. A run of more than ``RUN_LIMIT`` contexts isn't put into one task: its
   strings are dealt by their hashes into as many buckets as keep each at that
   size, and met there, with the same result.  Strings that a batch of contexts
   holds twice are settled in it and go on once, so a string that very many
   contexts share is one entry of each batch.

128 bytes that a sample finds very often (a passage that a third of all
documents share) never meet in one task: their contexts are summed up by
(128 bytes, context) and joined back.  The few contexts that hold much of all
anchors are broadcast for that, so no exchange gathers their copies.

Strings are compared by 64-bit hashes among those with equal anchors.  A null
text counts as empty; texts shorter than ``length`` keep all.  Rows that repeat
a doc_id are documents of their own, so two equal rows of 400 bytes remove each
other.  An empty table gives no rows.

A repeated passage of over 50 words is often shorter than 400 bytes and stays.
``remove_repeats`` finds these too, by strings of 200 bytes in the same way, and
counts them beside what it removes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import bucketed, clean_columns, frequent, scratch, slices, stored, text_buffer
from .words import mix, powers, prefix_sums, word_spans

LENGTH = 400
#: Bytes by which repeated passages are found, and the words one must exceed to count.
PASSAGE_BYTES, PASSAGE_WORDS = 200, 50
#: Contexts of one run that a single task compares at most.
RUN_LIMIT = 1000
#: Kinds of contexts with more than this part of all anchors are broadcast, so their copies aren't sent; fewer than this many can be.
MANY = 1 << 14
SLICE = 1 << 20
#: Bytes of contexts that are compared at a time.
CHUNK = 2 << 20
PLACE = np.uint64((1 << 31) - 1)

ANCHORS = "kh long, cd long, key long, at int, lead int, span int"
CONTEXTS = "lead_a long, lead_b long, kh long, key long, at int, lead int, whole boolean, buckets int, context binary"


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """min(values[i : i + width]) for each i with a whole window."""
    n = len(values)
    blocks = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    blocks[:n] = values
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray | int) -> np.ndarray:
    return (sums[ends] - sums[starts]) * powers(len(sums))[1][starts]


def anchor_width(length: int) -> int:
    """Bytes of an anchor: about a third of the string, whole 8-byte tokens."""
    if not 64 <= length <= 4000:
        raise ValueError("length is 64 to 4000 bytes")
    return max(16, length * 8 // 25 // 8 * 8)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """text, place, first start, last start, k-gram hash, context hash of all anchors."""
    anchor = anchor_width(length)
    n, width = len(data), length - anchor + 1
    none = tuple(np.zeros(0, np.int64) for _ in range(6))
    if n < length:
        return none
    sums = prefix_sums(data)
    places = np.arange(n - anchor + 1)
    grams = mix(range_hashes(sums, places, places + anchor))
    least = window_minima((grams & ~PLACE) | places.astype(np.uint64), width)
    lengths = np.diff(offsets)
    texts = np.flatnonzero(lengths >= length)
    counts = lengths[texts] - length + 1
    if not len(texts):
        return none
    text = np.repeat(texts, counts)
    starts = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(offsets[texts], counts)
    at = (least[starts] & PLACE).astype(np.int64)
    new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (text[1:] != text[:-1])])
    last = np.r_[new[1:], len(at)] - 1
    text, at, first, final = text[new], at[new], starts[new], starts[last]
    context = mix(range_hashes(sums, first, final + length) + mix(((at - first) << 20 | (final - first)).astype(np.uint64)))
    return text, at, first, final, grams[at], context


def anchor_rows(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``ANCHORS``: at is the anchor's place, lead how far its context starts before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text", SLICE):
                data, offsets = text_buffer(rows.column("text"))
                text, at, first, final, gram, context = anchors(data, offsets, length)
                key = rows.column("key").to_numpy()[text]
                columns = (gram.view(np.int64), context.view(np.int64), key, (at - offsets[text]).astype(np.int32), (at - first).astype(np.int32), (final - first + length).astype(np.int32))
                yield pa.record_batch([pa.array(c) for c in columns], names=["kh", "cd", "key", "at", "lead", "span"])

    return docs.select("key", "text").mapInArrow(run, ANCHORS)


def marked(docs: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """(key, start, stop) of contexts that occur again as a whole; one context of each kind in a run of several kinds.

    kh names the run of equal 128 bytes, cd the kind of context in it.
    """
    rows = stored(anchor_rows(docs, length), "suffix-anchors")
    n = rows.count()
    hot = frequent(rows, "kh", n)
    place = F.struct("key", "at", "lead", "span")

    run, kind = Window.partitionBy("kh"), Window.partitionBy("kh", "cd")
    # Dealt by run and sorted once, which serves all three windows.
    rare = rows.join(hot, "kh", "left_anti").repartition("kh").withColumn("nth", F.row_number().over(kind.orderBy("key", "at"))).withColumn("copies", F.count("*").over(kind))
    rare = rare.withColumn("kinds", F.sum(F.when(F.col("nth") == 1, 1).otherwise(0)).over(run)).filter("copies > 1 OR kinds > 1")
    rare = stored(rare.withColumn("first", F.col("nth") == 1).drop("cd", "nth"), "suffix-marks")

    often = rows.join(hot, "kh", "left_semi")
    kinds = stored(often.groupBy("kh", "cd").agg(F.count("*").alias("copies"), F.min(place).alias("first")), "suffix-kinds")
    # A row for each value of ``hot`` at most.
    runs = F.broadcast(kinds.groupBy("kh").agg(F.count("*").alias("kinds")).filter("kinds > 1"))
    kind_of, twice, most = ["kh", "cd"], F.col("copies") > 1, F.col("copies") * MANY > n
    many = F.broadcast(kinds.filter(twice & most).select(*kind_of))
    again = often.join(many, kind_of, "left_semi").unionByName(often.join(many, kind_of, "left_anti").join(kinds.filter(twice & ~most).select(*kind_of), kind_of, "left_semi"))

    span = [F.col("key"), (F.col("at") - F.col("lead")).alias("start"), (F.col("at") - F.col("lead") + F.col("span")).alias("stop")]
    whole = rare.filter("copies > 1").select(*span).unionByName(again.select(*span))
    one = ["kh", "key", "at", "lead", "span", (F.col("copies") > 1).alias("whole"), F.ceil(F.col("kinds") / RUN_LIMIT).cast("int").alias("buckets")]
    firsts = rare.filter("first AND kinds > 1").select(*one).unionByName(kinds.join(runs, "kh").select("kh", "first.*", "copies", "kinds").select(*one))
    return whole, firsts


def contexts(firsts: DataFrame, docs: DataFrame) -> DataFrame:
    """The bytes of one context of each kind, keyed by the suffix's leading tokens."""
    wanted = firsts.groupBy("key").agg(F.collect_list(F.struct("kh", "at", "lead", "span", "whole", "buckets")).alias("places"))
    rows = docs.join(wanted, "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                data, offsets = text_buffer(part.column("text"))
                lists = part.column("places")
                text = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
                places = lists.flatten()
                at, lead, span = (places.field(c).to_numpy().astype(np.int64) for c in ("at", "lead", "span"))
                start = offsets[text] + at - lead
                bounds = np.r_[0, np.cumsum(span)]
                tokens = data[(offsets[text] + at)[:, None] + np.arange(16)].view(">i8").astype(np.int64)
                keys = part.column("key").to_numpy()[text]
                # A part of the contexts at a time, as they overlap.
                a = 0
                while a < len(span):
                    b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + CHUNK, side="right")) - 1)
                    size = bounds[a : b + 1] - bounds[a]
                    index = np.arange(size[-1]) + np.repeat(start[a:b] - size[:-1], span[a:b])
                    out = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(size.astype(np.int32)), pa.py_buffer(data[index])])
                    some = places.slice(a, b - a)
                    yield pa.record_batch([pa.array(tokens[a:b, 0]), pa.array(tokens[a:b, 1]), some.field("kh"), pa.array(keys[a:b]), some.field("at"), some.field("lead"), some.field("whole"), some.field("buckets"), out], names=[c.split()[0] for c in CONTEXTS.split(", ")])
                    a = b

    return rows.mapInArrow(run, CONTEXTS)


def multikey_order(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of ``tokens`` and the number of each one's run of equal rows.

    Multikey quicksort, all open parts at once: a part takes its middle row's
    token as pivot and splits into rows below, equal and above; the equal ones
    go on with the next token, the others with the same one.
    """
    n, width = tokens.shape
    order, part, depth = np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
    while n:
        # ``part`` rises along ``order``; a part is open while it has several rows and tokens left.
        first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        size = np.diff(np.r_[first, n])
        alive = np.repeat((size > 1) & (depth[first] < width), size)
        at = np.flatnonzero(alive)
        if not len(at):
            break
        pivot = np.repeat(order[first + size // 2], size)[at]
        own, level = order[at], depth[at]
        t, p = tokens[own, level], tokens[pivot, level]
        side = np.where(t < p, 0, np.where(t == p, 1, 2))
        by = np.argsort(part[at] * 3 + side, kind="stable")
        order[at] = own[by]
        depth[at] = (level + (side == 1))[by]
        place = part * 3
        place[at] = (part[at] * 3 + side)[by]
        part = np.cumsum(np.r_[0, place[1:] != place[:-1]])
    return order, part


def start_hashes(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """context, start in it, hash of each string of ``length`` bytes of the contexts."""
    counts = np.diff(bounds) - length + 1
    context = np.repeat(np.arange(len(counts)), counts)
    nth = np.arange(len(context)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = bounds[context] + nth
    return context, nth, range_hashes(prefix_sums(data), at, at + length)


def compare_runs(rows: pa.Table, length: int = LENGTH) -> pa.RecordBatch:
    """key, start, stop of what the contexts repeat of each other."""
    data, bounds = text_buffer(rows.column("context"))
    at, lead = rows.column("at").to_numpy().astype(np.int64), rows.column("lead").to_numpy().astype(np.int64)
    head = (bounds[:-1] + lead)[:, None] + np.arange(anchor_width(length))
    order, run = multikey_order(data[head].view(">u8"))
    run_of = np.empty(len(order), np.int64)
    run_of[order] = run
    context, nth, h = start_hashes(data, bounds, length)
    key = mix(h + mix((run_of[context] << 12 | (lead[context] - nth)).astype(np.uint64)))
    by = np.argsort(key, kind="stable")
    same = key[by][1:] == key[by][:-1]
    twice = np.zeros(len(key), bool)
    twice[by[1:][same]] = True
    twice[by[:-1][same]] = True
    twice &= ~rows.column("whole").to_numpy(zero_copy_only=False)[context]
    found = np.flatnonzero(twice)
    cut = np.r_[True, (np.diff(found) > 1) | (np.diff(context[found]) != 0)] if len(found) else np.zeros(0, bool)
    first = found[cut]
    last = found[np.r_[np.flatnonzero(cut)[1:] - 1, len(found) - 1]] if len(found) else found
    c = context[first]
    base = at[c] - lead[c]
    return pa.record_batch([pa.array(rows.column("key").to_numpy()[c]), pa.array((base + nth[first]).astype(np.int32)), pa.array((base + nth[last] + length).astype(np.int32))], names=["key", "start", "stop"])


def bucket_spans(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """Compare contexts whose suffixes start alike, bucket by bucket."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Runs that share their leading tokens follow one another, so one run is all that is held.
    by = ["lead_a", "lead_b", "kh"]
    dealt = rows.repartitionByRange(n, *by).sortWithinPartitions(*by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, most = 0, CHUNK
        for batch in batches:
            for part in slices(batch, "context", CHUNK):
                held.append(part)
                size += part.nbytes
                if size < most:
                    continue
                # All but the last, perhaps unfinished, run.
                table = pa.Table.from_batches(held)
                keys = [table.column(c).to_numpy() for c in by]
                open_at = int(np.flatnonzero(np.any([k != k[-1] for k in keys], axis=0)).max(initial=-1)) + 1
                if open_at:
                    yield compare_runs(table.slice(0, open_at).combine_chunks(), length)
                held = table.slice(open_at).combine_chunks().to_batches()
                size = sum(x.nbytes for x in held)
                # A long run is looked at again only after it has grown by as much.
                most = max(CHUNK, 2 * size)
        if held:
            yield compare_runs(pa.Table.from_batches(held).combine_chunks(), length)

    return dealt.mapInArrow(run, "key long, start int, stop int")


#: A span of a document, or the strings of a batch that fall into one bucket of a run: hash, document, start, and whether it is settled.
ENTRIES = "key long, start int, stop int, kh long, bucket int, strings binary, keys binary, starts binary, settled binary"


def _spans(key: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """key, start, stop of the runs of starts that follow one another in a document."""
    if not len(key):
        return key.astype(np.int64), start.astype(np.int32), start.astype(np.int32)
    by = np.lexsort((start, key))
    key, start = key[by], start[by].astype(np.int64)
    new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (start[1:] > start[:-1] + 1)])
    last = np.r_[new[1:], len(key)] - 1
    return key[new], start[new].astype(np.int32), (start[last] + length).astype(np.int32)


def _again(*parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have a like in all ``parts``, and which are the first of their kind."""
    by = np.lexsort(parts[::-1])
    same = np.all([p[by][1:] == p[by][:-1] for p in parts], axis=0)
    again, first = np.zeros(len(by), bool), np.ones(len(by), bool)
    again[by[1:][same]] = True
    again[by[:-1][same]] = True
    first[by[1:][same]] = False
    return again, first


def met_spans(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """The same for runs too large for a task: strings meet in buckets by hash."""
    names = [c.split()[0] for c in ENTRIES.split(", ")]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "context", CHUNK):
                data, bounds = text_buffer(part.column("context"))
                lead = part.column("lead").to_numpy().astype(np.int64)
                context, nth, h = start_hashes(data, bounds, length)
                string = mix(h + mix((lead[context] - nth).astype(np.uint64)))
                start = ((part.column("at").to_numpy() - lead)[context] + nth).astype(np.int32)
                kh, key = part.column("kh").to_numpy()[context], part.column("key").to_numpy()[context]
                settled = part.column("whole").to_numpy(zero_copy_only=False)[context]
                again, first = _again(kh, string)
                found = again & ~settled
                spans = _spans(key[found], start[found], length)
                n = len(spans[0])
                yield pa.record_batch([*map(pa.array, spans), *(pa.nulls(n, t) for t in (pa.int64(), pa.int32(), *[pa.binary()] * 4))], names=names)
                settled = settled | again
                bucket = (string % part.column("buckets").to_numpy().astype(np.uint64)[context]).astype(np.int32)
                some = np.flatnonzero(first)
                some = some[np.lexsort((bucket[some], kh[some]))]
                cut = np.flatnonzero(np.r_[True, (kh[some][1:] != kh[some][:-1]) | (bucket[some][1:] != bucket[some][:-1])]) if len(some) else some
                ends = np.r_[cut[1:], len(some)]
                packed = [pa.array([x[some][a:b].tobytes() for a, b in zip(cut, ends, strict=True)], pa.binary()) for x in (string, key, start, settled)]
                n = len(cut)
                yield pa.record_batch([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.array(kh[some][cut]), pa.array(bucket[some][cut]), *packed], names=names)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        group = None

        def found() -> pa.RecordBatch:
            string, key, start, settled = (np.concatenate(held[c]) for c in names[5:])
            again = _again(string)[0] & ~settled
            spans = _spans(key[again], start[again], length)
            return pa.record_batch(list(map(pa.array, spans)), names=names[:3])

        for batch in batches:
            for i in range(batch.num_rows):
                now = (batch.column("kh")[i].as_py(), batch.column("bucket")[i].as_py())
                if now != group:
                    if group:
                        yield found()
                    group, held = now, {c: [] for c in names[5:]}
                for c, kind in zip(names[5:], (np.uint64, np.int64, np.int32, bool), strict=True):
                    held[c].append(np.frombuffer(batch.column(c)[i].as_buffer(), kind))
        if group:
            yield found()

    dealt = stored(rows.mapInArrow(deal, ENTRIES), "suffix-entries")
    known = dealt.filter("kh IS NULL").select("key", "start", "stop")
    groups = dealt.filter("kh IS NOT NULL").select(*names[3:]).repartition("kh", "bucket").sortWithinPartitions("kh", "bucket")
    return known.unionByName(groups.mapInArrow(meet, "key long, start int, stop int"))


def merged(spans: DataFrame) -> DataFrame:
    """key, spans: the maximal runs that the spans of a key cover, however often they repeat."""
    once = spans.groupBy("key", "start").agg(F.max("stop").alias("stop"))
    before = Window.partitionBy("key").orderBy("start")
    new = once.withColumn("reach", F.max("stop").over(before.rowsBetween(Window.unboundedPreceding, -1))).withColumn("new", F.when(F.col("start") <= F.col("reach"), 0).otherwise(1))
    runs = new.withColumn("run", F.sum("new").over(before)).groupBy("key", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    return runs.groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def removals(docs: DataFrame, length: int = LENGTH, within: DataFrame | None = None) -> DataFrame:
    """key, spans: what is removed of each document that loses anything.

    ``within`` has the keys of the documents to look at, if not all.
    """
    with scratch():
        docs = docs.select("key", "text")
        whole, firsts = marked(docs if within is None else docs.join(within, "key", "left_semi"), length)
        rows = stored(contexts(firsts, docs), "suffix-contexts")
        spans = whole.unionByName(bucket_spans(rows.filter("buckets = 1"), length))
        if firsts.filter("buckets > 1").limit(1).count():
            spans = spans.unionByName(met_spans(rows.filter("buckets > 1"), length))
        return stored(merged(spans), "suffix-removals", keep=True)


def removed_mask(data: np.ndarray, spans: pa.Scalar | None, over_words: int) -> np.ndarray:
    """Which bytes go: those of the runs with more than ``over_words`` whole words."""
    mask = np.zeros(len(data) + 1, np.int32)
    if spans is not None and len(spans):
        start, stop = (spans.values.field(c).to_numpy() for c in ("start", "stop"))
        if over_words:
            starts, ends, _ = word_spans(data, np.array([0, len(data)]))
            long = np.searchsorted(ends, stop, side="right") - np.searchsorted(starts, start) > over_words
            start, stop = start[long], stop[long]
        np.add.at(mask, start, 1)
        np.add.at(mask, stop, -1)
    return np.cumsum(mask)[:-1] > 0


def each_kept(batches: Iterator[pa.RecordBatch], over_words: int = 0) -> Iterator[tuple[pa.RecordBatch, list[tuple[np.ndarray, np.ndarray]]]]:
    """Batches of documents with (bytes, removed mask) of each row."""
    for batch in batches:
        for part in slices(batch, "text", 4 * SLICE):
            data, offsets = text_buffer(part.column("text"))
            spans, rows = part.column("spans"), []
            for i in range(part.num_rows):
                own = data[offsets[i] : offsets[i + 1]]
                rows.append((own, removed_mask(own, spans[i] if spans[i].is_valid else None, over_words)))
            yield part, rows


def keyed(docs: DataFrame) -> DataFrame:
    """The documents, written once in buckets by a key for each row, so joins on it send spans, never texts."""
    return bucketed(docs.withColumn("key", F.monotonically_increasing_id()), "suffix-documents", "key")


def joined(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents with ``spans``."""
    docs = keyed(docs)
    return docs.join(removals(docs, length), "key", "left")


def runs_of(mask: np.ndarray) -> int:
    return int((mask[1:] & ~mask[:-1]).sum() + mask[:1].sum())


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_passages, n_passage_bytes of every document.

    Passages are the runs of bytes that repeated strings of ``PASSAGE_BYTES``
    cover, if they hold more than ``PASSAGE_WORDS`` whole words.  They are
    counted, with their bytes, whether they are removed or not.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in each_kept(batches):
            n, removed, spans, sha, passages, covered = [], [], [], [], [], []
            for (data, mask), own in zip(rows, part.column("passages"), strict=True):
                n.append(len(data))
                removed.append(int(mask.sum()))
                spans.append(runs_of(mask))
                sha.append(hashlib.sha256(data[~mask].tobytes()).hexdigest())
                passage = removed_mask(data, own if own.is_valid else None, PASSAGE_WORDS)
                passages.append(runs_of(passage))
                covered.append(int(passage.sum()))
            counts = [pa.array(x, pa.int64()) for x in (n, removed, spans, passages, covered)]
            yield pa.record_batch([part.column("doc_id"), *counts[:3], pa.array(sha), *counts[3:]], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passages", "n_passage_bytes"])

    docs = clean_columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    with scratch():
        docs = keyed(docs)
        passages = removals(docs, PASSAGE_BYTES)
        # All of a repeated string is covered by the shorter ones in it, at each place where it starts.
        longer = passages.filter(F.exists("spans", lambda x: x.stop - x.start >= length)).select("key") if length >= PASSAGE_BYTES else None
        spans = passages if length == PASSAGE_BYTES else removals(docs, length, longer)
        out = docs.join(spans, "key", "left").join(passages.withColumnRenamed("spans", "passages"), "key", "left")
        out = out.select("doc_id", "text", "spans", "passages").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_passages long, n_passage_bytes long")
        return stored(out, "suffix-digests", keep=True)


def without_repeats(docs: DataFrame, length: int = LENGTH, over_words: int = 0) -> DataFrame:
    """The documents, all columns, with what is repeated cut out of ``text``.

    Of the runs of bytes that repeated strings of ``length`` bytes cover, those
    with more than ``over_words`` whole words go; the others stay.  Bytes that a cut leaves without the rest of their character go too.  A null
    text stays null, an empty one empty; repeated rows cut each other.
    """
    fields = docs.drop("text").columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in each_kept(batches, over_words):
            given = part.column("text").is_valid()
            text = [data[~mask].tobytes().decode("utf-8", "ignore") if x.as_py() else None for (data, mask), x in zip(rows, given, strict=True)]
            yield pa.record_batch([*(part.column(f"c{i}") for i in range(len(fields))), pa.array(text, pa.string())], names=[f"c{i}" for i in range(len(fields) + 1)])

    packed = docs.select("doc_id", "text", *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(fields)))
    out = joined(packed, length)
    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join(f"c{i} {types[c]}" for i, c in enumerate([*fields, "text"]))
    out = out.select("text", "spans", *(f"c{i}" for i in range(len(fields)))).mapInArrow(run, schema)
    named = {c: F.col(f"c{i}") for i, c in enumerate([*fields, "text"])}
    if "n_chars" in named:
        named["n_chars"] = F.length(named["text"]).cast(docs.schema["n_chars"].dataType)
    return out.select(*(named[c].alias(c) for c in docs.columns))

"""Near-duplicate join on word shingles with adaptive multi-match prefixes.

All sets are put in one order, rarest shingle first.  Two sets of Jaccard
similarity s or more share at least l shingles in their prefixes of length
``n - ceil(s * n) + l``.  Each document chooses its own l: a longer prefix
reads more of the others but lets fewer through, and the estimated frequencies
say where the sum is least.  A pair needs min(l, l') shared shingles, at places
that the overlap asked of their two sizes allows, before its sets are compared.

The order and the estimates come from one count-min sketch over all documents,
whose width grows with the corpus between two bounds.  It only ever affects
cost: any order that all sets share gives the same links.

Documents of equal sets form classes first, and only one document of a class
goes on.  Where thousands share a prefix shingle, each document is compared
with few hubs before all others: pairs inside one component need no check, as
a component is all that is asked for.  A hub is the document in which the
shingle has the fewest rarer ones before it, so a plain copy comes before
edited ones.  What then still lies in different
components is compared pair by pair, so no link between components is lost.
Shingles that very many prefixes hold are found by a sample and never meet in
one task: their rows are summed up and joined, both of which Spark can split.

Null and empty texts have no set and no link.  Rows with a null doc_id take no
part and keep a null component.  Rows that repeat a doc_id share its component.
An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .shared import clean_columns, discard, frequent, scratch, slices, stored, text_buffer
from .words import mix, shingle_sets

SIZE = 5
#: The similarity as a fraction.
SIMILAR = (80, 100)
#: The sketch has two rows of 2**21 counters for up to ``SKETCH_BYTES`` of text,
#: twice as many for each doubling, and 2**24 at most; beyond these its counters
#: are of 4 bytes, not 2 (128 MB in all).
SKETCH_BITS = (21, 24)
SKETCH_BYTES = 4 << 30
SKETCH_PARTS = 16
#: The longest l, and the cost of comparing two sets in prefix entries read.
MOST_MATCHES = 4
COMPARE_COST = 4.0
SLICE = 1 << 20
#: Set sizes fall into this many classes for each factor of e.
CLASSES = 20


def sketch_cells(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64), (hashes & np.uint64((1 << bits) - 1)).astype(np.int64)


def sketch_form(size: int) -> tuple[int, str]:
    """Bits of a row's width, and the type of a counter, for ``size`` bytes of text."""
    least, most = SKETCH_BITS
    bits = least + max(0, -(-size // SKETCH_BYTES) - 1).bit_length()
    return min(most, bits), "<u2" if bits <= most else "<u4"


def first_pass(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """doc_id, n, digest of every document; the frequency sketch."""
    bits, kind = sketch_form(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    full = np.iinfo(kind).max

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("part", pa.int32())])
        counts = np.zeros((2, 1 << bits), np.uint32)
        any_rows = False
        for batch in batches:
            for rows in slices(batch, "text", SLICE):
                any_rows = True
                sets = shingle_sets(*text_buffer(rows.column("text")), SIZE)
                for row, cells in zip(counts, sketch_cells(np.concatenate(sets), bits), strict=True):
                    np.add.at(row, cells, 1)
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                yield pa.record_batch([rows.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.nulls(len(sets), pa.int32())], schema=schema)
        if any_rows:
            for part, cells in enumerate(np.array_split(np.minimum(counts, full).astype(kind).ravel(), SKETCH_PARTS)):
                yield pa.record_batch([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([cells.tobytes()], pa.binary()), pa.array([part], pa.int32())], schema=schema)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, cells in zip(batch.column("part").to_pylist(), batch.column("digest").to_pylist(), strict=True):
                sums[part] = np.minimum(np.frombuffer(cells, kind).astype(np.int64) + sums.get(part, 0), full)
        if sums:
            data = [x.astype(kind).tobytes() for x in sums.values()]
            yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array(data, pa.binary())], names=["part", "digest"])

    both = stored(docs.mapInArrow(run, "doc_id long, n long, digest binary, part int"), "jaccard-sets")
    # Sketches add up within the tasks first, then part by part; each part has a fixed size.
    partial = both.filter("part IS NOT NULL").select("part", "digest").mapInArrow(add, "part int, digest binary")
    parts = partial.repartition(SKETCH_PARTS, "part").mapInArrow(add, "part int, digest binary").collect()
    parts.sort(key=lambda r: r.part)
    counts = np.concatenate([np.frombuffer(r.digest, kind) for r in parts]) if parts else np.zeros(2 << bits, kind)
    return both.filter("part IS NULL").select("doc_id", "n", "digest"), counts.reshape(2, -1)


def matches_needed(frequency: np.ndarray, n: int, needed: int) -> int:
    """The l of least estimated cost; ``frequency``: rarest first."""
    most = min(MOST_MATCHES, needed)
    read = np.cumsum(frequency[: n - needed + most])[n - needed :]
    cost = read * (1 + COMPARE_COST / np.arange(1, most + 1))
    return int(np.argmin(cost)) + 1


def prefixes(docs: DataFrame, shared: Broadcast) -> DataFrame:
    """doc_id, n, matches and the prefix's tokens of each document with a set."""
    num, den = SIMILAR

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = shared.value
        bits = sketch.shape[1].bit_length() - 1
        noise = np.maximum(1, np.median(sketch, axis=1))
        for batch in batches:
            for rows in slices(batch, "text", SLICE):
                sets = shingle_sets(*text_buffer(rows.column("text")), SIZE)
                lengths = np.array([len(s) for s in sets])
                flat = np.concatenate(sets)
                one, two = sketch_cells(flat, bits)
                seen = np.minimum(sketch[0][one] / noise[0], sketch[1][two] / noise[1])
                # Rarity in steps of an eighth of a doubling; the hash settles the rest of the order.
                rank = np.minimum(8 * np.log2(np.maximum(seen, 1)), 63).astype(np.uint64)
                key = (rank << np.uint64(58)) | (mix(flat) >> np.uint64(6))
                tokens, matches, at = [], [], 0
                for n in lengths.tolist():
                    if n:
                        needed = -(-num * n // den)
                        reach = n - needed + min(MOST_MATCHES, needed)
                        k = key[at : at + n]
                        order = np.argpartition(k, reach - 1)[:reach] if reach < n else np.arange(n)
                        order = order[np.argsort(k[order])]
                        m = matches_needed(seen[at : at + n][order], n, needed)
                        tokens.append(flat[at : at + n][order[: n - needed + m]].view(np.int64))
                        matches.append(m)
                    else:
                        tokens.append(np.zeros(0, np.int64))
                        matches.append(0)
                    at += n
                places = np.r_[0, np.cumsum([len(t) for t in tokens])].astype(np.int32)
                yield pa.record_batch([rows.column("doc_id"), pa.array(lengths, pa.int64()), pa.array(matches, pa.int32()), pa.ListArray.from_arrays(pa.array(places), pa.array(np.concatenate(tokens)))], names=["doc_id", "n", "matches", "tokens"])

    return docs.mapInArrow(run, "doc_id long, n long, matches int, tokens array<long>").filter("n > 0")


def similar_sizes(a: str, b: str):
    num, den = SIMILAR
    return den * F.least(a, b) >= num * F.greatest(a, b)


def overlap_needed(a: str, b: str):
    """The least intersection that makes sets of these sizes similar."""
    num, den = SIMILAR
    return F.ceil((F.col(f"{a}_n") + F.col(f"{b}_n")) * num / (num + den))


def early(a: str, b: str):
    """Whether a shared token's places are among those that decide.

    Of the tokens before the k-th shared one only k - 1 are shared, so in each
    set of a similar pair its place is ``n - overlap + k - 1`` at most, and the
    first ``matches`` shared tokens lie below these bounds.
    """
    last = lambda p: F.col(f"{p}_n") - overlap_needed(a, b) + F.least(f"{a}_matches", f"{b}_matches") - 1
    return (F.col(f"{a}_at") <= last(a)) & (F.col(f"{b}_at") <= last(b))


def size_class(n):
    return F.floor(F.log(n) * CLASSES)


def with_classes(rows: DataFrame, own: str, others: str) -> DataFrame:
    """The rows once for each class of sizes among which a token at their place may decide.

    The bound of ``early``, solved for the other set's size: the later the
    place, the smaller that set must be.  Rows that no size allows go.
    """
    num, den = SIMILAR
    most = F.floor((F.col("n") + F.col("matches") - 1 - F.col("at")) * (num + den) / num) - F.col("n")
    least, top = F.ceil(F.col("n") * num / den), F.least(most, F.floor(F.col("n") * den / num))
    kept = rows.withColumns({"from": least, "to": top}).filter("`from` <= `to`")
    kept = kept.withColumn(own, size_class("n")).withColumn(others, F.explode(F.sequence(size_class("from"), size_class("to"))))
    return kept.drop("from", "to")


def pair_slices(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts of both sides have about ``SLICE`` bytes."""
    size = sum(np.diff(text_buffer(rows.column(c))[1]) for c in ("x_text", "y_text"))
    ends, start = np.cumsum(size), 0
    while start < rows.num_rows:
        before = ends[start] - size[start]
        stop = max(start + 1, int(np.searchsorted(ends, before + SLICE, side="right")))
        yield rows.slice(start, stop - start)
        start = stop


def linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (x, y) whose sets are similar, by comparing the sets.

    Texts are sent, as sets of 8-byte hashes would be more than twice as large.
    Pairs arrive in the order of y, whose set is made once for all its pairs of
    a task.
    """
    num, den = SIMILAR
    side = lambda p: texts.select(F.col("doc_id").alias(p), F.col("text").alias(f"{p}_text"))
    both = pairs.select("x", "y").join(side("x"), "x").join(side("y"), "y").select("x", "y", "x_text", "y_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_text, last_set = None, None
        for batch in batches:
            for rows in pair_slices(batch):
                xs, keep = shingle_sets(*text_buffer(rows.column("x_text")), SIZE), []
                for s, text in zip(xs, rows.column("y_text"), strict=True):
                    if last_text is None or not last_text.equals(text):
                        last_text, last_set = text, shingle_sets(*text_buffer(pa.array([text.as_py()], pa.string())), SIZE)[0]
                    common = len(np.intersect1d(s, last_set, assume_unique=True))
                    keep.append(den * common >= num * (len(s) + len(last_set) - common))
                yield rows.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "x long, y long").distinct()


def shared_tokens(prefix: DataFrame) -> DataFrame:
    """token, doc_id, n, matches, at of the prefix tokens that several documents hold."""
    total = prefix.agg(F.sum(F.size("tokens"))).first()[0] or 0
    tokens = prefix.select("doc_id", "n", "matches", F.posexplode("tokens").alias("at", "token")).select("token", "doc_id", "n", "matches", "at")
    hot = frequent(tokens, "token", total)
    rare = tokens.join(hot, "token", "left_anti").withColumn("many", F.count("*").over(Window.partitionBy("token"))).filter("many > 1").drop("many")
    # What the sample holds often is shared, without a count.
    return stored(rare.unionByName(tokens.join(hot, "token", "left_semi")), "jaccard-shared")


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows with c, the component their document is known to lie in."""
    known = labels.select(F.col("node").alias("doc_id"), F.col("component").alias("c"))
    return rows.drop("c").join(known, "doc_id", "left").withColumn("c", F.coalesce("c", "doc_id"))


def open_rows(rows: DataFrame) -> DataFrame:
    """Rows of tokens whose documents lie in several components, with the token's main component.

    hub is the document of the token in which it comes first, other the one
    outside the hub's component.  Only sums and least values are taken by token.
    """
    rows = stored(rows, "jaccard-labelled")
    parts = rows.groupBy("token", "c").agg(F.count("*").alias("k"), F.min(F.struct("at", "doc_id", "n", "matches", "c")).alias("least"))
    parts = stored(parts, "jaccard-parts")
    # Sums are written before they are joined, as Spark splits a hot key only where a shuffle feeds the join.
    tokens = stored(parts.groupBy("token").agg(F.max_by("c", F.struct("k", "c")).alias("main"), F.min("least").alias("hub"), F.count("*").alias("kinds")).filter("kinds > 1").drop("kinds"), "jaccard-tokens")
    other = stored(parts.join(tokens, "token").filter(F.col("c") != F.col("hub.c")).groupBy("token").agg(F.min("least").alias("other")), "jaccard-others")
    return stored(rows.join(tokens, "token").join(other, "token"), "jaccard-open")


def hub_tries(rows: DataFrame) -> DataFrame:
    """x, y: each document and the hub it shares most tokens with, if it shares as many as it must."""
    tries = rows.filter("doc_id <> hub.doc_id").groupBy(F.col("doc_id").alias("x"), F.col("hub.doc_id").alias("y"), "n", "matches", F.col("hub.n").alias("m"), F.col("hub.matches").alias("hub_matches")).agg(F.count("*").alias("met"))
    return tries.filter(similar_sizes("n", "m") & (F.col("met") >= F.least("matches", "hub_matches")))


def best_tries(tries: DataFrame) -> DataFrame:
    """x and its one hub y."""
    return stored(tries.groupBy("x").agg(F.max_by("y", F.struct("met", -F.col("y"))).alias("y")), "jaccard-tries")


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct()


def hub_labels(links: DataFrame) -> DataFrame:
    """node, component: each linked x gets the label of its hub y, which may hang on a third or on x."""
    upper = links.select(F.col("x").alias("y"), F.col("y").alias("top"))
    component = F.when(F.col("top") == F.col("x"), F.least("x", "y")).otherwise(F.coalesce("top", "y"))
    return links.join(upper, "y", "left").select(F.col("x").alias("node"), component.alias("component"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    with scratch():
        docs = clean_columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
        known = docs.filter("doc_id IS NOT NULL")
        sets_of, counts = first_pass(docs)
        classes = sets_of.filter("n > 0 AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("first"))
        classes = stored(classes, "jaccard-classes")
        if sets_of.filter("n > 0 AND doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").limit(1).count():
            known = known.dropDuplicates(["doc_id", "text"])
        only = classes.select(F.col("first").alias("doc_id"))

        sketch = docs.sparkSession.sparkContext.broadcast(counts)
        prefix = stored(prefixes(known, sketch).join(only, "doc_id", "left_semi"), "jaccard-prefixes")
        sketch.destroy()
        shared = shared_tokens(prefix)
        discard(prefix)
        # Only what shares a token is ever compared.
        texts = stored(known.join(shared.select("doc_id").distinct(), "doc_id", "left_semi"), "jaccard-texts")

        # First every document with the hub of a token.
        hubs = stored(shared.groupBy("token").agg(F.min(F.struct("at", "doc_id", "n", "matches")).alias("hub")), "jaccard-hubs")
        first = best_tries(hub_tries(shared.join(hubs, "token")))
        links = stored(linked(first, texts), "jaccard-links")
        rows = open_rows(with_labels(shared, hub_labels(links)))
        # Then with the hub or, in its component, with the other.
        rows_of = rows.withColumn("hub", F.when(F.col("c") != F.col("hub.c"), F.col("hub")).otherwise(F.col("other")))
        old = first.unionByName(first.select(F.col("y").alias("x"), F.col("x").alias("y")))
        more = best_tries(hub_tries(rows_of).join(old, ["x", "y"], "left_anti"))
        tried = ordered(first.unionByName(more))
        links = stored(links.unionByName(linked(more, texts)), "jaccard-links")
        labels = stored(components(links), "jaccard-labels")
        rows = open_rows(with_labels(rows.drop("main", "hub", "other"), labels))
        discard(shared)

        # Every pair of a token across components has a row outside the token's main component.
        side = lambda p: [F.col("doc_id").alias(p), *(F.col(c).alias(f"{p}_{c}") for c in ("n", "matches", "at", "c"))]
        x = with_classes(rows.filter("c <> main"), "x_class", "y_class").select("token", "x_class", "y_class", *side("x"))
        y = with_classes(rows, "y_class", "x_class").select("token", "x_class", "y_class", *side("y"), (F.col("c") == F.col("main")).alias("in_main"))
        pairs = x.join(y, ["token", "x_class", "y_class"]).filter((F.col("x_c") != F.col("y_c")) & (F.col("in_main") | (F.col("x") < F.col("y"))) & similar_sizes("x_n", "y_n") & early("x", "y"))
        pairs = pairs.groupBy(F.least("x", "y").alias("y"), F.greatest("x", "y").alias("x"), F.least("x_matches", "y_matches").alias("need")).agg(F.count("*").alias("met")).filter("met >= need")
        rest = stored(pairs.select("x", "y").join(tried, ["x", "y"], "left_anti"), "jaccard-rest")
        # What is left links whole components.
        across = stored(linked(rest, texts), "jaccard-links")
        label = labels.select("node", "component")
        across = across.join(label.withColumnsRenamed({"node": "x", "component": "cx"}), "x", "left").join(label.withColumnsRenamed({"node": "y", "component": "cy"}), "y", "left")
        tops = components(across.select(F.coalesce("cx", "x").alias("x"), F.coalesce("cy", "y").alias("y")))
        tops = tops.toDF("component", "top")
        final = classes.select("first").join(labels, F.col("first") == F.col("node"), "left").select("first", F.coalesce("component", "first").alias("component")).join(tops, "component", "left")
        final = final.select(F.col("first").alias("node"), F.coalesce("top", "component").alias("component"))
        placed = sets_of.join(classes, "digest", "left").join(final, F.col("first") == F.col("node"), "left")
        result = placed.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "first", "doc_id")).alias("component_id"))
        return stored(result, "jaccard-components", keep=True)

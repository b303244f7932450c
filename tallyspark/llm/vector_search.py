"""Exact top-k inner products by vector-approximation files.

Vectors are packed into blocks, and each block is stored with its approximation
file, made once: for each dimension equal cells between the block's least and
greatest value, and for each component the number of its cell in one byte.

Blocks are dealt to groups of a bounded size, and blocks of queries pass by
each group: only queries, a small part of the rows, are sent more than once.
The cells of a block give an upper and a lower bound of each score.  What
cannot reach the k-th best lower bound so far is out, over all blocks of the
group and below the k-th best score in a few sample blocks, which every query
knows beforehand.  Of what is left, exact vectors are read in the order of the
upper bounds, and reading ends when the k-th score is certain.  The k best of
the groups are then ranked.

Components x become floor(1024 * x).  Vectors that are null or hold a null or
a component that isn't finite take no part, nor do rows whose id is null.
Vectors of different length count as filled up with zeros.  A repeated row is
a candidate of its own, as a query too; only the query's own row is left out.
Ties go to the smaller id; equal ids keep one rank each.  Scores are exact
while they fit into a long.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

SCALE = 1024
K = 10
#: Rows and components of a block at most (one row at least).
BLOCK = 4096
BLOCK_SIZE = 1 << 18
QUERY_BLOCK = 512
#: Cells of a dimension; their numbers take a byte.
CELLS = 256
#: Blocks of a group, about; blocks that give each query its first threshold.
GROUP_BLOCKS = 48
SAMPLE_BLOCKS = 4
#: Candidates of a group held at once before their exact vectors are read.
PENDING = 1 << 20

FILE = "block long, n int, dim int, ids binary, width int, data binary, low binary, step binary, cells binary"
RESULT = "query_row long, query_id long, vec_id long, score long"


def valid(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def packed(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """Blocks (see ``FILE``): ids, whole-number components and the approximation file."""
    rows = vectors.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), F.col(f"`{vector_column}`").alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & valid(F.col("vector")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 24
        for batch in batches:
            widest = int(batch.column("vector").value_lengths().to_numpy().max(initial=1))
            most = max(1, min(BLOCK, BLOCK_SIZE // max(widest, 1)))
            for start in range(0, batch.num_rows, most):
                part = batch.slice(start, most)
                lists = part.column("vector")
                length = lists.value_lengths().to_numpy()
                dim = int(length.max())
                whole = np.floor(SCALE * lists.flatten().to_numpy().astype(np.float64)).astype(np.int64)
                out = np.zeros((len(length), dim), np.int64)
                row = np.repeat(np.arange(len(length)), length)
                out[row, np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)] = whole
                narrow = out.astype("<i4") if not out.size or np.abs(out).max() < 2**31 else out
                low, step, cells = approximation(out)
                raw = [part.column("vec_id").to_numpy().astype("<i8"), narrow, low, step, cells]
                ids, data, low, step, cells = (pa.array([x.tobytes()]) for x in raw)
                yield pa.record_batch([pa.array([at]), pa.array([len(length)], pa.int32()), pa.array([dim], pa.int32()), ids, pa.array([narrow.itemsize], pa.int32()), data, low, step, cells], names=[c.split()[0] for c in FILE.split(", ")])
                at += 1

    return rows.mapInArrow(run, FILE)


def approximation(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least value and cell width of each dimension, and the cell of each component."""
    low, high = vectors.min(axis=0).astype(float), vectors.max(axis=0).astype(float)
    step = np.maximum((high - low + 1) / CELLS, 1e-9)
    return low, step, np.clip((vectors - low) / step, 0, CELLS - 1).astype(np.uint8)


class Block:
    """A block's ids, row numbers, exact vectors and approximation file."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], "<i8")
        n, dim = len(self.ids), row["dim"]
        self.rows = row["block"] * BLOCK + np.arange(n)
        self.exact = np.frombuffer(row["data"], f"<i{row['width']}").reshape(n, dim)
        self.low, self.step = np.frombuffer(row["low"]), np.frombuffer(row["step"])
        self.cells = np.frombuffer(row["cells"], np.uint8).reshape(n, dim)

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Middle of the bounds of each (query, vector), and how far they reach for each query."""
        dim = min(queries.shape[1], len(self.low))
        q, low, step = queries[:, :dim].astype(np.float64), self.low[:dim], self.step[:dim]
        about = (q * step) @ self.cells[:, :dim].T.astype(np.float64) + (q @ (low + step / 2))[:, None]
        far = np.abs(q) @ np.maximum(np.abs(low), np.abs(low + CELLS * step))
        # A query of zeros scores 0 with any vector, so its bounds meet.
        return about, (np.abs(q) @ (step / 2) * (1 + 1e-9) + far * 1e-12 + 1) * q.any(axis=1)

    def thinned(self, k: int) -> Block:
        """The block with the k + 1 least ids of each vector: of equal vectors no other can be among the k best of a query."""
        same = np.unique(np.ascontiguousarray(self.exact).view(f"V{self.exact.shape[1] * self.exact.itemsize}").ravel() if self.exact.shape[1] else np.zeros(len(self.ids)), return_inverse=True)[1]
        order = np.lexsort((self.rows, self.ids, same))
        rank = np.arange(len(order)) - np.searchsorted(same[order], same[order])
        if (rank <= k).all():
            return self
        keep, out = np.sort(order[rank <= k]), object.__new__(Block)
        out.ids, out.rows, out.exact, out.cells, out.low, out.step = self.ids[keep], self.rows[keep], self.exact[keep], self.cells[keep], self.low, self.step
        return out

    def scores(self, queries: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Inner products of each query and the vector at its place, as longs."""
        dim = min(queries.shape[1], self.exact.shape[1])
        return np.einsum("ij,ij->i", queries[:, :dim], self.exact[at, :dim].astype(np.int64))


def query_blocks(blocks: DataFrame, every: int) -> DataFrame:
    """The rows whose id ``every`` divides, packed anew."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                ids, vectors = block.ids, block.exact
                at = np.flatnonzero(ids % every == 0)
                if len(at):
                    data = [vectors[i].astype("<i8").tobytes() for i in at]
                    yield pa.record_batch([pa.array(block.rows[at]), pa.array(ids[at]), pa.array(data)], names=["row", "id", "data"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if parts:
            part = pa.Table.from_batches(parts)
            rows = [np.frombuffer(x, "<i8") for x in part.column("data").to_pylist()]
            out = np.zeros((len(rows), max(map(len, rows))), "<i8")
            for i, x in enumerate(rows):
                out[i, : len(x)] = x
            yield pa.record_batch([pa.array([TaskContext.get().partitionId()])] + [pa.array([part.column(c).to_numpy().astype("<i8").tobytes()]) for c in ("row", "id")] + [pa.array([out.shape[1]], pa.int32()), pa.array([out.tobytes()])], names=["q_block", "q_rows", "q_ids", "q_dim", "q_data"])

    queries = stored(blocks.mapInArrow(pick, "row long, id long, data binary"), "search-queries")
    n_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    # Dealt out in turn, each partition gets QUERY_BLOCK rows or fewer.
    packed_queries = queries.repartition(n_blocks).mapInArrow(pack, "q_block long, q_rows binary, q_ids binary, q_dim int, q_data binary")
    return stored(packed_queries, "search-query-blocks")


def kth(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th greatest of each row, or the least number where there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, values.shape[1] - k, axis=1)[:, values.shape[1] - k]


def best_of_group(blocks: list[Block], queries: np.ndarray, own: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """query, id and score of the k best candidates of each query, and the number of exact vectors read.

    ``own`` holds the row numbers of the queries, ``least`` the score that each
    query's k best have in any case.  Blocks should be thinned, so that equal
    vectors are few.  Whenever ``PENDING`` candidates are held, their vectors
    are read and the k best so far raise what later ones must reach.
    """
    n = len(queries)
    best_low = np.full((n, k), -np.inf)
    nothing = np.iinfo(np.int64).min
    score, ids, filled = np.full((n, k), nothing), np.zeros((n, k), np.int64), np.zeros((n, k), bool)
    held: list[tuple[np.ndarray, ...]] = []
    reads = 0

    def certain() -> np.ndarray:
        """The score that each query's k best have at least, by exact scores and lower bounds."""
        return np.maximum(np.maximum(least, best_low[:, k - 1]), np.where(filled[:, k - 1], score[:, k - 1].astype(float), -np.inf))

    def settle() -> None:
        """Read the held candidates in the order of their bounds, twice as many each time, until the k-th score is certain."""
        nonlocal score, ids, filled, reads
        query, block, place, upper = map(np.concatenate, zip(*held, strict=True))
        held.clear()
        fine = upper >= certain()[query]
        query, block, place, upper = (x[fine] for x in (query, block, place, upper))
        order = np.lexsort((-upper, query))
        query, block, place, upper = (x[order] for x in (query, block, place, upper))
        nth = np.arange(len(query)) - np.searchsorted(query, query)
        start, size = 0, k
        while start <= int(nth.max(initial=-1)):
            bar = certain()
            some = np.flatnonzero((nth >= start) & (nth < start + size) & (upper >= (bar - np.abs(np.where(np.isinf(bar), 0, bar)) * 1e-12)[query]))
            if not len(some):
                break
            new_score, new_id = np.zeros(len(some), np.int64), np.zeros(len(some), np.int64)
            for number in np.unique(block[some]):
                at = np.flatnonzero(block[some] == number)
                new_score[at] = blocks[number].scores(queries[query[some[at]]], place[some[at]])
                new_id[at] = blocks[number].ids[place[some[at]]]
            reads += len(some)
            old = np.nonzero(filled)
            q, i, s = np.r_[old[0], query[some]], np.r_[ids[filled], new_id], np.r_[score[filled], new_score]
            by = np.lexsort((i, -s, q))
            q, i, s = q[by], i[by], s[by]
            rank = np.arange(len(q)) - np.searchsorted(q, q)
            top = rank < k
            score, ids, filled = np.full((n, k), nothing), np.zeros((n, k), np.int64), np.zeros((n, k), bool)
            score[q[top], rank[top]], ids[q[top], rank[top]], filled[q[top], rank[top]] = s[top], i[top], True
            start, size = start + size, size * 2

    pending = 0
    for number, b in enumerate(blocks):
        about, slack = b.bounds(queries)
        about[own[:, None] == b.rows[None, :]] = -np.inf
        lows = about - slack[:, None]
        top = min(k, lows.shape[1])
        lows = np.partition(lows, lows.shape[1] - top, axis=1)[:, lows.shape[1] - top :]
        best_low = -np.sort(-np.concatenate([best_low, lows], axis=1), axis=1)[:, :k]
        near = (about >= (certain() - slack)[:, None]) & ~np.isneginf(about)
        # Where all scores tie, the least ids are the best.
        for row in np.flatnonzero(slack == 0):
            at = np.flatnonzero(near[row])
            near[row] = False
            near[row, at[np.lexsort((b.rows[at], b.ids[at]))[:k]]] = True
        q, at = np.nonzero(near)
        held.append((q, np.full(len(q), number), at, about[q, at] + slack[q]))
        pending += len(q)
        if pending >= PENDING:
            settle()
            pending = 0
    if held:
        settle()
    query, rank = np.nonzero(filled)
    return query, ids[query, rank], score[query, rank], reads


def query_arrays(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    own, ids = np.frombuffer(row["q_rows"], "<i8"), np.frombuffer(row["q_ids"], "<i8")
    return own, ids, np.frombuffer(row["q_data"], "<i8").reshape(len(own), row["q_dim"])


def with_thresholds(queries: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """Query blocks with q_least: each query's k-th best score in a few blocks."""
    sample = blocks.limit(SAMPLE_BLOCKS).collect()
    shared = queries.sparkSession.sparkContext.broadcast([r.asDict() for r in sample])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Block(r).thinned(k) for r in shared.value]
        for batch in batches:
            least = []
            for row in batch.to_pylist():
                own, _, q = query_arrays(row)
                out = np.full(len(own), -np.inf)
                if held:
                    a, _, s, _ = best_of_group(held, q, own, out, k)
                    last = np.flatnonzero(np.arange(len(a)) - np.searchsorted(a, a) == k - 1)
                    out[a[last]] = s[last]
                least.append(out.tobytes())
            yield pa.record_batch([*batch.columns, pa.array(least, pa.binary())], names=[*batch.schema.names, "q_least"])

    return queries.mapInArrow(run, "q_block long, q_rows binary, q_ids binary, q_dim int, q_data binary, q_least binary")


def top_k(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", k: int = K, every: int = 100) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` best of each query.

    Queries are the rows whose id ``every`` divides; every row is a candidate.
    """
    spark = vectors.sparkSession
    blocks = stored(packed(vectors, id_column, vector_column), "search-blocks")
    queries = with_thresholds(query_blocks(blocks, every), blocks, k)
    n = blocks.count()
    groups = max(1, -(-n // GROUP_BLOCKS), min(n, spark.sparkContext.defaultParallelism))
    # Blocks of a group come first, so the queries that follow meet all of them.
    file = blocks.withColumn("group", F.pmod(F.xxhash64("block"), F.lit(groups))).withColumn("turn", F.lit(0))
    asked = queries.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))).withColumn("turn", F.lit(1))
    both = file.unionByName(asked, allowMissingColumns=True).repartition(groups, "group").sortWithinPartitions("group", "turn")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["group"] != group:
                    group, held = row["group"], []
                if not row["turn"]:
                    held.append(Block(row).thinned(k))
                elif held:
                    own, q_ids, q = query_arrays(row)
                    a, ids, s, _ = best_of_group(held, q, own, np.frombuffer(row["q_least"]), k)
                    yield pa.record_batch([pa.array(own[a]), pa.array(q_ids[a]), pa.array(ids), pa.array(s)], names=["query_row", "query_id", "vec_id", "score"])

    best = both.mapInArrow(run, RESULT)
    ranked = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

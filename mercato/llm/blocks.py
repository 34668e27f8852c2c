"""Integer vectors in binary blocks, and the join of query blocks with candidate blocks.

A block is one row that holds up to `BLOCK_ROWS` vectors.  Blocks are packed
where the rows lie, so candidates are not shuffled one by one; a stated set of
queries meets them block by block, a tile of scores for each pair.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors in a block at most; a position within a block has this many bits.
POSITION_BITS = 12
BLOCK_ROWS = 1 << POSITION_BITS
#: Numbers in a block at most, so wide vectors make blocks of fewer rows.
BLOCK_VALUES = 1 << 20
#: Queries in a block, and candidate blocks that meet a query block in one go, at most.
QUERY_ROWS = 256
GROUP_BLOCKS = 16

BLOCK = "block long, n int, dims int, width int, ids array<long>, labels array<int>, copies array<long>, vectors binary"


def takes_part(vector: Column) -> Column:
    """Whether a vector is there and all its numbers are there and finite."""
    return F.coalesce(F.forall(vector, lambda x: F.abs(x.cast("double")) < F.lit(float("inf"))), F.lit(False))


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) for each x; exact Python integers where they outgrow 64 bits."""
    whole = np.floor(values.astype(np.float64) * scale)
    if len(whole) and np.abs(whole).max() >= 2.0**62:
        return np.array([int(x) for x in whole], dtype=object)
    return whole.astype(np.int64)


def pack(rows: DataFrame, scale: int, limit: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` (id, label, copies, vector) as blocks, with floor(scale * x) for each number x.

    Vectors of a block may differ in length: missing numbers count as zero.  Block
    numbers follow the tasks, so the result must be stored before it is used twice.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        held: list[pa.RecordBatch] = []
        count = widest = 0
        for batch in batches:
            lengths = np.diff(np.asarray(batch.column("vector").offsets))
            start = 0
            for at, length in enumerate(lengths.tolist()):
                if count and (count == limit or (count + 1) * max(widest, length) > BLOCK_VALUES):
                    held.append(batch.slice(start, at - start))
                    yield _block(held, number, scale)
                    number, held, start, count, widest = number + 1, [], at, 0, 0
                count, widest = count + 1, max(widest, length)
            held.append(batch.slice(start))
        if count:
            yield _block(held, number, scale)

    return rows.select("id", "label", "copies", F.col("vector").cast("array<double>").alias("vector")).mapInArrow(blocks, BLOCK)


def _block(held: list[pa.RecordBatch], number: int, scale: int) -> pa.RecordBatch:
    table = pa.Table.from_batches(held).combine_chunks()
    lists = table.column("vector").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    lengths = np.diff(np.asarray(lists.offsets))
    flat = integers(np.asarray(lists.flatten()), scale)
    matrix = np.zeros((len(lengths), int(lengths.max(initial=0))), dtype=flat.dtype)
    matrix[np.arange(matrix.shape[1]) < lengths[:, None]] = flat
    return block_batch(number, *[table.column(c).combine_chunks() for c in ("id", "label", "copies")], matrix)


def block_batch(number: int, ids: pa.Array, labels: pa.Array, copies: pa.Array, matrix: np.ndarray, **more: bytes) -> pa.RecordBatch:
    """One block as a batch of one row; ``more`` are further binary columns."""
    width, data = _bytes(matrix)
    columns = {
        "block": pa.array([number], pa.int64()), "n": pa.array([matrix.shape[0]], pa.int32()),
        "dims": pa.array([matrix.shape[1]], pa.int32()), "width": pa.array([width], pa.int32()),
        "ids": _one_list(ids, pa.int64()), "labels": _one_list(labels, pa.int32()), "copies": _one_list(copies, pa.int64()),
        "vectors": pa.array([data], pa.binary()),
    }
    return pa.RecordBatch.from_pydict(columns | {k: pa.array([v], pa.binary()) for k, v in more.items()})


def _one_list(values: pa.Array, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks() if values.num_chunks != 1 else values.chunk(0)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values.cast(kind))


def _bytes(matrix: np.ndarray) -> tuple[int, bytes]:
    """Bytes for each number and the numbers in their smallest integer type; width 0: decimal text."""
    if matrix.dtype == object:
        return 0, " ".join(map(str, matrix.ravel())).encode()
    most = max(int(matrix.max(initial=0)), -int(matrix.min(initial=0)) - 1)
    width = next(w for w in (1, 2, 4, 8) if most < 1 << (8 * w - 1))
    return width, matrix.astype(f"<i{width}").tobytes()


def numbers(data: bytes, width: int) -> np.ndarray:
    """The numbers that `_bytes` wrote."""
    if width == 0:
        return np.array([int(x) for x in data.split()], dtype=object)
    return np.frombuffer(data, dtype=f"<i{width}").astype(np.int64)


class Block:
    """A block read from a row of a batch whose columns start with ``prefix``."""

    def __init__(self, batch: pa.RecordBatch, row: int, prefix: str = ""):
        self.get = lambda name: batch.column(prefix + name)[row]
        self.number, n, dims = (self.get(c).as_py() for c in ("block", "n", "dims"))
        self.matrix = numbers(self.get("vectors").as_py(), self.get("width").as_py()).reshape(n, dims)

    def longs(self, name: str) -> tuple[np.ndarray, np.ndarray]:
        """Values of an array column, and where they are null (zero stands there)."""
        values = self.get(name).values
        return np.asarray(values.fill_null(0)).astype(np.int64), np.asarray(values.is_null())


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices without the columns that only one has: there the other counts as zero."""
    d = min(a.shape[1], b.shape[1])
    return a[:, :d], b[:, :d]


def equal_rows(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows are equal where a missing number counts as zero."""
    d = min(a.shape[1], b.shape[1])
    return (a[:, :d] == b[:, :d]).all(axis=1) & (a[:, d:] == 0).all(axis=1) & (b[:, d:] == 0).all(axis=1)


def largest_product(a: np.ndarray, b: np.ndarray) -> int:
    """No inner product of a row of ``a`` with one of ``b``, nor a part of its sum, is larger."""
    size = lambda m: max(int(m.max(initial=0)), -int(m.min(initial=0)))
    return a.shape[1] * size(a) * size(b)


def multiply(a: np.ndarray, b: np.ndarray, bound: int) -> np.ndarray:
    """a @ b in exact integers, given a bound of every partial sum."""
    if bound < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b if bound < 1 << 62 and object not in (a.dtype, b.dtype) else a.astype(object) @ b.astype(object)


def ordered_keys(scores: np.ndarray, rank: np.ndarray, bound: int) -> np.ndarray:
    """One number for each score: larger for a higher score, then for a smaller rank within the block."""
    if bound >= 1 << (62 - POSITION_BITS):
        scores = scores.astype(object)
    return scores * BLOCK_ROWS + (BLOCK_ROWS - 1 - rank)


def id_rank(ids: np.ndarray, null: np.ndarray) -> np.ndarray:
    """Place of each row in the order of ids, nulls last."""
    rank = np.empty(len(ids), dtype=np.int64)
    rank[np.lexsort((ids, null))] = np.arange(len(ids))
    return rank


class Best:
    """The first ``k`` hits of each group by falling score, then rising id (null last), merged as hits come."""

    def __init__(self, k: int):
        self.k = k
        self.hits: dict[str, np.ndarray] = {}

    def add(self, group: np.ndarray, score: np.ndarray, ident: np.ndarray, null: np.ndarray, **more: np.ndarray) -> None:
        new = {"group": group, "score": score.astype(np.int64), "id": ident, "null": null} | more
        if self.hits:
            new = {c: np.concatenate((self.hits[c], v)) for c, v in new.items()}
        order = np.lexsort((new["id"], new["null"], ~new["score"], new["group"]))
        grouped = new["group"][order]
        first = np.flatnonzero(np.concatenate(([True], grouped[1:] != grouped[:-1]))[: len(grouped)])
        place = np.arange(len(grouped)) - np.repeat(first, np.diff(np.append(first, len(grouped))))
        self.hits = {c: v[order[place < self.k]] for c, v in new.items()}


def spread(queries: DataFrame, candidates: DataFrame, home: bool | None = None) -> DataFrame:
    """Every pair of a query block (``q_`` columns) and a candidate block (``c_`` columns).

    Candidate blocks fall into groups of up to `GROUP_BLOCKS`, fewer while that keeps
    the machine busy; each query block goes to every group, so it is sent once for
    that many blocks.  ``home``: only each query block's own group, or all others.
    """
    spark = queries.sparkSession
    n_blocks = candidates.count()  # of blocks, not rows; it reads no column
    groups = max(1, -(-n_blocks // GROUP_BLOCKS), min(n_blocks, 2 * spark.sparkContext.defaultParallelism))
    right = candidates.select(F.pmod(F.xxhash64("block"), F.lit(groups)).alias("g"), *[F.col(c).alias(f"c_{c}") for c in candidates.columns])
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))
    left = queries.select(*[F.col(c).alias(f"q_{c}") for c in queries.columns], F.pmod(F.xxhash64(F.lit(7), "block"), F.lit(groups)).alias("home"))
    if home:
        left = left.withColumnRenamed("home", "g")
    else:
        left = left.withColumn("g", every)
        left = (left if home is None else left.filter("g <> home")).drop("home")
    # Sort-merge keeps the blocks of one group at a time, whatever the number of groups in a task.
    return left.hint("merge").join(right, "g").drop("g")


def over_tiles(pairs: DataFrame, schema: str, start: Callable, visit: Callable, end: Callable) -> DataFrame:
    """Walk over `spread` pairs: ``state = start(query block)``, ``visit(state, candidate block)``, ``end(state)`` gives a batch.

    Pairs of one query block usually come together and share a state.  Where they
    do not, it only means more states, whose hits meet in the next step.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, state = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                if (at := batch.column("q_block")[row].as_py()) != number:
                    if state is not None:
                        yield end(state)
                    number, state = at, start(Block(batch, row, "q_"))
                visit(state, Block(batch, row, "c_"))
        if state is not None:
            yield end(state)

    return pairs.mapInArrow(walk, schema)


def first_others(hits: DataFrame, k: int) -> DataFrame:
    """The first k of each query's ``hits`` (q, id, score, same) that are other rows, with their rank from 1.

    Of the hits that equal the query one is the query itself, so the first k + 1 are enough.
    """
    every = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    cut = hits.withColumn("place", F.row_number().over(every)).filter(F.col("place") <= k + 1)
    own = F.row_number().over(Window.partitionBy("q", "same").orderBy("place"))
    others = cut.withColumn("nth", own).filter(~(F.col("same") & (F.col("nth") == 1)))
    rank = F.row_number().over(Window.partitionBy("q").orderBy("place"))
    return others.withColumn("rank", rank).filter(F.col("rank") <= k).drop("place", "nth", "same")

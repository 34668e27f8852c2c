"""Exact top-k search by inner product: a KD-tree for each block of candidates.

A block's tree splits at the median of its widest dimension down to leaves of
about `LEAF` vectors; every node keeps the tight box of its vectors.  No vector of
a node scores higher with a query than the best corner of the box, so a node whose
bound cannot beat the query's k-th score is left with all below it.  A query first
searches the group of blocks that hashing deals it; its k-th score there is
propagated to all others, and from block to block within a group.

Every candidate lies in a block and only bounds leave nodes out, so results are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm import blocks
from mercato.llm.tables import stored

#: Vectors in a leaf, about.
LEAF = 64

TREE = blocks.BLOCK + ", low binary, high binary, box_width int"
HITS = "q long, query_id long, copies long, id long, score long, same boolean"


# --- trees --------------------------------------------------------------------

def depth(n: int) -> int:
    return max(0, (max(n, 1) - 1) // LEAF).bit_length()


def segments(n: int, levels: int) -> list[np.ndarray]:
    """Row bounds of the nodes on each level, the root first: 2**level + 1 numbers."""
    out = [np.array([0, n])]
    for _ in range(levels):
        last = out[-1]
        out.append(np.sort(np.concatenate((last, (last[:-1] + last[1:]) // 2))))
    return out


def build_tree(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order of rows, low corners, high corners); corners level by level, the root first.

    Equal values keep their order, so copies of one vector split by position.
    """
    n, order = len(matrix), np.arange(len(matrix))
    levels = segments(n, depth(n))
    low, high = [], []
    for cuts in levels:
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            part = matrix[order[a:b]]
            low.append(part.min(axis=0))
            high.append(part.max(axis=0))
            if cuts is not levels[-1] and matrix.shape[1]:
                widest = int(np.argmax(high[-1] - low[-1]))
                order[a:b] = order[a:b][np.argsort(part[:, widest], kind="stable")]
    return order, np.array(low), np.array(high)


def plant_trees(packed: DataFrame) -> DataFrame:
    """Each block with its rows in tree order and the boxes of all nodes."""

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = blocks.Block(batch, row)
                by_id = np.argsort(blocks.id_rank(*block.longs("ids")))
                order, low, high = build_tree(block.matrix[by_id])
                order = by_id[order]
                width, corners = blocks._bytes(np.concatenate((low, high)))
                half = len(corners) // 2
                if width == 0:
                    half = len(" ".join(map(str, low.ravel())).encode())
                arrays = [block.get(c).values.take(pa.array(order)) for c in ("ids", "labels", "copies")]
                tree = blocks.block_batch(block.number, *arrays, block.matrix[order], low=corners[:half], high=corners[half:])
                yield tree.append_column("box_width", pa.array([width], pa.int32()))

    return packed.mapInArrow(plant, TREE)


# --- search -------------------------------------------------------------------

class Search:
    """One query block and what it has found so far."""

    def __init__(self, block: blocks.Block, k: int):
        self.block, self.k = block, k
        self.ids, self.null = block.longs("ids")
        self.best = blocks.Best(k + 1)
        bounds, unknown = block.longs("bounds")
        #: The score a candidate must reach; -inf as None.
        self.bound = [None if u else int(b) for b, u in zip(bounds, unknown, strict=True)]

    def visit(self, tree: blocks.Block) -> None:
        queries, vectors = blocks.same_width(self.block.matrix, tree.matrix)
        rank = blocks.id_rank(*tree.longs("ids"))
        keys, floor, bound = search_tree(queries, vectors, rank, boxes(tree), self.floors(), self.k + 1)
        row, column = np.nonzero(keys > floor[:, None])
        if not len(row):
            return
        found = keys[row, column]
        place = np.empty_like(rank)
        place[rank] = np.arange(len(rank))
        at = place[(blocks.BLOCK_ROWS - 1 - found % blocks.BLOCK_ROWS).astype(np.int64)]
        ids, null = (x[at] for x in tree.longs("ids"))
        same = (ids == self.ids[row]) & ~null
        same[same] = blocks.equal_rows(self.block.matrix[row[same]], tree.matrix[at[same]])
        self.best.add(row, found // blocks.BLOCK_ROWS, ids, null, same=same)
        self.propagate()

    def floors(self) -> list[int | None]:
        """Keys that are too low: those of scores below the bound."""
        return [None if b is None else b * blocks.BLOCK_ROWS - 1 for b in self.bound]

    def propagate(self) -> None:
        """The k-th score of other rows found so far bounds what follows."""
        for row, score in kth_scores(self.best.hits, self.k):
            if self.bound[row] is None or score > self.bound[row]:
                self.bound[row] = score

    def batch(self) -> pa.RecordBatch:
        hits = self.best.hits or {c: np.zeros(0, np.int64) for c in ("group", "score", "id")} | {c: np.zeros(0, bool) for c in ("null", "same")}
        group = hits["group"]
        copies, _ = self.block.longs("copies")
        return pa.RecordBatch.from_arrays(
            [
                pa.array((self.block.number << blocks.POSITION_BITS) + group, pa.int64()), pa.array(self.ids[group], pa.int64()),
                pa.array(copies[group], pa.int64()), pa.array(hits["id"], pa.int64(), mask=hits["null"]),
                pa.array(hits["score"], pa.int64()), pa.array(hits["same"], pa.bool_()),
            ],
            names=["q", "query_id", "copies", "id", "score", "same"],
        )


def kth_scores(hits: dict[str, np.ndarray], k: int) -> list[tuple[int, int]]:
    """(query, k-th score) where k hits are other rows; of hits that equal the query one is the query itself."""
    out, group = [], hits["group"]
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(group)], strict=True):
        own = int(hits["same"][a:b].any())
        if b - a - own >= k:
            out.append((int(group[a]), int(hits["score"][a + k - 1 + own])))
    return out


def boxes(tree: blocks.Block) -> tuple[np.ndarray, np.ndarray]:
    width = tree.get("box_width").as_py()
    low, high = (blocks.numbers(tree.get(c).as_py(), width) for c in ("low", "high"))
    nodes = (2 << depth(len(tree.matrix))) - 1
    return low.reshape(nodes, -1), high.reshape(nodes, -1)


def search_tree(
    queries: np.ndarray, vectors: np.ndarray, rank: np.ndarray, corners: tuple[np.ndarray, np.ndarray], floors: list[int | None], k: int
) -> tuple[np.ndarray, np.ndarray, int]:
    """The k largest keys of each query above its floor, as (keys, floors, bound of all scores).

    All queries of a block go down together.  From a level to the next a query keeps
    the nodes whose bound can beat its floor; the leaves that are left are taken best
    first, 1, 2, 4 ... at a time, until the next one cannot beat the k-th key.
    """
    low, high = (c[:, : queries.shape[1]] for c in corners)
    bound = max(blocks.largest_product(queries, np.concatenate((low, high))), 1)
    lowest = -(bound + 1) * blocks.BLOCK_ROWS
    kind = np.int64 if bound < 1 << (62 - blocks.POSITION_BITS) else object
    floor = np.array([lowest if f is None else max(lowest, min(f, -lowest)) for f in floors], dtype=kind)
    positive, negative = np.maximum(queries, 0), np.minimum(queries, 0)
    levels = segments(len(vectors), depth(len(vectors)))
    alive = np.ones((len(queries), 1), dtype=bool)
    for level, cuts in enumerate(levels):
        nodes = slice((1 << level) - 1, (2 << level) - 1)
        least = np.minimum.reduceat(rank, cuts[:-1])
        top = np.full((len(queries), len(cuts) - 1), lowest, dtype=kind)
        going = np.flatnonzero(alive.any(axis=1))
        corner = blocks.multiply(positive[going], high[nodes].T, bound) + blocks.multiply(negative[going], low[nodes].T, bound)
        top[going] = blocks.ordered_keys(corner, least, bound)
        alive = alive & (top > floor[:, None])
        if level + 1 < len(levels):
            alive = np.repeat(alive, 2, axis=1)
    top[~alive] = lowest
    order = np.argsort(-top, axis=1, kind="stable")
    top = np.take_along_axis(top, order, axis=1)
    keys = np.full((len(queries), k), lowest, dtype=kind)
    cuts, start, step = levels[-1], 0, 1
    while start < top.shape[1]:
        least_key = np.maximum(floor, keys.min(axis=1))
        row, column = np.nonzero(top[:, start : start + step] > least_key[:, None])
        if not len(row):
            break
        leaves = order[row, start + column]
        by_leaf = np.argsort(leaves, kind="stable")
        for mine in np.split(by_leaf, np.flatnonzero(np.diff(leaves[by_leaf])) + 1):
            a, b = cuts[leaves[mine[0]]], cuts[leaves[mine[0]] + 1]
            asking = row[mine]
            found = blocks.ordered_keys(blocks.multiply(queries[asking], vectors[a:b].T, bound), rank[a:b], bound)
            better = np.flatnonzero((found > np.maximum(floor[asking], keys[asking].min(axis=1))[:, None]).any(axis=1))
            if len(better):
                both = np.concatenate((keys[asking[better]], found[better]), axis=1)
                keys[asking[better]] = np.sort(both, axis=1)[:, -k:]
        start, step = start + step, step * 2
    return keys, floor, bound


# --- Spark jobs ---------------------------------------------------------------

def search(rows: DataFrame, is_query: Column, k: int, scale: int = 1, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` rows of highest inner product with each query row: query_id, rank, key, score.

    Numbers x count as floor(scale * x).  Ties go to the smaller key, null keys last.
    Rows with a null vector, or a null or non-finite number in it, take no part.  A row is
    not its own candidate; a repeated row is one of its other copies', and is a query
    once for each copy.  An empty vector scores zero with all; in vectors of different
    lengths the missing numbers count as zero.  A score beyond 64 bits is an error.
    Only ``key`` and ``vector`` are read, so other columns may have any name.
    """
    rows = rows.filter(blocks.takes_part(F.col(vector))).select(
        F.col(key).cast("long").alias("id"), F.lit(None).cast("int").alias("label"), F.lit(1).cast("long").alias("copies"),
        F.col(vector).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    asking = rows.filter("asks").groupBy("id", "vector").agg(F.count(F.lit(1)).alias("copies")).withColumn("label", F.lit(None).cast("int"))
    queries = stored(blocks.pack(asking, scale, blocks.QUERY_ROWS), "queries")
    trees = stored(plant_trees(blocks.pack(rows, scale)), "trees")

    unknown = F.transform("ids", lambda x: F.lit(None).cast("long"))
    near = stored(_hits(blocks.spread(queries.withColumn("bounds", unknown), trees, home=True), k), "near")
    # The k-th score of other rows in the query's own group bounds all others.
    best = blocks.first_others(near, k).filter(F.col("rank") == k).select((F.shiftright("q", blocks.POSITION_BITS)).alias("block"), "q", "score")
    known = best.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("q", "score"))).alias("known"))
    at = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.try_element_at("known", F.shiftleft("block", blocks.POSITION_BITS) + i))
    bounded = queries.join(known, "block", "left").withColumn("bounds", F.coalesce(at, unknown)).drop("known")
    far = _hits(blocks.spread(stored(bounded, "bounded"), trees, home=False), k)
    ranked = blocks.first_others(near.unionByName(far), k)
    each = ranked.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return each.select("query_id", "rank", F.col("id").alias(key), "score")


def _hits(pairs: DataFrame, k: int) -> DataFrame:
    return blocks.over_tiles(pairs, HITS, lambda block: Search(block, k), lambda state, tree: state.visit(tree), lambda state: state.batch())

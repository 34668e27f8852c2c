"""Hard negatives for contrastive training, scored by Strassen multiplication of integer tiles.

Blocks of anchors meet all blocks of candidates; each tile of scores is one exact
integer product.  A first pass keeps the positives of each anchor, a second one the
best candidates of another label inside each positive's score window.  Both keep
short ordered lists that merge, in a task from tile to tile and across tasks in Spark.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm import blocks
from mercato.llm.tables import stored

#: The recursion ends where a side of a factor is no longer than this.
SMALL = 16

POSITIVES = "q long, anchor_id long, copies long, id long, score long, same boolean"
NEGATIVES = "q long, place int, anchor_id long, copies long, positive_id long, positive_score long, id long, score long"


# --- multiplication -----------------------------------------------------------

def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b for integers by Strassen's recursion, exact.

    Both factors are padded with zeros so that every side halves as often as the
    shortest one takes to reach `SMALL`.  Sums double at most with each step down;
    where they could outgrow 64 bits, Python integers take over.
    """
    levels = max(0, (min(*a.shape, *b.shape) // SMALL).bit_length() - 1)
    bound = blocks.largest_product(a, b.T) << (2 * levels)
    if bound >= 1 << 62:
        a, b = a.astype(object), b.astype(object)
    unit = 1 << levels
    rows, columns = a.shape[0], b.shape[1]
    a, b = (np.pad(m, [(0, -side % unit) for side in m.shape]) for m in (a, b))
    return _recurse(a, b, levels, bound)[:rows, :columns]


def _recurse(a: np.ndarray, b: np.ndarray, levels: int, bound: int) -> np.ndarray:
    if levels == 0:
        return blocks.multiply(a, b, bound)
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    down = lambda x, y: _recurse(x, y, levels - 1, bound)
    p1 = down(a11 + a22, b11 + b22)
    p2 = down(a21 + a22, b11)
    p3 = down(a11, b12 - b22)
    p4 = down(a22, b21 - b11)
    p5 = down(a11 + a12, b22)
    p6 = down(a21 - a11, b11 + b12)
    p7 = down(a12 - a22, b21 + b22)
    out = np.empty((2 * m, 2 * n), dtype=p1.dtype)
    out[:m, :n] = p1 + p4 - p5 + p7
    out[:m, n:] = p3 + p5
    out[m:, :n] = p2 + p4
    out[m:, n:] = p1 - p2 + p3 + p6
    return out


# --- passes over tiles --------------------------------------------------------

class Tile:
    """Scores of an anchor block with a candidate block, candidates in the order of ids."""

    def __init__(self, anchors: blocks.Block, candidates: blocks.Block):
        ids, null = candidates.longs("ids")
        order = np.argsort(blocks.id_rank(ids, null))
        self.ids, self.null = ids[order], null[order]
        self.matrix = candidates.matrix[order]
        self.same_label = anchors.longs("labels")[0][:, None] == candidates.longs("labels")[0][order]
        a, b = blocks.same_width(anchors.matrix, self.matrix)
        self.scores = strassen(a, np.ascontiguousarray(b.T))
        most = max(blocks.largest_product(a, b), 1)
        self.keys = blocks.ordered_keys(self.scores, np.arange(len(order)), most)
        self.lowest = -(most + 1) * blocks.BLOCK_ROWS

    def leaders(self, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, columns) of the first k allowed candidates of each anchor."""
        masked = np.where(allowed, self.keys, self.lowest)
        n = masked.shape[1]
        columns = np.argpartition(masked, n - k, axis=1)[:, n - k :] if n > k else np.broadcast_to(np.arange(n), masked.shape)
        row, place = np.nonzero(np.take_along_axis(masked, columns, axis=1) > self.lowest)
        return row, columns[row, place]


class Positives:
    """The first k + 1 rows of each anchor's label: one of them may be the anchor itself."""

    def __init__(self, anchors: blocks.Block, k: int):
        self.anchors, self.k, self.best = anchors, k, blocks.Best(k + 1)
        self.ids, self.null = anchors.longs("ids")

    def visit(self, candidates: blocks.Block) -> None:
        tile = Tile(self.anchors, candidates)
        row, column = tile.leaders(tile.same_label, self.k + 1)
        same = (tile.ids[column] == self.ids[row]) & ~tile.null[column]
        same[same] = blocks.equal_rows(self.anchors.matrix[row[same]], tile.matrix[column[same]])
        self.best.add(row, tile.scores[row, column], tile.ids[column], tile.null[column], same=same)

    def batch(self) -> pa.RecordBatch:
        hits, (copies, _) = self.best.hits, self.anchors.longs("copies")
        row = hits["group"]
        return pa.RecordBatch.from_arrays(
            [
                pa.array((self.anchors.number << blocks.POSITION_BITS) + row), pa.array(self.ids[row]), pa.array(copies[row]),
                pa.array(hits["id"], mask=hits["null"]), pa.array(hits["score"]), pa.array(hits["same"], pa.bool_()),
            ],
            names=["q", "anchor_id", "copies", "id", "score", "same"],
        )


class Windows:
    """The first k rows of other labels in the score window of each (anchor, positive)."""

    def __init__(self, anchors: blocks.Block, k: int, low: int, high: int):
        self.anchors, self.k, self.low, self.high = anchors, k, low, high
        self.best = blocks.Best(k)
        self.ids, _ = anchors.longs("ids")
        self.copies, _ = anchors.longs("copies")
        self.row, self.place, self.score = (anchors.longs(c)[0] for c in ("w_row", "w_place", "w_score"))
        self.positive, self.positive_null = anchors.longs("w_id")

    def visit(self, candidates: blocks.Block) -> None:
        tile = Tile(self.anchors, candidates)
        # Bounds in Python integers: 100 * score may pass 64 bits.
        within = [(-(-self.low * int(s) // 100), self.high * int(s) // 100) for s in self.score]
        at = lambda side: np.array([w[side] for w in within], dtype=tile.scores.dtype)[:, None]
        scores = tile.scores[self.row]
        allowed = ~tile.same_label[self.row] & (scores >= at(0)) & (scores <= at(1))
        whole, tile.keys = tile.keys, tile.keys[self.row]
        window, column = tile.leaders(allowed, self.k)
        tile.keys = whole
        self.best.add(window, scores[window, column], tile.ids[column], tile.null[column])

    def batch(self) -> pa.RecordBatch:
        hits, window = self.best.hits, self.best.hits["group"]
        row = self.row[window]
        return pa.RecordBatch.from_arrays(
            [
                pa.array((self.anchors.number << blocks.POSITION_BITS) + row), pa.array(self.place[window].astype(np.int32)),
                pa.array(self.ids[row]), pa.array(self.copies[row]),
                pa.array(self.positive[window], mask=self.positive_null[window]), pa.array(self.score[window]),
                pa.array(hits["id"], mask=hits["null"]), pa.array(hits["score"]),
            ],
            names=["q", "place", "anchor_id", "copies", "positive_id", "positive_score", "id", "score"],
        )


# --- Spark jobs ---------------------------------------------------------------

def mine(
    rows: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 10, window: tuple[int, int] = (30, 90), scale: int = 1,
    key: str = "vec_id", vector: str = "embedding", label: Column | str = "label",
) -> DataFrame:
    """Hard negatives of each anchor row and positive: anchor_id, positive_id, rank, negative_id and both scores.

    Numbers x count as floor(scale * x); a score is an inner product; rows come by
    falling score, then key, null keys last.  Positives are the first ``n_positives`` other
    rows of the anchor's label.  Negatives have another label and
    ``low * positive_score <= 100 * score <= high * positive_score`` for ``window`` (low, high);
    a positive score below zero has none.  Rows with a null label or vector, or a null or
    non-finite number, take no part.  A repeated row is a positive of its other copies and an
    anchor once for each copy.  In vectors of different lengths the missing numbers count as
    zero; a score beyond 64 bits is an error.  Other columns may have any name.
    """
    label = F.col(label) if isinstance(label, str) else label
    rows = rows.filter(blocks.takes_part(F.col(vector)) & label.isNotNull()).select(
        F.col(key).cast("long").alias("id"), label.cast("int").alias("label"), F.lit(1).cast("long").alias("copies"),
        F.col(vector).alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("asks"),
    )
    asking = rows.filter("asks").groupBy("id", "label", "vector").agg(F.count(F.lit(1)).alias("copies"))
    anchors = stored(blocks.pack(asking, scale, blocks.QUERY_ROWS), "anchors")
    candidates = stored(blocks.pack(rows, scale), "candidates")

    hits = blocks.over_tiles(
        blocks.spread(anchors, candidates), POSITIVES,
        lambda block: Positives(block, n_positives), lambda state, block: state.visit(block), lambda state: state.batch(),
    )
    positives = blocks.first_others(hits, n_positives)
    # At most QUERY_ROWS * n_positives windows in a block.
    windows = (
        positives.select(
            F.shiftright("q", blocks.POSITION_BITS).alias("block"),
            F.struct((F.col("q") % blocks.BLOCK_ROWS).alias("row"), F.col("rank").cast("long").alias("place"), "id", "score").alias("w"),
        )
        .groupBy("block").agg(F.sort_array(F.collect_list("w")).alias("w"))
        .select("block", *[F.col(f"w.{c}").alias(f"w_{c}") for c in ("row", "place", "id", "score")])
    )
    asked = stored(anchors.join(windows, "block"), "windows")
    found = blocks.over_tiles(
        blocks.spread(asked, candidates), NEGATIVES,
        lambda block: Windows(block, n_negatives, *window), lambda state, block: state.visit(block), lambda state: state.batch(),
    )
    order = Window.partitionBy("q", "place").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n_negatives)
    each = ranked.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return each.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))

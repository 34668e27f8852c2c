"""Best-fit packing into sequences of several permitted lengths.

Documents are dealt to shards of a bounded number of pieces; each shard is packed
by best-fit decreasing.  A piece goes to the open bin with the least room that
still holds it.  If there is none, the permitted length with the least cost per
token that can still be filled is opened: cost(length) / min(length, tokens left).
At the end every bin is closed at the smallest permitted length that holds its
contents.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Permitted lengths, and the cost of one sequence: its tokens, a fixed part, and attention.
LENGTHS = (2048, 4096, 8192, 16384)
FIXED_COST = 128.0
ATTENTION_COST = 1.0 / (1 << 20)
SHARD_PIECES = 20_000


def cost(length: int) -> float:
    return FIXED_COST + length + ATTENTION_COST * length * length


def pack(sizes: Sequence[int], lengths: Sequence[int]) -> tuple[list[int], list[int], dict[int, int]]:
    """Bin and offset of each size (given in decreasing order), and the final length of each bin."""
    lengths = sorted(lengths)
    left, bins, offsets, used = sum(sizes), [], [], []
    rooms: list[int] = []  # distinct free rooms, ascending
    open_bins: dict[int, list[int]] = {}
    for size in sizes:
        at = bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms[at]
            b = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room], rooms[at]
        else:
            room = min((c for c in lengths if c >= size), key=lambda c: (cost(c) / min(c, max(left, 1)), c))
            b = len(used)
            used.append(0)
        bins.append(b)
        offsets.append(used[b])
        used[b] += size
        left -= size
        if room := room - size:
            if room not in open_bins:
                insort(rooms, room)
                open_bins[room] = []
            open_bins[room].append(b)
    return bins, offsets, {b: next(c for c in lengths if c >= u) for b, u in enumerate(used)}


def pack_documents(documents: DataFrame, key: str = "doc_id", size: str = "n_tokens", lengths: Sequence[int] = LENGTHS, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """One row per piece: key, piece, start, n_tokens, bin_id, bin_offset, bin_length, bin_used.

    A document longer than the longest permitted length is cut into pieces of that
    length and a rest; nothing is dropped.  Size null or below 1 gives one row with
    n_tokens 0 and no bin.  Null keys and repeated rows are packed like any others.
    The result depends only on the rows: shards come from a hash of key, start and
    size, ties are ordered by key.  Rows equal in all three share a shard whatever
    their number, so they are numbered within it by order alone.  Other columns are
    ignored.
    """
    longest, total = max(lengths), F.greatest(F.coalesce(F.col("size"), F.lit(0)), F.lit(0))
    rows = documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{size}`").cast("long").alias("size"))
    cut = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(total / longest) - 1, F.lit(0)).cast("long")))
    cut_rows = rows.select("key", total.alias("total"), cut.alias("piece")).select(
        "key", "piece", (F.col("piece") * longest).alias("start"),
        F.least(F.lit(longest).cast("long"), F.col("total") - F.col("piece") * longest).alias("n_tokens"),
    )
    shards = max(1, -(-cut_rows.count() // shard_pieces))
    dealt = cut_rows.withColumn("shard", F.pmod(F.xxhash64("key", "start", "n_tokens"), F.lit(shards)))
    key_type = rows.schema["key"].dataType.simpleString()

    def pack_shard(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["n_tokens", "key", "start"], ascending=[False, True, True], kind="stable")
        full = shard["n_tokens"] > 0
        bins, offsets, final = pack(shard.loc[full, "n_tokens"].tolist(), lengths)
        used: dict[int, int] = {}
        for b, n in zip(bins, shard.loc[full, "n_tokens"], strict=True):
            used[b] = used.get(b, 0) + n
        empty = [None] * int((~full).sum())  # these sort last
        name = [f"{shard['shard'].iloc[0]}-{b}" for b in bins]
        out = shard[["key", "piece", "start", "n_tokens"]].copy()
        out["bin_id"] = name + empty
        out["bin_offset"] = pd.array(offsets + empty, dtype="Int64")
        out["bin_length"] = pd.array([final[b] for b in bins] + empty, dtype="Int64")
        out["bin_used"] = pd.array([used[b] for b in bins] + empty, dtype="Int64")
        return out

    schema = f"key {key_type}, piece long, start long, n_tokens long, bin_id string, bin_offset long, bin_length long, bin_used long"
    return dealt.groupBy("shard").applyInPandas(pack_shard, schema).withColumnRenamed("key", key)

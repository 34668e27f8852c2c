"""Cross-entropy difference of two matched bigram models.

The target model is counted on documents labelled good, the background model on
the whole corpus.  Both have the order, the smoothing and the vocabulary in common:
every word of the corpus.  The score of a document is its mean loss per token under
the target model minus that under the background model; lower means more like the
target.

Documents lie in blocks of a bounded size.  A block sends each of its distinct
bigrams, words and contexts once, with its own counts, to the part of the key range
it belongs to; there the counts of all blocks are summed and sent back.  So neither
the models nor the tokens of a common word are ever in one place.  Texts, keys and
counts are packed before they are written or shuffled, and which documents are in the
target is found by key alone, so texts move once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.tables import stored
from mercato.llm.vectors import Texts, mix, pieces

INTERPOLATION = 0.7
SMOOTHING = 0.5
#: Tokens of the corpus for each part of the key range, and the least number of parts as a power of two.
PART_TOKENS = 1 << 22
PART_BITS = 8
#: The low bits of a key tell bigrams (0), words (1) and contexts (2) apart.
_KIND = np.uint64(3)
_BEGIN, _SALT = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


def _p(pair, seen, word, total, words):
    """p(word | previous): bigram interpolated with an add-a unigram over ``words`` words."""
    unigram = (word + SMOOTHING) / (total + SMOOTHING * words)
    bigram = np.where(seen > 0, pair / np.maximum(seen, 1), unigram)
    return INTERPOLATION * bigram + (1 - INTERPOLATION) * unigram


def loss(counts: np.ndarray) -> np.ndarray:
    """-log p(word | previous) of a dense table; id 0 opens a text and is no word; rows sum to one over words."""
    word = counts.sum(axis=0)
    p = _p(counts, counts.sum(axis=1, keepdims=True), word, word[1:].sum(), len(word) - 1)
    p[:, 0] = 0
    with np.errstate(divide="ignore"):
        return -np.log(p)


def _keys(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys of a block, the places in them of each token's bigram, word and context, and its row."""
    words = texts.words()
    own = words.hash
    before = np.concatenate((own[:0], own[:1], own[:-1]))
    before[words.first[:-1][np.diff(words.first) > 0]] = _BEGIN
    with np.errstate(over="ignore"):
        pair = mix(mix(before ^ _SALT) + own)
    kinds = (pair, mix(own), mix(before))
    keys, at = np.unique(np.concatenate([k & ~_KIND | np.uint64(i) for i, k in enumerate(kinds)]), return_inverse=True)
    return keys, at.reshape(3, -1), words.row


def packed(values: np.ndarray) -> bytes:
    """Numbers or bytes, compressed a byte of each number at a time: small and evenly spread numbers take few bytes."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int, kind) -> np.ndarray:
    kind = np.dtype(kind)
    planes = pa.decompress(data, decompressed_size=n * kind.itemsize, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, dtype=np.uint8).reshape(kind.itemsize, n).T).view(kind).reshape(-1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 33
    for batch in batches:
        for part in pieces(batch, "text"):
            texts = Texts(part.column("text"))
            ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("id"))
            held = [pa.array([packed(x)], pa.binary()) for x in (np.diff(texts.offsets), texts.bytes)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), ids, pa.array([len(texts.bytes)]), *held, pa.array([len(texts.words())])], ["block", "ids", "size", "lengths", "texts", "n"]
            )
            number += 1


def _texts(rows: int, size: int, lengths: bytes, texts: bytes) -> Texts:
    offsets = np.concatenate((np.zeros(1, np.int64), np.cumsum(unpacked(lengths, rows, np.int64))))
    data = unpacked(texts, size, np.uint8).tobytes()
    return Texts(pa.LargeStringArray.from_buffers(rows, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)))


def _sent(bits: int):
    """(block, part, m, keys, n, n_good): the ``m`` distinct keys of a block in a part of the key range, as steps from the one before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, at, rows = _keys(_texts(row["rows"], row["size"], row["lengths"], row["texts"]))
                in_target = np.zeros(row["rows"], bool)
                in_target[row["good"] or []] = True
                n = np.bincount(at.ravel(), minlength=len(keys)).astype(np.uint32)
                n_good = np.bincount(at.ravel()[np.tile(in_target[rows], 3)], minlength=len(keys)).astype(np.uint32)
                parts = keys >> np.uint64(64 - bits)
                first = np.flatnonzero(np.concatenate(([True], parts[1:] != parts[:-1]))) if len(keys) else np.zeros(0, int)
                ends = np.append(first[1:], len(keys))[: len(first)]
                steps = np.diff(keys, prepend=np.uint64(0))
                steps[first] = keys[first] - (parts[first] << np.uint64(64 - bits))
                held = [pa.array([packed(c[a:b]) for a, b in zip(first.tolist(), ends.tolist(), strict=True)], pa.binary()) for c in (steps, n, n_good)]
                block = pa.array([row["block"]] * len(first), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [block, pa.array(parts[first].astype(np.int64)), pa.array(ends - first, pa.int64()), *held], ["block", "part", "m", "keys", "n", "n_good"]
                )

    return run


def _values(rows: pa.Table, column: str, kind) -> np.ndarray:
    found = [unpacked(v, m, kind) for m, v in zip(rows["m"].to_pylist(), rows[column].to_pylist(), strict=True)]
    return np.concatenate(found) if found else np.zeros(0, kind)


def _summed(bits: int):
    """The counts of all blocks for the keys that each block sent; one row has the distinct words and the tokens of both models."""

    def run(sent: pa.Table) -> pa.Table:
        start = np.uint64(sent["part"][0].as_py()) << np.uint64(64 - bits)
        steps = [np.cumsum(unpacked(v, m, np.uint64), dtype=np.uint64) for m, v in zip(sent["m"].to_pylist(), sent["keys"].to_pylist(), strict=True)]
        keys, at = np.unique(np.concatenate(steps) + start, return_inverse=True)
        sums = [np.bincount(at, weights=_values(sent, c, np.uint32), minlength=len(keys)).astype(np.int64) for c in ("n", "n_good")]
        cuts = np.cumsum([0, *sent["m"].to_pylist()]).tolist()
        held = [pa.array([packed(s[at[a:b]]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()) for s in sums]
        words = keys & _KIND == 1
        totals = [pa.array([int(x)] + [0] * (sent.num_rows - 1), pa.int64()) for x in (words.sum(), sums[0][words].sum(), sums[1][words].sum())]
        return pa.table([sent["block"], sent["part"], sent["m"], *held, *totals], names=["block", "part", "m", "n", "n_good", "words", "total", "total_good"])

    return run


def _scored(total: int, total_good: int, words: int):
    def score(blocks: pa.Table, sums: pa.Table) -> pa.Table:
        sums = sums.sort_by("part")
        n, n_good = _values(sums, "n", np.int64), _values(sums, "n_good", np.int64)
        ids = blocks["ids"].combine_chunks().flatten()
        _, (pair, word, context), rows = _keys(_texts(len(ids), *[blocks[c][0].as_py() for c in ("size", "lengths", "texts")]))
        difference = np.log(_p(n[pair], n[context], n[word], total, words)) - np.log(_p(n_good[pair], n_good[context], n_good[word], total_good, words))
        length = np.bincount(rows, minlength=len(ids))
        mean = np.bincount(rows, weights=difference, minlength=len(ids)) / np.maximum(length, 1)
        return pa.table([ids, pa.array(length.astype(np.int64)), pa.array(mean, mask=length == 0)], names=["id", "n_words", "score"])

    return score


def score_documents(documents: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, score), one row per input row.

    ``target`` holds the keys of the target documents; nulls in it are ignored and
    repeats count once.  A document without words, null text included, has n_words 0
    and score null.  Without target documents the target model is the smoothing
    alone.  Rows with null keys or repeated rows are scored like others.  Counts are
    taken over all documents and all their words, told apart by 62-bit hashes.
    Other columns are ignored.
    """
    texts = documents.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    id_type = texts.schema["id"].dataType.simpleString()
    ids = target.select(F.col(f"`{key}`").alias("id")).dropna()
    schema = f"block long, ids array<{id_type}>, size long, lengths binary, texts binary, n long"
    blocks = stored(texts.mapInArrow(_blocks, schema), "blocks")
    places = blocks.select("block", F.posexplode("ids").alias("row", "id")).join(ids, "id", "left_semi")
    # A few bytes for a document, so the blocks need no shuffle to get them until the corpus has millions of them.
    good = stored(places.groupBy("block").agg(F.collect_list("row").alias("good")), "good")
    bits = max(PART_BITS, (int(blocks.agg(F.sum("n")).first()[0] or 0) // PART_TOKENS).bit_length())
    flagged = blocks.withColumn("rows", F.size("ids")).drop("ids", "n").join(good, "block", "left")
    sent = flagged.mapInArrow(_sent(bits), "block long, part long, m long, keys binary, n binary, n_good binary")
    counts = "block long, part long, m long, n binary, n_good binary, words long, total long, total_good long"
    sums = stored(sent.groupBy("part").applyInArrow(_summed(bits), counts), "sums")
    words, total, total_good = (int(x or 0) for x in sums.agg(F.sum("words"), F.sum("total"), F.sum("total_good")).first())
    back = sums.select("block", "part", "m", "n", "n_good").groupBy("block")
    scored = blocks.drop("n").groupBy("block").cogroup(back).applyInArrow(
        _scored(total, total_good, words), f"id {id_type}, n_words long, score double"
    )
    return scored.withColumnRenamed("id", key)

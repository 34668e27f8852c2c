"""Token counts of whole texts without materialising ids.

A byte-level BPE first cuts a text into pre-tokens and then works inside each, so
a text's count is the sum over its pre-tokens.  Pieces are counted once per
distinct pre-token of the corpus; the counts are joined to the pre-token
frequencies of each text and summed.

Pre-tokens are found for a whole Arrow batch at once from the character classes
of the public byte-level pattern (contractions, letters, numbers, other
characters, white space) and identified by a 64-bit hash; their strings leave the
worker once per task and distinct value.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.tables import stored
from mercato.llm.vectors import Texts, pieces, signed, span_hashes

SPECIAL = "<|endoftext|>"
#: Pre-tokens whose counts every worker holds (12 bytes each); all others are joined.
COMMON = 1 << 17

LETTER, NUMBER, OTHER, WHITE = 1, 2, 3, 4
# The contractions of the public pattern.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


@lru_cache(maxsize=1)
def character_classes() -> np.ndarray:
    """Class of every code point."""
    import regex

    every = "".join(map(chr, range(0x110000)))
    classes = np.full(0x110000, OTHER, dtype=np.uint8)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", WHITE)):
        for m in regex.finditer(pattern, every):
            classes[m.start() : m.end()] = kind
    return classes


def _code_points(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    data = texts.bytes
    lead = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return points, lead[texts.offsets]


def pre_tokens(texts: Texts, special: str = SPECIAL) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points, starts and ends of all pre-tokens in order, their rows, and which are the special string."""
    points, offsets = _code_points(texts)
    n = len(points)
    kind = character_classes()[points] if n else np.zeros(0, np.uint8)
    segment = np.zeros(n + 1, dtype=bool)
    segment[offsets] = True
    marked = np.zeros(n, dtype=bool)
    special_starts = []
    if n and special:
        mark = np.frombuffer(special.encode("utf-32-le"), dtype=np.uint32)
        at = np.flatnonzero(points[: n - len(mark) + 1] == mark[0]) if n >= len(mark) else np.zeros(0, int)
        for j in range(1, len(mark)):
            at = at[points[at + j] == mark[j]]
        own = np.searchsorted(offsets, at, side="right") == np.searchsorted(offsets, at + len(mark) - 1, side="right")
        special_starts = at[own]
        for s in special_starts:
            segment[s] = segment[s + len(mark)] = True
            marked[s : s + len(mark)] = True
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return points, none, none, none, none.astype(bool)
    first = segment[:-1]  # first code point of a segment
    last = segment[1:]
    previous = np.concatenate(([0], kind[:-1]))
    following = np.concatenate((kind[1:], [0]))
    white = kind == WHITE
    run_start = first | (kind != previous)
    start = run_start & ~white
    # White space before a word: the last character of the run stands alone, or joins the word if it is a blank.
    before_word = white & ~last & (following != WHITE)
    lead_blank = before_word & (points == 0x20)
    start |= white & run_start
    start |= before_word
    takes = np.zeros(n, dtype=bool)
    takes[1:] = lead_blank[:-1]
    start &= ~(takes & ~white)
    # Contractions count only where a pre-token may begin: the quote starts a run and no blank leads it.
    quotes = np.flatnonzero((points == 0x27) & (run_start & ~takes))
    if len(quotes):
        stop_of = np.flatnonzero(segment)
        limit = stop_of[np.searchsorted(stop_of, quotes, side="right")]
        free = np.ones(len(quotes), dtype=bool)
        for form in CONTRACTIONS:
            tail = np.frombuffer(form.encode("utf-32-le"), dtype=np.uint32)[1:]
            ok = free & (quotes + len(tail) < limit)
            for j, c in enumerate(tail, 1):
                ok[ok] = points[quotes[ok] + j] == c
            begin = quotes[ok]
            free &= ~ok
            start[begin + 1] = False
            end = begin + 1 + len(tail)
            end = end[end < n]
            # What follows starts anew: the rest of the letters is a pre-token of its own.
            start[end[~segment[end] & (kind[end] == LETTER)]] = True
    if len(special_starts):
        start[marked] = False
        start[special_starts] = True
    starts = np.flatnonzero(start)
    ends = np.append(starts[1:], n) if len(starts) else starts
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return points, starts, ends, rows, marked[starts] if len(starts) else np.zeros(0, bool)


def _hashed(texts: Texts):
    points, starts, ends, rows, special = pre_tokens(texts)
    values = points.astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        values = values * np.uint64(0xD6E8FEB86659FD93)
        values ^= values >> np.uint64(32)
    return points, starts, ends, rows, span_hashes(values, starts, ends), special


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, piece, count) of the distinct pre-tokens of each slice of a task."""
    for batch in batches:
        for part in pieces(batch, "text"):
            points, starts, ends, _, hashes, special = _hashed(Texts(part.column("text")))
            keep = ~special
            found, at, counts = np.unique(hashes[keep], return_index=True, return_counts=True)
            starts, ends = starts[keep][at], ends[keep][at]
            strings = [points[s:e].tobytes().decode("utf-32-le") for s, e in zip(starts, ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(found)), pa.array(strings, pa.string()), pa.array(counts.astype(np.int64))], ["hash", "piece", "n"]
            )


def _counter(tokenizer_path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        for batch in batches:
            strings = batch.column("piece").to_pylist()
            sizes = []
            for at in range(0, len(strings), 2000):
                sizes += [len(e) for e in tokenizer.encode_batch(strings[at : at + 2000], add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays([batch.column("hash"), batch.column("n"), pa.array(sizes, pa.int32())], ["hash", "n", "pieces"])

    return count


def piece_counts(texts: DataFrame, tokenizer_path: str) -> DataFrame:
    """(hash, n, pieces): tokens of every distinct pre-token of column ``text``, and how often it occurs."""
    distinct = (
        texts.mapInArrow(_distinct, "hash long, piece string, n long")
        .groupBy("hash")
        .agg(F.sum("n").alias("n"), F.min("piece").alias("piece"))
    )
    return distinct.mapInArrow(_counter(tokenizer_path), "hash long, n long, pieces int")


def _frequencies(common):
    """Per text: one row with the tokens of common pre-tokens, and a row for each other distinct pre-token."""
    names = ["row", "id", "n_bytes", "known", "hash", "times"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, sizes = common.value
        at = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in pieces(batch, "text"):
                texts = Texts(part.column("text"))
                _, _, _, rows, hashes, special = _hashed(texts)
                keys, n = signed(hashes), part.num_rows
                where = np.minimum(np.searchsorted(table, keys), max(len(table) - 1, 0))
                hit = (table[where] == keys) & ~special if len(table) else np.zeros(len(keys), bool)
                known = np.bincount(rows[hit], weights=sizes[where[hit]], minlength=n) if hit.any() else np.zeros(n)
                known = (known + np.bincount(rows[special], minlength=n)).astype(np.int64)
                rest = ~hit & ~special
                pair = np.empty(int(rest.sum()), dtype=[("row", np.int64), ("hash", np.int64)])
                pair["row"], pair["hash"] = rows[rest], keys[rest]
                order = np.lexsort((pair["hash"], pair["row"]))
                pair = pair[order]
                new = np.ones(len(pair), bool)
                new[1:] = pair[1:] != pair[:-1]
                first = np.flatnonzero(new)
                times = np.diff(np.append(first, len(pair)))
                pair = pair[first]
                ids = np.arange(n, dtype=np.int64) + at
                at += n
                empty = pa.nulls(len(pair), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate((ids, ids[pair["row"]]))),
                        pa.concat_arrays([part.column("id").cast(pa.int64()), empty]),
                        pa.concat_arrays([pa.array(np.diff(texts.offsets)), empty]),
                        pa.array(np.concatenate((known, np.zeros(len(pair), np.int64)))),
                        # A row of its own joins nothing; its number only spreads it.
                        pa.array(np.concatenate((ids, pair["hash"]))),
                        pa.array(np.concatenate((np.zeros(n, np.int64), times.astype(np.int64)))),
                    ],
                    names,
                )

    return count


def count_tokens(documents: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", common: int = COMMON) -> DataFrame:
    """(key, n_bytes, n_tokens), one row per input row; ``key`` must be integral.

    Null text is empty: 0 bytes, 0 tokens.  Null keys and repeated rows each keep a
    row.  The special string inside a text is one token, as by the library's default.
    ``common`` bounds what is broadcast; it changes the speed, never the result.
    ``tokenizer_path`` must exist on every executor.  Other columns are ignored.
    """
    spark = documents.sparkSession
    texts = documents.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    counts = stored(piece_counts(texts.select("text"), tokenizer_path), "pieces")
    top = sorted((r["hash"], r["pieces"]) for r in counts.orderBy(F.desc("n"), "hash").limit(common).select("hash", "pieces").toLocalIterator())
    shared = spark.sparkContext.broadcast((np.array([h for h, _ in top], np.int64), np.array([p for _, p in top], np.int64)))
    rows = texts.mapInArrow(_frequencies(shared), "row long, id long, n_bytes long, known long, hash long, times long")
    tokens = F.col("known") + F.when(F.col("times") > 0, F.col("times") * F.col("pieces")).otherwise(0)
    return (
        rows.join(counts.select("hash", "pieces"), "hash", "left")
        .groupBy("row")
        .agg(F.max("id").alias("id"), F.max("n_bytes").alias("n_bytes"), F.sum(tokens).alias("n_tokens"))
        .select(F.col("id").alias(key), "n_bytes", "n_tokens")
    )

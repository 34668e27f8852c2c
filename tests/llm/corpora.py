"""Odd documents and prose that the tests of the operators share."""

from __future__ import annotations

import random

#: Names that operators use inside, here as columns of the documents.
CLASHING = ("id", "key", "t", "row", "text_key", "class", "n", "spans", "quality", "judged", "part", "shard")
SCHEMA = "doc_id long, text string, lang string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)


def prose(seed: int, n: int, vocabulary: int = 4000) -> str:
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}x" for _ in range(n))


def documents(spark, rows):
    """Rows (doc_id, text) with further columns of clashing names."""
    return spark.createDataFrame([(i, t, "en", len(t) if t else None, *CLASHING) for i, t in rows], SCHEMA)


ODD = [
    (1, None), (None, prose(1, 80)), (None, None), (2, ""), (3, " \n\t "), (4, prose(1, 80)), (4, prose(1, 80)),
    (5, prose(2, 30000)), (6, "one"), (7, "one two three four"), (8, "é" * 5000), (9, prose(3, 60)), (10, "\x00odd \U0001f600 mark"),
]

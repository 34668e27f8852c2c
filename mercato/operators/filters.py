"""Predicates that need more than one built-in function."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the filter in front of a join; with more listed values than that it lets more through.
FILTER_BITS = 1 << 25


def like_any(df: DataFrame, column: str, patterns: list[str]) -> DataFrame:
    """Rows whose text matches at least one LIKE pattern."""
    return df.where(reduce(lambda a, b: a | b, [F.col(column).like(p) for p in patterns]))


def not_in(df: DataFrame, column: str, listed: DataFrame, listed_column: str) -> DataFrame:
    """SQL ``NOT IN (subquery)``: a NULL in the subquery empties the result.

    Written as an ordinary anti join on the distinct values plus two scalar
    subqueries, because the null-aware anti join must broadcast the subquery.
    """
    value = F.col(listed_column)
    known = listed.where(value.isNotNull()).select(value.alias(column)).distinct()
    rows = listed.agg(F.count(F.lit(1))).scalar()
    nulls = listed.agg(F.count(F.when(value.isNull(), 1))).scalar()
    kept = df.join(known, column, "left_anti")
    return kept.where((rows == 0) | ((nulls == 0) & F.col(column).isNotNull())).select(*df.columns)


def unless_exists(df: DataFrame, listed: DataFrame) -> DataFrame:
    """All rows when the other query is empty, none otherwise."""
    return df.where(~listed.limit(1).exists())


def may_be_in(df: DataFrame, column: str, listed: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """Every row whose value is in the column of that name of ``listed``, and few others; NULL is left out.

    For a large side whose rows mostly find no partner in an inner or semi join: they drop out
    before the shuffle, and the join decides.  What is broadcast is a table of at most ``bits`` / 64
    words, whatever the size of ``listed``.
    """

    def word_and_bit(value: Column) -> tuple[Column, Column]:
        place = F.xxhash64(value).bitwiseAND(F.lit(bits - 1).cast("long"))
        return F.shiftright(place, 6), F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63).cast("long")).cast("int"))

    # The hash depends on the type.
    word, bit = word_and_bit(F.col(column).cast(df.schema[column].dataType))
    known = listed.where(F.col(column).isNotNull()).select(word.alias("_word"), bit.alias("_bit"))
    words = F.broadcast(known.groupBy("_word").agg(F.bit_or("_bit").alias("_bits")))
    word, bit = word_and_bit(F.col(column))
    found = df.where(F.col(column).isNotNull()).join(words, word == F.col("_word")).where(F.col("_bits").bitwiseAND(bit) != 0)
    return found.select(*df.columns)

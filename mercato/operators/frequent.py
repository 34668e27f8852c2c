"""The most frequent value of columns, exact, without shuffling every distinct value.

Rows are first counted by a hash of the value, which sends a bounded number of
counters whatever the data.  A value is never more frequent than its bucket, so once
one value's exact count is known, buckets below that count cannot hold the winner or
a tie.  Only values of the other buckets are counted one by one.  Where values are
hardly repeated all buckets stay and the second count is the plain one: the answer is
exact either way, only the work differs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.operators.profile import as_text, literal_rows, unpivot

#: Counters per column.  A value held by more than a share of 1 / BUCKETS of the rows leaves most buckets behind.
BUCKETS = 1 << 16


def most_frequent(df: DataFrame, columns: list[str], buckets: int = BUCKETS) -> DataFrame:
    """``top`` value and its ``freq`` per column, ties to the smallest value; ``counted`` rows had their values counted one by one.

    NULL values are left out; a column without values has no top and frequency 0.
    """
    long = unpivot({n: as_text(df, n) for n in columns}, df).where(F.col("value").isNotNull())
    long = long.withColumn("bucket", F.pmod(F.xxhash64("value"), F.lit(buckets)))
    sizes = long.groupBy("column", "bucket").agg(F.count("*").alias("size"))
    # The fullest bucket of each column is counted first: its best value is the count to beat.
    fullest = sizes.groupBy("column").agg(F.max(F.struct("size", "bucket"))["bucket"].alias("bucket"))
    # At most `buckets` counters per named column, so these broadcasts are bounded.
    first = long.join(F.broadcast(fullest), ["column", "bucket"]).groupBy("column", "value").agg(F.count("*").alias("n"))
    to_beat = first.groupBy("column").agg(F.max("n").alias("least"))
    open_buckets = sizes.join(F.broadcast(to_beat), "column").where(F.col("size") >= F.col("least")).select("column", "bucket")
    counts = long.join(F.broadcast(open_buckets), ["column", "bucket"]).groupBy("column", "value").agg(F.count("*").alias("n"))
    best = counts.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("rank"), "value")).alias("best"), F.sum("n").alias("counted"))
    blank = literal_rows(df.sparkSession, ["column"], [(n,) for n in columns])
    return blank.join(best, "column", "left").select(
        "column", F.col("best.value").alias("top"), F.coalesce(-F.col("best.rank"), F.lit(0)).alias("freq"), F.coalesce("counted", F.lit(0)).alias("counted")
    )


def frequent_values(df: DataFrame, column: str, k: int, buckets: int = BUCKETS) -> DataFrame:
    """The ``k`` most frequent values of a column with their exact counts, ties to the smaller value.

    The values of the k fullest buckets are counted first; the k-th largest of their counts
    is the one to beat, and buckets below it are left out.  With fewer than k
    values there, every bucket stays.
    """
    rows = df.select(as_text(df, column).alias("value")).where(F.col("value").isNotNull()).withColumn("bucket", F.pmod(F.xxhash64("value"), F.lit(buckets)))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("size"))
    fullest = sizes.orderBy(F.desc("size"), "bucket").limit(k).select("bucket")
    first = rows.join(F.broadcast(fullest), "bucket").groupBy("value").agg(F.count("*").alias("n")).orderBy(F.desc("n")).limit(k)
    least = first.agg(F.when(F.count("*") >= k, F.min("n")).otherwise(0)).scalar()
    counts = rows.join(F.broadcast(sizes.where(F.col("size") >= least).select("bucket")), "bucket").groupBy("value").agg(F.count("*").alias("n"))
    order = Window.orderBy(F.desc("n"), "value")
    head = counts.orderBy(F.desc("n"), "value").limit(k)
    return head.select(F.row_number().over(order).alias("place"), F.col("value").alias(column), "n")  # k rows are left

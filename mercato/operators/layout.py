"""Table layout and lifecycle: monthly partitions, pruned reads, retention, archive."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.functions.dates import as_date, as_timestamp, month_label, month_start
from mercato.functions.jsonq import has_key, int_at, parsed
from mercato.operators.comoments import co_moments, correlation, merge_states
from mercato.operators.ranks import counts_before, cuts_below, order_number

MONTH = "order_month"
DEFAULT = "default"
PURCHASE = "order_purchase_timestamp"
#: Bits of each column's place in the interleaved order.
ORDER_BITS = 8
#: Leading bits of the interleaved order by which rows are counted before they are dealt to files.
CELL_BITS = 16
#: Rows of a file that are compared in one window of the clustering report.
RUN_ROWS = 100_000


def with_month(df: DataFrame, ts_col: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Add the partition column; months outside ``first..last`` (``yyyy_MM``) and NULLs go to ``default``."""
    label = month_label(F.col(ts_col))
    inside = label.isNotNull()
    if first is not None:
        inside = inside & (label >= first)
    if last is not None:
        inside = inside & (label <= last)
    return df.withColumn(MONTH, F.when(inside, label).otherwise(F.lit(DEFAULT)))


def write_monthly(
    df: DataFrame, path: str, ts_col: str = PURCHASE, first: str | None = None, last: str | None = None
) -> None:
    """Write one directory per month.

    The rebalance step gathers each month into few files and splits a hot month
    over several tasks; only the months present in ``df`` are overwritten.
    """
    (
        with_month(df, ts_col, first, last)
        .hint("rebalance", F.col(MONTH))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(MONTH)
        .parquet(path)
    )


def append_rows(df: DataFrame, path: str, ts_col: str = PURCHASE, first: str | None = None, last: str | None = None) -> None:
    """Add rows to the monthly table."""
    with_month(df, ts_col, first, last).hint("rebalance", F.col(MONTH)).write.mode("append").partitionBy(MONTH).parquet(path)


def read_monthly(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The monthly table; the partition column is text, never guessed as a number.

    With a declared schema an empty or missing folder is an empty table.
    """
    if schema is None:
        plain = spark.read.option("basePath", path).parquet(path)
        return plain.withColumn(MONTH, F.col(MONTH).cast("string"))
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def read_pruned(spark: SparkSession, path: str, start: str, end: str, ts_col: str = PURCHASE) -> DataFrame:
    """Rows with ``start <= ts < end`` reading only the months that can hold them.

    A range on the timestamp does not prune the derived month directories, so
    the month predicate is added; ``default`` may hold any month.
    """
    inside = (F.col(ts_col) >= as_timestamp(start)) & (F.col(ts_col) < as_timestamp(end))
    return spark.read.option("basePath", path).parquet(path).where(months_of(start, end) & inside)


def months_of(start: str, end: str) -> Column:
    """The monthly partitions that can hold ``start <= ts < end``; ``default`` may hold any month."""
    begin = dt.datetime.fromisoformat(str(start))
    stop = dt.datetime.fromisoformat(str(end)) - dt.timedelta(microseconds=1)
    return F.col(MONTH).between(f"{begin:%Y_%m}", f"{stop:%Y_%m}") | (F.col(MONTH) == DEFAULT)


def partition_distribution(df: DataFrame) -> DataFrame:
    """Rows per monthly partition."""
    return df.groupBy(MONTH).agg(F.count("*").alias("row_count")).orderBy(MONTH)


def retention_tiers(months: DataFrame, as_of: str | None = None) -> DataFrame:
    """Age of each monthly partition and the tier it belongs to.

    The month of the report date is month 1.  ``default`` has no age.
    """
    begin = F.try_to_date(F.concat_ws("_", F.col(MONTH), F.lit("01")), "yyyy_MM_dd")
    age = (F.floor(F.months_between(F.trunc(as_date(as_of), "MM"), begin)) + 1).cast("int")
    tier = (
        F.when(F.col("age_months") <= 12, "active-hot")
        .when(F.col("age_months") <= 24, "active-warm")
        .when(F.col("age_months") <= 36, "archive")
        .when(F.col("age_months") > 36, "purge")
    )
    return months.withColumn("age_months", age).withColumn("tier", tier)


def partition_gaps(df: DataFrame, as_of: str | None = None, ahead: int = 2) -> DataFrame:
    """Months without a partition from the first one present to ``as_of`` plus ``ahead``.

    The number of months, not the number of rows, decides the size of everything
    after the first aggregation.
    """
    present = df.groupBy(MONTH).agg(F.count("*").alias("n")).where(F.col(MONTH) != DEFAULT)
    begin = F.to_date(F.concat_ws("_", F.min(MONTH), F.lit("01")), "yyyy_MM_dd")
    until = F.add_months(F.trunc(as_date(as_of), "MM"), ahead)
    expected = present.agg(begin.alias("b")).where(F.col("b") <= until).select(
        F.explode(F.sequence(F.col("b"), until, F.expr("INTERVAL 1 MONTH"))).alias("d")
    )
    wanted = expected.select(F.date_format("d", "yyyy_MM").alias(MONTH))
    return wanted.join(present, MONTH, "left_anti").orderBy(MONTH)


def default_rows(df: DataFrame) -> DataFrame:
    """Rows that fell outside the declared months."""
    return df.agg(F.count(F.when(F.col(MONTH) == DEFAULT, F.lit(1))).alias("default_rows"))


def archive_month(
    spark: SparkSession, path: str, archive_path: str, month: str, as_of: str, min_age: int = 36
) -> str:
    """Copy one old month to the archive and say what happened.

    ``month`` is ``yyyy_MM``.  A month younger than ``min_age`` months is
    refused.  Only counts reach the driver.  The month leaves the live table
    through :func:`without_months`, so a failed copy loses nothing.
    """
    first = dt.date.fromisoformat(month.replace("_", "-") + "-01")
    limit = dt.date.fromisoformat(str(as_of))
    age = (limit.year - first.year) * 12 + limit.month - first.month
    if age < min_age:
        return f"partition {month} is too recent to archive"
    rows = read_monthly(spark, path).where(F.col(MONTH) == month)
    before = rows.count()
    if before == 0:
        return f"partition {month} does not exist"
    rows.hint("rebalance", F.col(MONTH)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        MONTH
    ).parquet(archive_path)
    after = read_monthly(spark, archive_path).where(F.col(MONTH) == month).count()
    if after != before:
        return f"partition {month} copied incompletely: {before} rows, {after} archived"
    return f"partition {month} archived: {after} rows"


def archive_partitions(
    spark: SparkSession, path: str, live_path: str, archive_path: str, as_of: str, min_age: int = 36
) -> DataFrame:
    """Split the table into a live and an archived one by the age of the month.

    ``live_path`` is replaced as a whole; the archive gains the months moved now and
    keeps all others, so running again with the same targets changes nothing.  Either
    side may be empty.  The returned row compares the counts of the months moved.
    """
    table = read_monthly(spark, path)
    begin = F.try_to_date(F.concat_ws("_", F.col(MONTH), F.lit("01")), "yyyy_MM_dd")
    old = F.coalesce(begin <= F.add_months(as_date(as_of), -min_age), F.lit(False))
    for rows, target, scope in ((table.where(old), archive_path, "dynamic"), (table.where(~old), live_path, "static")):
        rows.hint("rebalance", F.col(MONTH)).write.mode("overwrite").option("partitionOverwriteMode", scope).partitionBy(MONTH).parquet(target)
    moved = table.where(old).select(MONTH).distinct()
    archived = read_monthly(spark, archive_path, table.schema).join(moved, MONTH, "left_semi")
    counts = table.agg(F.count("*").alias("total_rows")).select(
        "total_rows",
        read_monthly(spark, live_path, table.schema).agg(F.count("*")).scalar().alias("live_rows"),
        archived.agg(F.count("*")).scalar().alias("archived_rows"),
    )
    whole = F.col("total_rows") == F.col("live_rows") + F.col("archived_rows")
    return counts.withColumn("result", F.when(whole, "OK").otherwise("MISMATCH"))


def without_months(df: DataFrame, months: list[str]) -> DataFrame:
    """The table less some months."""
    return df.where(~F.col(MONTH).isin(list(months)))


def snapshot_table(df: DataFrame, path: str) -> DataFrame:
    """Write a full copy and return the number of rows in it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path).agg(F.count("*").alias("row_count"))


# The row subsets worth a filtered view of their own.
SUBSETS = {
    "delivered": lambda: F.col("order_status") == "delivered",
    "analytics_states": lambda: F.col("order_status").isin("delivered", "shipped", "invoiced"),
    "pending": lambda: F.col("order_status").isin("processing", "shipped") & F.col("order_delivered_customer_date").isNull(),
    "premium_items": lambda: F.col("price") > 100,
    "has_warranty": lambda: has_key(parsed(F.col("product_attributes")), "warranty_months"),
}
TOP_STATES = ("SP", "RJ", "MG", "PR", "RS")


def named_subset(df: DataFrame, name: str, states: tuple[str, ...] = TOP_STATES) -> DataFrame:
    """One of the reusable filtered views."""
    if name == "top_states":
        return df.where(F.col("customer_state").isin(list(states)))
    return df.where(SUBSETS[name]())


def derived_columns(df: DataFrame) -> DataFrame:
    """Add the derived columns whose inputs the table has."""
    out = df
    if PURCHASE in df.columns:
        out = out.withColumn("purchase_month", month_start(F.col(PURCHASE)))
    if {"price", "freight_value"} <= set(df.columns):
        out = out.withColumn("item_total", F.col("price") + F.col("freight_value"))
    if "product_attributes" in df.columns:
        out = out.withColumn("warranty_months", int_at(parsed(F.col("product_attributes")), "warranty_months", safe=True))
    return out


def clustering_report(table: DataFrame, column: str) -> DataFrame:
    """How well each file is ordered by a column of any sortable type, and how far the files overlap.

    ``table`` must come straight from a file scan.  ``ascending_share`` is the share of
    neighbouring rows that do not descend, whatever the distances; it is the larger of
    that for either direction.  ``overlapping_files`` counts the other files whose range
    meets this one's: 0 means a range filter skips all but one file.  Rows are
    compared within runs of RUN_ROWS by position, so no task holds a file.
    """
    rows = table.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("pos"), F.col(column).alias("v")
    ).where(F.col("v").isNotNull())
    # The last row of a run is also given to the next one, so that no pair of neighbours is lost.
    run = F.floor(F.col("pos") / RUN_ROWS)
    runs = F.when(F.col("pos") % RUN_ROWS == RUN_ROWS - 1, F.array(run, run + 1)).otherwise(F.array(run))
    before = F.lag("v").over(Window.partitionBy("file", "run").orderBy("pos"))
    pairs = rows.withColumn("run", F.explode(runs)).withColumn("before", before)
    own = F.floor(F.col("pos") / RUN_ROWS) == F.col("run")
    counted = F.col("before").isNotNull()
    files = pairs.groupBy("file").agg(
        F.count(F.when(own, 1)).alias("row_count"),
        F.count(F.when(counted & (F.col("before") <= F.col("v")), 1)).alias("up"),
        F.count(F.when(counted & (F.col("before") >= F.col("v")), 1)).alias("down"),
        F.count(F.when(counted, 1)).alias("pairs"),
        F.min("v").alias("low"),
        F.max("v").alias("high"),
    )
    share = F.when(F.col("pairs") == 0, 1.0).otherwise(F.greatest("up", "down") / F.col("pairs"))
    # Ranges that begin no later than this one ends, less those that end before it begins.
    bounds = files.select(F.col("low").alias("at"), F.lit(1).alias("begins"), F.lit(0).alias("ends")).unionByName(
        files.select(F.col("high").alias("at"), F.lit(0).alias("begins"), F.lit(1).alias("ends"))
    )
    upto = bounds.groupBy("at").agg(F.sum("begins").alias("begins"), F.sum("ends").alias("ends"))
    ordered = Window.orderBy("at")
    running = upto.select("at", F.sum("begins").over(ordered).alias("begun"), (F.sum("ends").over(ordered) - F.col("ends")).alias("ended"))
    overlaps = files.join(running.select(F.col("at").alias("high"), "begun"), "high").join(running.select(F.col("at").alias("low"), "ended"), "low")
    return overlaps.select(
        "file", "row_count", share.alias("ascending_share"), "low", "high", (F.col("begun") - F.col("ended") - 1).alias("overlapping_files")
    ).withColumn(
        "suitability",
        F.when(F.col("ascending_share") > 0.9, "excellent")
        .when(F.col("ascending_share") > 0.7, "good")
        .when(F.col("ascending_share") > 0.6, "acceptable")
        .otherwise("not recommended"),
    )


def physical_correlation(table: DataFrame, column: str) -> DataFrame:
    """Correlation of row position and value in each file, and what it says about skipping ranges.

    ``table`` must come straight from a file scan.  Numbers, dates and times count by
    their value, texts by their exact mean rank in the file.  NULL values are left out;
    a file in which the column does not vary has no correlation.  Runs of RUN_ROWS
    rows give one state each, and a file's states merge, so no task holds a file.
    """
    kind = table.select(column).schema[0].dataType
    rows = table.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("pos"), F.col(column).alias("v"))
    value = order_number("v", kind)
    if isinstance(kind, T.StringType):
        ranks = counts_before(rows, ["file"], "v").withColumn("y", F.col("before") + (F.col("n") - 1) / 2)
        rows, value = rows.join(ranks.select("file", "v", "y"), ["file", "v"]), F.col("y")
    runs = co_moments(rows.withColumn("run", F.floor(F.col("pos") / RUN_ROWS)), ["file", "run"], F.col("pos"), value)
    found = merge_states(runs, ["file"], "run").select("file", F.col("state.n").alias("row_count"), correlation(F.col("state")).alias("correlation"))
    size = F.abs("correlation")
    return found.withColumn(
        "suitability",
        F.when(size > 0.9, "excellent").when(size > 0.7, "good").when(size > 0.5, "acceptable").otherwise("not recommended"),
    )


def clustered_write(df: DataFrame, path: str, column: str, files: int | None = None) -> None:
    """Write the table range-partitioned and sorted by a column.

    ``files`` sets their number; Spark's shuffle settings do otherwise.  Rows with equal values may land in different ranges: the row id breaks
    ties, so a value held by a third of the rows does not fill one task.
    """
    keys = [F.col(column), F.col("_row")]
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    (
        (numbered.repartitionByRange(*keys) if files is None else numbered.repartitionByRange(files, *keys))
        .sortWithinPartitions(column)
        .drop("_row")
        .write.mode("overwrite")
        .parquet(path)
    )


def interleaved(places: list[Column], bits: int = ORDER_BITS) -> Column:
    """One number from several of ``bits`` bits: their highest bits first, column by column, then the next ones."""
    n = len(places)
    parts = [
        F.shiftleft(F.shiftright(place, bit).bitwiseAND(F.lit(1)).cast("long"), bit * n + n - 1 - i)
        for i, place in enumerate(places) for bit in range(bits)
    ]
    return reduce(Column.bitwiseOR, parts)


def file_borders(sizes: list[tuple[int, int]], files: int, bits: int) -> list[tuple[int, int, int]]:
    """(first cell, number of the first file, files) of each run of cells that is written together.

    ``sizes`` has the rows of each occupied cell of ``bits`` bits, in order.  Files hold about as many rows each, and
    a border lies where the highest possible bit changes among the places that leave either neighbour
    between half and three halves of that.  A cell of more rows than a file is dealt over several.
    """
    runs, at, left = [], 0, sum(n for _, n in sizes)
    numbered = 0
    while at < len(sizes):
        share = left / max(files - numbered, 1)
        room = files - numbered - (at + 1 < len(sizes))
        whole = max(min(int(sizes[at][1] / share + 0.5), room), 1)
        stop, held = at + 1, sizes[at][1]
        if whole == 1 and files - numbered > 1:
            best, rows = None, 0
            for k in range(at, len(sizes)):
                # Every later file needs a cell, or a share of a cell, of its own.
                rows += sizes[k][1]
                if k + 1 == len(sizes) or (best and rows > 1.5 * share):
                    break
                changed = (sizes[k][0] ^ sizes[k + 1][0]).bit_length()
                near = 0.5 * share <= rows <= 1.5 * share
                if best is None or (near, changed if near else 0, -abs(rows - share)) > best[0]:
                    best = ((near, changed if near else 0, -abs(rows - share)), k + 1, rows)
            if best:
                stop, held = best[1:]
        elif whole == 1:
            stop, held = len(sizes), left
        runs.append((sizes[at][0], numbered, whole))
        numbered, left, at = numbered + whole, left - held, stop
    return runs


def clustered_write_by(df: DataFrame, path: str, columns: list[str], files: int | None = None) -> None:
    """Write the table so that a range of any of several columns meets few files (Z-order).

    A row's place in a column is its rank among approximate quantiles, so skewed and uneven values
    spread evenly; NULL comes first.  Places are interleaved bit by bit and the table is
    partitioned by ranges of the result: by Spark's sample, or, where ``files`` sets
    their number, by exact counts, so that files end where a block of places does.  Rows
    that agree in all columns do not fill one task.
    """
    n = 1 << ORDER_BITS
    edges = [i / n for i in range(1, n)]
    numbers = {c: order_number(c, df.schema[c].dataType) for c in columns}
    # An array of some hundred numbers for each column; the same ones for the counts and for the rows.
    cuts = df.agg(*[F.percentile_approx(v, edges, 10 * n).alias(f"_{i}") for i, v in enumerate(numbers.values())]).first()
    places = [
        F.coalesce(cuts_below(F.lit(cuts[i] or []).cast("array<double>"), n, v), F.lit(0)) for i, v in enumerate(numbers.values())
    ]
    # The row travels whole beside its keys, so its columns may have any name.
    numbered = df.select(F.struct(*df.columns).alias("row"), interleaved(places).alias("z"), F.monotonically_increasing_id().alias("id"))
    if files is None:
        spread = numbered.repartitionByRange("z", "id")
    else:
        bits = min(ORDER_BITS * len(columns), CELL_BITS)
        cell = F.shiftright("z", ORDER_BITS * len(columns) - bits).cast("int")
        # At most 2 ** CELL_BITS counts.
        sizes = sorted(tuple(r) for r in numbered.groupBy(cell.alias("cell")).count().collect())
        runs = file_borders(sizes, files, bits)
        first, number, whole = (F.lit(list(c)).cast("array<int>") for c in zip(*runs, strict=True)) if runs else (F.array(F.lit(0)),) * 3
        run = cuts_below(first, len(runs), cell + 1) - 1
        file = F.get(number, run) + F.when(F.get(whole, run) > 1, F.pmod(F.xxhash64("id"), F.get(whole, run))).otherwise(F.lit(0)).cast("int")
        spread = numbered.repartitionById(files, file)
    spread.sortWithinPartitions("z").select("row.*").write.mode("overwrite").parquet(path)


def files_met(table: DataFrame, column: str, low: object, high: object) -> DataFrame:
    """Files of a scanned table, and how many of them a filter ``low <= column <= high`` has to open by their ranges."""
    files = table.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(column).alias("low"), F.max(column).alias("high"))
    met = F.count(F.when((F.col("low") <= F.lit(high)) & (F.col("high") >= F.lit(low)), 1))
    return files.agg(F.count("*").alias("files"), met.alias("files_met"))

"""Monthly tables that hold what their manifest says: repeatable appends, archiving as a move.

Below the folder of a table lie ``data/batch=<id>/order_month=<month>/`` and
``manifest/version=<n>/``, one small file that lists the directories that count.  A
job first writes its rows where no reader looks and then, last, one new version of
the manifest.  Whatever step a job fails at, the table is as before or as after, and
the same job run again ends in the state after.  A table has one writer at a time.

The manifest has one entry per directory, which Spark lists on the driver anyway.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import astuple, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.operators.layout import MONTH, PURCHASE, with_month

ENTRY = "batch STRING, order_month STRING, root STRING, tier STRING, row_count BIGINT"
LIVE, ARCHIVE = "live", "archive"


@dataclass(frozen=True)
class Entry:
    """A directory of rows; a batch without rows has one entry without a month."""

    batch: str
    month: str | None
    root: str
    tier: str
    row_count: int

    @property
    def folder(self) -> str:
        return f"{self.root}/data/batch={self.batch}/{MONTH}={self.month}"


def _versions(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(f"{ENTRY}, version INT").parquet(f"{path}/manifest")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def manifest(spark: SparkSession, path: str) -> tuple[int, list[Entry]]:
    """Newest version, 0 for none, and its entries."""
    versions = _versions(spark, path)
    if versions is None:
        return 0, []
    newest = versions.agg(F.max("version")).first()[0]
    if newest is None:  # a first commit that never ended
        return 0, []
    rows = versions.where(F.col("version") == newest).drop("version").collect()
    return newest, [Entry(*r) for r in rows]


def _commit(spark: SparkSession, path: str, version: int, entries: list[Entry]) -> None:
    """The one step that readers see: a single file that appears under its name once it is whole."""
    rows = spark.createDataFrame([astuple(e) for e in entries], ENTRY).coalesce(1)
    rows.write.mode("overwrite").parquet(f"{path}/manifest/version={version}")


def _write(rows: DataFrame, folder: str) -> None:
    # Static: a repeated run replaces all that a failed one left.
    rows.hint("rebalance", F.col(MONTH)).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(MONTH).parquet(folder)


def _written(spark: SparkSession, folder: str, schema: T.StructType) -> dict[str, int]:
    """Rows of each month in a folder, from the footers of its files."""
    found = spark.read.schema(schema).parquet(folder).groupBy(MONTH).agg(F.count("*").alias("n"))
    return {r[MONTH]: r["n"] for r in found.collect()}


def append_batch(
    df: DataFrame, path: str, batch: str, ts_col: str = PURCHASE, first: str | None = None, last: str | None = None
) -> int:
    """Add the rows of a batch once and return how many came in; a batch that is there already adds none.

    ``batch`` names the work, not the attempt (a load date, a source file), so a job
    that is run again gives the same name.  Months are those of `layout.with_month`.
    """
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
        raise ValueError("a batch is named by letters, digits, '_', '.' and '-'")
    spark = df.sparkSession
    version, entries = manifest(spark, path)
    if any(e.batch == batch for e in entries):
        return 0
    rows = with_month(df, ts_col, first, last)
    folder = f"{path}/data/batch={batch}"
    _write(rows, folder)
    months = _written(spark, folder, rows.schema)
    new = [Entry(batch, month, path, LIVE, n) for month, n in sorted(months.items())]
    _commit(spark, path, version + 1, entries + (new or [Entry(batch, None, path, LIVE, 0)]))
    return sum(months.values())


def read_batches(spark: SparkSession, path: str, schema: T.StructType | str, tier: str | None = LIVE, months: tuple[str, str] | None = None) -> DataFrame:
    """The committed rows of a tier, or of both (``None``), with their month.

    ``months`` (first, last) opens those directories alone, and ``default``, which may
    hold any month.
    """
    _, entries = manifest(spark, path)
    chosen = [
        e for e in entries
        if e.month is not None and (tier is None or e.tier == tier) and (months is None or e.month == "default" or months[0] <= e.month <= months[1])
    ]
    return _read(spark, chosen, schema)


def _read(spark: SparkSession, entries: list[Entry], schema: T.StructType | str) -> DataFrame:
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    whole = T.StructType([*(f for f in schema.fields if f.name != MONTH), T.StructField(MONTH, T.StringType())])
    found = spark.createDataFrame([], whole)
    for root in sorted({e.root for e in entries}):
        folders = [e.folder for e in entries if e.root == root]
        found = found.unionByName(spark.read.schema(whole).option("basePath", f"{root}/data").parquet(*folders).select(*whole.names))
    return found


def archive_old(spark: SparkSession, path: str, archive_root: str, schema: T.StructType | str, as_of: str, min_age: int = 36) -> DataFrame:
    """Move the months of ``min_age`` months and more to another folder and say for each month what was done.

    Only the months concerned are read and written.  Their counts are compared before
    the manifest moves them, all at once, from one tier to the other; on a difference
    nothing moves and an error names the month.
    """
    version, entries = manifest(spark, path)
    day = dt.date.fromisoformat(as_of)
    months = day.year * 12 + day.month - 1 - min_age
    limit = f"{months // 12:04d}_{months % 12 + 1:02d}"
    live = [e for e in entries if e.tier == LIVE and e.month not in (None, "default")]
    moving = [e for e in live if e.month <= limit]
    if moving:
        # The same name on a repeated run, as long as the manifest has not moved on.
        batch = f"archive-{version}"
        rows = _read(spark, moving, schema)
        _write(rows, f"{archive_root}/data/batch={batch}")
        copied = _written(spark, f"{archive_root}/data/batch={batch}", rows.schema)
        for month in {e.month for e in moving}:
            before = sum(e.row_count for e in moving if e.month == month)
            if copied.get(month, 0) != before:
                raise ValueError(f"month {month} has {before} rows, but {copied.get(month, 0)} were copied: nothing was moved")
        moved = [Entry(batch, month, archive_root, ARCHIVE, n) for month, n in sorted(copied.items())]
        _commit(spark, path, version + 1, [e for e in entries if e not in moving] + moved)
    said = spark.createDataFrame([(e.month, e.row_count, e in moving) for e in live], "order_month STRING, row_count BIGINT, moved BOOLEAN")
    each = said.groupBy("order_month").agg(F.sum("row_count").alias("row_count"), F.bool_or("moved").alias("moved"))
    message = F.when(F.col("moved"), F.format_string("partition %s archived: %d rows", "order_month", "row_count")).otherwise(
        F.format_string("partition %s is too recent to archive", "order_month")
    )
    return each.select("order_month", "row_count", message.alias("message"))


def batch_report(spark: SparkSession, path: str) -> DataFrame:
    """Rows of each month and tier by the manifest alone; no data is read."""
    _, entries = manifest(spark, path)
    rows = spark.createDataFrame([astuple(e) for e in entries], ENTRY).where("order_month IS NOT NULL")
    return rows.groupBy("order_month", "tier").agg(F.count("*").alias("batches"), F.sum("row_count").alias("row_count"))


def unreferenced(spark: SparkSession, path: str) -> DataFrame:
    """Directories that earlier versions of the manifest listed and the newest does not: free to be deleted."""
    versions = _versions(spark, path)
    if versions is None:
        return spark.createDataFrame([], "folder STRING")
    folder = F.concat("root", F.lit("/data/batch="), "batch", F.lit(f"/{MONTH}="), "order_month").alias("folder")
    newest, _ = manifest(spark, path)
    listed = versions.where("order_month IS NOT NULL").select("version", folder)
    return listed.groupBy("folder").agg(F.max("version").alias("v")).where(F.col("v") < newest).select("folder")

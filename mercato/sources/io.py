"""Readers with declared schemas and plain writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.operators.quality import DOCUMENT
from mercato.sources.schemas import TABLES


BAD_RECORD = "_bad_record"


def read_csv_table(spark: SparkSession, path: str, table: str, keep_bad: bool = False) -> DataFrame:
    """One of the relational tables from CSV with a header; nothing is inferred.

    A value that does not fit its column stops the read; with ``keep_bad`` the row stays
    and its line is in the column ``_bad_record``, which is null for good rows.  Reviews
    hold line breaks, so each of their files is read by one task: convert them to
    Parquet once and read that.
    """
    schema = TABLES[table] + (f", {BAD_RECORD} STRING" if keep_bad else "")
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", keep_bad)  # the extra column is in no file
        .option("multiLine", table == "order_reviews")
        .option("escape", '"')
        .option("mode", "PERMISSIVE" if keep_bad else "FAILFAST")
    )
    return (reader.option("columnNameOfCorruptRecord", BAD_RECORD) if keep_bad else reader).csv(path)


def bad_records(table: DataFrame) -> DataFrame:
    """First column and whole line of the rows of a table read with ``keep_bad`` that did not fit."""
    # Every column takes part, because the parser skips columns that nobody asks for and with them their bad values.
    parsed = F.length(F.concat_ws("", *[F.col(c).cast("string") for c in table.columns])) >= 0
    return table.where(parsed & (F.coalesce(BAD_RECORD, F.lit("")) != "")).select(table.columns[0], F.col(BAD_RECORD).alias("line"))


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A columnar table; a declared schema saves the job that reads the footers."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON document per line, read with its declared nested schema.

    The document itself stays beside the typed columns as VARIANT in ``_document``, so
    the validator can tell a value of the wrong type from a missing one.
    """
    lines = spark.read.text(path)
    typed = F.from_json("value", schema)
    return lines.select(typed.alias("typed"), F.try_parse_json("value").alias(DOCUMENT)).select("typed.*", DOCUMENT)


def register_tables(spark: SparkSession, folder: str, names: list[str]) -> None:
    """Expose the tables of a folder as temporary views for SQL users."""
    for name in names:
        read_table(spark, f"{folder}/{name}.parquet").createOrReplaceTempView(name)


def insert_documents(df: DataFrame, path: str) -> None:
    """Append documents as JSON lines."""
    df.write.mode("append").json(path)


def insert_rows(df: DataFrame, path: str) -> None:
    """Append rows to a columnar table."""
    df.write.mode("append").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """Write a result as CSV files with a header, in parallel."""
    df.write.mode("overwrite").option("header", True).csv(path)

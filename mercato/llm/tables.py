"""Small shared pieces: intermediate tables in the shared folder, text keys, word rules."""

from __future__ import annotations

import os
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import mercato
from mercato.session import new_table_path

#: Separator of words, as a Java pattern: space and the ASCII controls 9 to 13.
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the folder all executors share, and read back.

    What follows starts from the files, so a lost executor repeats no earlier work.
    """
    spark: SparkSession = df.sparkSession
    path = new_table_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_key(text: Column) -> Column:
    """A 256-bit key of a text; null for null."""
    return F.unhex(F.sha2(text, 256))


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row, however often and however deep ``use`` mentions it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` in order; null or blank text has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package's modules to the Python workers, as ``--py-files`` would; once per session."""
    context = spark.sparkContext
    if "mercato.zip" not in context._python_includes:
        root = Path(mercato.__file__).resolve().parent
        # In the driver's own Spark folder: the driver serves it to the executors from there.
        archive = os.path.join(context._temp_dir, "mercato.zip")
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for source in sorted(root.rglob("*.py")):
                out.write(source, source.relative_to(root.parent))
        context.addPyFile(archive)
    return spark

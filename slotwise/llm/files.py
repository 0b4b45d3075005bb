"""Raw binary files, written and read by Spark alone, so they may lie in any of its stores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_binary(rows: DataFrame, path: str) -> None:
    """Write ``payload`` of each row to files below ``path/<other columns>=...``.

    Spark's text sink writes a string's bytes as they are and a line end after each row; it also
    commits a task's files at once, so a task that is lost and run again leaves no second copy.
    Rows of one folder and task follow each other in one file.
    """
    folders = [c for c in rows.columns if c != "payload"]
    raw = rows.select(*folders, F.col("payload").cast("string").alias("value"))
    raw.write.partitionBy(*folders).text(path)


def read_binary(spark: SparkSession, path: str) -> DataFrame:
    """A row per file: ``content`` and the folder columns."""
    return spark.read.format("binaryFile").load(path).drop("path", "modificationTime", "length")

"""Prediction, metric and summary tables."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.schemas import DRIFT_SUMMARY, PREDICTIONS


def folder_of(spark: SparkSession, path: str):
    """A path and its file system, whatever store it lies in."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root, root.getFileSystem(spark._jsc.hadoopConfiguration())


def date_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the ``dt=YYYY-MM-DD`` folders of a table, in their order; none if there is no table."""
    root, fs = folder_of(spark, path)
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
    return sorted(n for n in names if n.startswith("dt=") and n[3:4].isdigit())


def newest_date(spark: SparkSession, path: str) -> date | None:
    """The last date a table holds rows of, from the names of its folders; no row is read but to
    pass over folders that writers left empty."""
    for name in reversed(date_folders(spark, path)):
        day = date.fromisoformat(name[3:])
        if not spark.read.parquet(path).where(F.col("dt") == F.lit(str(day)).cast("date")).isEmpty():
            return day
    return None


RETAINED = "_retained"  # folder of empty files named by the first date a table still holds


def note_retained(spark: SparkSession, path: str, first: date) -> None:
    root, fs = folder_of(spark, path)
    fs.create(spark._jvm.org.apache.hadoop.fs.Path(root, f"{RETAINED}/{first}"), True).close()


def first_retained(spark: SparkSession, path: str) -> date | None:
    """The first date that retention left in a table; None if it never ran there."""
    root, fs = folder_of(spark, path)
    notes = spark._jvm.org.apache.hadoop.fs.Path(root, RETAINED)
    if not fs.exists(notes):
        return None
    return max(date.fromisoformat(s.getPath().getName()) for s in fs.listStatus(notes))


def read_dated(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    start: str | date | None = None,
    end: str | date | None = None,
) -> DataFrame:
    """A date-partitioned table with its ``dt``, batch- or stream-written, after retention as well.

    The schema is declared, so no file is opened to infer it, and dates before the retention limit
    are pruned, so names of deleted files in a stream's log are never followed.
    """
    first = first_retained(spark, path)
    start = max((date.fromisoformat(str(d)) for d in (start, first) if d is not None), default=None)
    dated = T.StructType([f for f in schema.fields if f.name != "dt"] + [T.StructField("dt", T.DateType())])
    rows = spark.read.schema(dated).parquet(path)
    if start is not None:
        rows = rows.where(F.col("dt") >= F.lit(str(start)).cast("date"))
    if end is not None:
        rows = rows.where(F.col("dt") <= F.lit(str(end)).cast("date"))
    return rows


def query(spark: SparkSession, text: str, args: dict, **frames: DataFrame) -> DataFrame:
    """SQL with typed named parameters (``:name``) over frames (``{name}``)."""
    return spark.sql(text, args=args, **frames)


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    start: str | date | None = None,
    end: str | date | None = None,
) -> DataFrame:
    """A date-partitioned table without its partition column; empty if absent.

    Only the folders between the two inclusive dates are read.
    """
    try:
        return read_dated(spark, path, schema, start, end).select(*schema.fieldNames())
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)


def read_predictions(
    spark: SparkSession,
    path: str,
    start: str | date | None = None,
    end: str | date | None = None,
) -> DataFrame:
    """Predictions made between two inclusive dates."""
    return read_table(spark, path, PREDICTIONS, start, end)


def newest_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Predictions made on the newest date of the stored table: one folder is read, of any number."""
    day = newest_date(spark, path)
    if day is None:
        return spark.createDataFrame([], PREDICTIONS)
    return read_predictions(spark, path, day, day)


def stored_predictions_for(spark: SparkSession, path: str, target_time: datetime) -> DataFrame:
    """Predictions of one target time from the stored table: those made within a day before it."""
    day = target_time.date()
    return predictions_for(read_predictions(spark, path, day - timedelta(days=1), day), target_time)


def predictions_for(predictions: DataFrame, target_time: datetime) -> DataFrame:
    """Predictions of exactly one target time (UTC unless it has an offset)."""
    columns = ", ".join(PREDICTIONS.fieldNames())
    return query(
        predictions.sparkSession,
        f"SELECT {columns} FROM {{predictions}} "
        "WHERE target_time = CAST(:target_time AS TIMESTAMP)",
        {"target_time": str(target_time)},
        predictions=predictions,
    )


def read_drift_summary(spark: SparkSession, path: str, day: str | date) -> DataFrame:
    """The summary of a date; no row when there is none, so no alert fires."""
    try:
        summaries = spark.read.schema(DRIFT_SUMMARY).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        summaries = spark.createDataFrame([], DRIFT_SUMMARY)
    return summaries.where(F.col("date") == F.lit(str(day)).cast("date"))

"""Model runs and promotions as tables."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.ml import model as trees
from slotwise.ml.model import TreeModel
from slotwise.schemas import MODEL_RUNS, PROMOTIONS
from slotwise.sources.tables import read_table


def _utc(at: datetime) -> datetime:
    return at if at.tzinfo else at.replace(tzinfo=UTC)


def version_of(saved_at: datetime) -> str:
    return _utc(saved_at).astimezone(UTC).strftime("v%Y%m%d_%H%M%S")


def run_row(
    spark: SparkSession,
    saved_at: datetime,
    metrics: dict[str, float],
    feature_names: list[str],
    num_trees: int = 0,
    top: list[tuple[str, float]] = (),
) -> DataFrame:
    """One row of the model-run table."""
    row = (version_of(saved_at), _utc(saved_at), feature_names, num_trees, metrics, list(top))
    return spark.createDataFrame([row], MODEL_RUNS)


def log_run(row: DataFrame, path: str) -> None:
    """Append a run; a version that is already there is an error."""
    spark = row.sparkSession
    known = read_table(spark, path, MODEL_RUNS)
    if not known.join(row.select("version"), "version", "left_semi").isEmpty():
        raise ValueError("this version is already logged")
    row.coalesce(1).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, MODEL_RUNS)


def latest_run(runs: DataFrame) -> DataFrame:
    """The run with the greatest version name, which is the latest; no row without runs."""
    return runs.orderBy(F.col("version").desc()).limit(1)


def latest_version(runs: DataFrame) -> str:
    version = runs.agg(F.max("version").alias("v")).first()["v"]
    if version is None:
        raise LookupError("no model has been logged")
    return version


def champion(runs: DataFrame, promotions: DataFrame) -> DataFrame:
    """The run promoted last; no row when nothing was promoted."""
    last = promotions.orderBy(F.col("promoted_at").desc(), F.col("version").desc()).limit(1)
    return runs.join(last, "version")


def champion_metric(runs: DataFrame, promotions: DataFrame, name: str = "mae"):
    """The champion's metric as a scalar subquery; null without a champion."""
    return champion(runs, promotions).select(F.try_element_at("metrics", F.lit(name))).scalar()


def promote(spark: SparkSession, path: str, version: str, at: datetime) -> None:
    row = spark.createDataFrame([(version, _utc(at))], PROMOTIONS)
    row.coalesce(1).write.mode("append").parquet(path)


def save_model(model: TreeModel, test: DataFrame, path: str, version: str) -> None:
    """The fitted trees and category means with the test rows they are to be judged on."""
    model.pipeline.save(f"{path}/{version}/model")
    model.means.write.parquet(f"{path}/{version}/means")
    inputs = test.sparkSession.createDataFrame(
        [(model.columns, model.encoded, float(model.overall))],
        "columns array<string>, encoded array<string>, overall double",
    )
    inputs.coalesce(1).write.json(f"{path}/{version}/inputs")
    test.write.parquet(f"{path}/{version}/test")


def load_model(spark: SparkSession, path: str, version: str) -> TreeModel:
    inputs = spark.read.schema("columns array<string>, encoded array<string>, overall double")
    row = inputs.json(f"{path}/{version}/inputs").first()
    means = spark.read.parquet(f"{path}/{version}/means")
    pipeline = PipelineModel.load(f"{path}/{version}/model")
    return TreeModel(row["columns"], row["encoded"], means, row["overall"], pipeline)


def read_test_set(spark: SparkSession, path: str, version: str) -> DataFrame | None:
    """The stored test rows of a version, or None."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(f"{path}/{version}/test")
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def promote_if_better(
    challenger: TreeModel,
    challenger_version: str,
    champion_model: TreeModel | None,
    champion_mae: float | None,
    test: DataFrame | None,
    challenger_mae: float | None = None,
) -> dict:
    """Decide by the error of both models on the challenger's test rows.

    Without a champion the challenger wins. Without test rows, or if the champion's model
    is gone, its stored error stands in. Only a strictly lower error wins.
    """
    if test is not None:
        challenger_mae = trees.validation_mae(challenger, test)
        if champion_model is not None:
            champion_mae = trees.validation_mae(champion_model, test)
    promoted = champion_mae is None or (
        challenger_mae is not None and challenger_mae < champion_mae
    )
    return {
        "version": challenger_version,
        "challenger_mae": challenger_mae,
        "champion_mae": champion_mae,
        "promoted": promoted,
    }

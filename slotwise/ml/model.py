"""Boosted trees on the feature frame, trained with absolute loss on Spark ML."""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from slotwise.config import DEFAULTS, SERIES
from slotwise.operators.metrics import mae
from slotwise.functions.numeric import rounded_count
from slotwise.operators.rows import present
from slotwise.schemas import MODEL_COLUMNS
from slotwise.session import materialise, scratch_dir

# The trees reject nulls. This value lies below every real one, so a split can put
# "missing" on its own side, and no statistic has to be fitted for it.
MISSING = -1.0e6

# Candidates fitted at the same time. The passes of one fit wait for each other and leave cores idle between
# them; each fit keeps its own binned rows, so this also bounds the memory.
PARALLEL = 2

DEFAULT_PARAMS: dict[str, Any] = {
    "maxIter": 100,
    "stepSize": 0.05,
    "maxDepth": 6,
    "minInstancesPerNode": 20,
    "subsamplingRate": 0.8,
    "featureSubsetStrategy": "0.8",
    "seed": DEFAULTS.seed,
    "patience": 50,
}


@dataclass
class TreeModel:
    """Fitted trees with what turns a frame into their inputs.

    ``means`` has one row per category of each encoded column (``column``, ``category``,
    ``mean``): the mean target of the train part. It stays a table at every size.
    """

    columns: list[str]
    encoded: list[str]
    means: DataFrame
    overall: float
    pipeline: PipelineModel
    errors: list[float] = field(default_factory=list)  # on the validation part, by round

    @property
    def stages(self) -> list:
        return self.pipeline.stages


def _encoded(df: DataFrame, used: Sequence[str]) -> list[str]:
    """Text columns and the series key: numbers would order them by accident."""
    return [c for c in used if c == SERIES.key or df.schema[c].dataType.typeName() == "string"]


def category_means(train: DataFrame, encoded: Sequence[str]) -> DataFrame:
    """Mean target per category; each task adds up its own rows before anything moves."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category")) for c in encoded])
    )
    rows = train.select(F.col(SERIES.target).cast("double").alias("y"), pairs.alias("p"))
    return rows.where("p.category IS NOT NULL").groupBy("p.column", "p.category").agg(F.avg("y").alias("mean"))


def prepare(
    df: DataFrame, columns: Sequence[str], encoded: Sequence[str], means: DataFrame, overall: float
) -> DataFrame:
    """Add ``x_<column>`` model inputs: numbers and booleans as doubles, categories as the mean
    target the train part had for them, unseen ones as the overall mean."""
    inputs = {}
    for c in columns:
        if c in encoded:
            own = means.where(F.col("column") == c).select(
                F.col("category").alias(f"_k_{c}"), F.col("mean").alias(f"_m_{c}")
            )
            df = df.join(own, F.col(c).cast("string") == F.col(f"_k_{c}"), "left").drop(f"_k_{c}")
            inputs[f"x_{c}"] = F.coalesce(F.col(f"_m_{c}"), F.lit(overall))
        elif df.schema[c].dataType.typeName() == "boolean":
            inputs[f"x_{c}"] = F.coalesce(F.col(c).cast("int").cast("double"), F.lit(MISSING))
        else:
            inputs[f"x_{c}"] = F.coalesce(F.col(c).cast("double"), F.lit(MISSING))
    return df.withColumns(inputs)


@dataclass
class TreeInputs:
    """Model inputs of both parts, written once however many candidates are fitted on them."""

    columns: list[str]
    encoded: list[str]
    means: DataFrame
    overall: float
    assembler: VectorAssembler
    train: DataFrame
    val: DataFrame


def tree_inputs(train: DataFrame, val: DataFrame, columns: Sequence[str] = MODEL_COLUMNS) -> TreeInputs:
    """Vectors of the rows that have a target. Category means see the train part only."""
    has_target = F.col(SERIES.target).isNotNull()
    train, val = train.where(has_target), val.where(has_target)
    for name, part in (("training", train), ("validation", val)):
        if part.isEmpty():
            raise ValueError(f"the {name} set has no rows with a target")
    used = present(train, columns)
    encoded = _encoded(train, used)
    means = materialise(category_means(train, encoded), "category-means")
    overall = train.agg(F.avg(SERIES.target)).first()[0]
    assembler = VectorAssembler(inputCols=[f"x_{c}" for c in used], outputCol="features")
    parts = []
    for part in (train, val):
        rows = assembler.transform(prepare(part, used, encoded, means, overall))
        parts.append(materialise(rows.select("features", SERIES.target), "tree-input"))
    return TreeInputs(used, encoded, means, overall, assembler, *parts)


def best_round(errors: Sequence[float], patience: int | None) -> int:
    """How many trees to keep: up to the lowest error before ``patience`` rounds passed without a lower one."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif patience is not None and i - best >= patience:
            break
    return best + 1


def first_trees(model: GBTRegressionModel, n: int) -> GBTRegressionModel:
    """The ensemble of the first ``n`` trees."""
    if n >= model.getNumTrees:
        return model
    context = SparkSession.active().sparkContext
    java, jvm, gateway = model._java_obj, context._jvm, context._gateway
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    weights = gateway.new_array(jvm.double, n)
    for i in range(n):
        trees[i], weights[i] = java.trees()[i], java.treeWeights()[i]
    cut = GBTRegressionModel(jvm.org.apache.spark.ml.regression.GBTRegressionModel(model.uid, trees, weights))
    return cut.setFeaturesCol("features").setPredictionCol("prediction")


def fit_trees(inputs: TreeInputs, params: dict[str, Any] | None = None) -> TreeModel:
    """Grow ``maxIter`` trees on the train part, keep those up to the best round on the validation part.

    Each round's validation error comes from staged predictions, one pass for all rounds.
    ``patience`` ends the search for a better round; None looks at all of them.
    """
    settings = {"maxBins": 64, **DEFAULT_PARAMS, **(params or {})}
    patience = settings.pop("patience")
    trees = GBTRegressor(
        featuresCol="features", labelCol=SERIES.target, predictionCol="prediction", lossType="absolute", **settings
    ).fit(inputs.train)
    errors = trees.evaluateEachIteration(inputs.val, "absolute")
    kept = first_trees(trees, best_round(errors, patience))
    pipeline = PipelineModel(stages=[inputs.assembler, kept])
    return TreeModel(inputs.columns, inputs.encoded, inputs.means, inputs.overall, pipeline, list(errors))


def train_model(
    train: DataFrame,
    val: DataFrame,
    params: dict[str, Any] | None = None,
    columns: Sequence[str] = MODEL_COLUMNS,
) -> TreeModel:
    """Fit on ``train``, keep the trees up to the round with the lowest error on ``val``.

    Give it written or cached frames: the inputs are built from them more than once.
    """
    return fit_trees(tree_inputs(train, val, columns), params)


def predict(model: TreeModel, df: DataFrame) -> DataFrame:
    """``df`` with a ``prediction`` column; rows without a target are kept."""
    inputs = prepare(df, model.columns, model.encoded, model.means, model.overall)
    return model.pipeline.transform(inputs).select(*df.columns, "prediction")


def validation_mae(model: TreeModel, df: DataFrame) -> float:
    error = rounded_count(F.col("prediction")) - F.col(SERIES.target)
    rows = predict(model, df.where(F.col(SERIES.target).isNotNull()))
    return rows.agg(mae(error).alias("mae")).first()["mae"]


def inputs_mae(model: TreeModel, inputs: TreeInputs) -> float:
    """``validation_mae`` from the written vectors of the validation part, without building them again."""
    error = rounded_count(F.col("prediction")) - F.col(SERIES.target)
    return model.stages[-1].transform(inputs.val).agg(mae(error).alias("mae")).first()["mae"]


def fit_each(inputs: TreeInputs, candidates: Sequence[dict[str, Any]], parallel: int = PARALLEL) -> list[tuple[float, TreeModel]]:
    """The error on the validation part and the model of every candidate, in their order, ``parallel`` at a time."""

    def trial(params: dict[str, Any]):
        def run() -> tuple[float, TreeModel]:
            model = fit_trees(inputs, params)
            return inputs_mae(model, inputs), model

        return run

    runs = map(inheritable_thread_target(inputs.train.sparkSession), map(trial, candidates))
    with ThreadPool(max(1, min(parallel, len(candidates)))) as pool:
        return pool.map(lambda run: run(), list(runs), chunksize=1)


def grid(**choices: Sequence[Any]) -> list[dict[str, Any]]:
    """All combinations of the given parameter values."""
    return [dict(zip(choices, values)) for values in itertools.product(*choices.values())]


def tune(
    train: DataFrame,
    val: DataFrame,
    candidates: Sequence[dict[str, Any]],
    columns: Sequence[str] = MODEL_COLUMNS,
) -> tuple[dict[str, Any], TreeModel, list[tuple[dict[str, Any], float]]]:
    """Fit every candidate on ``train``, keep the one with the lowest error on ``val``.

    The validation part is later in time; random folds would leak the future. Returns the
    best parameters, its model, and all trials.
    """
    if not candidates:
        raise ValueError("no parameters to try")
    inputs = tree_inputs(train, val, columns)
    trials, best = [], None
    for params, (error, model) in zip(candidates, fit_each(inputs, candidates)):
        trials.append((params, error))
        if best is None or error < best[1]:
            best = (params, error, model)
    return best[0], best[2], trials


@dataclass(frozen=True)
class Range:
    """Values between two bounds, both included; ``log`` draws their logarithm, ``whole`` rounds."""

    low: float
    high: float
    log: bool = False
    whole: bool = False

    def draw(self, rng: random.Random) -> float:
        if self.log:
            value = math.exp(rng.uniform(math.log(self.low), math.log(self.high)))
        else:
            value = rng.uniform(self.low, self.high)
        value = min(max(value, self.low), self.high)
        return round(value) if self.whole else value


# What a search looks at unless told otherwise.
SEARCH_SPACE: dict[str, Range] = {
    "stepSize": Range(0.01, 0.3, log=True),
    "maxDepth": Range(4, 10, whole=True),
    "minInstancesPerNode": Range(5, 100, log=True, whole=True),
    "subsamplingRate": Range(0.5, 1.0),
}


def sampled(space: Mapping[str, Range | Sequence[Any]], n: int, seed: int = DEFAULTS.seed) -> list[dict[str, Any]]:
    """``n`` candidates drawn from ranges and lists of values; the same for the same seed."""
    rng = random.Random(seed)
    names = sorted(space)
    return [{c: space[c].draw(rng) if isinstance(space[c], Range) else rng.choice(list(space[c])) for c in names} for _ in range(n)]


@dataclass(frozen=True)
class Trial:
    number: int  # of the candidate
    params: dict[str, Any]
    rounds: int  # trees it was given
    error: float
    kept: bool  # it went on, or won


def search(
    train: DataFrame,
    val: DataFrame,
    space: Mapping[str, Range | Sequence[Any]] | None = None,
    n: int = 9,
    keep: int = 3,
    rounds: int | None = None,
    seed: int = DEFAULTS.seed,
    columns: Sequence[str] = MODEL_COLUMNS,
    fixed: dict[str, Any] | None = None,
) -> tuple[dict[str, Any], TreeModel, list[Trial]]:
    """Successive halving over ``n`` sampled candidates, judged on the later validation part.

    All candidates grow few trees; one in ``keep`` goes on with ``keep`` times as many, until the
    last grows ``rounds`` (``maxIter``). So a bad candidate costs a fraction of a fit. Ties go to
    the earlier candidate. Returns the best parameters, its model, and every trial.
    """
    if n < 1 or keep < 2:
        raise ValueError("a search needs a candidate, and keep must be 2 or more")
    rounds = rounds or (fixed or {}).get("maxIter", DEFAULT_PARAMS["maxIter"])
    live = list(enumerate(sampled(SEARCH_SPACE if space is None else space, n, seed)))
    inputs, trials = tree_inputs(train, val, columns), []
    steps = math.ceil(math.log(n, keep) - 1e-9) if n > 1 else 0
    for step in range(steps, -1, -1):
        grown = max(1, rounds // keep**step)
        fits = fit_each(inputs, [{**(fixed or {}), **params, "maxIter": grown} for _, params in live])
        tried = [(error, number, params, model) for (number, params), (error, model) in zip(live, fits)]
        tried.sort(key=lambda t: t[:2])
        best = tried[0]
        live = [(number, params) for _, number, params, _ in tried[: max(1, -(-len(tried) // keep)) if step else 1]]
        going = {number for number, _ in live}
        trials += [Trial(number, params, grown, error, number in going) for error, number, params, _ in tried]
    return best[2], best[3], trials


def num_trees(model: TreeModel) -> int:
    return model.stages[-1].getNumTrees


def feature_importance(model: TreeModel, spark) -> DataFrame:
    """(feature, gain, gain_pct, split, split_pct), one row per model column.

    Read from the saved trees as a table; columns that never split have zeros.
    """
    path = scratch_dir(spark, "trees")
    model.stages[-1].save(path)
    nodes = spark.read.parquet(f"{path}/data").select("nodeData.*")
    used = (
        nodes.where("split.featureIndex >= 0")
        .groupBy(F.col("split.featureIndex").alias("index"))
        .agg(F.sum("gain").alias("gain"), F.count("*").alias("split"))
    )
    names = spark.createDataFrame(list(enumerate(model.columns)), "index int, feature string")
    full = names.join(used, "index", "left").select(
        "feature",
        F.coalesce("gain", F.lit(0.0)).alias("gain"),
        F.coalesce("split", F.lit(0)).alias("split"),
    )
    return with_shares(full)


def with_shares(importance: DataFrame) -> DataFrame:
    """Gain and split with their percentage of the total, a total of 0 counting as 1.

    The window has no keys, over one row per model column.
    """
    all_rows = Window.partitionBy(F.lit(1))

    def share(name: str):
        total = F.sum(name).over(all_rows)
        return F.round(F.col(name) / F.when(total == 0, 1).otherwise(total) * 100, 2)

    return importance.select(
        "feature",
        F.round("gain", 4).alias("gain"),
        share("gain").alias("gain_pct"),
        "split",
        share("split").alias("split_pct"),
    )


def top_features(importance: DataFrame, n: int = 5, by: str = "gain") -> DataFrame:
    return importance.orderBy(F.col(by).desc(), "feature").limit(n)

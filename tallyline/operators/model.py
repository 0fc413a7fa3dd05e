"""Model table, time split, boosted-tree training and scoring as Spark jobs."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.contracts import ContractError, require_columns
from tallyline.functions.dates import to_day
from tallyline.functions.numeric import finite_or_null
from tallyline.operators.evaluate import PREDICTED, add_base_uncertainty, apply_intervals
from tallyline.operators.trailing import latest_rows
from tallyline.schemas import MODEL_FEATURES, MODEL_LABEL, SPLIT_DATE, UNCERTAINTY_COLUMNS
from tallyline.session import ensure_checkpoint_dir

ID_COLUMNS = ("game_date", "game_pk", "pitcher", "player_name")


@dataclass(frozen=True)
class BoostParams:
    """Boosting parameters; the defaults are the fixed values of the workload."""

    max_depth: int = 4
    step_size: float = 0.05
    subsample: float = 0.8
    feature_share: float = 0.8
    seed: int = 42
    rounds: int = 200


def model_table(periods: DataFrame) -> DataFrame:
    """Ids, label, features and uncertainty columns. Infinite values are missing, rows
    without label or any feature drop out, missing uncertainty does not matter."""
    base = [*ID_COLUMNS, MODEL_LABEL, *MODEL_FEATURES]
    require_columns(periods, base, "entity_periods")
    extra = [c for c in UNCERTAINTY_COLUMNS if c in periods.columns]
    chosen = periods.select(*base, *extra).withColumn("game_date", to_day(F.col("game_date")))
    floating = [f.name for f in chosen.schema.fields if f.dataType.typeName() in ("double", "float")]
    cleaned = chosen.withColumns({c: finite_or_null(F.col(c)) for c in floating})
    return cleaned.dropna(subset=[MODEL_LABEL, *MODEL_FEATURES])


def time_split(table: DataFrame, split_date: str = SPLIT_DATE, *, strict: bool = True):
    """(train, test): rows before the date, rows from it on; both must hold rows."""
    day = F.lit(split_date).cast("date")
    train, test = table.filter(F.col("game_date") < day), table.filter(F.col("game_date") >= day)
    if strict and (train.isEmpty() or test.isEmpty()):
        raise ContractError(f"empty train or test split: rows are needed on both sides of {split_date}")
    return train, test


def assembler(features: Sequence[str] = MODEL_FEATURES) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def train_model(
    train: DataFrame,
    *,
    features: Sequence[str] = MODEL_FEATURES,
    label: str = MODEL_LABEL,
    params: BoostParams = BoostParams(),
    validation: str | None = None,
    tolerance: float = 0.01,
) -> PipelineModel:
    """Fit boosted regression trees on squared error. Rows for which the boolean column
    ``validation`` holds are not fitted; boosting ends when their error no longer falls by
    ``tolerance`` (relative to it, if it is over 1%).

    Boosting is a long iteration, so its lineage is cut in the shared folder every few
    rounds; a lost executor costs those rounds, not the run."""
    require_columns(train, [*features, label], "train")
    ensure_checkpoint_dir(train.sparkSession)
    assemble = assembler(features)
    booster = GBTRegressor(
        featuresCol="features",
        labelCol=label,
        predictionCol=PREDICTED,
        lossType="squared",
        maxDepth=params.max_depth,
        stepSize=params.step_size,
        subsamplingRate=params.subsample,
        featureSubsetStrategy=str(params.feature_share),
        seed=params.seed,
        maxIter=params.rounds,
        cacheNodeIds=True,
        checkpointInterval=10,
    )
    chosen = [*features, F.col(label).cast("double").alias(label)]
    if validation:
        booster = booster.setParams(validationIndicatorCol=validation, validationTol=tolerance)
        chosen.append(F.coalesce(F.col(validation), F.lit(False)).alias(validation))
    rows = assemble.transform(train.select(*chosen))
    return PipelineModel(stages=[assemble, booster.fit(rows)])


def score(
    model: PipelineModel,
    df: DataFrame,
    *,
    features: Sequence[str] = MODEL_FEATURES,
    interval_config: Mapping | None = None,
) -> DataFrame:
    """Forecast, deviation and interval for any table that has the feature columns."""
    require_columns(df, features, "features")
    forecast = model.transform(df).drop("features")
    return apply_intervals(add_base_uncertainty(forecast), interval_config)


def error_by_round(
    model: PipelineModel, tables: Mapping[str, DataFrame], *, features: Sequence[str] = MODEL_FEATURES, label: str = MODEL_LABEL
) -> DataFrame:
    """Rows (round, one column for each table): the root mean squared error after every
    round of boosting. Each table is read once: its rows add up the margins of the trees, and
    sums of squares by round are all that leaves a task. An empty table has no errors."""
    assemble, boosted = model.stages
    errors = {}
    for name, table in tables.items():
        rows = table.select(*features, F.col(label).cast("double").alias(label)).dropna(subset=[label])
        if rows.isEmpty():
            errors[name] = [None] * boosted.getNumTrees
        else:
            means = boosted.evaluateEachIteration(assemble.transform(rows), "squared")
            errors[name] = [math.sqrt(e) for e in means]
    layout = "round int, " + ", ".join(f"`{name}` double" for name in errors)
    rounds = [(i + 1, *(e[i] for e in errors.values())) for i in range(boosted.getNumTrees)]
    return SparkSession.active().createDataFrame(rounds, layout)


def score_latest(model: PipelineModel, table: DataFrame, *, features: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Forecasts for the latest row of every entity."""
    scored = score(model, latest_rows(table, ("pitcher",), ("game_date", "game_pk")), features=features)
    kept = ["game_date", "pitcher", MODEL_LABEL, PREDICTED, "lower_bound", "upper_bound", "std_dev"]
    return scored.select(*kept, *features)


def feature_importance(model: PipelineModel) -> DataFrame:
    """Normalized gain of every used feature, highest first."""
    names = model.stages[0].getInputCols()
    gains = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(gain)) for name, gain in zip(names, gains, strict=True) if gain > 0]
    return SparkSession.active().createDataFrame(rows, "feature string, importance_gain double").orderBy(
        F.col("importance_gain").desc(), "feature"
    )


def params_record(params: BoostParams) -> dict:
    """The parameters as the training metadata stores them."""
    return asdict(params)

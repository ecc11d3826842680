"""Regression models and metrics on Spark ML.

The forest matches the reference's settings where Spark allows: 500 trees, all
features at every split, seed 42. Spark caps tree depth at 30 and bins
continuous features, so trees are not bit-equal to scikit-learn's; results
are compared by metrics. Models are ``PipelineModel``s saved to shared storage.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import reliable_checkpoint
from .columns import q
from .features import DENSITY_LOG, LAG_NAMES, ROLLING_NAME, trend_lines

FOREST_TREES = 500
FOREST_MAX_DEPTH = 30   # Spark's limit; the reference grows trees without a limit
FOREST_SEED = 42


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")


def forest_pipeline(features: Sequence[str], label: str = "count", num_trees: int = FOREST_TREES,
                    max_depth: int = FOREST_MAX_DEPTH, seed: int = FOREST_SEED, max_bins: int = 32,
                    max_memory_mb: int = 2048) -> Pipeline:
    """M4: assembler + random forest regressor.

    The training frame is a panel (areas x months), small at any input size, while
    500 unpruned trees have hundreds of thousands of nodes: the cost is the number
    of node-splitting rounds, so each round may hold ``max_memory_mb`` of split
    statistics and node ids are cached on the executors instead of being re-derived
    from the trees every round."""
    rf = RandomForestRegressor(featuresCol="features", labelCol=label, predictionCol="prediction",
                               numTrees=num_trees, maxDepth=max_depth, seed=seed, maxBins=max_bins,
                               featureSubsetStrategy="all", bootstrap=True, minInstancesPerNode=1,
                               maxMemoryInMB=max_memory_mb, cacheNodeIds=True, checkpointInterval=10)
    return Pipeline(stages=[_assembler(features), rf])


def linear_pipeline(features: Sequence[str], label: str = "count") -> Pipeline:
    """M8: assembler + ordinary least squares."""
    lr = LinearRegression(featuresCol="features", labelCol=label, predictionCol="prediction", regParam=0.0,
                          elasticNetParam=0.0, solver="normal")
    return Pipeline(stages=[_assembler(features), lr])


def fit(pipeline: Pipeline, train: DataFrame, label: str = "count") -> PipelineModel:
    """Fit on rows with a label. The input is checkpointed to the shared checkpoint
    folder first: iterative training re-reads it many times, and a lost executor
    then recomputes from the checkpoint, not from the raw tables."""
    return pipeline.fit(reliable_checkpoint(train.where(F.col(label).isNotNull())))


def predict_frame(model: PipelineModel, test: DataFrame, key: str = "area_code", date_col: str = "date",
                  label: str = "count") -> DataFrame:
    """M5: ``(key, date, predicted_crime, actual_crime)``."""
    return model.transform(test).select(key, date_col, F.col("prediction").alias("predicted_crime"),
                                        F.col(label).cast("double").alias("actual_crime"))


def regression_metrics(results: DataFrame, actual: str = "actual_crime", predicted: str = "predicted_crime"
                       ) -> DataFrame:
    """E5: one row ``(n, mse, rmse)`` over rows where both values exist."""
    sq = F.pow(F.col(actual) - F.col(predicted), 2)
    return (results.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
            .agg(F.count(F.lit(1)).alias("n"), F.avg(sq).alias("mse"))
            .withColumn("rmse", F.sqrt("mse")))


def metrics_by_area(results: DataFrame, key: str = "area_code", actual: str = "actual_crime",
                    predicted: str = "predicted_crime") -> DataFrame:
    """``(key, n, mse)`` per area."""
    sq = F.pow(F.col(actual) - F.col(predicted), 2)
    return (results.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
            .groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.avg(sq).alias("mse")))


def score(model: PipelineModel, features: DataFrame, key: str = "area_code", date_col: str = "date") -> DataFrame:
    """M6/M7: ``(key, date, crime_prediction)`` for every row of ``features``."""
    return model.transform(features).select(key, date_col, F.col("prediction").alias("crime_prediction"))


def forecast_months(model: PipelineModel, history: DataFrame, months: int, key: str = "area_code", date_col: str = "date",
                    target: str = "count", density_col: str | None = "population_density",
                    trend_cols: Sequence[str] | None = None) -> DataFrame:
    """M7 for several months: ``(key, date, step, crime_prediction)`` for the ``months`` months after each area's last row.

    Every step predicts all areas at once; its predictions become the newest of the three values that the next step's lags
    and rolling mean come from. Other columns go on along each area's own line (M1): a point on a line doesn't turn it, so
    the line is fitted once. What a step passes on, one row per area, is written to the shared folder, so a plan is as deep
    at the last month as at the first. Areas with fewer than three rows have no lags and are left out.
    """
    if months < 1:
        raise ValueError("months must be at least 1")
    lines = trend_lines(history, key, date_col, target, trend_cols)
    newest = Window.partitionBy(q(key)).orderBy(F.desc(q(date_col)))
    last = history.select(q(key), q(date_col), q(target).cast("double").alias("_y")).withColumn(
        "_r", F.row_number().over(newest)).where(F.col("_r") <= len(LAG_NAMES))
    lags = last.groupBy(q(key)).agg(*[F.max(F.when(F.col("_r") == i + 1, F.col("_y"))).alias(n) for i, n in enumerate(LAG_NAMES)])
    state = reliable_checkpoint(lines.join(lags.na.drop(subset=[LAG_NAMES[-1]]), key))
    trends = [f.name for f in lines.schema.fields if f.name.startswith("_slope_")]
    steps = []
    for step in range(months):
        rows = state.withColumn(date_col, F.add_months(F.col("_last"), step + 1))
        for name in trends:
            c = name.removeprefix("_slope_")
            rows = rows.withColumn(c, F.col(f"_start_{c}") + F.col(name) * (F.col("_n") + step))
        rows = rows.withColumn(ROLLING_NAME, sum(F.col(n) for n in LAG_NAMES) / len(LAG_NAMES))
        if density_col is not None and density_col in rows.columns:
            rows = rows.withColumn(DENSITY_LOG, F.log1p(q(density_col)))
        scored = model.transform(rows).select(*state.columns, q(date_col), F.col("prediction").alias("_p"))
        scored = reliable_checkpoint(scored)
        steps.append(scored.select(q(key), q(date_col), F.lit(step + 1).alias("step"), F.col("_p").alias("crime_prediction")))
        state = scored.select(*[c for c in state.columns if c not in LAG_NAMES], F.col("_p").alias(LAG_NAMES[0]), *[
            F.col(a).alias(b) for a, b in zip(LAG_NAMES[:-1], LAG_NAMES[1:], strict=True)])
    return reduce(DataFrame.unionByName, steps)


def linear_coefficients(model: PipelineModel, features: Sequence[str]) -> list[tuple[str, float]]:
    """M8: ``[("intercept", b0), (feature, b), …]`` from a fitted linear pipeline."""
    lr = model.stages[-1]
    return [("intercept", float(lr.intercept))] + [(f, float(c)) for f, c in zip(features, lr.coefficients)]


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)

"""Registered feature and model queries on the stand-in panels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import features as M
from ..operators import models as ML
from ..operators import relational as R
from ..operators import timeseries as TS
from ..session import reliable_checkpoint
from . import jobs as J
from . import standins as S
from .catalog import _r, register
from .catalog_io import trend_panel
from .views import prediction_for


def density_panel(spark, sf, panel_df: DataFrame | None = None) -> DataFrame:
    """Orders per km² of a nation's stand-in area (population density stand-in)."""
    panel_df = S.panel(spark, sf) if panel_df is None else panel_df
    pop = panel_df.select("area_code", "date", F.col("count").alias("population"))
    area = S.table(spark, sf, "nation").select(S.area_code("n_nationkey").alias("area_code"),
                                               ((F.col("n_regionkey") + 1) * 1.5).alias("area"))
    return R.ratio_join_density(pop, area, "area_code", "population", "area")


def history(spark, sf) -> DataFrame:
    return R.join_panels([S.panel(spark, sf), S.supply_panel(spark, sf)])


@register
def q_trend_forecast(spark, sf):
    out = M.trend_forecast(history(spark, sf), "area_code", "date", "count")
    return out.withColumns({c: _r(F.col(c), 4) for c in ("value", "qty", "gross")})


@register
def q_prediction_features(spark, sf):
    p = reliable_checkpoint(S.panel(spark, sf))  # its orders are scanned once for both panels
    h = reliable_checkpoint(R.join_panels([p, S.supply_panel(spark, sf), density_panel(spark, sf, p)]))
    out = M.prediction_features(h, "area_code", "date", "count", "population_density")
    return out.withColumns({**{c: _r(F.col(c), 4) for c in ("value", "qty", "gross")},
                            M.ROLLING_NAME: _r(F.col(M.ROLLING_NAME)), M.DENSITY_LOG: _r(F.col(M.DENSITY_LOG))})


def model_panels(spark, sf) -> list[DataFrame]:
    """The four panels the model reads. The order panel feeds three of them, so its
    aggregate over the raw orders runs once and is checkpointed (it is small:
    areas × months), instead of rescanning the orders table per branch."""
    p = reliable_checkpoint(S.panel(spark, sf))
    return [p, S.supply_panel(spark, sf), trend_panel(spark, sf, p), density_panel(spark, sf, p)]


def training_frame(spark, sf, panels: list[DataFrame] | None = None):
    panels = model_panels(spark, sf) if panels is None else panels
    return M.training_features(panels, "area_code", "date", "count", "population_density", names=S.names(spark, sf))


@register
def q_training_features(spark, sf):
    feats, _ = training_frame(spark, sf)
    return feats.withColumns({M.ROLLING_NAME: _r(F.col(M.ROLLING_NAME)), M.DENSITY_LOG: _r(F.col(M.DENSITY_LOG))})


def lag_results(spark, sf) -> DataFrame:
    """Naive forecast results: last month's count predicts this month's."""
    lags = TS.lag_features(S.panel(spark, sf), "area_code", "date", "count", (1,), ["prev"], dropna=True)
    return lags.select("area_code", "date", F.col("prev").cast("double").alias("predicted_crime"),
                       F.col("count").cast("double").alias("actual_crime"))


@register
def q_regression_metrics(spark, sf):
    out = ML.regression_metrics(lag_results(spark, sf))
    return out.select("n", _r(F.col("mse")).alias("mse"), _r(F.col("rmse")).alias("rmse"))


@register
def q_metrics_by_area(spark, sf):
    out = ML.metrics_by_area(lag_results(spark, sf))
    return out.select("area_code", "n", _r(F.col("mse")).alias("mse"))


@register
def q_linear_fit(spark, sf):
    lags = TS.lag_features(S.panel(spark, sf), "area_code", "date", "count", (1,), ["crime_last_month"])
    model = ML.fit(ML.linear_pipeline(["crime_last_month"]), lags)
    coefs = ML.linear_coefficients(model, ["crime_last_month"])
    return spark.createDataFrame([(t, round(v, 6)) for t, v in coefs], "term string, coefficient double")


FORECAST_MONTHS = 6


@register
def q_forecast_months(spark, sf):
    """Six months ahead by a linear model of the mean of the last three months."""
    p = reliable_checkpoint(S.panel(spark, sf))
    feats = M.add_crime_features(p, "area_code", "date", "count", None)
    model = ML.fit(ML.linear_pipeline([M.ROLLING_NAME]), feats)
    out = ML.forecast_months(model, p, FORECAST_MONTHS, "area_code", "date", "count", None)
    return out.select("area_code", "date", "step", _r(F.col("crime_prediction"), 4).alias("crime_prediction"))


def ward_panels(spark, sf) -> dict[str, DataFrame]:
    """The four published panels under their published column names, from the stand-in panels."""
    p = reliable_checkpoint(S.panel(spark, sf))
    ward = F.col("area_code").alias("ward_code")
    supply, trend = S.supply_panel(spark, sf), trend_panel(spark, sf, p)
    return {"crime": p.select(ward, "date", "count"),
            "education": supply.select(ward, "date", F.col("qty").alias("pop_with_qual"), F.col("gross").alias("pop_without_qual")),
            "employment": trend.select(ward, "date", F.col("value_trend").alias("unemployed_adults")),
            "density": density_panel(spark, sf, p).select(ward, "date", "population_density")}


def ward_names(spark, sf) -> DataFrame:
    return S.names(spark, sf).select(F.col("area_code").alias("ward_code"), F.col("area_name").alias("ward_name"))


@register
def q_rf_fit_predict(spark, sf):
    """J7 with the full forest: predictions for the last tenth of the rows."""
    return J.training_job(**ward_panels(spark, sf), names=ward_names(spark, sf))["results"]


@register
def q_score_next_month(spark, sf):
    """J8 with the full forest: next month's prediction for every ward."""
    panels = ward_panels(spark, sf)
    model = J.training_job(**panels, names=ward_names(spark, sf))["model"]
    return J.scoring_job(model, **panels)


#: Trees of the forest where only facts about the result are compared.
FEW_TREES = 20


def _plausible(value: str, labels: DataFrame) -> Column:
    """A mean of training labels lies between the least and the greatest of them."""
    ends = labels.agg(F.min("count").alias("lo"), F.max("count").alias("hi"))
    return F.col(value).between(ends.select("lo").scalar(), ends.select("hi").scalar())


@register
def q_training_job(spark, sf):
    """The rows tested and what was counted there; predictions lie within the labels seen."""
    panels = ward_panels(spark, sf)
    out = J.training_job(**panels, names=ward_names(spark, sf), num_trees=FEW_TREES)
    return out["results"].select("ward_code", "date", "actual_crime", _plausible("predicted_crime", panels["crime"]).alias("plausible"))


@register
def q_scoring_job(spark, sf):
    """The month after each ward's last, a plausible prediction, and the answer for that ward alone."""
    panels = ward_panels(spark, sf)
    model = J.training_job(**panels, names=ward_names(spark, sf), num_trees=FEW_TREES)["model"]
    scored = reliable_checkpoint(J.scoring_job(model, **panels))
    one = S.area_code(F.lit(7))
    answer = prediction_for(scored, one, "ward_code").select(F.col("crime_prediction").alias("answer"))
    return scored.join(answer, (F.col("ward_code") == one) & (F.col("answer") == F.col("crime_prediction")), "left").select(
        "ward_code", "date", _plausible("crime_prediction", panels["crime"]).alias("plausible"), F.col("answer").isNotNull().alias("answered"))

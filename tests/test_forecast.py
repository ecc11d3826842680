"""Several months ahead: each step against plain Python that walks one area at a time."""

import datetime as dt
import math
import random

import numpy as np
import pytest

from areapanel.operators import features as M
from areapanel.operators import models as ML


def months_on(d, k):
    m = d.year * 12 + d.month - 1 + k
    return dt.date(m // 12, m % 12 + 1, 1)


def test_steps_feed_the_next(spark):
    random.seed(8)
    rows = [(a, months_on(dt.date(2020, 1, 1), i), random.randint(5, 60), random.uniform(0, 9), 50 + 3 * i + random.uniform(0, 2))
            for a, n in (("A", 12), ("B", 7), ("C", 3), ("D", 2)) for i in range(n)]
    df = spark.createDataFrame(rows, "area_code string, date date, count long, extra double, population_density double")
    cols = ["extra", *M.LAG_NAMES, M.ROLLING_NAME, M.DENSITY_LOG]
    model = ML.fit(ML.linear_pipeline(["extra", M.LAG_NAMES[0], M.LAG_NAMES[2], M.DENSITY_LOG]), M.add_crime_features(df))
    coef = dict(ML.linear_coefficients(model, ["extra", M.LAG_NAMES[0], M.LAG_NAMES[2], M.DENSITY_LOG]))
    got = {(r.area_code, r.step): r for r in ML.forecast_months(model, df, 5).collect()}
    assert {k[0] for k in got} == {"A", "B", "C"} and len(got) == 15 and len(cols) == 6
    for area in "ABC":
        own = sorted(r[1:] for r in rows if r[0] == area)
        counts = [float(r[1]) for r in own]
        lines = [np.polyfit(range(len(own)), [r[k] for r in own], 1) for k in (2, 3)]
        for step in range(5):
            extra, density = (line[0] * (len(own) + step) + line[1] for line in lines)
            want = (coef["intercept"] + coef["extra"] * extra + coef[M.LAG_NAMES[0]] * counts[-1]
                    + coef[M.LAG_NAMES[2]] * counts[-3] + coef[M.DENSITY_LOG] * math.log1p(density))
            assert got[area, step + 1].crime_prediction == pytest.approx(want, rel=1e-9)
            assert got[area, step + 1].date == months_on(own[-1][0], step + 1)
            counts.append(want)


def test_first_step_is_the_next_month(spark):
    rows = [(a, months_on(dt.date(2020, 1, 1), i), i * k + 3, float(i), 2.0) for k, a in enumerate("AB") for i in range(9)]
    df = spark.createDataFrame(rows, "area_code string, date date, count long, extra double, population_density double")
    model = ML.fit(ML.linear_pipeline(["extra", M.LAG_NAMES[1], M.ROLLING_NAME]), M.add_crime_features(df))
    want = {r.area_code: r.crime_prediction for r in ML.score(model, M.prediction_features(df)).collect()}
    got = {r.area_code: r.crime_prediction for r in ML.forecast_months(model, df, 1).collect()}
    assert got == pytest.approx(want)
    with pytest.raises(ValueError):
        ML.forecast_months(model, df, 0)

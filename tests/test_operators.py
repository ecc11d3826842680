import datetime as dt

import pytest
from pyspark.sql import functions as F

from areapanel.operators import checks as C
from areapanel.operators import columns as B
from areapanel.operators import features as M
from areapanel.operators import relational as R
from areapanel.operators import timeseries as TS


def d(y, m, day=1):
    return dt.date(y, m, day)


def test_exclude_values_keeps_nulls(spark):
    df = spark.createDataFrame([("a",), (None,)], "c string")
    assert [r.c for r in B.exclude_values(df, "c", ["a"]).collect()] == [None]


def test_group_sum_null_rules(spark):
    df = spark.createDataFrame([("a", None), (None, 2.0)], "k string, v double")
    assert [tuple(r) for r in R.group_sum(df, "k", "v").collect()] == [("a", 0.0)]


def test_null_safe_left_join(spark):
    left = spark.createDataFrame([("a", 1), (None, 2)], "k string, l int")
    right = spark.createDataFrame([("a", 10), (None, 20)], "k string, r int")
    got = {tuple(r) for r in R.lookup_left_join(left, right, "k", null_safe=True).collect()}
    assert got == {("a", 1, 10), (None, 2, 20)}
    plain = {tuple(r) for r in R.lookup_left_join(left, right, "k").collect()}
    assert (None, 2, None) in plain


def test_join_suffixes_clashing_columns(spark):
    left = spark.createDataFrame([("a", 1)], "k string, v int")
    right = spark.createDataFrame([("a", 2)], "k string, v int")
    assert R.lookup_left_join(left, right, "k").columns == ["k", "v_x", "v_y"]


def test_require_columns_exact_case(spark):
    df = spark.createDataFrame([(1,)], "K int")
    with pytest.raises(ValueError):
        B.rename_columns(df, {"k": "x"})
    with pytest.raises(ValueError):
        B.subset_columns(df, ["missing"])


def test_contains_all_is_regex_any_case(spark):
    df = spark.createDataFrame([("ab",), ("a.b",), ("xaxby",), (None,)], "s string")
    assert [r.s for r in B.contains_all(df, "s", "A.B").collect()] == ["a.b", "xaxby"]
    assert [r.s for r in B.contains_all(df, "s", r"A\.B").collect()] == ["a.b"]
    assert [r.s for r in B.contains_all(df, "s", ["a", "y"]).collect()] == ["xaxby"]


def test_split_rows_null_goes_to_not_equal(spark):
    df = spark.createDataFrame([("x",), ("y",), (None,)], "c string")
    eq, ne = B.split_rows(df, "c", "x")
    assert eq.count() == 1 and ne.count() == 2


def test_fractions_see_earlier_results(spark):
    df = spark.createDataFrame([(2.0, 4.0, 8.0)], "a double, b double, c double")
    out = B.fractions(df, {"b": "c", "a": "b"}).first()
    assert (out.b, out.a) == (0.5, 4.0)


def test_apply_weight_reference_squares_weight(spark):
    df = spark.createDataFrame([(2.0, 0.5)], "v double, w double")
    assert tuple(B.apply_weight(df, "w", square_weight=True).first()) == (1.0, 0.25)


def test_pivot_wide(spark):
    df = spark.createDataFrame([(2, "y", 1), (1, "x", 2)], "i int, c string, v int")
    out = {r.i: (r.x, r.y) for r in R.pivot_wide(df, "i", "c", "v").collect()}
    assert out == {1: (2, None), 2: (None, 1)}
    dup = spark.createDataFrame([(1, "x", 1), (1, "x", 2)], "i int, c string, v int")
    with pytest.raises(Exception):
        R.pivot_wide(dup, "i", "c", "v", ["x"]).collect()


def test_stack_frames(spark):
    a = spark.createDataFrame([(1,)], "a int")
    b = spark.createDataFrame([("x", 2)], "b string, a int")
    assert sorted(tuple(r) for r in R.stack_frames([a, b]).collect()) == [(1, None), (2, "x")]


def test_interpolate_linear(spark):
    vals = [None, 1.0, None, 3.0, None]
    df = spark.createDataFrame([("k", i, v) for i, v in enumerate(vals)], "k string, i int, v double")
    out = [r.v for r in TS.interpolate_linear(df, "k", "i", "v").orderBy("i").collect()]
    assert out == [None, 1.0, 2.0, 3.0, 3.0]


def test_interpolate_stays_within_group(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 1, 2.0), ("b", 0, None), ("b", 1, 5.0)],
                               "k string, i int, v double")
    out = {(r.k, r.i): r.v for r in TS.interpolate_linear(df, "k", "i", "v").collect()}
    assert out[("b", 0)] is None


def _fill_by_position(vals):
    out = []
    for i, v in enumerate(vals):
        prev = [j for j in range(i) if vals[j] is not None]
        nxt = [j for j in range(i + 1, len(vals)) if vals[j] is not None]
        if v is not None or not prev:
            out.append(v)
        elif not nxt:
            out.append(vals[prev[-1]])
        else:
            i0, i1 = prev[-1], nxt[0]
            out.append(vals[i0] + (vals[i1] - vals[i0]) / (i1 - i0) * (i - i0))
    return out


def test_interpolate_whole_frame_across_partitions(spark):
    """key=None (the reference's whole-frame fill) is a distributed scan: runs of
    nulls crossing range-partition boundaries are filled as one series."""
    import random
    rng = random.Random(7)
    for n, p_null in [(1, 0.5), (37, 0.8), (250, 0.95), (250, 0.3)]:
        a = [None if rng.random() < p_null else float(rng.randint(0, 99)) for _ in range(n)]
        b = [None if rng.random() < 0.5 else float(rng.randint(0, 99)) for _ in range(n)]
        rows = [(3 * i, a[i], b[i]) for i in range(n)]
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "t int, a double, b double").repartition(5)
        out = TS.interpolate_linear(df, None, "t", ["a", "b"]).orderBy("t").collect()
        assert len(out) == n
        for got, want in [([r.a for r in out], _fill_by_position(a)), ([r.b for r in out], _fill_by_position(b))]:
            assert all((g is None and w is None) or (g is not None and w is not None and abs(g - w) < 1e-9)
                       for g, w in zip(got, want))


def test_densify_linear_12_and_133(spark):
    df = spark.createDataFrame([("w", d(2011, 1), 1.0), ("w", d(2011, 12), 12.0)], "k string, date date, v double")
    out = TS.densify_linear(df, "k", "date", "v").orderBy("date").collect()
    assert [r.v for r in out] == [float(i) for i in range(1, 13)]
    assert [r.date for r in out] == [d(2011, m) for m in range(1, 13)]
    long = spark.createDataFrame([("w", d(2011, 1), 0.0), ("w", d(2022, 1), 132.0), ("x", d(2011, 1), 5.0)],
                                 "k string, date date, v double")
    out = TS.densify_linear(long, "k", "date", "v")
    assert out.where("k = 'w'").count() == 133
    assert out.where("k = 'x'").count() == 1  # one census row: kept, not an error
    C.enforce(out.where("k = 'w'"), {"series": lambda x: C.check_month_series(x, "k", "date", "2011-01-01",
                                                                               "2022-01-01")})


def test_expand_months_mid_month_start(spark):
    df = spark.createDataFrame([("w", d(2011, 1, 15), 1.0), ("w", d(2011, 4, 15), 4.0)],
                               "k string, date date, v double")
    out = TS.expand_months(df, "k", "date").orderBy("date").collect()
    assert [r.date for r in out] == [d(2011, 1, 15), d(2011, 2, 1), d(2011, 3, 1), d(2011, 4, 15)]
    assert [r.v for r in out] == [1.0, None, None, 4.0]


def test_extend_flat(spark):
    df = spark.createDataFrame([("w", d(2020, 11), 3.0)], "k string, date date, v double")
    out = TS.extend_flat(df, "k", "date", "2021-02-01").orderBy("date").collect()
    assert [(r.date, r.v) for r in out] == [(d(2020, 11), 3.0), (d(2020, 12), 3.0), (d(2021, 1), 3.0),
                                            (d(2021, 2), 3.0)]


def test_resample_monthly(spark):
    df = spark.createDataFrame([("a", d(2020, 1, 1), 1.0), ("a", d(2020, 3, 1), 3.0), ("a", d(2020, 3, 15), 5.0)],
                               "k string, date date, v double")
    out = TS.resample_monthly(df, "k", "date", "v").orderBy("date").collect()
    assert [(r.date, r.v) for r in out] == [(d(2020, 1), 1.0), (d(2020, 2), 2.5), (d(2020, 3), 4.0)]


def test_rolling_mean_needs_all_three(spark):
    vals = [1, 2, None, 4, 5, 6, 7]
    df = spark.createDataFrame([("k", i, v) for i, v in enumerate(vals)], "k string, i int, v int")
    out = [r.m for r in TS.rolling_mean(df, "k", "i", "v", name="m").orderBy("i").collect()]
    assert out == [None] * 6 + [5.0]


def test_lag_features_positional(spark):
    df = spark.createDataFrame([("k", d(2020, m), m) for m in (1, 2, 4, 5)], "k string, date date, c int")
    out = TS.lag_features(df, "k", "date", "c").orderBy("date").collect()
    assert [(r.c, r.c_lag1, r.c_lag3) for r in out] == [(5, 4, 1)]


def test_trend_forecast(spark):
    df = spark.createDataFrame([("a", d(2020, 1), 5, 1.0), ("a", d(2020, 2), 6, 3.0), ("a", d(2020, 3), 7, 2.0),
                                ("b", d(2020, 1), 1, 4.0)], "k string, date date, count int, x double")
    out = {r.k: r for r in M.trend_forecast(df, "k", "date", "count").collect()}
    assert out["a"].date == d(2020, 4) and out["a"]["count"] is None and abs(out["a"].x - 3.0) < 1e-12
    assert out["b"].x == 4.0


def test_latest_row_and_first_k(spark):
    df = spark.createDataFrame([("a", d(2020, 1), 1), ("a", d(2020, 2), 2), ("b", d(2020, 1), 3)],
                               "k string, date date, v int")
    assert sorted(tuple(r) for r in R.latest_row(df, "k").collect()) == [("a", d(2020, 2), 2), ("b", d(2020, 1), 3)]
    assert R.first_k_keys(df, "k", 1).count() == 2


def test_ordered_split_matches_position_rule(spark):
    rows = [(k, d(2020, m), 1) for k in ("a", "b", "c") for m in range(1, 8)]
    df = spark.createDataFrame(rows, "k string, date date, v int")
    train, test = R.ordered_split(df, ["k", "date"], 0.1)
    got = sorted((r.k, r.date) for r in test.collect())
    # n = 21 rows, ceil(2.1) = 3 test rows: the last three in (area, date) order
    assert got == [("c", d(2020, 5)), ("c", d(2020, 6)), ("c", d(2020, 7))]
    assert train.count() == 18


def test_ordered_split_hot_area_spread_over_partitions(spark):
    """One area holds most rows; positions still follow (area, date) exactly."""
    import random
    rng = random.Random(11)
    rows = [("hot", d(2000 + m // 12, m % 12 + 1), m) for m in range(240)]
    rows += [(k, d(2020, m), 0) for k in ("a", "z") for m in range(1, 13)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, date date, v int").repartition(6)
    train, test = R.ordered_split(df, ["k", "date"], 0.25)
    ordered = sorted((r[0], r[1]) for r in rows)
    n_test = -(-len(rows) // 4)
    assert sorted((r.k, r.date) for r in test.collect()) == ordered[-n_test:]
    assert sorted((r.k, r.date) for r in train.collect()) == ordered[:-n_test]
    assert train.columns == df.columns


def test_checks(spark):
    df = spark.createDataFrame([("a", d(2020, 1), None), ("a", d(2020, 3), 1.0)], "k string, date date, v double")
    assert C.check_nulls(df, ["k", "v"]).collect()[0].column == "v"
    br = C.check_month_series(df, "k", "date").first()
    assert (br.expected, br.found, br.position) == (d(2020, 2), d(2020, 3), 2)
    assert C.check_columns(df, ["k", "zz"]).first().column == "zz"
    with pytest.raises(C.PipelineCheckError):
        C.enforce(df, {"nulls": lambda x: C.check_nulls(x)})
    assert C.check_unique(df, ["k"]).first().n == 2


def test_find_column_and_suffix(spark):
    df = spark.createDataFrame([("c", 1, 2)], "ward_code string, a_2011 int, b_2022 int")
    assert B.find_column(df, "2011") == "a_2011"
    with pytest.raises(ValueError):
        B.find_column(df, "_20")
    assert B.select_by_suffix(df, "_2011").columns == ["ward_code", "a"]


def test_lag_features_calendar(spark):
    df = spark.createDataFrame([("k", d(2020, m), m) for m in (1, 2, 4, 5)], "k string, date date, c int")
    out = TS.lag_features(df, "k", "date", "c", calendar=True).orderBy("date").collect()
    assert [(r.date, r.c, r.c_lag1, r.c_lag3) for r in out] == [(d(2020, 4), 4, 0, 1), (d(2020, 5), 5, 4, 2)]


def test_crosswalk_rate_weights_by_target_share(spark):
    from areapanel.operators import spatial as G
    values = spark.createDataFrame([("s1", 0.2), ("s2", 0.6)], "source_code string, rate double")
    cw = spark.createDataFrame([("s1", "t", 1.0, 1.0), ("s2", "t", 3.0, 0.5)],
                               "source_code string, target_code string, overlap_area double, weight double")
    count_style = G.crosswalk_reweight(values, cw, ["rate"]).first().rate
    rate_style = G.crosswalk_reweight(values, cw, ["rate"], kind="rate").first().rate
    assert abs(count_style - (0.2 * 1.0 + 0.6 * 0.5)) < 1e-12        # reference rule (X1)
    assert abs(rate_style - (0.2 * 1.0 + 0.6 * 3.0) / 4.0) < 1e-12    # area-weighted mean over the target

"""Physical-plan properties the design relies on."""

import __spark_entry__ as E


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    import io
    import contextlib
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


NATIVE = ["monthly_area_counts", "normalise_name", "densify_linear", "interpolate_linear", "overlap_area",
          "training_features", "links_by_title", "trend_forecast", "crosswalk_reweight", "simplify_rings"]


def test_native_queries_have_no_python_udfs(spark, sf_dir):
    for name in NATIVE:
        text = formatted(E.queries()[name](spark, sf_dir))
        assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text, name
        assert "FlatMapGroupsInPandas" not in text, name


def test_scans_are_pruned_and_filtered(spark, sf_dir):
    text = formatted(E.queries()["monthly_area_counts"](spark, sf_dir))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in text
    assert "PushedFilters: [Or(IsNull(c_mktsegment),Not(EqualTo(c_mktsegment,AUTOMOBILE)))" in text


def test_lookups_are_broadcast(spark, sf_dir):
    text = formatted(E.queries()["monthly_area_counts"](spark, sf_dir))
    assert "BroadcastHashJoin LeftOuter" in text


def test_windows_are_partitioned(spark, sf_dir):
    for name in ["densify_linear", "interpolate_linear", "lag_features", "rolling_mean", "trend_forecast"]:
        text = formatted(E.queries()[name](spark, sf_dir))
        assert "Window" in text and "SinglePartition" not in text, name


def test_bound_history_reads_one_year(spark, sf_dir):
    text = formatted(E.queries()["history_crime_month"](spark, sf_dir))
    filters = next(line for line in text.splitlines() if line.startswith("PartitionFilters"))
    assert "date_year" in filters and "1997" in filters


def test_bucketed_panels_join_without_an_exchange(spark, sf_dir):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        from areapanel.operators import relational as R
        from areapanel.operators import timeseries as TS
        from areapanel.plans import standins as S
        from areapanel.session import scratch_path
        from areapanel.sinks import tables as K
        panels = [K.bucket_panel(df, f"plan_{name}", scratch_path(spark, name)) for name, df in (
            ("a", S.panel(spark, sf_dir)), ("b", S.supply_panel(spark, sf_dir)))]
        joined = R.join_bucketed(panels)
        lagged = TS.lag_features(joined, "area_code", "date", "count", (1,), ["before"])
        for df in (joined, lagged):
            assert "Exchange" not in formatted(df) and "SortMergeJoin" in formatted(df)
        assert joined.count() == R.join_panels([S.panel(spark, sf_dir), S.supply_panel(spark, sf_dir)]).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in "ab":
            spark.sql(f"DROP TABLE IF EXISTS plan_{name}")


def test_name_lookup_reads_no_geometry(spark, sf_dir):
    from areapanel.plans import jobs as J
    from areapanel.plans.catalog_jobs import LAYER, layer_features
    text = formatted(J.name_lookup_job(layer_features(spark, sf_dir, "2022"), LAYER))
    assert "from_json" not in text.lower().replace("to_json", "")

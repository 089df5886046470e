"""Rules at the edges: strict thresholds, ties, NaN, zero actuals, gaps, calendar corners."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelcast.functions.calendar import floor_period, next_period, select_date_features
from panelcast.functions.metrics import round_scaled, settled
from panelcast.functions.text import check_identifier, metric_column, normalize_model_name, tenant_of
from panelcast.models.registry import forecast_path, season_of
from panelcast.operators import champion as ch
from panelcast.operators import evaluate as ev
from panelcast.operators import prepare as pp
from panelcast.operators.features import FeatureSpec, build_features, default_lag_transforms, series_features
from panelcast.operators.series import fill_gaps, hold_out, panel_rows, rmse_of, series_rows
from panelcast.operators.shards import balanced_shards, length_plan
from panelcast.plans.audit import native_forecast
from panelcast.sources.panel import read_mapped_panel, read_panel


def month(i):
    return dt.date(2020 + i // 12, i % 12 + 1, 1)


def panel(spark, lengths):
    rows = [(f"s_{n}", month(i), float(i + 1)) for n in lengths for i in range(n)]
    return spark.createDataFrame(rows, "unique_id string, ds date, y double")


def ids(df):
    return sorted({r["unique_id"] for r in df.select("unique_id").distinct().collect()})


def test_thresholds(spark):
    df = panel(spark, [1, 2, 3, 12, 13, 23, 24])
    assert ids(pp.filter_series(df, 12)) == ["s_13", "s_23", "s_24"]
    assert ids(pp.filter_series(df, 2)) == ["s_12", "s_13", "s_23", "s_24", "s_3"]
    flags = {r["unique_id"]: r["is_eligible"] for r in pp.flag_history(df, 24).collect()}
    assert [k for k, v in flags.items() if v] == ["s_24"]
    assert ids(pp.filter_series(df, 12, bounded=False)) == ["s_13", "s_23", "s_24"]
    split = pp.holdout_split(df, 12)
    assert ids(split) == ["s_13", "s_23", "s_24"]
    assert sorted(pp.holdout_split(df, 12, bounded=False).collect()) == sorted(split.collect())
    counts = {r["unique_id"]: r["n"] for r in pp.valid_part(split).groupBy("unique_id").agg(F.count("*").alias("n")).collect()}
    assert set(counts.values()) == {12}


def test_split_parts_cover_the_panel(spark):
    df = panel(spark, [13, 30])
    split = pp.holdout_split(df, 12)
    train, valid = pp.train_part(split), pp.valid_part(split)
    assert train.count() + valid.count() == df.count()
    assert train.join(valid, ["unique_id", "ds"]).count() == 0


def test_dirty_values(spark):
    rows = [
        ("a", "2024-01-01", "1.5"), ("a", "2024-01-02", "abc"), ("a", "2024-01-03", "NaN"),
        ("a", "2024-01-04", ""), (None, "2024-01-05", "1"), ("a", None, "1"), ("a", "2024-01-07", None),
    ]
    out = pp.coerce_types(spark.createDataFrame(rows, "unique_id string, ds string, y string")).collect()
    assert [(r["unique_id"], r["ds"], r["y"]) for r in out] == [("a", dt.date(2024, 1, 1), 1.5)]


def test_bad_date_raises(spark):
    df = spark.createDataFrame([("a", "not a date", "1")], "unique_id string, ds string, y string")
    with pytest.raises(PySparkException):
        pp.coerce_types(df).collect()


def test_repeated_date_raises(spark):
    df = spark.createDataFrame([("a", month(0), 1.0), ("a", month(0), 2.0)], "unique_id string, ds date, y double")
    with pytest.raises(PySparkException, match="more than one row"):
        pp.assert_one_row_per_period(df).collect()


def test_parallel_top_n_equals_single_task(spark):
    df = panel(spark, [3, 7, 12, 24, 40]).repartition(7)
    order = [F.col("unique_id").desc(), F.col("ds").desc()]
    for n in (1, 30, 60, 86, 500):
        parallel = pp.take_ordered(df, n, order)
        assert sorted(parallel.collect()) == sorted(df.orderBy(*order).limit(n).collect())


def test_missing_columns(spark):
    with pytest.raises(ValueError, match="y"):
        read_panel(spark, spark.range(1).select(F.lit("a").alias("unique_id"), F.current_date().alias("ds")))


def metrics(spark, rows):
    return spark.createDataFrame(rows, "unique_id string, model string, rmse double, mae double, wmape double")


def test_tie_rules(spark):
    m = metrics(spark, [("a", "z", 1.0, 2.0, 3.0), ("a", "b", 1.0, 2.0, 3.0), ("a", "c", 1.0, 2.0, 4.0)])
    assert ch.series_champion_rmse(m).first()["best_model_name"] == "b"
    assert ch.series_champion_multi(m, ["z", "b", "c"]).first()["champion_model"] == "z"
    results = m.withColumn("model_ordinal", ch.model_ordinal(F.col("model"), ["z", "b", "c"]))
    assert ch.select_global_champion(results, "rmse").first()["model"] == "z"


def test_nan_metric_sorts_last(spark):
    nan = float("nan")
    m = metrics(spark, [("a", "first", nan, nan, nan), ("a", "second", 1.0, 1.0, 1.0), ("b", "x", nan, nan, nan), ("b", "w", None, None, None)])
    got = {r["unique_id"]: (r["best_model_name"], r["rmse"]) for r in ch.series_champion_rmse(m).collect()}
    assert got == {"a": ("second", 1.0), "b": ("w", None)}
    assert ch.valid_results(m, "rmse").count() == 1


def test_zero_actuals(spark):
    joined = spark.createDataFrame([("a", "m", 0.0, 1.0), ("a", "m", 0.0, 3.0)], "unique_id string, model string, y double, prediction double")
    assert ev.global_metrics(joined).first()["wmape"] is None
    assert ev.global_metrics(joined, wmape="percent").first()["wmape"] == 0.0
    assert ev.series_metrics(joined).first()["wmape"] == pytest.approx(4e9)


def test_disjoint_dates(spark):
    valid = spark.createDataFrame([("a", month(0), 1.0)], "unique_id string, ds date, y double")
    preds = spark.createDataFrame([("a", month(5), "m", 2.0)], "unique_id string, ds date, model string, prediction double")
    assert ev.join_actual_pred(valid, preds).count() == 0
    row = ev.percent_wmape(ev.align_outer(valid, preds)).first()
    assert (row["rmse"], row["wmape"]) == (None, 0.0)
    assert ev.align_outer(valid, preds).count() == 2


def test_gaps_are_positional_for_lags_and_calendar_for_forecasts(spark):
    rows = [("a", month(i), float(v)) for i, v in ((0, 1), (1, 2), (3, 4), (6, 7))]
    df = spark.createDataFrame(rows, "unique_id string, ds date, y double")
    lags = [r["lag1"] for r in build_features(df, FeatureSpec([1])).orderBy("ds").collect()]
    assert lags == [None, 1.0, 2.0, 4.0]
    split = hold_out(series_rows(df), 2)
    got = native_forecast(split, ["naive"], 2, "MS", 1, values="train", last_ds="train_end").orderBy("ds").collect()
    assert [r["ds"] for r in got] == [month(2), month(3)]
    # Only the fourth month is both held out and predicted: 4 against the last training value 2.
    error = split.select(
        rmse_of(F.col("valid_dates"), F.col("valid"), F.array(F.lit(month(2)), F.lit(month(3))), F.array(F.lit(2.0), F.lit(2.0))).alias("e")
    ).first()["e"]
    assert error == pytest.approx(2.0)
    filled = panel_rows(fill_gaps(series_rows(df), "MS")).orderBy("ds").collect()
    assert [r["y"] for r in filled] == [1.0, 2.0, 0.0, 4.0, 0.0, 0.0, 7.0]


def test_single_lag_keeps_the_last_rule():
    assert default_lag_transforms([1]) == {1: [3]}
    assert default_lag_transforms([1, 12]) == {1: [3, 6, 12], 12: [3]}
    assert FeatureSpec([1, 12], default_lag_transforms([1, 12])).history == 14


def test_unknown_date_features_are_dropped():
    assert select_date_features(["month", "moonphase", "dayofweek"]) == ["month", "dayofweek"]


def test_warm_up_of_features(spark):
    spec = FeatureSpec([1, 12], default_lag_transforms([1, 12]))
    assert build_features(panel(spark, [20]), spec, drop_incomplete=True).count() == 20 - 14


def test_model_labels(spark):
    labels = ["ARCH(1)", " ARCH (1)", "GARCH(1,1)", "NaiveFallback", " Naive ", "", None]
    df = spark.createDataFrame([(v,) for v in labels], "label string")
    got = [r[0] for r in df.select(normalize_model_name(F.col("label"))).collect()]
    assert got == ["ARCH", "ARCH", "GARCH", "Naive_Fallback", "Naive", "", None]
    assert metric_column("ARCH(1)") == "ARCH_1__RMSE"


def test_tenant_delimiter_is_literal(spark):
    df = spark.createDataFrame([("a.b_c",), ("abc",), ("_x",)], "id string")
    assert [r[0] for r in df.select(tenant_of(F.col("id"), "_")).collect()] == ["a.b", "abc", ""]
    assert [r[0] for r in df.select(tenant_of(F.col("id"), ".")).collect()] == ["a", "abc", "_x"]
    with pytest.raises(ValueError):
        tenant_of(F.col("id"), "")


def test_identifier():
    assert check_identifier("abc_1") == "abc_1"
    with pytest.raises(ValueError):
        check_identifier("abc; DROP")


def test_calendar(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 7),), (dt.date(2024, 1, 8),), (dt.date(2021, 1, 1),)], "d date")
    week = [r[0] for r in df.select(floor_period(F.col("d"), "W")).collect()]
    assert week == [dt.date(2024, 1, 7), dt.date(2024, 1, 14), dt.date(2021, 1, 3)]
    ahead = [r[0] for r in df.select(next_period(F.col("d"), 1, "W")).collect()]
    assert ahead == [dt.date(2024, 1, 14), dt.date(2024, 1, 14), dt.date(2021, 1, 3)]
    quarter = [r[0] for r in df.select(next_period(F.col("d"), 1, "QS")).collect()]
    assert quarter == [dt.date(2024, 4, 1), dt.date(2024, 4, 1), dt.date(2021, 4, 1)]
    with pytest.raises(ValueError, match="unsupported frequency"):
        floor_period(F.col("d"), "B")


def greedy(lengths, n):
    loads, count = [0] * n, {}
    for length in sorted(lengths, reverse=True):
        i = loads.index(min(loads))
        loads[i] += length
        count[length, i] = count.get((length, i), 0) + 1
    return count


@pytest.mark.parametrize("n", [1, 2, 3, 7])
def test_shard_plan_is_the_greedy_one(n):
    lengths = [5] * 40 + [4] * 3 + [9] * 11 + [1] * 100 + [60]
    histogram = [(v, lengths.count(v)) for v in set(lengths)]
    got = {(length, shard): b - a + 1 for length, shard, a, b in length_plan(histogram, n)}
    assert got == greedy(lengths, n)


def test_shards_never_exceed_series(spark):
    out = balanced_shards(panel(spark, [3, 5, 8]), 10)
    assert sorted(r["shard"] for r in out.collect()) == [0, 1, 2]


def test_sentinel_stays_in_wmape_ranking_only(spark):
    rows = [("m1", None, 0.3, 5.0, 4.0), ("m2", "boom", None, None, None)]
    df = ch.failed_model_sentinel(spark.createDataFrame(rows, "model_type string, error string, wmape double, rmse double, mae double"))
    assert ch.valid_results(df, "wmape").count() == 2
    assert ch.valid_results(df, "rmse").count() == 1
    assert df.where("error IS NOT NULL").first()["wmape"] == 999999.0


def test_mapped_panel_limits_series(spark):
    df = panel(spark, [3, 4, 5]).select(F.col("unique_id").alias("p"), F.col("ds").alias("d"), F.col("y").alias("v"))
    out = read_mapped_panel(spark, df, "p", "d", "v", max_series=2)
    assert ids(out) == ["s_3", "s_4"]
    assert out.first()["sys_id"] == "s"


def test_hot_series_holdout_sends_few_rows(spark):
    """The rank limit sits below the shuffle, so a hot series ships only h + 1 rows per map task."""
    plan = pp.holdout_split(panel(spark, [30]), 12, bounded=False)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_raw_hold_out_counts_rows_that_share_dates(spark):
    rows = [("a", dt.date(2024, 1, 1 + i // 4), float(i)) for i in range(20)] + [("b", dt.date(2024, 1, 1), 1.0)] * 4
    df = spark.createDataFrame(rows, "unique_id string, ds date, y double")
    for h in (1, 3, 4, 7):
        valid = pp.valid_part(pp.holdout_split(df, h, bounded=False)).where("unique_id = 'a'")
        assert valid.count() == h
        assert valid.agg(F.min("ds")).first()[0] == dt.date(2024, 1, 5 - (h - 1) // 4)


def test_take_ordered_breaks_ties_by_all_columns(spark):
    df = spark.createDataFrame([(1, i % 3, i) for i in range(50)], "a int, b int, c int").repartition(5)
    want = sorted((1, i % 3, i) for i in range(50))[:17]
    assert sorted(tuple(r) for r in pp.take_ordered(df, 17, [F.col("a").asc()]).collect()) == want


def test_series_features_equal_window_features(spark):
    df = panel(spark, [3, 7, 12, 24, 40])
    spec = FeatureSpec([1, 3], {1: [3], 3: [2, 4]}, ["month", "quarter"])
    a = build_features(df, spec, drop_incomplete=True).select("unique_id", "ds", "y", *spec.columns)
    b = series_features(series_rows(df), spec).select("unique_id", "ds", "y", *spec.columns)
    rounded = lambda x: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in x.collect())
    assert rounded(a) == rounded(b)
    plan = series_features(series_rows(df), spec)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == series_rows(df)._jdf.queryExecution().executedPlan().toString().count("Exchange")


@pytest.mark.parametrize(
    "label,base",
    [("ARCH(1)", "ARCH"), (" GARCH (1, 1) ", "GARCH"), ("NaiveFallback", "Naive_Fallback"), ("Naive_Fallback", "Naive_Fallback"),
     ("AutoARIMA", "AutoARIMA"), ("", ""), (None, None), ("MyARCH(1)", "MyARCH(1)"), ("ARCH", "ARCH")],
)
def test_model_labels(spark, label, base):
    df = spark.createDataFrame([(label,)], "l string")
    assert df.select(normalize_model_name(F.col("l"))).first()[0] == base


def test_seasonal_models_need_a_season(spark):
    for name in ("mstl", "SeasonalNaive"):
        with pytest.raises(ValueError, match="season"):
            forecast_path(name, F.col("values"), 3, 1)
    assert (season_of("mstl", "library", "MS"), season_of("MSTL", "panel", "MS"), season_of("ets", "panel", "D")) == (24, 12, 7)


def test_scores_do_not_depend_on_the_order_of_rows(spark):
    """Errors are added by date however rows arrive, so models with equal errors tie, and the tie goes by name."""
    terms = [1 / 3, 2 / 3, 4 / 3, 0.1, 0.7, 1.1, 1e-3, 5 / 3]
    orders = [range(8), range(7, -1, -1), [3, 1, 4, 0, 5, 2, 7, 6], [6, 2, 7, 0, 1, 5, 4, 3]]
    rows = [("a", f"m{3 - k}", month(i), 2.0 + terms[i], 2.0) for k, order in enumerate(orders) for i in order]
    frame = spark.createDataFrame(rows, "unique_id string, model string, ds date, y double, prediction double").coalesce(1)
    scores = ev.series_metrics(frame)
    assert scores.select("rmse", "mae", "wmape").distinct().count() == 1
    squares = 0.0
    for t in terms:
        squares += (2.0 + t - 2.0) ** 2
    assert scores.first()["rmse"] == (squares / 8) ** 0.5
    assert ch.series_champion_rmse(ev.series_rmse(frame)).first()["best_model_name"] == "m0"


def test_settled_values(spark):
    tiny = spark.createDataFrame([(0.0,), (None,), (float("nan"),), (float("inf"),), (0.40624999999999994,), (-1e300,)], "v double")
    got = [r[0] for r in tiny.select(settled(F.col("v"))).collect()]
    assert got[0] == 0.0 and got[1] is None and got[2] != got[2] and got[3:] == [float("inf"), 0.40625, -1e300]


def test_scaled_rounding(spark):
    frame = spark.createDataFrame([(0.43624999999999997,), (-0.43624999999999997,), (0.4362,), (None,), (0.0,)], "v double")
    assert [r[0] for r in frame.select(round_scaled(F.col("v"), 4)).collect()] == [0.4363, -0.4363, 0.4362, None, 0.0]

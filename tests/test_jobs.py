"""Whole jobs with their written tables, and the table writers."""

import datetime as dt
import json
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelcast import schemas
from panelcast.catalogue.panels import demand_source, event_days, event_raw, sales, sales_raw
from panelcast.operators.prepare import aggregate_period
from panelcast.operators.series import SERIES_PER_PART, in_few_parts
from panelcast.plans import jobs
from panelcast.plans.forecast import batch_forecast
from panelcast.sources import panel as src
from panelcast.sources import synthetic, tables

RUN_TS = dt.datetime(2024, 2, 1)
SMALL = jobs.SeriesConfig(stats_models=("Naive", "SeasonalNaive", "AutoTheta"), ml_models=("LightGBM",), profile="fast")


def run(spark, sf_dir, out, config, run_id):
    return jobs.run_series_champion(
        spark, demand_source(spark, sf_dir), "product_id", "date", "quantity", config, output=out, run_id=run_id, run_ts=RUN_TS
    )


def test_series_champion_job(spark, sf_dir, tmp_path):
    out = str(tmp_path / "out")
    result = run(spark, sf_dir, out, SMALL, "r1")
    n_series = result.series.count()
    champions = tables.read_table(spark, f"{out}/champions")
    assert champions.count() == champions.select("unique_id").distinct().count() <= n_series
    short = result.series.where("n < 24").count()
    assert champions.where("best_model_name = 'Naive_Fallback' AND rmse IS NULL").count() == short
    forecasts = tables.read_table(spark, f"{out}/forecasts")
    per_series = forecasts.groupBy("unique_id").agg(F.count("*").alias("n")).select("n").distinct().collect()
    assert [r["n"] for r in per_series] == [12]
    metrics = tables.read_table(spark, f"{out}/metrics")
    assert {"LightGBM_RMSE", "Naive_RMSE", "SeasonalNaive_RMSE", "AutoTheta_RMSE", "Best_model_name"} <= set(metrics.columns)
    scored = metrics.select(
        "unique_id", F.least("LightGBM_RMSE", "Naive_RMSE", "SeasonalNaive_RMSE", "AutoTheta_RMSE").alias("least"), "Best_model_RMSE"
    )
    assert scored.where(F.abs(F.col("least") - F.col("Best_model_RMSE")) > 1e-9).count() == 0
    log = tables.read_table(spark, f"{out}/run_logs").first()
    assert log["series_count"] == n_series
    assert log["fallback_ids"] == short
    assert log["forecast_rows"] == forecasts.count()
    assert log["champion_rows"] == champions.count()
    # The same run again replaces its rows; another run adds its own.
    native = jobs.SeriesConfig(stats_models=("Naive",), ml_models=())
    run(spark, sf_dir, out, native, "r1")
    assert tables.read_table(spark, f"{out}/champions").count() <= n_series
    run(spark, sf_dir, out, native, "r2")
    assert tables.read_table(spark, f"{out}/champions").select("run_id").distinct().count() == 2


def test_unscored_series_can_fall_back(spark, sf_dir):
    panel = sales_raw(spark, sf_dir)
    config = jobs.SeriesConfig(stats_models=("Naive",), ml_models=(), min_history=5, horizon=3)
    plain = jobs.series_champion(panel, config)
    whole = jobs.series_champion(panel, jobs.SeriesConfig(**{**config.__dict__, "fallback_unscored": True}))
    assert whole.champions.count() == whole.series.count() > plain.champions.count()


def test_sharded_ml_audit(spark, sf_dir):
    config = jobs.SeriesConfig(stats_models=("Naive",), ml_models=("XGBoost",), ml_shards=2, profile="fast")
    result = jobs.series_champion(src.read_mapped_panel(spark, demand_source(spark, sf_dir), "product_id", "date", "quantity"), config)
    assert result.shards_used == 2
    # Lag 12 with a mean of three needs 14 training rows; boosters take missing features, so shorter series are scored too.
    long = result.metrics.join(result.series.where("n >= 12 + 14"), "unique_id", "left_semi")
    scored = result.metrics.where("XGBoost_RMSE IS NOT NULL").count()
    assert scored == result.metrics.where("Naive_RMSE IS NOT NULL").count() > long.count() > 0


def test_no_rows_for_tenant(spark, sf_dir):
    with pytest.raises(ValueError, match="no rows"):
        jobs.run_series_champion(
            spark, demand_source(spark, sf_dir), "product_id", "date", "quantity", sys_id_value="nobody"
        )


def test_global_champion_job(spark, sf_dir, tmp_path):
    out = str(tmp_path / "out")
    config = jobs.GlobalConfig(freq="MS", horizon=2, models=("ridge", "rf", "naive"), profile="fast")
    result = jobs.run_global_champion(spark, sales(spark, sf_dir), config, "sales", RUN_TS, out, batch=True)
    rows = {r["model_type"]: r for r in result.results.collect()}
    assert set(rows) == {"ridge", "rf", "naive"}
    assert all(r["rmse"] > 0 and r["wmape"] > 0 for r in rows.values())
    assert result.model_type == min(rows.values(), key=lambda r: r["wmape"])["model_type"]
    predictions = tables.read_table(spark, f"{out}/predictions")
    assert predictions.count() == sum(r["valid_rows"] for r in rows.values())
    champion = tables.read_table(spark, f"{out}/champion").first()
    assert (champion["champion_model_type"], json.loads(champion["lags"])) == (result.model_type, [1, 2, 3])
    assert champion["series_count"] > 0 and champion["train_rows"] > 0
    forecasts = tables.read_table(spark, f"{out}/batch_forecasts")
    assert {f.name for f in schemas.BATCH_FORECASTS.fields} == set(forecasts.columns)
    assert Path(f"{out}/metadata/{config.model_display_name}/{result.model_type}").exists()
    if champion["champion_model_uri"]:
        again = jobs.run_batch_forecast(spark, sales(spark, sf_dir), f"{out}/champion", config, RUN_TS, "sales")
        a = sorted((r["unique_id"], r["ds"], r["prediction"]) for r in again.where("prediction IS NOT NULL").collect())
        b = sorted((r["unique_id"], r["ds"], r["prediction"]) for r in forecasts.where("prediction IS NOT NULL").collect())
        assert [x[:2] for x in a] == [x[:2] for x in b]
        assert [x[2] for x in a] == pytest.approx([x[2] for x in b])


def test_hold_out_is_per_series(spark, sf_dir):
    """Each model is scored on the last rows of all series, and no training row is among them."""
    config = jobs.GlobalConfig(freq="D", horizon=2, models=("naive",))
    split = jobs.prepare_global(event_days(spark, sf_dir), config)
    counts = split.valid.groupBy("unique_id").agg(F.count("*").alias("n"))
    assert counts.where("n <> 2").count() == 0
    assert split.valid.join(split.train_rows, ["unique_id", "ds"]).count() == 0


def test_batch_forecast_of_native_model(spark, sf_dir):
    out = batch_forecast(
        sales(spark, sf_dir), "theta", 4, "MS", jobs.GlobalConfig().features, RUN_TS, "sales"
    )
    assert out.count() == 4 * sales(spark, sf_dir).select("unique_id").distinct().count()


def test_fan_out_survives_a_failing_model(spark, sf_dir, tmp_path):
    config = jobs.GlobalConfig(freq="MS", horizon=2, profile="fast", lags=(1, 400))
    short = jobs.GlobalConfig(freq="MS", horizon=2, profile="fast", lags=(1,))
    panel = sales(spark, sf_dir)
    _, bad = jobs.train_one_model(panel, "ridge", config, "sales", RUN_TS)
    preds, good = jobs.train_one_model(panel, "naive", short, "sales", RUN_TS, str(tmp_path / "one"))
    assert bad.first()["error"] and bad.first()["wmape"] == 999999.0
    assert preds.count() > 0 and Path(tmp_path / "one" / "evaluation" / "naive").exists()
    assert jobs.select_champion([bad, good], ["ridge", "naive"]).first()["model_type"] == "naive"
    with pytest.raises(ValueError, match="supported"):
        jobs.train_one_model(panel, "prophet", short)


def test_series_champion_ml_job_writes(spark, sf_dir, tmp_path):
    out = jobs.run_series_champion_ml(
        spark, sales(spark, sf_dir), "unique_id", "ds", "y", ["lr", "ridge"], 3, 3, lags=(1, 2), profile="fast",
        output=str(tmp_path / "ml"), run_ts=RUN_TS,
    )
    champions = spark.read.parquet(str(tmp_path / "ml" / "champions"))
    assert champions.count() == champions.select("unique_id").distinct().count()
    assert set(out["metrics"].columns) >= {"sys_id", "unique_id", "model", "mae", "rmse", "wmape", "n_validation_rows"}
    assert spark.read.parquet(str(tmp_path / "ml" / "forecasts")).count() % 3 == 0


def test_monthly_job_writes_csv(spark, sf_dir, tmp_path):
    out = jobs.run_monthly_ml(
        spark, demand_source(spark, sf_dir), {"product_id": "unique_id", "date": "ds", "quantity": "y"}, ("lr",), 4,
        output_csv=str(tmp_path / "csv"),
    )
    back = src.resolve(spark, str(tmp_path / "csv") + "/*.csv")
    assert back.columns == ["unique_id", "ds", "lr"]
    assert back.count() == out.count()


def test_tables_grow_and_reject(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.createDataFrame([(1, "a")], "id int, v string"), path)
    wider = spark.createDataFrame([(2, "b", 0.5)], "id int, v string, extra double")
    with pytest.raises(ValueError, match="extra"):
        tables.write_table(wider, path)
    tables.write_table(wider, path, evolve=True)
    stored = tables.read_table(spark, path, evolved=True)
    assert {r["id"]: r["extra"] for r in stored.collect()} == {1: None, 2: 0.5}
    rows = spark.createDataFrame([(3, "c", 1.0), (4, None, 2.0)], "id int, v string, extra double")
    assert tables.append_valid(rows, path, ["v"], rejects_path=str(tmp_path / "rejects")) == (1, 1)
    assert spark.read.parquet(str(tmp_path / "rejects")).first()["id"] == 4
    before = tables.read_table(spark, path).count()
    with pytest.raises(ValueError, match="rejected"):
        tables.append_valid(rows, path, ["v"], raise_on_reject=True)
    assert tables.read_table(spark, path).count() == before


def test_partition_overwrite_keeps_other_tenants(spark, tmp_path):
    path = str(tmp_path / "p")
    both = spark.createDataFrame([("A", 1), ("B", 2)], "sys_id string, v int")
    tables.write_table(both, path, "overwrite", partition_by=["sys_id"])
    tables.write_table(spark.createDataFrame([("A", 9)], "sys_id string, v int"), path, "overwrite", partition_by=["sys_id"])
    assert {r["sys_id"]: r["v"] for r in tables.read_table(spark, path).collect()} == {"A": 9, "B": 2}


def test_runs_in_catalog_tables(spark):
    """The tables of the layout take a run's rows, whatever columns it lacks, and a repeated run replaces its own."""
    tables.ensure_tables(spark, "run_demo")
    rows = spark.range(3).select(
        F.col("id").cast("string").alias("unique_id"), F.lit(dt.date(2024, 1, 1)).alias("ds"),
        F.lit(RUN_TS).alias("run_ts"), F.lit(1.0).alias("prediction"),
    )
    for run_id, n in (("r1", 3), ("r2", 3), ("r1", 1)):
        tables.write_run(rows.limit(n), "run_demo.predictions", run_id)
    stored = tables.read_table(spark, "run_demo.predictions")
    assert {r["run_id"]: r["count"] for r in stored.groupBy("run_id").count().collect()} == {"r1": 1, "r2": 3}
    assert [f.name for f in stored.schema] == [f.name for f in schemas.PREDICTIONS.fields]


def test_ensure_tables_twice(spark):
    first = tables.ensure_tables(spark, "forecasting_demo")
    assert first == tables.ensure_tables(spark, "forecasting_demo")
    assert spark.table("forecasting_demo.champion").columns[:3] == ["run_ts", "champion_model_type", "champion_metric_name"]
    with pytest.raises(ValueError):
        tables.ensure_tables(spark, "bad name")


def test_generated_panel(spark):
    start, end = dt.date(2023, 1, 1), dt.date(2023, 1, 10)
    df = synthetic.generate_panel(spark, start, end, num_systems=3, num_accounts=4)
    assert df.count() == synthetic.expected_rows(start, end, 3, 4) == 120
    assert df.select("unique_id").distinct().count() == 12
    assert df.agg(F.min("target")).first()[0] >= 0
    again = synthetic.generate_panel(spark, start, end, num_systems=3, num_accounts=4)
    assert sorted(df.collect()) == sorted(again.repartition(5).collect())
    tables.create_or_replace_table_as(df, "generated_panel")
    assert src.table_row_count(spark, "generated_panel").first()[0] == 120
    panel = src.read_renamed_panel(spark, "generated_panel")
    assert panel.columns == ["unique_id", "ds", "y"]
    with pytest.raises(ValueError):
        synthetic.generate_panel(spark, end, start)


def test_parameters_are_bound_not_pasted(spark):
    out = src.parameterised_query(spark, "SELECT :v AS v", v="x' OR '1'='1")
    assert out.first()["v"] == "x' OR '1'='1"
    with pytest.raises(PySparkException):
        src.parameterised_query(spark, "SELECT :missing AS v").collect()


def test_hourly_panel(spark, sf_dir):
    hourly = event_raw(spark, sf_dir, by_user=False)
    config = jobs.GlobalConfig(freq="H", horizon=3, models=("naive", "ridge"), lags=(1, 2), date_features=(), profile="fast")
    panel = aggregate_period(hourly, "H")
    result = jobs.global_champion(panel, config, "events", RUN_TS)
    assert result.results.count() == 2
    assert dict(result.predictions.dtypes)["ds"] == "timestamp_ntz"


def test_single_fit_writes(spark, sf_dir, tmp_path):
    config = jobs.GlobalConfig(freq="MS", horizon=2, models=("ridge", "naive"), profile="fast")
    out = str(tmp_path / "single")
    wide, results = jobs.run_multi_model_single_fit(spark, sales(spark, sf_dir), config, RUN_TS, "sales", out)
    best = results.orderBy("wmape", "model_ordinal").first()["model"]
    assert [r[0] for r in tables.read_table(spark, f"{out}/predictions").select("best_model").distinct().collect()] == [best]
    assert spark.read.json(f"{out}/model_results").count() == 2
    assert Path(f"{out}/models/{config.model_display_name}/ridge").exists()
    assert wide.count() > 0


def test_hot_series_sums_exactly(spark):
    """A third of all raw rows in one series: the panel is the same as computed by hand."""
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 500)).alias("unique_id"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 700).cast("int")).alias("ds"),
        F.lit(1.0).alias("y"),
    )
    panel = aggregate_period(rows, "MS")
    assert panel.where("unique_id = 'hot'").agg(F.sum("y")).first()[0] == 20_000
    assert panel.agg(F.sum("y")).first()[0] == 60_000
    assert panel.groupBy("unique_id").count().agg(F.max("count")).first()[0] <= 24


def test_runs_of_one_session_replace_side_by_side(spark):
    """Four threads replace their own partition of one catalog table, others append: none removes another's rows."""
    spark.sql("CREATE TABLE side_by_side (v BIGINT, run_id STRING) USING parquet PARTITIONED BY (run_id)")
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")

    def replace(run):
        rows = spark.range(run + 1).select(F.col("id").alias("v"), F.lit(f"r{run}").alias("run_id"))
        for _ in range(2):
            tables.write_table(rows, "side_by_side", "overwrite", partition_by=["run_id"])

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(replace, range(4)))
    tables.write_table(spark.sql("SELECT 9L AS v, 'more' AS run_id"), "side_by_side")
    got = {r["run_id"]: r["count"] for r in spark.table("side_by_side").groupBy("run_id").count().collect()}
    assert got == {"r0": 1, "r1": 2, "r2": 3, "r3": 4, "more": 1}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode


def test_few_series_take_few_partitions(spark):
    """A panel of few series is not spread over every partition of the shuffle, where each step would start a worker."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    cores = spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.shuffle.partitions", 64)
    try:
        days = "explode(sequence(DATE'2024-01-01', DATE'2024-01-09', INTERVAL 1 DAY)) AS ds"
        panel = spark.sql(f"SELECT concat('a_', id) AS unique_id, {days}, id * 1D AS y FROM range(40)")
        split = jobs.prepare_global(panel, jobs.GlobalConfig(freq="D", horizon=2))
        assert split.series.rdd.getNumPartitions() == min(cores, 64)
        assert split.series.count() == 40 and split.train_rows.count() == 280 and split.valid.count() == 80
        wide = spark.range(0, 10, 1, 64)
        assert in_few_parts(wide, 64 * SERIES_PER_PART).rdd.getNumPartitions() == 64
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_the_full_job_fits_full_boosters(spark, sf_dir, monkeypatch):
    """The query's job has all models, all series and the 400 rounds of the audit."""
    from panelcast.catalogue.jobs import series_champion_full_job
    from panelcast.models.global_ml import params

    seen = []

    def stop(panel, config):
        seen.append(config)
        raise InterruptedError

    monkeypatch.setattr(jobs, "series_champion", stop)
    with pytest.raises(InterruptedError):
        series_champion_full_job(spark, sf_dir)
    assert seen == [jobs.SeriesConfig()] and seen[0].max_series == 0 and len(seen[0].stats_models) == 10
    assert [params(k, seen[0].profile)["trees"] for k in ("lgbm", "xgb")] == [400, 400]

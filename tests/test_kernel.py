"""The Huber regression on random Fourier features against Spark ML's solver on the same features, and its plan."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from panelcast.models import kernel as k
from panelcast.models.global_ml import estimator
from panelcast.operators.features import FeatureSpec
from panelcast.plans.recursive import predict_recursive

P = {"c": 100.0, "features": 12, "iterations": 50, "tolerance": 1e-4, "seed": 42}
NAMES = ["a", "b"]


def frame(spark, n=900):
    rng = np.random.default_rng(3)
    a, b = rng.normal(5, 3, n).round(3), rng.integers(0, 4, n).astype(float)
    y = np.sin(a) + b + rng.standard_t(2, n).round(3)  # far residuals, whose loss is linear
    return spark.createDataFrame([tuple(map(float, r)) for r in zip(y, a, b)], "y double, a double, b double").repartition(3)


def loss(z, y, coef, scale, c):
    r, n = np.abs(y - z @ coef), len(y)
    one = np.where(r <= 1.35 * scale, scale + r**2 / scale, scale + 2 * 1.35 * r - scale * 1.35**2) / 2
    return one.mean() + 0.5 * (z[:, 1:].var(0, ddof=1) * coef[1:] ** 2).sum() / (c * n)


@pytest.fixture(scope="module")
def fitted(spark):
    rows = frame(spark).persist()
    return rows, k.KernelRegression(P, NAMES).fit(rows)


def test_loss_is_not_above_that_of_the_library(spark, fitted):
    rows, model = fitted
    content = model.content
    data = np.array(rows.select("y", *NAMES).collect())
    y, z = data[:, 0], k.fourier(data[:, 1:], content["drawn"])
    wide = spark.createDataFrame([tuple(map(float, r)) for r in np.column_stack([y, z[:, 1:]])], ["y", *[f"z{i}" for i in range(12)]])
    solver = LinearRegression(featuresCol="features", labelCol="y", loss="huber", regParam=1.0 / (P["c"] * len(y)), maxIter=300, tol=1e-9)
    library = Pipeline(stages=[VectorAssembler(inputCols=wide.columns[1:], outputCol="features"), solver]).fit(wide).stages[-1]
    theirs = np.append(library.intercept, library.coefficients.toArray())
    ours = np.array(content["coefficients"])
    assert loss(z, y, ours, content["scale"], P["c"]) <= loss(z, y, theirs, library.scale, P["c"]) * (1 + 1e-5)
    np.testing.assert_allclose(z @ ours, z @ theirs, atol=0.02)
    assert content["scale"] == pytest.approx(library.scale, rel=0.01)


def test_features_stay_within_tasks(spark, fitted):
    """No row holds the features and no expression lists them; there is no prediction without an input."""
    rows, model = fitted
    pipeline = estimator("svr", "parallel", NAMES, rows)
    assert [type(s) for s in pipeline.getStages()] == [k.KernelRegression]
    scored = model.transform(rows)
    assert scored.columns == [*rows.columns, "prediction"]
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" in plan and "cos(" not in plan.lower()
    gone = model.transform(spark.createDataFrame([(None, 1.0)], "a double, b double")).first()
    assert gone["prediction"] is None


def test_saved_model(fitted, tmp_path):
    rows, model = fitted
    PipelineModel(stages=[model]).write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    both = model.transform(rows).select("y", F.col("prediction").alias("p")).collect()
    assert sorted(both) == sorted(again.transform(rows).select("y", "prediction").collect())


@pytest.mark.parametrize("value", [lambda i: 4.0, lambda i: 2.0 * (i % 5)])
def test_targets_without_error(spark, value):
    rows = spark.createDataFrame([(value(i), float(i % 5), 1.0) for i in range(60)], "y double, a double, b double")
    out = k.KernelRegression(P, NAMES).fit(rows).transform(rows).select(F.max(F.abs(F.col("prediction") - F.col("y")))).first()
    assert out[0] < 0.01  # the penalty holds the coefficients a little below


def test_no_rows(spark):
    with pytest.raises(ValueError, match="no rows"):
        k.KernelRegression(P, NAMES).fit(spark.createDataFrame([], "y double, a double, b double"))


def test_steps_keep_only_what_they_need(spark, fitted):
    """A written forecast step holds the trailing values, not the series' other columns."""
    seen = []

    class Watched:
        stages = [type("Last", (), {"runs_in_workers": False})]

        def transform(self, df):
            seen.append(df.columns)
            return df.withColumn("prediction", F.col("lag1"))

    series = spark.sql("SELECT 's' AS unique_id, array(DATE'2024-01-01') AS dates, array(1D, 2D, 3D) AS values, DATE'2024-01-01' AS last_ds")
    out = predict_recursive(series, {"m": Watched()}, 2, "MS", FeatureSpec([1])).collect()
    assert [r["prediction"] for r in out] == [3.0, 3.0]
    assert all("dates" not in c and "values" not in c for c in seen)

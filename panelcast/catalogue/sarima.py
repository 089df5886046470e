"""Queries of the seasonal ARMA models: the tests for differences, one order stated in SQL, the forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.catalogue.models import _DEMAND, _LISTS, _SEASON, _forecast, demand_series
from panelcast.catalogue.registry import query
from panelcast.models import sarima

_STATISTIC = """
long_enough AS (
  SELECT unique_id, 0 AS seasonal, y FROM lists
  UNION ALL
  SELECT unique_id, 1, list_transform(range(13, n + 1), lambda i: y[i] - y[i - 12]) FROM lists WHERE n >= 36
),
centred_lists AS (
  SELECT unique_id, seasonal, len(y) AS n, list_transform(y, lambda v: v - list_avg(y)) AS e,
         CAST(floor(4 * pow(len(y) / 100.0, 0.25)) AS BIGINT) AS width
  FROM long_enough
),
walks AS (
  SELECT unique_id, seasonal, sum(s * s) AS squares FROM (
    SELECT unique_id, seasonal, sum(v) OVER (PARTITION BY unique_id, seasonal ORDER BY i) AS s
    FROM (SELECT unique_id, seasonal, unnest(e) AS v, unnest(range(1, n + 1)) AS i FROM centred_lists)
  ) GROUP BY 1, 2
),
statistics AS (
  SELECT c.unique_id, c.seasonal, squares / (n * greatest(
           list_dot_product(e, e) + 2 * coalesce(list_sum(list_transform(range(1, least(width, n - 1) + 1),
             lambda j: (1 - j / (width + 1.0)) * list_dot_product(e[j + 1:], e[:n - j]))), 0), 1e-12)) AS level
  FROM centred_lists c JOIN walks w ON w.unique_id = c.unique_id AND w.seasonal = c.seasonal
),
strengths AS (
  SELECT t.unique_id, CASE WHEN var_pop(y - trend) > 1e-12
           THEN greatest(1 - var_pop(y - trend - effect) / var_pop(y - trend), 0) ELSE 0 END AS strength
  FROM trended t JOIN effects f ON f.unique_id = t.unique_id AND pos = (t - 1) % 12 WHERE t.n >= 36 GROUP BY 1
)"""


@query(
    "sarima_differences",
    f"""
    WITH {_DEMAND}, {_SEASON}, {_STATISTIC}
    SELECT l.unique_id, CAST(l.n AS BIGINT) AS n, round(strength, 5) AS strength, round(p.level, 5) AS level_statistic,
           CAST(coalesce(strength, 0) > 0.64 AS BIGINT) AS seasonal,
           CAST(CASE WHEN strength > 0.64 THEN s.level ELSE p.level END > 0.463 AS BIGINT) AS d
    FROM lists l JOIN statistics p ON p.unique_id = l.unique_id AND p.seasonal = 0
    LEFT JOIN statistics s ON s.unique_id = l.unique_id AND s.seasonal = 1
    LEFT JOIN strengths ON strengths.unique_id = l.unique_id
    """,
)
def sarima_differences(spark, sf_dir):
    """Strength of the season, level statistic and the differences they call for."""
    y = F.col("values")
    rows = demand_series(spark, sf_dir).select(
        "unique_id",
        F.size(y).cast("bigint").alias("n"),
        F.when(F.size(y) >= 36, F.round(sarima.seasonal_strength(y, 12), 5)).alias("strength"),
        F.round(sarima.stationarity_statistic(y), 5).alias("level_statistic"),
        sarima.differences(y, 12).alias("f"),
    )
    return rows.select(
        "unique_id",
        "n",
        "strength",
        "level_statistic",
        F.col("f.seasonal").cast("bigint").alias("seasonal"),
        F.col("f.d").cast("bigint").alias("d"),
    )


def _determinant(a: list[list[str]]) -> str:
    (p, q, r), (s, t, u), (v, w, x) = a
    return f"({p} * ({t} * {x} - {u} * {w}) - {q} * ({s} * {x} - {u} * {v}) + {r} * ({s} * {w} - {t} * {v}))"


_COVARIANCES = [[f"c{min(i, j)}{max(i, j)}" for j in (1, 2, 3)] for i in (1, 2, 3)]


def _slope(column: int) -> str:
    replaced = [[f"c0{i + 1}" if j == column else v for j, v in enumerate(row)] for i, row in enumerate(_COVARIANCES)]
    return f"{_determinant(replaced)} / {_determinant(_COVARIANCES)}"


@query(
    "sarima_fit_1_0_1",
    f"""
    WITH {_DEMAND}, {_LISTS},
    means AS (SELECT unique_id, avg(y) AS mu FROM numbered GROUP BY unique_id),
    lags AS (
      SELECT n.unique_id, t, n, mu, y - mu AS z0, lag(y - mu, 1) OVER o AS z1, lag(y - mu, 2) OVER o AS z2,
             lag(y - mu, 3) OVER o AS z3
      FROM numbered n JOIN means m ON m.unique_id = n.unique_id WINDOW o AS (PARTITION BY n.unique_id ORDER BY t)
    ),
    moments AS (
      SELECT unique_id, avg(z0) AS m0, avg(z1) AS m1, avg(z2) AS m2, avg(z3) AS m3,
             {", ".join(f"covar_pop(z{i}, z{j}) AS c{i}{j}" for i in range(4) for j in range(i, 4) if j)}
      FROM lags WHERE t > 3 GROUP BY unique_id
    ),
    long_fit AS (
      SELECT *, {", ".join(f"{_slope(i)} AS b{i + 1}" for i in range(3))} FROM moments
      WHERE {_determinant(_COVARIANCES)} > 1e-9 * c11 * c22 * c33
    ),
    shocks AS (
      SELECT l.unique_id, t, n, mu, z0, z1, CASE WHEN t <= 3 THEN 0.0
               ELSE z0 - m0 - b1 * (z1 - m1) - b2 * (z2 - m2) - b3 * (z3 - m3) END AS e
      FROM lags l JOIN long_fit f ON f.unique_id = l.unique_id
    ),
    pairs AS (SELECT *, lag(e) OVER (PARTITION BY unique_id ORDER BY t) AS e1 FROM shocks),
    sums AS (
      SELECT unique_id, max(mu) AS mu, count(*) AS n, avg(z0) AS m0, avg(z1) AS m1, avg(e1) AS me, var_pop(z0) AS v0,
             var_pop(z1) AS v1, var_pop(e1) AS ve, covar_pop(z0, z1) AS c1, covar_pop(z0, e1) AS ce,
             covar_pop(z1, e1) AS cx
      FROM pairs WHERE t > 3 GROUP BY unique_id
    ),
    solved AS (
      SELECT *, (c1 * ve - ce * cx) / (v1 * ve - cx * cx) AS phi, (ce * v1 - c1 * cx) / (v1 * ve - cx * cx) AS theta
      FROM sums WHERE n > 5 AND v1 * ve - cx * cx > 1e-10 * v1 * ve
    ),
    stable AS (
      SELECT *, n * ln(greatest(v0 - phi * c1 - theta * ce, 1e-12)) + 8 + 40.0 / (n - 5) AS aicc
      FROM solved WHERE abs(phi) < 0.99 AND abs(theta) < 0.99
    )
    SELECT m.unique_id, s.unique_id IS NOT NULL AS identified, round(coalesce(aicc, 0), 4) AS aicc,
           round(coalesce(s.mu * (1 - phi) + m0 - phi * m1 - theta * me, m.mu), 4) AS c,
           round(coalesce(phi, 0), 4) AS phi, round(coalesce(theta, 0), 4) AS theta
    FROM means m LEFT JOIN stable s ON s.unique_id = m.unique_id
    """,
)
def sarima_fit_1_0_1(spark, sf_dir):
    """One lag and one innovation on the levels."""
    model = sarima.fit(F.col("values"), 1, [(1, 1, 0, 0)])
    rows = demand_series(spark, sf_dir).select("unique_id", model.alias("f"))
    return rows.select(
        "unique_id",
        (F.col("f.size") > 0).alias("identified"),
        F.round("f.aicc", 4).alias("aicc"),
        F.round("f.c", 4).alias("c"),
        F.round(F.col("f.phi")[0], 4).alias("phi"),
        F.round(F.col("f.theta")[0], 4).alias("theta"),
    )


@query("sarima_forecast")
def sarima_forecast(spark, sf_dir):
    """Twelve months of all demand series by their best orders; compared with plain numpy in ``tests/test_sarima.py``."""
    return _forecast(demand_series(spark, sf_dir), "sarima", digits=3)

"""Every registered query against its SQL on the same files."""

import pytest

import __spark_entry__ as entry
import oracle

# Boosters with all their rounds take minutes; the correctness run of the driver has them.
HEAVY = {"series_champion_full_job", "stats_audit", "lgbm_forecast", "xgb_forecast", "gb_forecast", "monthly_ml_job", "tree_predictions"}
# Queries of the optional corpus part have their own tests.
OPTIONAL = set(entry.corpus.queries()) if entry.corpus else set()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - HEAVY - OPTIONAL))
def test_matches_sql(spark, sf_dir, con, name):
    assert oracle.compare(entry.queries()[name](spark, sf_dir), con, entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql()) - HEAVY - OPTIONAL))
def test_gives_rows(spark, sf_dir, name):
    """All columns are computed; a count alone would prune them."""
    df = entry.queries()[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    assert not df.isEmpty()


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["unique_id", "sys_id", "ds", "Forecast", "Best_model_name"]
    assert df.count() > 0

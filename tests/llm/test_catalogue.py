"""Every registered query over the test tables, against its SQL where SQL can state it."""

import oracle
import pytest

from panelcast.llm import catalogue


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_matches_sql(spark, sf_dir, con, name):
    assert oracle.compare(catalogue.queries()[name](spark, sf_dir), con, catalogue.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_gives_a_row_per_input_row(spark, sf_dir, name):
    table = "pages" if name.startswith("op8") else "documents"
    n = spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
    rows = len(catalogue.queries()[name](spark, sf_dir).collect())
    assert 0 < rows <= n if name == "pipeline" else rows == n

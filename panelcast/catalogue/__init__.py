"""Named queries over the test tables, each with the SQL that states the same result."""

from panelcast.catalogue import evaluation, jobs, linear_jobs, machine, models, panels, preparation, sarima, sources, tables  # noqa: F401
from panelcast.catalogue.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]

"""Text rules: tenant keys, identifiers, model labels, metric column names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def tenant_of(unique_id: Column, delimiter: str) -> Column:
    """Text before the first literal ``delimiter`` (the whole id when it is absent)."""
    if not delimiter:
        raise ValueError("the id delimiter must not be empty")
    return F.split_part(unique_id, F.lit(delimiter), F.lit(1))


def is_identifier(name: Column) -> Column:
    return name.rlike("^[A-Za-z0-9_]+$")


def check_identifier(name: str, what: str = "identifier") -> str:
    if not re.fullmatch(r"[A-Za-z0-9_]+", name):
        raise ValueError(f"{what} may only hold letters, digits and underscores: {name!r}")
    return name


def normalize_model_name(label: Column) -> Column:
    """Base name of a model label: no outer blanks, no bracketed orders, one spelling of the fallback."""
    without_orders = F.regexp_replace(F.trim(label), r"^(G?ARCH) *\(.*$", "$1")
    return F.regexp_replace(without_orders, "^Naive_?Fallback$", "Naive_Fallback")


def metric_column(model: str, suffix: str = "RMSE") -> str:
    """Name of a model's column in the wide metric table, safe for any catalog."""
    return re.sub(r"[^a-zA-Z0-9_]", "_", f"{model}_{suffix}")

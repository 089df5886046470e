"""Forecasting models: per-series models as array expressions, global models on Spark ML."""

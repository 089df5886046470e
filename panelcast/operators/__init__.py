"""Relational operators on panels, predictions and metrics."""

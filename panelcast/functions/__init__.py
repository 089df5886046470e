"""Column-level building blocks: calendar, text, metric and array expressions."""

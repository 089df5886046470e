"""Panel forecasting and champion-model selection on Spark DataFrames."""

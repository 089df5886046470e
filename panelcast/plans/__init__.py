"""Training, forecasting and champion jobs composed from the operators."""

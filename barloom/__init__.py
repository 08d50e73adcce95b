"""Daily time-series features, model training, drift and batch scoring on Spark."""

"""Time-series features and forecast evaluation on Spark."""

"""Site-flow features, forecasting samples and forecast evaluation on Spark."""

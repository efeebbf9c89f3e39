"""Panel-forecasting analytics on Spark DataFrames: features, quality rules, metrics, dataset graph."""

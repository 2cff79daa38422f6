"""Market-trade analytics on Spark: DataFrame-in, DataFrame-out operators for tables and streams."""

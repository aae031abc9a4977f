"""Order analytics on Spark: bronze, silver and gold layers, a star schema and its checks."""

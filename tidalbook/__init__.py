"""Event-time market data, feature computation and corpus preparation on Spark."""

"""tallybook: multi-currency transaction quality and analytics on Spark."""

"""Point-in-time customer spend tables on Spark."""

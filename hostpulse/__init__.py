"""Access-log analytics on Spark: parse, roll up, score, flag and serve."""

"""Commerce analytics on Spark: load, check and report on five retail tables."""

"""opslog: operational-log analytics on Spark DataFrames."""
